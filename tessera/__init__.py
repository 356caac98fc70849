"""tessera: reusable analytics operators on PySpark DataFrames.

Every operator takes DataFrames plus parameters and returns a lazy
DataFrame; Catalyst plans it, Tungsten runs it. Sub-packages:

* ``sources``   - readers for the text formats and bindings of the test tables
* ``functions`` - column-expression helpers (Java split rule, hashing, text lines)
* ``operators`` - keyed aggregates, word counts, ranking, similarity, graph, ML, splits
* ``streaming`` - Structured Streaming jobs
* ``plans``     - the registered queries and their SQL oracles
"""

from tessera.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]

"""Operators of a training-data pipeline, one module each.

``catalog`` registers their queries and ``oracle`` holds their SQL. Nothing
outside this package imports it, except the guarded hook in
``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""

import sys

from pyspark import cloudpickle

# Task functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

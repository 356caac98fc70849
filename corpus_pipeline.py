"""A training corpus from the ``documents`` table, in five stages.

Each stage is ``f(spark, docs, sf_dir) -> DataFrame``, works on all rows its
predecessor kept, and is written as Parquet and read again before the next. All
but the last return the columns of ``documents``.

1. *Language*: documents whose language compression cannot tell go.
2. *Near duplicates*: of each group of documents linked by five-word runs at a
   similarity of 0.8, the one with the smallest id stays. Rows that share an id
   are documents of their own.
3. *Personal data*: spans are replaced by their kind.
4. *Mixing*: rows are repeated to the temperature weights of their sources,
   under the smallest budget that uses every document.
5. *Packing*: token sequences of 4096; one row per piece, as in
   ``tessera.llm.packing``. A document drawn twice is packed twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.catalog import tokenizer_json
from tessera.llm.common import cut, table
from tessera.llm.jaccard_join import jaccard_components
from tessera.llm.language import fit_dictionaries, keep_identified
from tessera.llm.mixing import draw_mixture
from tessera.llm.packing import pack_documents
from tessera.llm.pii import mask_pii


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs, fit_dictionaries(docs.select("doc_id", "text", "lang")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are told apart by a key of their own, written once, so only similarity
    decides which go: of each group the first row in the order of ids stays
    (rows without an id come last, rows of one id in the order of their keys),
    and two different texts under one id both stay. A row without words is
    linked with nothing and stays."""
    key = next(name for name in ("_row", *(f"_row{k}" for k in range(len(docs.columns)))) if name not in docs.columns)
    keyed = cut(docs.withColumn(key, F.monotonically_increasing_id()), "pipeline-keyed")
    groups = jaccard_components(keyed.select(F.col(key).alias("doc_id"), "text"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(key).alias("key"))
    first = keyed.select(key, "doc_id").join(groups.select(F.col("doc_id").alias(key), "component_id"), key).groupBy(
        "component_id").agg(F.min(order).alias("first")).select(F.col("first.key").alias(key))
    return keyed.join(first, key, "left_semi").drop(key)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = mask_pii(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return draw_mixture(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, tokenizer_json())


STAGES = [("language_id", language), ("ngram_jaccard_join", near_duplicates), ("pii", personal_data),
          ("source_mixing", mixing), ("packing", packing)]

# The language stage learns a model and the packing stage runs a tokenizer and a
# linear program: not SQL. tests/llm checks every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Readers for the plain-text inputs of the original programs.

Every reader declares its schema (no inference) so the scan can prune columns
and push filters, and numeric fields fail the job on bad input
(``mode=FAILFAST``), as the original parsers did by throwing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import java_split

PEOPLE_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("friends", T.IntegerType()),
])

RATINGS_SCHEMA = T.StructType([
    T.StructField("user", T.IntegerType()),
    T.StructField("item", T.IntegerType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("ts", T.LongType()),
])

USERS_SCHEMA = T.StructType([
    T.StructField("user", T.IntegerType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("occupation", T.StringType()),
    T.StructField("zip", T.StringType()),
])

STATION_SCHEMA = T.StructType([
    T.StructField("station", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("value", T.IntegerType()),
])

ORDERS_SCHEMA = T.StructType([
    T.StructField("customer", T.IntegerType()),
    T.StructField("item", T.IntegerType()),
    T.StructField("amount", T.FloatType()),
])

POINTS_SCHEMA = T.StructType([
    T.StructField("label", T.DoubleType()),
    T.StructField("feature", T.DoubleType()),
])


def _csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", **opts) -> DataFrame:
    reader = spark.read.schema(schema).option("sep", sep).option("header", "false").option("mode", "FAILFAST")
    for key, value in opts.items():
        reader = reader.option(key, value)
    return reader.csv(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line: ``value STRING``."""
    return spark.read.text(path)


def read_people(spark: SparkSession, path: str) -> DataFrame:
    """``id,name,age,friends`` without header (CRLF is handled by the csv reader)."""
    return _csv(spark, path, PEOPLE_SCHEMA)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``user item rating ts``."""
    return _csv(spark, path, RATINGS_SCHEMA, sep="\t")


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated ``user|age|gender|occupation|zip`` (zip stays a string)."""
    return _csv(spark, path, USERS_SCHEMA, sep="|")


def read_titles(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """Pipe-separated item file: field 0 is the id, field 1 the title.

    Lines with a single field are dropped. The file is Latin-1, so decoding it
    as such keeps accented titles intact instead of replacing bytes.
    """
    raw = (spark.read.option("sep", "\u0000").option("header", "false").option("quote", "")
           .option("encoding", encoding).schema("value STRING").csv(path))
    fields = java_split(F.col("value"), r"\|")
    return (raw.select(fields.alias("f"))
               .filter(F.size("f") > 1)
               .select(F.trim(F.col("f")[0]).cast("int").alias("id"), F.col("f")[1].alias("title")))


GENRES = 19  # flags at the end of a line of the item file


def parse_genres(lines: DataFrame, col: str = "value", first: int = 5, flags: int = GENRES) -> DataFrame:
    """Pipe rows of the item file to ``(id, title, genres)``: field 0 is the id,
    field 1 the title, and the ``flags`` fields from number ``first`` on are 0 or
    1; ``genres`` has bit k set if the k-th is 1. Lines with a single field are
    dropped, as in ``read_titles``; missing flags count as 0."""
    fields = java_split(F.col(col), r"\|")
    mask = F.lit(0).cast("long")
    for k in range(flags):
        mask = mask.bitwiseOR(F.when(F.get("f", F.lit(first + k)) == "1", F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
    return (lines.select(fields.alias("f")).filter(F.size("f") > 1)
                 .select(F.trim(F.col("f")[0]).cast("long").alias("id"), F.col("f")[1].alias("title"), mask.alias("genres")))


def read_genres(spark: SparkSession, path: str, flags: int = GENRES) -> DataFrame:
    return parse_genres(read_text(spark, path), flags=flags)


def read_station_readings(spark: SparkSession, path: str) -> DataFrame:
    """``station,date,type,value[,...]`` weather readings."""
    return _csv(spark, path, STATION_SCHEMA)


def read_customer_orders(spark: SparkSession, path: str) -> DataFrame:
    """``customer,item,amount`` order lines (amount is a 32-bit float, as parsed originally)."""
    return _csv(spark, path, ORDERS_SCHEMA)


def read_labeled_points(spark: SparkSession, path: str) -> DataFrame:
    """``label,feature`` pairs."""
    return _csv(spark, path, POINTS_SCHEMA)


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """One word per line: ``word STRING``."""
    return spark.read.text(path).select(F.col("value").alias("word"))


def adjacency_to_edges(lines: DataFrame, col: str = "value") -> DataFrame:
    """Whitespace-separated adjacency lines ``id n1 n2 ...`` to an edge table.

    A vertex may span several lines; every line contributes its own edges, so
    parallel edges are kept. Returns ``src BIGINT, dst BIGINT``.
    """
    tokens = F.split(F.trim(F.col(col)), r"\s+")
    parsed = lines.select(tokens.alias("t")).filter(F.col("t")[0] != "")
    return parsed.select(
        F.col("t")[0].cast("long").alias("src"),
        F.explode(F.slice("t", 2, F.size("t") - 1)).alias("dst_s"),
    ).select("src", F.col("dst_s").cast("long").alias("dst"))


def adjacency_line_counts(lines: DataFrame, col: str = "value") -> DataFrame:
    """Per line: ``(id, connections)`` where connections = tokens - 1."""
    tokens = F.split(F.trim(F.col(col)), r"\s+")
    return (lines.select(tokens.alias("t")).filter(F.col("t")[0] != "")
                 .select(F.col("t")[0].cast("long").alias("id"),
                         (F.size("t") - 1).cast("long").alias("connections")))


def read_adjacency(spark: SparkSession, path: str) -> DataFrame:
    return adjacency_to_edges(read_text(spark, path))


def parse_quoted_names(lines: DataFrame, col: str = "value", id_below: int | None = None) -> DataFrame:
    """``id "NAME"`` lines to ``(id BIGINT, name STRING)``.

    Split on the double quote with Java rules; lines yielding fewer than two
    fields are dropped. ``id_below`` keeps only ids under a cutoff (the graph
    program's intent: ids at or above it are not real vertices).
    """
    fields = java_split(F.col(col), '"')
    out = (lines.select(fields.alias("f")).filter(F.size("f") > 1)
                .select(F.trim(F.col("f")[0]).cast("long").alias("id"), F.col("f")[1].alias("name")))
    if id_below is not None:
        out = out.filter(F.col("id") < F.lit(id_below))
    return out


def read_quoted_names(spark: SparkSession, path: str, id_below: int | None = None) -> DataFrame:
    return parse_quoted_names(read_text(spark, path), id_below=id_below)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines with a declared schema (named as an alternative input in the SQL examples)."""
    return spark.read.schema(schema).json(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or temp view."""
    return spark.table(name)


def read_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-based streaming source (any Structured Streaming source fits the jobs)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)

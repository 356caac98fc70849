"""Tables in the text formats of the original programs, written and read back.

``write_*`` put a table into a folder in one format; the readers of
``tessera.sources.readers`` read them. ``checked_rows`` reads delimited lines
into typed rows and gives the lines that do not fit as a table of their own,
instead of failing the job at the first one.

The files lie in folders of the shared checkpoint directory and are written and
read by tasks. A vertex's neighbours are dealt over lines of bounded length, so
no line gathers all edges of a frequent vertex.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch_path

LINE_NEIGHBOURS = 200  # about as many neighbours stand on one adjacency line
_BAD = "_line_that_does_not_fit"


@dataclass(frozen=True)
class Checked:
    """Typed rows, and the lines that do not fit the schema (``value``)."""

    rows: DataFrame
    bad: DataFrame


def checked_rows(lines: DataFrame, schema: T.StructType, sep: str = ",", col: str = "value") -> Checked:
    """``lines`` parsed by ``schema``. A line fits if it has as many fields as the
    schema and each can be read as its type; an empty field is null; an empty
    line is neither a row nor bad, as in the original loaders."""
    extended = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    parsed = lines.filter(F.length(F.col(col)) > 0).select(
        F.col(col).alias("value"),
        F.from_csv(F.col(col), extended.simpleString()[7:-1].replace(":", " "),
                   {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD, "quote": "\u0000",
                    "ignoreLeadingWhiteSpace": "false"}).alias("row"))
    fits = F.col(f"row.{_BAD}").isNull()
    return Checked(parsed.filter(fits).select(*(F.col(f"row.{f.name}").alias(f.name) for f in schema.fields)),
                   parsed.filter(~fits).select("value"))


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> str:
    """One line per row, its columns joined by ``sep``. Columns must hold no
    ``sep`` or line end; nulls are empty fields."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(sep, *fields).alias("value")).write.text(path)
    return path


def write_adjacency(edges: DataFrame, path: str, per_line: int = LINE_NEIGHBOURS) -> str:
    """Lines ``src dst dst ...``: each vertex has as many lines as its edges need
    at about ``per_line`` neighbours each; many parallel edges are dealt over
    several lines too."""
    size = F.lit(int(per_line)).cast("long")
    e = edges.groupBy(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst")).agg(
        F.count(F.lit(1)).alias("n"))
    lines = e.groupBy("src").agg(F.ceil(F.sum("n") / size).cast("long").alias("lines"))
    pieces = e.join(lines, "src").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / size))))
    copies = F.least(size, F.col("n") - F.col("piece") * size).cast("int")
    line = F.pmod(F.xxhash64("dst", "piece"), F.col("lines"))
    grouped = pieces.withColumn("to", F.concat_ws(" ", F.array_repeat(F.col("dst").cast("string"), copies))).groupBy(
        "src", line.alias("line")).agg(F.concat_ws(" ", F.collect_list("to")).alias("to"))
    grouped.select(F.concat_ws(" ", F.col("src").cast("string"), "to").alias("value")).write.text(path)
    return path


def write_quoted_names(names: DataFrame, path: str) -> str:
    """Lines ``id "NAME"``."""
    names.select(F.concat(F.col("id").cast("string"), F.lit(' "'), F.col("name"), F.lit('"')).alias("value")).write.text(path)
    return path


def write_titles(titles: DataFrame, path: str, flags: int = 19) -> str:
    """Pipe rows ``id|title|date|video date|address|flag|...``: an item's genres
    as ``flags`` fields of 0 or 1. ``titles``: ``id, title, genres`` (a bit mask)."""
    bits = [F.getbit(F.col("genres"), F.lit(k)).cast("string") for k in range(flags)]
    empty = [F.lit("")] * 3
    titles.select(F.concat_ws("|", F.col("id").cast("string"), "title", *empty, *bits).alias("value")).write.text(path)
    return path


def round_trip(spark: SparkSession, name: str) -> str:
    """A fresh folder of the shared checkpoint directory for one text table."""
    return scratch_path(spark, f"text-{name}")

"""Sinks: results are DataFrames; these write them out (the original kept a
commented-out text-file save of the similarity table)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import create_empty, delete_path, names_in


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None) -> None:
    """Write a result as parquet/csv/json/orc, optionally partitioned by columns."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_text_lines(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """One text line per row: the columns joined by ``sep`` (the text-file
    form of a tuple RDD save)."""
    line = F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns]).alias("value")
    df.select(line).write.mode(mode).text(path)


def write_epoch(df: DataFrame, path: str, epoch: int, col: str = "batch") -> None:
    """Idempotent micro-batch output for ``foreachBatch``: each epoch
    overwrites its own folder ``{col}={epoch}``. ``foreachBatch`` is
    at-least-once, so an epoch replayed after a failure replaces its earlier
    output instead of appending a second copy. Reading the sink folder adds
    ``col`` back as a partition column."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{col}={int(epoch)}")


# --- committed epochs ----------------------------------------------------------
# A reader must not see an epoch whose files are only partly written, nor scan all
# epochs to find the newest. So an epoch counts from when an empty file named
# after it stands in the manifest folder, which the writer adds last.

MANIFEST = "_epochs"  # Spark's readers pass over names that begin so


def _epoch_path(path: str, epoch: int, col: str = "batch") -> str:
    return f"{path.rstrip('/')}/{col}={int(epoch)}"


def commit_epoch(df: DataFrame, path: str, epoch: int, keep: int | None = None) -> None:
    """``write_epoch``, then list the epoch in the manifest. A job that is killed
    before the listing leaves files that no reader takes; the replayed epoch
    overwrites them. ``keep`` deletes all but the newest so many listed epochs
    afterwards (for results that each hold everything so far)."""
    spark = df.sparkSession
    write_epoch(df, path, epoch)
    create_empty(spark, f"{path.rstrip('/')}/{MANIFEST}/{int(epoch):019d}")
    if keep is not None:
        for old in committed_epochs(spark, path)[:-keep]:
            # First from the manifest, so no reader is sent to files that are going.
            delete_path(spark, f"{path.rstrip('/')}/{MANIFEST}/{old:019d}")
            delete_path(spark, _epoch_path(path, old))


def committed_epochs(spark: SparkSession, path: str) -> list[int]:
    return [int(name) for name in names_in(spark, f"{path.rstrip('/')}/{MANIFEST}")]


def read_epochs(spark: SparkSession, path: str, epochs: Sequence[int], schema: str) -> DataFrame:
    """Rows of the given epochs, with their number as ``batch``."""
    if not epochs:
        return spark.createDataFrame([], schema + ", batch int")
    paths = [_epoch_path(path, e) for e in epochs]
    return spark.read.option("basePath", path).schema(schema + ", batch int").parquet(*paths)

"""A table replayed as a stream, one micro-batch after another.

The rows are dealt into numbered epochs by an expression (an event time, an id
range), written once, and published epoch by epoch: a rename moves an epoch's
files into the folder that a file stream watches. A streaming query that runs
on all available files after each publication makes one micro-batch of each
epoch, in order, and resumes from its checkpoint in between, as a job does that
is stopped and started again. Nothing passes through the driver but names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import delete_path, is_directory, make_directory, rename_path, scratch_path

EPOCH = "epoch"


def even_epochs(df: DataFrame, value: Column, epochs: int) -> Column:
    """Epoch of each row when the range of ``value`` (a whole number) is cut into
    ``epochs`` parts of one length. Rows without a value are in the first."""
    ends = df.agg(F.min(value), F.max(value)).first()
    low, high = (0 if v is None else int(v) for v in ends)
    return F.coalesce(F.floor((value - F.lit(low)) * F.lit(epochs) / F.lit(high - low + 1)), F.lit(0)).cast("int")


class Replay:
    """``df`` staged by epoch. ``stream`` is the source; ``publish`` adds the next
    epoch to it; ``run`` publishes all, calling ``job(stream)`` after each."""

    def __init__(self, df: DataFrame, epoch: Column, epochs: int) -> None:
        self.spark, self.epochs, self.published = df.sparkSession, int(epochs), 0
        self.staged, self.source = (scratch_path(self.spark, f"replay-{x}") for x in ("staged", "source"))
        df.withColumn(EPOCH, epoch).write.partitionBy(EPOCH).parquet(self.staged)
        make_directory(self.spark, self.source)
        self.columns = df.columns
        self.schema = T.StructType([*df.schema.fields, T.StructField(EPOCH, T.IntegerType())])

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.schema).parquet(self.source).select(*self.columns)

    def publish(self) -> int | None:
        """Make the next epoch's files visible; its number, or None after the last.
        An epoch without rows is published as nothing."""
        if self.published >= self.epochs:
            return None
        name = f"{EPOCH}={self.published}"
        if is_directory(self.spark, f"{self.staged}/{name}"):
            rename_path(self.spark, f"{self.staged}/{name}", f"{self.source}/{name}")
        self.published += 1
        return self.published - 1

    def run(self, job: Callable[[DataFrame], str]) -> str:
        """Publish every epoch and call ``job`` on the stream after each; what the
        last call returned."""
        out = None
        while self.publish() is not None:
            out = job(self.stream())
        return out

    def drop(self) -> None:
        for path in (self.staged, self.source):
            delete_path(self.spark, path)


def replayed(df: DataFrame, value: Column, epochs: int, job: Callable[[DataFrame], str]) -> str:
    """Run ``job`` over ``df`` as a stream of ``epochs`` micro-batches in the order
    of ``value``, and delete the staged files."""
    replay = Replay(df, even_epochs(df, value, epochs), epochs)
    try:
        return replay.run(job)
    finally:
        replay.drop()


"""Structured Streaming jobs over a stream of ``(ts, text)`` statuses.

* ``top_lengths``: per micro-batch, the 10 longest texts (what the original
  job does: it prints text lengths sorted descending every second). A sort
  on a raw stream is not allowed, so it runs inside ``foreachBatch``.
* ``hashtag_counts``: hashtag counts per sliding event-time window (the job's
  stated purpose: 5-minute window, 1-second slide) with a watermark that
  bounds state; the top k per window is taken in ``foreachBatch`` once a
  window is final (append mode emits each window exactly once).
* ``allowed_words``: per micro-batch, the most frequent words that are not on a
  list, which is read again for each batch.

The counting is two-staged: hashtags are first counted per 1-second bucket,
then buckets become windows: entry and exit deltas and running sums, so no
status or bucket is copied into its ``window/slide`` windows. In append mode
Spark's state holds the buckets that the watermark has not passed; buckets that
it has passed are final, and those of the last window length are carried to the
next micro-batch, so a window is complete when the watermark passes its end. Both
are bounded by window and watermark, whatever the length of the stream. In complete
mode all buckets are state and each micro-batch makes all windows anew. All
forms give the same counts.

Sinks write parquet to a folder under the shared checkpoint folder; the
streaming checkpoint (offsets, state) lives there too, so a restarted query
resumes where it stopped. Outputs go to one folder per epoch, overwritten on
replay, so a batch re-run after a failure is not duplicated, and an epoch counts
once it is listed (``tessera.sources.sinks``).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.text import hashtags
from tessera.sources.readers import read_stop_words
from tessera.sources.sinks import commit_epoch, committed_epochs, read_epochs
from tessera.session import partitions_for, scratch_path


def _seconds(duration: str) -> int:
    num, unit = duration.split()
    scale = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600}[unit]
    return int(num) * scale


def tags_of(statuses: DataFrame, ts: str = "ts", text: str = "text") -> DataFrame:
    return statuses.select(F.col(ts).alias("ts"), F.explode(hashtags(F.col(text))).alias("hashtag"))


def bucket_counts(statuses: DataFrame, slide: str = "1 second", ts: str = "ts", text: str = "text") -> DataFrame:
    """``(b, hashtag, c)``: occurrences per slide-long bucket ``b``. Works on
    batch and streaming statuses."""
    return (tags_of(statuses, ts, text).groupBy(F.window("ts", slide).alias("b"), "hashtag")
            .agg(F.count(F.lit(1)).alias("c")))


def hashtag_window_counts(statuses: DataFrame, window: str = "5 minutes", slide: str = "1 second",
                          ts: str = "ts", text: str = "text", chunk_windows: int = 12) -> DataFrame:
    """Batch form: ``(window_start, window_end, hashtag, count)`` for every
    sliding window containing at least one occurrence."""
    return window_counts(bucket_counts(statuses, slide, ts, text), window, slide, chunk_windows)


EXPANDED_BYTES = 8 << 20  # input whose windows one task makes


def window_counts(per_bucket: DataFrame, window: str = "5 minutes", slide: str = "1 second",
                  chunk_windows: int = 12) -> DataFrame:
    """Sliding-window counts from ``bucket_counts``.

    Positions are counted in slides. A bucket ``b`` with ``c`` occurrences lies
    in the windows starting at ``b - copies + 1 .. b``, so it adds ``+c`` at
    ``b - copies + 1`` and ``-c`` at ``b + 1``; the running sum of these
    deltas in position order is the count of every window start up to the next
    delta. The deltas are grouped by (hashtag, chunk of ``chunk_windows``
    window lengths); a bucket is sent to the one or two chunks its window
    starts fall in, so a group never needs another group's rows and holds at
    most a few rows per slide of its chunk, however hot the tag. Each
    constant-count segment is then exploded into its window starts: exactly
    one row per output row, no copies to aggregate.
    """
    w, s = _seconds(window), _seconds(slide)
    if w % s:
        raise ValueError("window must be a multiple of the slide")
    copies = w // s
    span = copies * max(1, int(chunk_windows))  # chunk length in slides, >= copies
    bi = F.floor(F.unix_seconds(F.col("b.start")) / F.lit(s))
    first = F.col("bi") - F.lit(copies - 1)
    routed = per_bucket.select("hashtag", "c", bi.alias("bi")).select(
        "hashtag", "c", "bi",
        F.explode(F.array_distinct(F.array(F.floor(first / F.lit(span)), F.floor(F.col("bi") / F.lit(span)))))
         .alias("chunk"))
    deltas = routed.select("hashtag", "chunk", F.explode(F.array(
        F.struct(first.alias("pos"), F.col("c").alias("d")),
        F.struct((F.col("bi") + 1).alias("pos"), (-F.col("c")).alias("d")))).alias("e")
    ).select("hashtag", "chunk", "e.pos", "e.d")
    # The delta table is small but expands into the output next: an explicit
    # partition count keeps AQE from coalescing it into one task. It follows the
    # bytes that are read, as a bucket becomes a row per window.
    deltas = deltas.repartition(partitions_for(per_bucket, EXPANDED_BYTES), "hashtag", "chunk")
    order = Window.partitionBy("hashtag", "chunk").orderBy("pos")
    seg = deltas.select(
        "hashtag", "chunk", "pos",
        F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("n"),
        F.lead("pos").over(order).alias("nxt"))
    lo = F.greatest(F.col("pos"), F.col("chunk") * F.lit(span))
    hi = F.least(F.col("nxt"), (F.col("chunk") + 1) * F.lit(span))
    starts = (seg.filter((F.col("n") > 0) & (hi > lo))
                 .select("hashtag", F.col("n").alias("count"), F.explode(F.sequence(lo, hi - 1)).alias("wi")))
    window_start = F.timestamp_seconds(F.col("wi") * F.lit(s))
    return starts.select(window_start.alias("window_start"),
                         (window_start + F.expr(f"INTERVAL {w} SECONDS")).alias("window_end"),
                         "hashtag", "count")


def top_per_window(counts: DataFrame, k: int = 10) -> DataFrame:
    """Keep the k most frequent hashtags of each window (ties: hashtag asc)."""
    w = Window.partitionBy("window_start").orderBy(F.col("count").desc(), F.col("hashtag").asc())
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= F.lit(k))


def hashtag_top_windows(statuses: DataFrame, window: str = "5 minutes", slide: str = "1 second",
                        k: int = 10) -> DataFrame:
    """Batch form of the whole job."""
    return top_per_window(hashtag_window_counts(statuses, window, slide), k)


def tags_with_watermark(statuses: DataFrame, watermark: str) -> DataFrame:
    return statuses.withWatermark("ts", watermark)


def epoch_watermark(spark: SparkSession, checkpoint: str, epoch: int) -> int:
    """The watermark (epoch milliseconds) that held in a micro-batch, which Spark
    notes in the stream's offset log before it runs the batch."""
    for row in spark.read.text(f"{checkpoint}/offsets/{int(epoch)}").collect():  # a few lines
        if "batchWatermarkMs" in row["value"]:
            return int(json.loads(row["value"])["batchWatermarkMs"])
    return 0


def _run(spark: SparkSession, result: DataFrame, sink, out_path: str, output_mode: str, schema: str,
         available_now: bool, trigger_seconds: int, timeout: float | None) -> str:
    """Start ``result`` with ``sink`` per micro-batch and wait. A stream without
    any batch leaves an empty result, so the folder can always be read."""
    writer = (result.writeStream.outputMode(output_mode).foreachBatch(sink)
                    .option("checkpointLocation", out_path + "-checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=f"{trigger_seconds} seconds")
    query = writer.start()
    if not query.awaitTermination(timeout) and timeout is not None:
        query.stop()
    if not committed_epochs(spark, out_path):
        commit_epoch(spark.createDataFrame([], schema), out_path, 0)
    return out_path


def latest(spark: SparkSession, out_path: str) -> DataFrame:
    """The newest committed epoch of a complete-mode sink, without its ``batch``
    column. Only that epoch's files are read."""
    newest = committed_epochs(spark, out_path)[-1]
    return spark.read.parquet(f"{out_path}/batch={newest}")


def every_epoch(spark: SparkSession, out_path: str, schema: str) -> DataFrame:
    """The rows of all committed epochs of a sink, with their ``batch``."""
    return read_epochs(spark, out_path, committed_epochs(spark, out_path), schema)


BUCKET_SCHEMA = "b struct<start:timestamp,end:timestamp>, hashtag string, c long"
LENGTH_SCHEMA = "rank int, length int"
WORD_SCHEMA = "word string, count long, rank int"
WINDOW_SCHEMA = "window_start timestamp, window_end timestamp, hashtag string, count long, rank int"


def run_hashtag_stream(spark: SparkSession, statuses: DataFrame, out_path: str | None = None,
                       window: str = "5 minutes", slide: str = "1 second", watermark: str = "10 minutes",
                       k: int = 10, output_mode: str = "append", available_now: bool = True,
                       trigger_seconds: int = 1, timeout: float | None = None) -> str:
    """Start the hashtag job; returns the sink folder (parquet, one folder per
    epoch).

    ``append``: each window once, when the watermark has passed its end. The
    final buckets of the last window length are kept beside the sink, one table
    per epoch of which the newest two stay, and meet the next epoch's.
    ``complete``: the state holds the count of every bucket; each micro-batch
    turns all of them into windows and writes the whole result as its epoch
    (``latest`` reads the newest), so a reader never sees a half-written one.
    """
    out_path = out_path or scratch_path(spark, "hashtags-out")
    if output_mode == "complete":
        counts = bucket_counts(statuses, slide)
    else:
        counts = bucket_counts(tags_with_watermark(statuses, watermark), slide)
    carry, length = out_path + "-buckets", _seconds(window)

    def all_windows(batch: DataFrame, epoch: int) -> None:
        commit_epoch(top_per_window(window_counts(batch, window, slide), k), out_path, epoch, keep=1)

    def final_windows(batch: DataFrame, epoch: int) -> None:
        # An epoch that runs again reads what the ones before it left, so it gives the same.
        before = [e for e in committed_epochs(spark, carry) if e < epoch][-1:]
        carried = read_epochs(spark, carry, before, BUCKET_SCHEMA).drop("batch")
        batch.persist()
        try:
            now = epoch_watermark(spark, out_path + "-checkpoint", epoch) // 1000
            then = epoch_watermark(spark, out_path + "-checkpoint", before[0]) // 1000 if before else 0
            buckets = carried.unionByName(batch.select("b", "hashtag", "c"))
            end = F.unix_seconds("window_end")  # complete now, and not before
            windows = window_counts(buckets, window, slide).filter((end > F.lit(then)) & (end <= F.lit(now)))
            buckets = buckets.filter(F.unix_seconds("b.end") > F.lit(now - length))
            commit_epoch(top_per_window(windows, k), out_path, epoch)
            commit_epoch(buckets, carry, epoch, keep=2)
        finally:
            batch.unpersist()

    sink = all_windows if output_mode == "complete" else final_windows

    return _run(spark, counts, sink, out_path, output_mode, WINDOW_SCHEMA, available_now, trigger_seconds, timeout)


def run_top_lengths_stream(spark: SparkSession, statuses: DataFrame, out_path: str | None = None, k: int = 10,
                           text: str = "text", available_now: bool = True, trigger_seconds: int = 1,
                           timeout: float | None = None) -> str:
    """Per micro-batch: the k largest text lengths, descending. Returns the
    sink folder with ``(batch, rank, length)``."""
    out_path = out_path or scratch_path(spark, "lengths-out")
    lengths = statuses.select(F.length(F.col(text)).alias("length"))

    def sink(batch: DataFrame, epoch: int) -> None:
        top = batch.orderBy(F.col("length").desc()).limit(k)
        ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("length").desc())))
        commit_epoch(ranked.select("rank", "length"), out_path, epoch)

    return _run(spark, lengths, sink, out_path, "append", LENGTH_SCHEMA, available_now, trigger_seconds, timeout)


WHITESPACE = "[ \t\n\r\f]+"


def run_allowed_words(spark: SparkSession, statuses: DataFrame, banned_path: str, out_path: str | None = None,
                      k: int = 10, text: str = "text", available_now: bool = True, trigger_seconds: int = 1,
                      timeout: float | None = None) -> str:
    """Per micro-batch: the k most frequent words of its statuses that the word
    file ``banned_path`` (one word a line) does not list. The file is read for
    each batch, so a changed list holds from the next batch on. Returns the
    sink folder with ``(batch, word, count, rank)``."""
    out_path = out_path or scratch_path(spark, "allowed-out")
    words = statuses.select(F.explode(F.split(F.lower(F.col(text)), WHITESPACE)).alias("word")).filter(F.col("word") != "")

    def sink(batch: DataFrame, epoch: int) -> None:
        # A new reader lists the file again; counts are few next to words, so the list meets those.
        counts = batch.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
        banned = read_stop_words(spark, banned_path).select(F.lower(F.trim("word")).alias("word")).distinct()
        order = [F.col("count").desc(), F.col("word").asc()]
        top = counts.join(banned, "word", "left_anti").orderBy(*order).limit(k)
        commit_epoch(top.withColumn("rank", F.row_number().over(Window.orderBy(*order))), out_path, epoch)

    return _run(spark, words, sink, out_path, "append", WORD_SCHEMA, available_now, trigger_seconds, timeout)


def word_running_counts(statuses: DataFrame, text: str = "text") -> DataFrame:
    """Running count per whitespace-separated word (a stateful aggregation:
    one state row per distinct word)."""
    words = statuses.select(F.explode(F.split(F.col(text), WHITESPACE)).alias("word")).filter(F.col("word") != "")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def running_avg_length(statuses: DataFrame, text: str = "text") -> DataFrame:
    """Running average text length (one state row)."""
    return statuses.agg(F.avg(F.length(F.col(text))).alias("avg_length"), F.count(F.lit(1)).alias("n"))


def run_running_aggregate(spark: SparkSession, result: DataFrame, out_path: str | None = None,
                          k: int | None = None, order=None, available_now: bool = True, trigger_seconds: int = 1,
                          timeout: float | None = None, name: str = "running") -> str:
    """Run a stateful running aggregation in complete mode; each micro-batch
    writes the current result (optionally its top k) as its epoch. Returns the
    sink folder; ``latest`` reads the newest epoch."""
    out_path = out_path or scratch_path(spark, name + "-out")

    def sink(batch: DataFrame, epoch: int) -> None:
        commit_epoch(batch.orderBy(*order).limit(k) if k else batch, out_path, epoch, keep=1)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in result.schema.fields)
    return _run(spark, result, sink, out_path, "complete", schema, available_now, trigger_seconds, timeout)


def run_popular_words(spark: SparkSession, statuses: DataFrame, k: int = 10, **kw) -> str:
    """The k most frequent words so far (ties: word ascending)."""
    return run_running_aggregate(spark, word_running_counts(statuses), k=k,
                                 order=[F.col("count").desc(), F.col("word").asc()], name="popular-words", **kw)


def run_avg_length(spark: SparkSession, statuses: DataFrame, **kw) -> str:
    """The running average text length."""
    return run_running_aggregate(spark, running_avg_length(statuses), name="avg-length", **kw)

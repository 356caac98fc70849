import datetime as dt
import math
import os

from pyspark.sql import functions as F

from conftest import rows
from tessera.session import scratch_path
from tessera.streaming import jobs


def _statuses(spark):
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    data = [
        (base + dt.timedelta(seconds=0), "#a hello #b"),
        (base + dt.timedelta(seconds=0.5), "#a"),
        (base + dt.timedelta(seconds=30), "no tags here"),
        (base + dt.timedelta(seconds=200), "#b #b"),
        (base + dt.timedelta(seconds=900), "#c"),
        (base + dt.timedelta(seconds=100), "#a late"),
    ]
    return spark.createDataFrame(data, "ts timestamp, text string")


def brute(statuses, window_s, slide_s):
    import re

    counts = {}
    for ts, text in statuses:
        t = math.floor(ts.replace(tzinfo=dt.timezone.utc).timestamp())
        for tag in re.findall(r"#\w+", text):
            first = (t // slide_s) * slide_s - window_s + slide_s
            for start in range(first, t + 1, slide_s):
                counts[(start, tag)] = counts.get((start, tag), 0) + 1
    return counts


def test_batch_window_counts_match_brute_force(spark):
    s = _statuses(spark)
    got = {(r["ws"], r["hashtag"]): r["count"] for r in jobs.hashtag_window_counts(s, "5 minutes", "1 minute")
           .select(F.unix_seconds("window_start").alias("ws"), "hashtag", "count").collect()}
    want = brute([(r["ts"], r["text"]) for r in s.collect()], 300, 60)
    assert got == want


def test_window_counts_dense_across_chunks_match_brute_force(spark):
    """A hot tag in every second, bursts, gaps and negative epochs; chunks as
    short as one window so most windows straddle a chunk boundary."""
    import random

    rnd = random.Random(7)
    base = dt.datetime(1969, 12, 31, 23, 50, 0)
    data = [(base + dt.timedelta(seconds=i), "#hot") for i in range(0, 1500)]
    data += [(base + dt.timedelta(seconds=rnd.randrange(0, 3000), milliseconds=rnd.randrange(1000)),
              rnd.choice(["#a", "#b #a", "#b", "none"])) for _ in range(400)]
    data += [(base + dt.timedelta(seconds=2200), "#burst")] * 50
    s = spark.createDataFrame(data, "ts timestamp, text string")
    want = brute([(r["ts"], r["text"]) for r in s.collect()], 300, 1)
    for chunk_windows in (1, 2, 12):
        got = {(r["ws"], r["hashtag"]): r["count"] for r in
               jobs.hashtag_window_counts(s, "5 minutes", "1 second", chunk_windows=chunk_windows)
               .select(F.unix_seconds("window_start").alias("ws"), "hashtag", "count").collect()}
        assert got == want, chunk_windows


def test_streaming_equals_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    _statuses(spark).write.parquet(src)
    stream = spark.readStream.schema("ts timestamp, text string").parquet(src)
    out = jobs.run_hashtag_stream(spark, stream, window="5 minutes", slide="1 minute", watermark="1 hour",
                                  k=10, output_mode="complete")
    streamed = rows(jobs.latest(spark, out).select(F.unix_seconds("window_start"), "hashtag", "count", "rank"))
    batch = rows(jobs.hashtag_top_windows(spark.read.parquet(src), "5 minutes", "1 minute", 10)
                 .select(F.unix_seconds("window_start"), "hashtag", "count", "rank"))
    assert streamed == batch


def test_streaming_append_emits_only_final_windows(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    _statuses(spark).write.parquet(src)
    stream = spark.readStream.schema("ts timestamp, text string").parquet(src)
    out = jobs.run_hashtag_stream(spark, stream, window="5 minutes", slide="1 minute", watermark="1 minute",
                                  k=10, output_mode="append")
    batch = rows(jobs.hashtag_top_windows(spark.read.parquet(src), "5 minutes", "1 minute", 10)
                 .select(F.unix_seconds("window_start"), "hashtag", "count", "rank"))
    streamed = rows(spark.read.parquet(out).select(F.unix_seconds("window_start"), "hashtag", "count", "rank"))
    # The last status is at second 900 and the watermark a minute behind it:
    # the windows that end by second 840 are final, the later ones are held back.
    start = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp())
    assert streamed == [r for r in batch if r[0] + 300 <= start + 840] and streamed
    assert [r for r in batch if r[1] == "#c"] and not [r for r in streamed if r[1] == "#c"]


def test_stream_restarts_where_it_stopped(spark, tmpdir_path):
    """A second run over the same checkpoint reads only the new file."""
    src, out = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "out")
    schema = "text string"
    spark.createDataFrame([("abc",), ("a",)], schema).coalesce(1).write.parquet(src)
    jobs.run_top_lengths_stream(spark, spark.readStream.schema(schema).parquet(src), out_path=out, k=5)
    spark.createDataFrame([("abcdef",)], schema).coalesce(1).write.mode("append").parquet(src)
    jobs.run_top_lengths_stream(spark, spark.readStream.schema(schema).parquet(src), out_path=out, k=5)
    assert rows(spark.read.parquet(out), "batch", "rank", "length") == [(0, 1, 3), (0, 2, 1), (1, 1, 6)]


def test_processing_time_trigger(spark, tmpdir_path):
    src, out = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "out")
    spark.createDataFrame([("abc",), ("a",)], "text string").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("text string").parquet(src)
    jobs.run_top_lengths_stream(spark, stream, out_path=out, k=5, available_now=False, trigger_seconds=1, timeout=15)
    assert rows(spark.read.parquet(out), "rank", "length") == [(1, 3), (2, 1)]


def test_streams_over_tables_of_several_files(spark, tmpdir_path):
    """A table stored as a folder of part files streams as the batch reads it."""
    from tessera.sources import bindings

    texts = [(c, 0, "user", "w " * (c + 1)) for c in range(12)]
    spark.createDataFrame(texts, "conv_id long, turn long, role string, text string").repartition(3).write.parquet(
        os.path.join(tmpdir_path, "conversations.parquet"))
    base = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(base + dt.timedelta(seconds=k), f"t{k % 3}") for k in range(40)],
                          "ts timestamp, event_type string").repartition(4).write.parquet(
        os.path.join(tmpdir_path, "events.parquet"))
    out = jobs.run_popular_words(spark, bindings.conversation_texts(spark, tmpdir_path, stream=True))
    assert rows(jobs.latest(spark, out), "word", "count") == [("w", sum(c + 1 for c in range(12)))]
    top = jobs.run_hashtag_stream(spark, bindings.hashtag_events(spark, tmpdir_path, stream=True),
                                  output_mode="complete")
    batch = jobs.hashtag_top_windows(bindings.hashtag_events(spark, tmpdir_path))
    assert rows(jobs.latest(spark, top), "window_start", "hashtag", "count", "rank") == rows(
        batch, "window_start", "hashtag", "count", "rank")


def test_stream_without_data_leaves_an_empty_result(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    stream = spark.readStream.schema("ts timestamp, text string").parquet(src)
    assert jobs.latest(spark, jobs.run_hashtag_stream(spark, stream, output_mode="complete")).count() == 0
    assert spark.read.parquet(jobs.run_top_lengths_stream(spark, stream)).count() == 0


def test_top_lengths_stream(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "texts")
    data = [("x" * n,) for n in [5, 50, 7, 100, 3, 3, 9, 11, 12, 13, 14, 1]]
    spark.createDataFrame(data, "text string").write.parquet(src)
    stream = spark.readStream.schema("text string").parquet(src)
    out = jobs.run_top_lengths_stream(spark, stream, out_path=scratch_path(spark, "len"), k=3)
    got = [tuple(r) for r in spark.read.parquet(out).orderBy("rank").select("rank", "length").collect()]
    assert got == [(1, 100), (2, 50), (3, 14)]


def test_replayed_epoch_is_not_duplicated(spark, tmpdir_path):
    from tessera.sources.sinks import write_epoch

    out = os.path.join(tmpdir_path, "sink")
    first = spark.createDataFrame([(1, 10), (2, 7)], "rank int, length int")
    write_epoch(first, out, 0)
    write_epoch(spark.createDataFrame([(1, 4)], "rank int, length int"), out, 1)
    write_epoch(first, out, 0)  # epoch 0 re-run after a failure
    got = rows(spark.read.parquet(out), "batch", "rank", "length")
    assert got == [(0, 1, 10), (0, 2, 7), (1, 1, 4)]

"""Streams over several micro-batches: replay, manifest, bounded state, word lists."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows, write_lines
from tessera.session import scratch_path
from tessera.sources import sinks
from tessera.sources.replay import Replay, even_epochs, replayed
from tessera.streaming import jobs

BASE = dt.datetime(2024, 1, 1)


def statuses(spark, seed=4, seconds=4000, n=900):
    rnd = random.Random(seed)
    data = [(BASE + dt.timedelta(seconds=rnd.randrange(seconds), milliseconds=rnd.randrange(1000)),
             rnd.choice(["#a", "#b #a", "#b", "none", f"#t{rnd.randrange(5)}"])) for _ in range(n)]
    return spark.createDataFrame(data, "ts timestamp, text string")


def as_rows(windows):
    return rows(windows.select(F.unix_seconds("window_start").alias("s"), "hashtag", "count", "rank"))


def test_epochs_are_published_in_order(spark):
    df = spark.createDataFrame([(k, f"t{k}") for k in range(10)] + [(None, "none")], "id long, text string")
    replay = Replay(df, even_epochs(df, F.col("id"), 3), 3)
    seen = []
    while replay.publish() is not None:
        seen.append(sorted(r["text"] for r in spark.read.parquet(replay.source).collect()))
    assert seen == [sorted([f"t{k}" for k in range(4)] + ["none"]), sorted([f"t{k}" for k in range(7)] + ["none"]),
                    sorted([f"t{k}" for k in range(10)] + ["none"])]
    assert replay.stream().columns == ["id", "text"]
    replay.drop()
    assert not os.path.exists(replay.source.replace("file:", ""))


def test_each_epoch_is_one_micro_batch(spark):
    df = spark.createDataFrame([(k, "x" * (k + 1)) for k in range(9)], "id long, text string")
    out = scratch_path(spark, "lengths")
    replayed(df, F.col("id"), 3, lambda s: jobs.run_top_lengths_stream(spark, s, out_path=out, k=2))
    assert rows(jobs.every_epoch(spark, out, jobs.LENGTH_SCHEMA), "batch", "rank", "length") == [
        (0, 1, 3), (0, 2, 2), (1, 1, 6), (1, 2, 5), (2, 1, 9), (2, 2, 8)]


def test_replay_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id long, text string")
    out = scratch_path(spark, "none")
    replayed(df, F.col("id"), 3, lambda s: jobs.run_top_lengths_stream(spark, s, out_path=out))
    assert jobs.every_epoch(spark, out, jobs.LENGTH_SCHEMA).count() == 0


@pytest.mark.parametrize("epochs", [1, 4])
def test_final_windows_over_epochs_equal_the_batch_form(spark, epochs):
    s = statuses(spark)
    out = scratch_path(spark, "final")
    replayed(s, F.unix_micros("ts"), epochs, lambda stream: jobs.run_hashtag_stream(
        spark, stream, out, "5 minutes", "1 second", "2 minutes", k=3))
    got = as_rows(jobs.every_epoch(spark, out, jobs.WINDOW_SCHEMA))
    last = s.agg(F.max(F.unix_millis("ts"))).first()[0] - 120_000
    want = [r for r in as_rows(jobs.hashtag_top_windows(s, k=3)) if (r[0] + 300) * 1000 <= last]
    assert got == want and len(want) > 1000


def test_state_is_bounded_by_window_and_watermark(spark):
    """Ten times the stream leaves no more state rows and no more carried buckets."""
    sizes = []
    for seconds in (1500, 15_000):
        data = [(BASE + dt.timedelta(seconds=k), "#a #b") for k in range(0, seconds, 3)]
        s = spark.createDataFrame(data, "ts timestamp, text string")
        out = scratch_path(spark, "bounded")
        states = []

        def job(stream):
            jobs.run_hashtag_stream(spark, stream, out, "5 minutes", "1 second", "1 minute")
            checkpoint = out + "-checkpoint"
            states.append(spark.read.format("statestore").load(checkpoint).count())
            return out

        replayed(s, F.unix_micros("ts"), 5, job)
        carried = sinks.committed_epochs(spark, out + "-buckets")
        assert len(carried) <= 2
        sizes.append((max(states), spark.read.parquet(f"{out}-buckets/batch={carried[-1]}").count()))
    # 60 s of watermark and 300 s of window, a bucket of two tags every third second.
    assert all(state <= 2 * 22 and kept <= 2 * 101 for state, kept in sizes), sizes


def test_an_epoch_that_is_not_committed_does_not_count(spark, monkeypatch):
    """Killed between writing and listing: readers see the epoch before; the
    replayed epoch replaces the files."""
    out = scratch_path(spark, "kill")
    df = spark.createDataFrame([(k, "w " * (k + 1)) for k in range(6)], "id long, text string")
    replay = Replay(df, even_epochs(df, F.col("id"), 2), 2)
    replay.publish()
    jobs.run_avg_length(spark, replay.stream(), out_path=out)
    before = rows(jobs.latest(spark, out), "n")
    replay.publish()

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(sinks, "create_empty", killed)
        with pytest.raises(Exception):
            jobs.run_avg_length(spark, replay.stream(), out_path=out)
    assert rows(jobs.latest(spark, out), "n") == before == [(3,)]
    jobs.run_avg_length(spark, replay.stream(), out_path=out)
    assert rows(jobs.latest(spark, out), "n") == [(6,)]
    # A result that holds everything keeps its newest epoch only.
    assert len(sinks.committed_epochs(spark, out)) == 1
    assert [x for x in os.listdir(out.replace("file:", "")) if x.startswith("batch=")] == ["batch=1"]


def test_killed_hashtag_epoch_gives_the_same_windows(spark, monkeypatch):
    """Killed after the windows are listed and before the buckets are: the epoch
    runs again from the buckets of the one before."""
    s = statuses(spark, seed=9, seconds=1500, n=300)
    out = scratch_path(spark, "kill-tags")
    replay = Replay(s, even_epochs(s, F.unix_micros("ts"), 3), 3)
    fail = {"at": 4}
    plain = sinks.create_empty

    def sometimes(session, path):
        fail["at"] -= 1
        if fail["at"] == 0:
            raise RuntimeError("killed")
        plain(session, path)

    monkeypatch.setattr(sinks, "create_empty", sometimes)
    failed = 0
    while replay.publish() is not None:
        for _ in range(2):
            try:
                jobs.run_hashtag_stream(spark, replay.stream(), out, "5 minutes", "1 second", "1 minute", k=2)
                break
            except Exception:
                failed += 1
    assert failed == 1
    got = as_rows(jobs.every_epoch(spark, out, jobs.WINDOW_SCHEMA))
    last = s.agg(F.max(F.unix_millis("ts"))).first()[0] - 60_000
    assert got == [r for r in as_rows(jobs.hashtag_top_windows(s, k=2)) if (r[0] + 300) * 1000 <= last] and got


def test_word_list_is_read_for_each_batch(spark, tmpdir_path):
    listed = os.path.join(tmpdir_path, "banned")
    os.makedirs(listed)
    write_lines(listed, "a.txt", ["the", " And "])
    df = spark.createDataFrame([(0, "the cat and the hat"), (1, "the cat cat"), (2, "The hat")], "id long, text string")
    replay = Replay(df, even_epochs(df, F.col("id"), 3), 3)
    out = scratch_path(spark, "allowed")
    for k in range(3):
        replay.publish()
        if k == 1:
            write_lines(listed, "b.txt", ["cat"])  # a second file
        if k == 2:
            write_lines(listed, "a.txt", ["hat"])  # another content
        jobs.run_allowed_words(spark, replay.stream(), listed, out_path=out)
    assert rows(jobs.every_epoch(spark, out, jobs.WORD_SCHEMA), "batch", "rank", "word", "count") == [
        (0, 1, "cat", 1), (0, 2, "hat", 1), (2, 1, "the", 1)]

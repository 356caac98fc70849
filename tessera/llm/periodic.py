"""Periodic runs of words, by a dictionary of basic factors.

A *run* with period ``q`` is a stretch of words in which words ``q`` apart are
identical, that no neighbouring word extends, whose smallest period is ``q`` and
whose length is at least ``max(min_length, 2 * q)``.

1. *Dictionary*: for each power of two ``L`` the factors of ``L`` words that
   occur more than once in a document get a number; equal numbers mean equal
   words. A factor is a pair of factors of half its length, so each level is one
   sort of the places where the level below repeats, and prose runs out of them
   after a few levels.
2. *Proposals*: occurrences of a factor whose successor is at most ``L / 2``
   away overlap so much that they form one arithmetic progression; its
   difference is the factor's own smallest period. A run with period ``q`` in
   ``[L, 2L)`` repeats the factor at its start ``q`` words later, so the
   differences below ``2L`` between one progression and the next few (again an
   arithmetic progression, as all of a factor's have one step) propose every
   period. ``BASE`` is the shortest length that proposes: it serves all
   smaller periods too, as a run has ``min_length`` words at least.
3. *Extension*: proposals of one period that overlap are one stretch. It grows
   to both sides by comparing factors of falling lengths.
4. *Deduplication*: stretches with the same ends are one run, whose period is
   the smallest proposed.

A slice of many documents is handled at once: numbers of different documents
differ, so no factor spans two. Per word the cost is a handful of vector steps a
level; memory is four bytes a word and level.

Defined results: a null or empty text has no words and no runs; rows are kept
apart whatever their ids, so repeated rows give equal rows; an empty table gives
none; columns other than the id and the text do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import encoded, group_starts, slices

BASE = 4  # words of the shortest factor that proposes periods
SLICE = 1 << 20  # bytes of text handled at once
RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
OUT = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
Edit = Callable[[int | None, list[bytes]], list[bytes]]


def word_numbers(docs: list[list[bytes]]) -> np.ndarray:
    """A number for every word of every document, in order; 0 for the words that
    stand once in their document. Numbers of different documents differ."""
    numbers: list[int] = []
    first = 1
    for words in docs:
        seen: dict[bytes, int] = {}
        numbers += [seen.setdefault(w, first + len(seen)) for w in words]
        first += len(seen)
    every = np.array(numbers, dtype=np.int64)
    return np.where(np.bincount(every, minlength=1)[every] > 1, every, 0)


def next_level(below: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From the numbers of factors of ``length / 2`` words: the numbers of those
    of ``length`` (0 where one stands once), and their places and numbers
    sorted by number, then place."""
    half = length // 2
    if len(below) < length:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero((below[:-half] > 0) & (below[half:] > 0))
    key = below[at].astype(np.int64) << 32 | below[at + half]
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    starts = group_starts(key)
    size = np.diff(np.append(starts, len(key)))
    number = np.repeat(np.where(size > 1, np.cumsum(size > 1), 0), size)
    at, number = at[number > 0], number[number > 0]
    level = np.zeros(len(below), dtype=np.int32)
    level[at] = number
    return level, at, number


def progressions(at: np.ndarray, number: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``(first, last, step, number)`` of the arithmetic progressions of places of
    each factor (sorted by number, then place). A lone place has step 0."""
    gap = np.diff(at)
    joined = np.zeros(len(at), dtype=bool)
    joined[1:] = (number[1:] == number[:-1]) & (gap * 2 <= length)
    begin = np.flatnonzero(~joined)
    end = np.append(begin[1:], len(at)) - 1
    step = np.where(end > begin, at[np.minimum(begin + 1, len(at) - 1)] - at[begin], 0)
    return at[begin], at[end], step, number[begin]


def proposals(at: np.ndarray, number: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """``(start, period)``: places where the words ``start`` to ``start + length - 1``
    stand again ``period`` words later, for every period that the level proposes."""
    first, last, step, number = progressions(at, number, length)
    low = 1 if length == BASE else length
    own = (step >= low) & (step > 0)
    starts, periods = [first[own]], [step[own]]
    for ahead in range(1, len(first)):
        # Progressions of one factor lie more than length / 2 apart: three steps ahead at most.
        a, b = np.arange(len(first) - ahead), np.arange(ahead, len(first))
        near = (number[a] == number[b]) & (first[b] - last[a] < 2 * length)
        if not near.any():
            break
        a, b = a[near], b[near]
        by = np.maximum(np.maximum(step[a], step[b]), 1)
        more = (last[a] - first[a]) // by
        least = first[b] - last[a]
        times = more + (last[b] - first[b]) // by
        # Differences least + t * by, t from 0 to times, that lie in [low, 2 * length).
        t0 = np.maximum(0, -(-(low - least) // by))
        t1 = np.minimum(times, (2 * length - 1 - least) // by)
        n = np.maximum(t1 - t0 + 1, 0)
        pair = np.repeat(np.arange(len(a)), n)
        t = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + t0[pair]
        starts.append(last[a][pair] - np.minimum(t, more[pair]) * by[pair])
        periods.append(least[pair] + t * by[pair])
    return np.concatenate(starts), np.concatenate(periods)


def stretches(start: np.ndarray, period: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``(start, end, period)``: proposals of one period that touch, as one."""
    if not len(start):
        return start, start, period
    order = np.lexsort((start, period))
    start, period = start[order], period[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] - start[:-1] > length)
    begin = np.flatnonzero(new)
    return start[begin], start[np.append(begin[1:], len(start)) - 1] + length, period[begin]


def extend(levels: list[np.ndarray], start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``[start, end)`` (words there equal those ``period`` later)
    grown as far as that holds, by factors of falling lengths."""
    start, end = start.copy(), end.copy()
    for k in range(len(levels) - 1, -1, -1):
        level, length = levels[k], 1 << k
        if not len(level):
            continue
        live = np.arange(len(end))
        while live.size:
            z = end[live]
            y = z + period[live]
            fits = y + length <= len(level)
            live, z, y = live[fits], z[fits], y[fits]
            same = (level[z] == level[y]) & (level[z] > 0)
            live = live[same]
            end[live] += length
        live = np.arange(len(start))
        while live.size:
            z = start[live] - length
            live, z = live[z >= 0], z[z >= 0]
            same = (level[z] == level[z + period[live]]) & (level[z] > 0)
            live = live[same]
            start[live] -= length
    return start, end + period  # the last period of the run has no words to compare with


def find_runs(docs: list[list[bytes]], min_length: int = 12) -> tuple[np.ndarray, ...]:
    """``(document, start, length, period)`` of every run of the documents (lists
    of words), by document, start and period."""
    if min_length < 3 * BASE:
        raise ValueError(f"min_length must be at least {3 * BASE}")
    size = np.array([len(d) for d in docs], dtype=np.int64)
    begin = np.cumsum(size) - size
    level = word_numbers(docs)
    levels, found = [level], []
    length = 2
    while level.any():
        level, at, number = next_level(level, length)
        if not len(at):
            break
        levels.append(level)
        if length >= BASE:
            found.append(stretches(*proposals(at, number, length), length))
        length *= 2
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    start, end, period = (np.concatenate([f[i] for f in found]) for i in range(3))
    start, end = extend(levels, start, end, period)
    keep = end - start >= np.maximum(min_length, 2 * period)
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    once = group_starts(start, end)  # the first of equal ends has the smallest period
    start, end, period = start[once], end[once], period[once]
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    doc = np.searchsorted(begin, start, "right") - 1
    return doc, start - begin[doc], end - start, period


def periodic_runs(docs: DataFrame, edit: Edit | None = None, min_length: int = 12) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for each row of ``docs`` (``doc_id``,
    ``text``): every run by start, then period, and the text's words, joined by
    one space, without those that a run contains after its first period.
    ``edit(doc_id, words)`` may change the words first."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE):
            ids = part.column(0).to_pylist()
            words = [t.split() for t in encoded(part)]  # bytes split at the six white-space bytes
            if edit is not None:
                words = [edit(i, w) for i, w in zip(ids, words)]
            doc, start, length, period = find_runs(words, min_length)
            ends = np.searchsorted(doc, np.arange(len(words) + 1))
            kept = []
            for k, w in enumerate(words):
                if ends[k] < ends[k + 1]:
                    drop = np.zeros(len(w) + 1, dtype=np.int64)
                    own = slice(ends[k], ends[k + 1])
                    np.add.at(drop, start[own] + period[own], 1)
                    np.add.at(drop, start[own] + length[own], -1)
                    w = [w[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0)]
                kept.append(b" ".join(w))
            runs = pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)], fields=list(RUN))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(w) for w in words], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(find, OUT)

"""Exact removal of repeated word passages through difference-cover anchors.

A *window* is ``window`` consecutive words. Each word covered by a window whose
words also start in a document with a smaller id is removed. Hashing every
window of the corpus is not needed: with a difference cover ``D`` modulo a
period ``v``, for any two places ``i`` and ``j`` there is a shift ``k < v`` with
``i + k`` and ``j + k`` both in ``D`` modulo ``v``. So two equal windows always
hold an equal *anchor*, a run of ``window - v + 1`` words that starts at a cover
position in both documents, at the same place of the window.

1. *Anchors*: only runs at cover positions are hashed (3 of 7 by default) and
   sent, packed, to hash buckets, which report those found in two or more
   documents.
2. *Extension*: each reported anchor is extended to the windows that contain
   it. These candidate windows are hashed with 96 bits and sent to buckets,
   which know the smallest document of each and report the others' windows.
3. The reported windows mask the words of their document.

A task first settles what its own slice shows: of an anchor or window met in
several of its documents it sends one posting, so a passage in a third of all
documents is one posting per slice and no bucket gathers the corpus. The texts
are shuffled by ``doc_id`` twice, each time only to meet the reported positions.

Defined results: a null text has no words; ``doc_id`` is the document, so rows
repeated under one id are one document to each other and give one result row
each; rows with a null id take no part in the comparison and keep all words;
an empty table gives none. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (bucket_ranges, buckets_for, cut, encoded, group_starts, narrow, pack, slice_bytes, slices, unpack,
                                window_hashes, word_hashes)

ROWS = "bucket int, base long, settled boolean, data binary"
ROW_NAMES = ["bucket", "base", "settled", "data"]
FOUND = "base long, data binary"
OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                 ("kept_sha256", pa.string())])
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


@dataclass(frozen=True)
class CoverParams:
    window: int = 13
    period: int = 7
    cover: tuple[int, ...] = (0, 1, 3)

    def __post_init__(self) -> None:
        gaps = {(a - b) % self.period for a in self.cover for b in self.cover}
        if gaps != set(range(self.period)) or self.period > self.window:
            raise ValueError("cover must contain every difference modulo a period of at most one window")

    @property
    def anchor(self) -> int:
        return self.window - self.period + 1


def _packed_places(doc: np.ndarray, pos: np.ndarray) -> bytes:
    """Places as documents (counted from the slice's smallest id) and positions."""
    order = np.argsort(doc, kind="stable")
    return pack(doc[order].astype(np.uint64), narrow(pos[order]))


def _rows(doc: np.ndarray, pos: np.ndarray, n_buckets: int, postings: list[tuple[int, bytes]],
          base: int) -> pa.RecordBatch:
    """What a slice knows by itself (one row) and its postings, one per bucket."""
    n = len(postings) + 1
    return pa.RecordBatch.from_arrays(
        [pa.array([base % n_buckets, *(b for b, _ in postings)], pa.int32()), pa.array([base] * n, pa.int64()),
         pa.array([True] + [False] * (n - 1)), pa.array([_packed_places(doc, pos), *(p for _, p in postings)],
                                                        pa.binary())], names=ROW_NAMES)


def _split(group: pa.Table, n_cols: int) -> tuple[pa.Table, pa.Table, list[list[np.ndarray]]]:
    """Rows that only pass through, the others, and these unpacked."""
    own, sent = group.filter(group.column("settled")), group.filter(pc.invert(group.column("settled")))
    return own.select(["base", "data"]), sent, [unpack(d, n_cols) for d in sent.column("data").to_pylist()]


def _answered(own: pa.Table, sent: pa.Table, lists: list, hit: np.ndarray, doc_col: int, pos_col: int,
              shift: int = 0) -> pa.Table:
    """``own`` and one row per slice with the places of its postings in ``hit``."""
    ends, back = np.cumsum([len(x[0]) for x in lists]), []
    for x, e in zip(lists, ends):
        use = hit[e - len(x[0]):e]
        back.append(_packed_places(x[doc_col][use], x[pos_col][use].astype(np.int64) - shift))
    return pa.concat_tables([own, pa.table([sent.column("base"), pa.array(back, pa.binary())], names=["base", "data"])])


def places_by_document(found: DataFrame) -> DataFrame:
    """``(doc_id, places)`` from ``(base, packed places)``: all positions of a
    document as 32-bit integers, a slice's documents in one group."""

    def gather(group: pa.Table) -> pa.Table:
        lists = [unpack(d, 1) for d in group.column("data").to_pylist()]
        doc, pos = (np.concatenate([x[i] for x in lists]) for i in range(2))
        order = np.argsort(doc, kind="stable")
        doc, pos = doc[order].astype(np.int64) + group.column("base")[0].as_py(), pos[order].astype("<u4")
        at = group_starts(doc)
        return pa.table([pa.array(doc[at]), pa.array([pos[a:b].tobytes() for a, b in zip(at, [*at[1:], len(doc)])],
                                                     pa.binary())], names=["doc_id", "places"])

    by_slice = found.groupBy("base").applyInArrow(gather, "doc_id long, places binary")
    # A document repeated in several slices has its places from each.
    return by_slice.groupBy("doc_id").agg(F.collect_list("places").alias("places"))


def _parsed(part: pa.RecordBatch):
    """Word hashes of a slice, and for each word its row, place and text length."""
    h, per = word_hashes(encoded(part))
    row = np.repeat(np.arange(len(per)), per)
    start = np.cumsum(per) - per
    return h, per, row, start, np.arange(len(h)) - start[row]


def shared_anchors(docs: DataFrame, params: CoverParams, n_buckets: int) -> DataFrame:
    """``(base, packed places)`` of anchors found in two or more documents."""
    at_cover = np.zeros(params.period, dtype=bool)
    at_cover[list(params.cover)] = True
    size = params.anchor

    limit = slice_bytes(docs)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=limit):
            h, per, row, _, pos = _parsed(part)
            keys = window_hashes(h, size)
            if not len(keys):
                continue
            row, pos = row[:len(keys)], pos[:len(keys)]
            use = at_cover[pos % params.period] & (pos + size <= per[row]) & (per[row] >= params.window)
            ids = part.column(0).to_numpy()
            keys, doc, pos = keys[use], ids[row[use]], pos[use]
            if not len(keys):
                continue
            order = np.lexsort((pos, doc, keys))
            keys, doc, pos = keys[order], doc[order], pos[order]
            at = group_starts(keys)
            size_of = np.diff(np.append(at, len(keys)))
            many = np.repeat(doc[at] != doc[at + size_of - 1], size_of)  # in several documents of this slice
            send = ~many
            send[at] = True
            base = int(ids.min())
            cols = [np.where(many, 0, doc - base)[send], np.where(many, 0, pos + 1)[send]]
            keys = keys[send]
            postings = [(b, pack(keys[lo:hi], *(narrow(c[lo:hi]) for c in cols)))
                        for b, lo, hi in bucket_ranges(keys, n_buckets)]
            yield _rows(doc[many] - base, pos[many], n_buckets, postings, base)

    def meet(group: pa.Table) -> pa.Table:
        own, sent, lists = _split(group, 2)
        if not lists:
            return own
        base = np.repeat(sent.column("base").to_numpy(), [len(x[0]) for x in lists])
        keys, doc, place = (np.concatenate([x[i] for x in lists]) for i in range(3))
        order = np.argsort(keys, kind="stable")
        at = group_starts(keys[order])
        size_of = np.diff(np.append(at, len(keys)))
        settled = (place == 0)[order]  # stands for two or more documents
        doc = (doc.astype(np.int64) + base)[order]
        low = np.minimum.reduceat(np.where(settled, np.iinfo(np.int64).max, doc), at)
        high = np.maximum.reduceat(np.where(settled, np.iinfo(np.int64).min, doc), at)
        hit = np.empty(len(keys), dtype=bool)
        hit[order] = np.repeat(np.logical_or.reduceat(settled, at) | (low != high), size_of) & ~settled
        return _answered(own, sent, lists, hit, 1, 2, shift=1)

    return docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInArrow(post, ROWS) \
        .groupBy("bucket").applyInArrow(meet, FOUND)


def repeated_windows(docs: DataFrame, anchors: DataFrame, params: CoverParams, n_buckets: int) -> DataFrame:
    """``(base, packed starts)`` of windows that also start in a document with
    a smaller id; ``anchors`` as ``shared_anchors`` gives them."""
    size, reach = params.window, params.window - params.anchor

    limit = slice_bytes(docs)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=limit):
            h, per, row, start, _ = _parsed(part)
            first = window_hashes(h, size)
            if not len(first):
                continue
            edge = np.zeros(len(first) + 1, dtype=np.int64)
            for r, lists in enumerate(part.column(2).to_pylist()):
                places = np.frombuffer(b"".join(lists), dtype="<u4").astype(np.int64)
                last = int(per[r]) - size  # the last window's start
                if last < 0:
                    continue
                places = places[places <= last + reach]
                np.add.at(edge, start[r] + np.maximum(places - reach, 0), 1)
                np.add.at(edge, start[r] + np.minimum(places, last) + 1, -1)
            use = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
            if not len(use):
                continue
            ids = part.column(0).to_numpy()
            keys, more = first[use], (window_hashes(h, size, seed=1)[use] >> np.uint64(32)).astype(np.uint32)
            doc, pos = ids[row[use]], use - start[row[use]]
            order = np.lexsort((pos, doc, more, keys))
            keys, more, doc, pos = keys[order], more[order], doc[order], pos[order]
            at = group_starts(keys, more)
            later = doc > np.repeat(doc[at], np.diff(np.append(at, len(keys))))
            base = int(ids.min())
            keys, cols = keys[~later], [more[~later], doc[~later] - base, pos[~later]]
            postings = [(b, pack(keys[lo:hi], cols[0][lo:hi], narrow(cols[1][lo:hi]), narrow(cols[2][lo:hi])))
                        for b, lo, hi in bucket_ranges(keys, n_buckets)]
            yield _rows(doc[later] - base, pos[later], n_buckets, postings, base)

    def meet(group: pa.Table) -> pa.Table:
        own, sent, lists = _split(group, 3)
        if not lists:
            return own
        base = np.repeat(sent.column("base").to_numpy(), [len(x[0]) for x in lists])
        keys, more, doc = (np.concatenate([x[i] for x in lists]) for i in range(3))
        doc = doc.astype(np.int64) + base
        order = np.lexsort((doc, more, keys))
        at = group_starts(keys[order], more[order])
        hit = np.empty(len(keys), dtype=bool)
        hit[order] = doc[order] > np.repeat(doc[order][at], np.diff(np.append(at, len(keys))))
        return _answered(own, sent, lists, hit, 2, 3)

    held = places_by_document(anchors)
    return docs.select("doc_id", "text").join(held, "doc_id").select("doc_id", "text", "places") \
        .mapInArrow(post, ROWS).groupBy("bucket").applyInArrow(meet, FOUND)


def remove_repeats(docs: DataFrame, params: CoverParams = CoverParams()) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for each row of ``docs``
    (``doc_id``, ``text``); the hash is of the kept words joined by a space."""
    n_buckets = buckets_for(docs)
    anchors = cut(shared_anchors(docs, params, n_buckets), "anchors")
    windows = cut(repeated_windows(docs, anchors, params, n_buckets), "windows")

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = []
            for doc_id, text, lists in zip(part.column(0).to_pylist(), encoded(part), part.column(2).to_pylist()):
                words = text.split()
                n, gone = len(words), 0
                if lists:
                    edge = np.zeros(n + 1, dtype=np.int64)
                    starts = np.frombuffer(b"".join(lists), dtype="<u4").astype(np.int64)
                    starts = starts[starts + params.window <= n]
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + params.window, -1)
                    keep = np.cumsum(edge[:-1]) == 0
                    gone = n - int(keep.sum())
                    words = compress(words, keep.tolist())
                rows.append((doc_id, n, gone, hashlib.sha256(b" ".join(words)).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), OUT)], schema=OUT)

    held = places_by_document(windows)
    return docs.select("doc_id", "text").join(held, "doc_id", "left").select("doc_id", "text", "places") \
        .mapInArrow(mask, RESULT)

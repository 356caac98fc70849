"""Language-model scores: prediction by partial matching, and a word baseline.

**Partial matching.** The model is a trie of byte contexts up to ``order``
bytes, trained on the training documents. A byte that was seen after the
longest context costs ``c / (T + U)`` (its count, all counts, distinct
symbols); otherwise an escape ``U / (T + U)`` is paid and the next shorter
context decides, with the symbols of the longer context excluded from its
counts; below order 0 the bytes never seen share what is left evenly. The
counts are sums over every training document. A text's score is the sum of its
bytes' log10 probabilities, the negative code length. With each text begins a
new context of ``order`` zero bytes.

The trie to order 2 holds at most 256**3 counts whatever the corpus, which
bounds what is broadcast. The part above it grows with the corpus and stays
partitioned: a slice of documents sends its distinct grams (context and byte)
with their training counts to hash buckets of the last three context bytes, so
a bucket holds the whole trie above each of its three-byte contexts. It answers
with one cost per gram sent, and the slice adds them up over its texts.

**Words.** The baseline needs the count of each word in the training documents.
Word counts travel as packed postings (see ``common``) to hash buckets. There
the words of a document meet their counts, and one row per slice of documents
takes the sums back.
Words that make up more than one part in ``2**HEAVY_BITS`` of all words, at
most that many, are counted first and scored where the text is, so that no
bucket has to hold a posting of every document for a frequent word.

Defined results: a null text is empty (one end token); a document's row is
kept apart from any other with the same id, so repeated rows give equal rows;
an empty table gives none; without training rows all counts are 0.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (SLICE_BYTES, bucket_ranges, buckets_for, cut, encoded, group_starts, mix, narrow, pack,
                                planes, slice_bytes, slices, unpack, unplanes, word_hashes)

ORDER = 2  # of the broadcast trie, and the default
MAX_ORDER = 7  # a gram is a 64-bit key
LONG_SLICE = 4 << 20  # bytes of a slice that sends grams: fewer distinct ones per byte
RUN_BYTES = 1 << 20  # keys are made for so many bytes at a time
HEAVY_BITS = 17
GRAMS = "gram int, n long"


# --- partial matching -------------------------------------------------------------

def byte_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(codes, starts, inside)``: for every byte the three-byte code of its two
    predecessors and itself; where each text starts; which codes are no padding."""
    buf = np.frombuffer(b"".join(b"\0\0" + t for t in texts), dtype=np.uint8).astype(np.int32)
    codes = buf.copy()
    codes[1:] |= buf[:-1] << 8
    codes[2:] |= buf[:-2] << 16
    starts = np.cumsum([0, *(len(t) + 2 for t in texts)])[:-1]
    inside = np.ones(len(buf), dtype=bool)
    inside[starts] = inside[starts + 1] = False
    return codes, starts, inside


def train_trie(train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of all byte trigrams of ``train`` (``text``); the
    lower orders are their marginal sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            codes, _, inside = byte_grams(encoded(part))
            gram, n = np.unique(codes[inside], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram, pa.int32()), pa.array(n, pa.int64())], names=["gram", "n"])

    rows = train.select("text").mapInArrow(count, GRAMS).groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    return rows.column("gram").to_numpy(), rows.column("n").to_numpy()


def _costs(own: np.ndarray, seen: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """log10 probabilities of 256 symbols after each context (rows of counts
    ``own``), where symbols in ``seen`` are excluded and ``lower`` is what the
    next shorter context gives to symbols not seen here."""
    own = np.where(seen, 0.0, own)
    total, distinct = own.sum(axis=1, keepdims=True), (own > 0).sum(axis=1, keepdims=True)
    with np.errstate(divide="ignore"):
        escape = np.where(total > 0, np.log10(distinct / np.maximum(total + distinct, 1)), 0.0)
        here = np.log10(own / np.maximum(total + distinct, 1))
    return np.where(own > 0, here, escape + lower)


def trie_costs(gram: np.ndarray, n: np.ndarray) -> np.ndarray:
    """float32 table ``[context of two bytes * 256 + byte]`` of log10 probabilities."""
    c2 = np.zeros((256, 256))
    np.add.at(c2, ((gram >> 8) & 255, gram & 255), n)
    c1 = c2.sum(axis=0)
    never = np.full(256, -np.log10(max(1, int((c1 == 0).sum()))))
    none = np.zeros((1, 256), dtype=bool)
    order0_free = _costs(c1[None], none, never[None])  # nothing excluded
    order0 = _costs(np.broadcast_to(c1, (256, 256)), c2 > 0, never[None])  # symbols after each byte excluded
    order1_free = _costs(c2, np.zeros((256, 256), dtype=bool), np.where(c2.sum(1, keepdims=True) > 0, order0,
                                                                        order0_free))
    table = np.tile(order1_free.astype(np.float32), (256, 1, 1))  # contexts never seen: order 1 decides
    context, rank = np.unique(gram >> 8, return_inverse=True)
    c3 = np.zeros((len(context), 256))
    c3[rank, gram & 255] = n
    for a in range(0, len(context), 4096):
        ctx, rows = context[a:a + 4096], c3[a:a + 4096]
        after = ctx & 255
        order1 = _costs(c2[after], rows > 0, order0[after])
        table[ctx >> 8, after] = _costs(rows, np.zeros_like(rows, dtype=bool), order1)
    return table.reshape(-1)


def context_keys(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(keys, starts, inside)`` as ``byte_grams``, for contexts of ``order``
    bytes. The key has the nearest byte of the context on top and the byte
    itself at the bottom, so sorted keys hold every context's branch together."""
    buf = np.frombuffer(b"".join(b"\0" * order + t for t in texts), dtype=np.uint8)
    keys = buf.astype(np.uint64)
    for k in range(1, order + 1):
        keys[k:] |= buf[:-k].astype(np.uint64) << np.uint64(8 * (order + 1 - k))
    starts = np.cumsum([0, *(len(t) + order for t in texts)])[:-1]
    inside = np.ones(len(buf), dtype=bool)
    for k in range(order):
        inside[starts + k] = False
    return keys, starts, inside


def text_runs(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``RUN_BYTES`` (one text at least)."""
    a = size = 0
    for b, t in enumerate(texts):
        if b > a and size + len(t) > RUN_BYTES:
            yield a, b
            a, size = b, 0
        size += len(t)
    yield a, len(texts)


def run_keys(texts: list[bytes], order: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(from, to, keys)`` of each run of texts: the keys of their bytes in order."""
    for a, b in text_runs(texts):
        keys, _, inside = context_keys(texts[a:b], order)
        yield a, b, keys[inside]


def distinct_keys(texts: list[bytes], is_train: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of ``texts``, sorted, with their training counts."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    every = np.empty(int(size.sum()), dtype=np.uint64)
    flag = np.repeat(np.asarray(is_train, dtype=bool), size)
    at = 0
    for _, _, keys in run_keys(texts, order):
        every[at:at + len(keys)] = keys
        at += len(keys)
    if order < MAX_ORDER:  # a key leaves a bit free: one plain sort brings keys and flags together
        every <<= np.uint64(1)
        every |= flag
        every.sort()
        flag = (every & np.uint64(1)).astype(np.int64)
        every >>= np.uint64(1)
    else:
        rank = np.argsort(every, kind="stable")
        every, flag = every[rank], flag[rank].astype(np.int64)
    starts = group_starts(every)
    return every[starts], np.add.reduceat(flag, starts) if len(starts) else flag


def text_costs(texts: list[bytes], order: int, costs_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over each text's bytes of what ``costs_of`` gives for the distinct
    sorted keys of all. One sort gives those keys and the place of each byte's."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    every = np.concatenate([keys for _, _, keys in run_keys(texts, order)])
    rank = np.argsort(every)
    every = every[rank]
    starts = group_starts(every)
    spent = np.empty(len(every))
    spent[rank] = np.repeat(costs_of(every[starts]), np.diff(np.append(starts, len(every))))
    score, some = np.zeros(len(texts)), size > 0
    if some.any():
        score[some] = np.add.reduceat(spent, (np.cumsum(size) - size)[some])
    return score


def by_bucket(keys: np.ndarray, order: int, n_buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order of sorted ``keys`` by bucket, and ``(bucket, from, to)`` therein.
    The bucket is a hash of the last three bytes of the context."""
    h = mix((keys >> np.uint64(8 * (order - 2))) + np.uint64(1))
    place = np.argsort(h, kind="stable")
    return place, list(bucket_ranges(h[place], n_buckets))


class LowTrie:
    """The broadcast part of the model: costs, counts and sums to order 2."""

    def __init__(self, gram: np.ndarray, n: np.ndarray) -> None:
        order = np.argsort(gram)
        self.gram, self.n = gram[order].astype(np.int64), n[order].astype(np.int64)
        self.costs = trie_costs(gram, n)
        self.total = np.bincount(self.gram >> 8, self.n, 1 << 16)
        self.distinct = np.bincount(self.gram >> 8, minlength=1 << 16)

    def counts(self, code: np.ndarray) -> np.ndarray:
        if not len(self.gram):
            return np.zeros(len(code), np.int64)
        at = np.minimum(np.searchsorted(self.gram, code), len(self.gram) - 1)
        return np.where(self.gram[at] == code, self.n[at], 0)


_low: dict[str, LowTrie] = {}  # of the last model, as a worker serves many buckets


def low_trie(name: str, gram: np.ndarray, n: np.ndarray) -> LowTrie:
    if name not in _low:
        _low.clear()
        _low[name] = LowTrie(gram, n)
    return _low[name]


def _logs(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.log10(part / np.maximum(whole, 1), where=part > 0, out=np.zeros(len(part)))


def gram_costs(keys: np.ndarray, n: np.ndarray, order: int, low: LowTrie) -> np.ndarray:
    """log10 probability of the byte of each of the sorted, distinct ``keys``
    after its context, where ``n`` are their training counts. The keys must
    hold all of the model above each three-byte context they have.

    Counts of a context include those of any longer one, so what is excluded
    from a context are just the symbols of the next longer one. ``free`` is the
    cost where the search begins at the order reached, ``left`` the cost after
    an escape from the next longer context."""
    at = keys.astype(np.int64)
    code = ((at >> (8 * (order - 1))) & 255) << 16 | ((at >> (8 * order)) & 255) << 8 | at & 255
    free = low.costs[code].astype(np.float64)
    total, distinct, count = low.total[code >> 8], low.distinct[code >> 8], low.counts(code)
    # what is below order 2, when order 2 was left by an escape
    left = free - _logs(distinct, total + distinct)
    for k in range(3, order + 1):
        if k < order:
            gram, inside = np.unique((keys >> np.uint64(8 * (order + 1 - k))) << np.uint64(8) | keys & np.uint64(255),
                                     return_inverse=True)
        else:  # the keys themselves
            gram, inside = keys, np.arange(len(keys))
        own = np.bincount(inside, n, len(gram))
        starts = group_starts(gram >> np.uint64(8))
        context = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(gram))))
        shorter = np.zeros(len(gram))
        shorter[inside] = count  # of the same symbol after the next shorter context
        sums = [np.add.reduceat(x, starts)[context][inside] for x in (own, own > 0, np.where(own > 0, shorter, 0.0))]
        own_total, own_distinct, excluded = (x.astype(np.float64) for x in sums)
        rest, kinds = total - excluded, distinct - own_distinct  # of the shorter context, without this one's symbols
        left = np.where(count > 0, _logs(count, rest + kinds), _logs(kinds, rest + kinds) + left)
        total, distinct, count = own_total, own_distinct, own[inside]
        free = np.where(total == 0, free, np.where(count > 0, _logs(count, total + distinct),
                                                   _logs(distinct, total + distinct) + left))
    return free


# --- words ------------------------------------------------------------------------

COUNTS = "bucket int, words long, distinct_words long, all_words long, data binary"


def _bucket_rows(keys: np.ndarray, cols: list[np.ndarray], n_buckets: int) -> Iterator[tuple[int, bytes]]:
    for b, lo, hi in bucket_ranges(keys, n_buckets):
        yield b, pack(keys[lo:hi], *(narrow(c[lo:hi]) for c in cols))


def word_counts(docs: DataFrame, train: Column, n_buckets: int) -> DataFrame:
    """One row per bucket: words and distinct words of the training rows, words
    of all rows, and the packed (hash, training count, count)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            h, per = word_hashes([t.lower() for t in encoded(part)])
            is_train = np.repeat(np.asarray(part.column(1)), per)
            order = np.argsort(h, kind="stable")
            h, is_train = h[order], is_train[order].astype(np.int64)
            at = group_starts(h)
            if not len(at):
                continue
            used, every = np.add.reduceat(is_train, at), np.diff(np.append(at, len(h)))
            rows = list(_bucket_rows(h[at], [used, every], n_buckets))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                              pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "data"])

    def add(group: pa.Table) -> pa.Table:
        lists = [unpack(d, 2) for d in group.column("data").to_pylist()]
        h, used, every = (np.concatenate([x[i] for x in lists]) for i in range(3))
        order = np.argsort(h, kind="stable")
        h, used, every = h[order], used[order].astype(np.int64), every[order].astype(np.int64)
        at = group_starts(h)
        used, every = np.add.reduceat(used, at), np.add.reduceat(every, at)
        return pa.table({"bucket": pa.array([group.column("bucket")[0].as_py()], pa.int32()),
                         "words": [int(used.sum())], "distinct_words": [int((used > 0).sum())],
                         "all_words": [int(every.sum())], "data": pa.array([pack(h[at], narrow(used), narrow(every))],
                                                                           pa.binary())})

    parts = docs.select("text", F.coalesce(train, F.lit(False)).alias("is_train")).mapInArrow(
        count, "bucket int, data binary")
    return parts.groupBy("bucket").applyInArrow(add, COUNTS)


def heavy_words(counts: DataFrame, all_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and training counts of the words that make up at least
    one part in ``2**HEAVY_BITS`` of all words."""
    least = max(1, -(-all_words // (1 << HEAVY_BITS)))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                h, used, every = unpack(data, 2)
                keep = every >= least
                yield pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)),
                                                  pa.array(used[keep].astype(np.int64))], names=["h", "c"])

    rows = counts.select("data").mapInArrow(pick, "h long, c long").toArrow()
    h, c = rows.column("h").to_numpy().view(np.uint64), rows.column("c").to_numpy()
    order = np.argsort(h)
    return h[order], c[order]


SUMS = "rid long, doc_id long, n_tokens long, n_known long, word_sum double, score double"
SUM_NAMES = ["rid", "doc_id", "n_tokens", "n_known", "word_sum", "score"]
SENT = "text binary, data binary, grams binary"  # own rows have text (the slice's first one all), sent rows the others
SENT_NAMES = ["text", "data", "grams"]


def squeezed(texts: list[bytes]) -> bytes:
    head = np.array([len(texts), *map(len, texts)], dtype=np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(texts))


def unsqueezed(data: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    k = int(np.frombuffer(raw, np.int64, 1)[0])
    ends = np.cumsum(np.frombuffer(raw, np.int64, k, 8)) + 8 * (k + 1)
    return [raw[a:b] for a, b in zip([8 * (k + 1), *ends[:-1]], ends)]


def score_documents(docs: DataFrame, train: Column, order: int = ORDER) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for each
    row of ``docs`` (``doc_id``, ``text``), learned from the rows where
    ``train`` holds. ``order`` is the bytes of the longest context."""
    if not ORDER <= order <= MAX_ORDER:
        raise ValueError(f"order must be from {ORDER} to {MAX_ORDER}")
    sc = docs.sparkSession.sparkContext
    n_buckets = buckets_for(docs)
    trie = train_trie(docs.filter(train))
    counts = cut(word_counts(docs, train, n_buckets), "word-counts")
    total = counts.agg(F.sum("words"), F.sum("distinct_words"), F.sum("all_words")).first()
    words, distinct, all_words = (int(x or 0) for x in total)
    n_train = docs.filter(train).count()  # one end token each
    heavy = heavy_words(counts, all_words)
    model = sc.broadcast(((uuid.uuid4().hex, *trie), heavy))
    n, v = words + n_train, distinct + (n_train > 0)

    limit = slice_bytes(docs, SLICE_BYTES if order == ORDER else LONG_SLICE)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, (heavy_h, heavy_c) = model.value
        costs = low_trie(*trie).costs
        heavy_log = np.log10(heavy_c + 0.1)
        for part in slices(batches, limit=limit):
            texts = encoded(part)
            is_train = np.asarray(part.column(3))
            sent: dict[int, list] = {}  # bucket -> packed words, packed grams
            if order == ORDER:
                codes, starts, inside = byte_grams(texts)
                spent = np.add.reduceat(np.where(inside, costs[codes], np.float32(0)).astype(np.float64), starts)
            else:
                spent = np.zeros(len(texts))  # the slice adds up its answers
                keys, count = distinct_keys(texts, is_train, order)
                place, ranges = by_bucket(keys, order, n_buckets)
                keys, count = keys[place], count[place]
                for b, lo, hi in ranges:
                    inner = np.argsort(keys[lo:hi])
                    sent[b] = [None, pack(keys[lo:hi][inner], narrow(count[lo:hi][inner]))]
            h, per = word_hashes([t.lower() for t in texts])
            doc = np.repeat(np.arange(len(texts)), per)
            at = np.searchsorted(heavy_h, h)
            common = np.zeros(len(h), dtype=bool)
            if len(heavy_h):
                at = np.minimum(at, len(heavy_h) - 1)
                common = heavy_h[at] == h
            k = len(texts)
            known = np.bincount(doc[common], heavy_c[at[common]] > 0, k).astype(np.int64)
            logs = np.zeros(k)
            np.add.at(logs, doc[common], heavy_log[at[common]] if len(heavy_h) else 0.0)
            rid = part.column(0).to_numpy()
            first = int(rid[0])  # names the slice
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, (first + (first >> 33)) % n_buckets, np.int32)), pa.array(np.full(k, first)), pa.array(rid),
                 part.column(1), pa.array(per + 1), pa.array(known), pa.array(logs), pa.array(spent),
                 pa.array([b"" if order == ORDER else squeezed(texts), *[b""] * (k - 1)], pa.binary()),
                 *[pa.nulls(k, pa.binary())] * 2], names=["bucket", "first", *SUM_NAMES, *SENT_NAMES])
            h, doc = h[~common], doc[~common]
            by_word = np.lexsort((doc, h))
            h, doc = h[by_word], doc[by_word]
            at = group_starts(h, doc)
            n_here = np.diff(np.append(at, len(h)))
            words = _bucket_rows(h[at], [rid[doc[at]] - first, n_here * 2 + is_train[doc[at]]], n_buckets)
            for b, data in words if len(at) else ():
                sent.setdefault(b, [None, None])[0] = data
            m = len(sent)
            empty = [pa.nulls(m, t) for t in (*[pa.int64()] * 4, pa.float64(), pa.float64(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sent), pa.int32()), pa.array([first] * m, pa.int64()), *empty,
                 *(pa.array([x[i] for x in sent.values()], pa.binary()) for i in range(2))],
                names=["bucket", "first", *SUM_NAMES, *SENT_NAMES])

    def add_words(sent: list[bytes]) -> list[bytes]:
        lists = [unpack(d, 2) for d in sent]
        h, doc, times = (np.concatenate([x[i] for x in lists]) for i in range(3))
        times = times.astype(np.int64)
        order = np.argsort(h, kind="stable")
        at = group_starts(h[order])
        used = ((times >> 1) * (times & 1))[order]
        c = np.empty(len(h), dtype=np.int64)
        c[order] = np.repeat(np.add.reduceat(used, at), np.diff(np.append(at, len(h))))
        times >>= 1
        logs, known, ends, back = times * np.log10(c + 0.1), times * (c > 0), np.cumsum([len(x[0]) for x in lists]), []
        for x, e in zip(lists, ends):
            where = slice(e - len(x[0]), e)
            ids, inside = np.unique(doc[where].astype(np.int64), return_inverse=True)
            back.append(ids.tobytes() + np.bincount(inside, known[where], len(ids)).tobytes()
                        + np.bincount(inside, logs[where], len(ids)).tobytes())
        return back

    def cost_grams(sent: list[bytes]) -> list[bytes]:
        lists = [unpack(d, 1) for d in sent]
        keys, inside = np.unique(np.concatenate([x[0] for x in lists]), return_inverse=True)
        n = np.bincount(inside, np.concatenate([x[1] for x in lists]), len(keys))
        costs = gram_costs(keys, n, order, low_trie(*model.value[0])).astype(np.float32)[inside]
        ends = np.cumsum([len(x[0]) for x in lists])
        return [planes(costs[e - len(x[0]):e]) for x, e in zip(lists, ends)]

    def meet(group: pa.Table) -> pa.Table:
        """Words and grams meet their counts; one row per slice takes the sums
        and costs back."""
        group = group.select(["bucket", "first", *SUM_NAMES, *SENT_NAMES])
        own = group.filter(pc.is_valid(group.column("text")))
        sent = group.filter(pc.is_null(group.column("text")))
        if not sent.num_rows:
            return own
        back = {}
        for name, answer in (("data", add_words), ("grams", cost_grams)):
            asked = sent.column(name).to_pylist()
            given = iter(answer([x for x in asked if x is not None]) if any(x is not None for x in asked) else ())
            back[name] = pa.array([None if x is None else next(given) for x in asked], pa.binary())
        for name, column in back.items():
            sent = sent.set_column(sent.schema.get_field_index(name), name, column)
        return pa.concat_tables([own, sent])

    def total(group: pa.Table) -> pa.Table:
        is_own = pc.is_valid(group.column("text"))
        own, sent = group.filter(is_own).combine_chunks(), group.filter(pc.invert(is_own))
        packed, own = max(own.column("text").to_pylist(), key=len), own.select(SUM_NAMES)
        place = own.column("rid").to_numpy() - group.column("first")[0].as_py()
        by_place = np.argsort(place)
        known, logs = own.column("n_known").to_numpy().astype(np.float64), own.column("word_sum").to_numpy().copy()
        for data in sent.column("data").drop_null().to_pylist():
            ids, more_known, more = np.frombuffer(data, dtype=np.int64).reshape(3, -1)
            at = by_place[np.searchsorted(place, ids, sorter=by_place)]
            known[at] += more_known.view(np.float64)
            logs[at] += more.view(np.float64)
        own = own.set_column(3, "n_known", pa.array(known.astype(np.int64))).set_column(4, "word_sum", pa.array(logs))
        if order == ORDER:
            return own
        answers = dict(zip(sent.column("bucket").to_pylist(), sent.column("grams").to_pylist()))
        texts = unsqueezed(packed)

        def costs_of(keys: np.ndarray) -> np.ndarray:
            costs = np.empty(len(keys))
            rank, ranges = by_bucket(keys, order, n_buckets)
            for b, lo, hi in ranges:
                costs[np.sort(rank[lo:hi])] = unplanes(memoryview(answers[b]), hi - lo, "<f4")[0]
            return costs

        score = np.empty(len(texts))
        score[by_place] = text_costs(texts, order, costs_of)
        return own.set_column(5, "score", pa.array(score))

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text",
                       F.coalesce(train, F.lit(False)).alias("is_train"))
    parts = f"bucket int, first long, {SUMS}, {SENT}"
    per_doc = rows.mapInArrow(post, parts).groupBy("bucket").applyInArrow(meet, parts) \
        .groupBy("first").applyInArrow(total, SUMS)
    end_log, floor = float(np.log10(n_train + 0.1)), float(np.log10(n + 0.1 * (v + 1)))
    return per_doc.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.lit(int(n_train > 0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("word_sum") + F.lit(end_log) - F.col("n_tokens") * F.lit(floor)).alias("base_score"), "score")

"""Packing token sequences by cutting-stock column generation.

1. Every document becomes token ids plus an end id. A document longer than a
   sequence is cut into full sequences and one rest. One narrow pass gives the
   pieces with their lengths and checksums; texts are not read again.
2. Piece lengths, rounded up to ``unit`` tokens, form a histogram of at most
   ``seq_len / unit`` bins, the only thing that reaches the driver.
3. The linear program "cover the histogram with the fewest sequences" runs over
   patterns (how many pieces of each bin share a sequence). Columns are priced
   by an unbounded knapsack dynamic program on the duals until none improves.
   The patterns' counts are rounded down and the few pieces that remain are
   placed best fit, largest first.
4. Pieces are ranked within their bin (salted counts plus offsets, so a hot bin
   is many small windows) and the rank picks pattern, copy and slot. A running
   sum of lengths within each sequence gives the offsets.

Defined results: a null or empty text is one piece that holds the end id;
repeated rows are packed as rows of their own; an empty table packs to none.
The pattern table sent to tasks is bounded by the number of bins.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm.common import cut, slices

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
OUT = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])
CACHE_CHUNKS = 200_000


@dataclass(frozen=True)
class PackParams:
    seq_len: int = 4096
    unit: int = 16
    end_id: int = 2
    rank_rows: int = 10_000  # about as many pieces of a bin are ranked in one window


# --- token ids ----------------------------------------------------------------

def _byte_symbols() -> dict[int, int]:
    """Byte-level vocabularies write each byte as one printable character: the
    printable Latin-1 ones as themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{b: b for b in plain}, **{b: 256 + k for k, b in enumerate(rest)}}


class WordIds:
    """Token ids of texts, with the ids of each distinct chunk kept.

    A file of another kind than the following (its normalizer and word pattern
    are read from it) encodes every text whole. The vocabulary's tokenizer folds case and composition, splits a text into
    words, never across white space, and merges each word by itself. So the
    chunks between white space can be looked up, and only the words of new
    chunks go to the merge model. Texts for which the folding depends on more
    than a chunk (special-token strings, letters whose lower case depends on
    their place, control characters that only some count as white space) go
    through the tokenizer whole.
    """

    WHOLE = re.compile("<\\||[\u03a3\u0130\x1c-\x1f\x85\u180e]")
    SYMBOLS = _byte_symbols()

    def __init__(self, tokenizer_json: str) -> None:
        self.tok = Tokenizer.from_str(tokenizer_json)
        self.model = self.tok.model
        pattern = self.word_pattern(json.loads(tokenizer_json))
        self.words = regex.compile(pattern) if pattern else None
        # Of chunks and of the words in them, each with those of the time before:
        # a full table becomes the older one, and what is still in use moves on.
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.older_known: dict[str, bytes] = {}

    @staticmethod
    def word_pattern(spec: dict) -> str | None:
        """The pattern of words, if the file folds case and composition, splits
        words, never across white space, and merges the bytes of each."""
        folds = [(n["type"], n.get("pattern"), n.get("content")) for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        known = (folds == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
                 and [s["type"] for s in steps] == ["Split", "ByteLevel"]
                 and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and "Regex" in steps[0]["pattern"]
                 and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]
                 and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
                 and all(t["content"].startswith("<|") for t in spec.get("added_tokens", [])))
        pattern = steps[0]["pattern"]["Regex"] if known else None
        return pattern if known and not regex.search(pattern, " \n\t") else None

    def _word(self, word: str) -> bytes:
        if not (word.isascii() and word.isprintable()):  # those are their own symbols
            word = word.encode().decode("latin-1").translate(self.SYMBOLS)
        return self._pack([t.id for t in self.model.tokenize(word)])

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        packed = array("I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _chunk(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is not None:
            return ids
        out = []
        for word in self.words.findall(chunk):
            ids = self.known.get(word)
            if ids is None:
                ids = self.older_known.get(word) or self._word(word)
                self.known[word] = ids
            out.append(ids)
        return out[0] if len(out) == 1 else b"".join(out)

    def _whole(self, text: str) -> bytes:
        return self._pack(self.tok.encode(text, add_special_tokens=False).ids)

    def text_ids(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        if self.words is None or self.WHOLE.search(text):
            return self._whole(text)
        if len(self.kept) > CACHE_CHUNKS:
            self.older, self.kept = self.kept, {}
        if len(self.known) > CACHE_CHUNKS:
            self.older_known, self.known = self.known, {}
        chunks = unicodedata.normalize("NFC", text).lower().split()
        found = list(map(self.kept.get, chunks))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    chunk = chunks[i]
                    ids = self.kept.get(chunk)
                    if ids is None:
                        ids = self.kept[chunk] = self._chunk(chunk)
                    found[i] = ids
        return b"".join(found)


@lru_cache(maxsize=1)
def word_ids(tokenizer_json: str) -> WordIds:
    """One per Python worker: its later tasks find the words of earlier ones."""
    return WordIds(tokenizer_json)


def tokenized_pieces(docs: DataFrame, tokenizer_json: str, params: PackParams = PackParams()) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens``: full sequences and one
    rest of each row of ``docs`` (``doc_id``, ``text``)."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    end = np.array([params.end_id], dtype="<u4").tobytes()
    step = params.seq_len * 4

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(shared.value)
        for part in slices(batches, limit=1 << 20):
            rows = []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                data = memoryview(encoder.text_ids(text or "") + end)
                for a in range(0, len(data), step):
                    piece = data[a:a + step]
                    rows.append((doc_id, a // 4, len(piece) // 4, zlib.crc32(piece), len(data) // 4))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=OUT)

    return docs.select("doc_id", "text").mapInArrow(pieces, PIECES)


# --- the linear program --------------------------------------------------------

def best_pattern(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the multiset of sizes ``1..capacity`` of the greatest
    value that fits; ``values[b]`` is the value of size ``b`` (0: none)."""
    best = np.zeros(capacity + 1)
    pick = np.zeros(capacity + 1, dtype=np.int64)
    for c in range(1, capacity + 1):
        gain = best[c - 1::-1][:c] + values[1:c + 1]  # size b with what fits into c - b
        b = int(np.argmax(gain))
        if gain[b] > best[c - 1] + 1e-12:
            best[c], pick[c] = gain[b], b + 1
        else:
            best[c] = best[c - 1]
    pattern = np.zeros(capacity + 1, dtype=np.int64)
    c = capacity
    while c > 0:
        if pick[c]:
            pattern[pick[c]] += 1
            c -= pick[c]
        else:
            c -= 1
    return float(best[capacity]), pattern


def cutting_stock(demand: np.ndarray, capacity: int, max_rounds: int = 5000) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often to use each, for ``demand[b]`` pieces of size
    ``b`` (``b`` from 1 to ``capacity``). Every piece is covered."""
    sizes = np.flatnonzero(demand)
    m = len(sizes)
    if not m:
        return []
    columns = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(columns))
    x = demand[sizes].astype(float) / np.diag(columns)
    values = np.zeros(capacity + 1)
    for _ in range(max_rounds):
        duals = np.maximum(inverse.sum(axis=0), 0.0)  # every pattern costs one sequence
        values[:] = 0.0
        values[sizes] = duals
        worth, pattern = best_pattern(values, capacity)
        if worth <= 1 + 1e-9:
            break
        enter = pattern[sizes].astype(float)
        way = inverse @ enter
        rise = way > 1e-9
        if not rise.any():
            break
        ratio = np.where(rise, x / np.where(rise, way, 1.0), np.inf)
        out = int(np.argmin(ratio))
        step = ratio[out]
        x = np.maximum(x - step * way, 0.0)
        x[out] = step
        columns[:, out] = enter
        pivot = inverse[out] / way[out]
        inverse -= np.outer(way, pivot)
        inverse[out] = pivot
    plan: dict[bytes, list] = {}

    def use(pattern: np.ndarray, times: int) -> None:
        if times > 0:
            plan.setdefault(pattern.tobytes(), [pattern, 0])[1] += times

    left = demand.astype(np.int64).copy()
    for k in np.argsort(-x, kind="stable"):
        pattern = np.zeros(capacity + 1, dtype=np.int64)
        pattern[sizes] = np.rint(columns[:, k]).astype(np.int64)
        # Rounded down, and never more of a size than is still there.
        held = pattern > 0
        times = min(int(x[k] + 1e-6), int((left[held] // pattern[held]).min()))
        use(pattern, times)
        left -= times * pattern
    # What remains is a few sequences' worth: best fit, largest first, one pattern at a time.
    while left.any():
        pattern = np.zeros(capacity + 1, dtype=np.int64)
        room = capacity
        while room > 0 and left[:room + 1].any():
            b = int(np.flatnonzero(left[:room + 1])[-1])
            n = min(int(left[b]), room // b)
            pattern[b] += n
            left[b] -= n
            room -= n * b
        held = pattern > 0
        more = int((left[held] // pattern[held]).min())
        use(pattern, 1 + more)
        left -= more * pattern
    return [(p, n) for p, n in plan.values()]


# --- assignment -----------------------------------------------------------------

def slot_table(plan: list[tuple[np.ndarray, int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per bin: rank at which each pattern's slots begin, the pattern's first
    sequence, and its slots of this bin per sequence."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    filled: dict[int, int] = {}
    first = 0
    for pattern, times in plan:
        for b in np.flatnonzero(pattern):
            b, each = int(b), int(pattern[b])
            rows.setdefault(b, []).append((filled.get(b, 0), first, each))
            filled[b] = filled.get(b, 0) + each * times
        first += times
    return {b: tuple(np.array(c, dtype=np.int64) for c in zip(*v)) for b, v in rows.items()}


def pack_pieces(pieces: DataFrame, params: PackParams = PackParams()) -> DataFrame:
    """``pieces`` (a table that is cheap to read again) with ``sequence_id``
    and ``offset``."""
    binned = pieces.withColumn("bin", F.ceil(F.col("length") / params.unit).cast("int"))
    histogram = {r["bin"]: r["n"] for r in binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect()}
    capacity = params.seq_len // params.unit
    demand = np.zeros(capacity + 1, dtype=np.int64)
    for b, n in histogram.items():
        demand[b] = n
    slots = slot_table(cutting_stock(demand, capacity))

    # Rank within the bin: row number within a salted part plus the parts before.
    # A hot bin has as many parts as its own count asks for.
    parts = F.create_map(*[F.lit(x) for b, n in histogram.items() for x in (b, -(-n // params.rank_rows))]) if histogram \
        else F.create_map(F.lit(0), F.lit(1))
    salted = binned.withColumn("part", F.pmod(F.xxhash64("doc_id", "start"), F.element_at(parts, F.col("bin"))))
    sizes = salted.groupBy("bin", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("bin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("bin", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("bin", "part").orderBy(F.desc("length"), "doc_id", "start")
    ranked = salted.withColumn("rank", F.row_number().over(order)).join(sizes, ["bin", "part"]).withColumn(
        "rank", F.col("rank") - 1 + F.col("base")).drop("part", "base")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = batch.column(batch.schema.get_field_index("bin")).to_numpy()
            ranks = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            out = np.zeros(len(bins), dtype=np.int64)
            for b in np.unique(bins):
                at = np.flatnonzero(bins == b)
                begin, first, each = slots[int(b)]
                k = np.searchsorted(begin, ranks[at], "right") - 1
                out[at] = first[k] + (ranks[at] - begin[k]) // each[k]
            keep = [batch.column(batch.schema.get_field_index(c)) for c in OUT.names]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(out)], names=[*OUT.names, "sequence_id"])

    placed = ranked.mapInArrow(assign, PIECES + ", sequence_id long")
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start").rowsBetween(
        Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long"))


def pack_documents(docs: DataFrame, tokenizer_json: str, params: PackParams = PackParams()) -> DataFrame:
    """Pieces of all ``docs`` with the sequence and offset each is packed to."""
    return pack_pieces(cut(tokenized_pieces(docs, tokenizer_json, params), "pack-pieces"), params)

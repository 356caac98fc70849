"""Alignment of two tokenizers, with corpus-wide counts of linked ids.

A text is encoded twice, by a byte-level vocabulary (A) and by a vocabulary of
pieces (B), over the same bytes: a space and the text. Offsets at which tokens
of both end cut the tokens into *groups*; every A token of a group is *linked*
with every B token of it. The count of an id pair is the number of documents
that hold it linked.

**Alignment.** Neither vocabulary has a token that goes on from a character
that is no white space into a space or line feed, so both end there, a group
never spans such a place, and each chunk (white space, then other characters)
can be aligned by itself. Distinct chunks are aligned once per worker and kept;
a text is then a list of chunk numbers. Texts with other white space or control
characters are aligned whole.

**Counting** by external spills. A slice of documents (a *run*) reduces its
(pair, document) records to the documents per pair, radix-partitions them by the
low bits of the A id, and writes each part, sorted by A id and then B id, as
blocks of zstandard frames. Parts of about ``FAN`` runs meet in a k-way heap
merge that holds one block of each and adds up the counts. Merges of such sums
follow until ``FAN`` at most are left, and the last one sees all of a radix part.
As the order is by A id first, the greatest count of an A id is known when its
last pair has passed, and the counts go back at once to the sums that the pairs
came from, in the order they came, and merge by merge to the runs. A run adds
them up over its documents.

Per radix part a run sends its distinct pairs, whatever their number of
occurrences, so a frequent id is one record per partner and run; a sum has each
pair once, so the vocabularies bound it. No merge reads more than about ``FAN``
of them, whatever the input; there are as many rounds as its logarithm. Runs and
sums that are read twice are written once to the shared folder.

Defined results: a null or empty text, or one that a vocabulary does not give
back byte for byte, has no tokens and zeros, with empty groups; each row is a
document of its own whatever its id; an empty table gives none; columns other
than the id and the text do not matter.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, group_starts, narrow, pack, slices, unpack
from tessera.session import input_bytes, scratch_path

RUN_BYTES = 8 << 20  # text of a run
RADIX = 64  # parts of a run
FAN = 512  # runs or sums that meet in a merge
BLOCK = 1024  # records of a block
KEPT_CHUNKS = 400_000  # distinct chunks that a worker keeps
SPACE = "\u2581"  # a space in a piece
B_BITS = 20  # of a pair's key, for the B id

DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
NAMES = [c.split()[0] for c in DOC.split(", ")]
SENT = "run long, grp long, part int, data binary"
OWN = -1  # part of the row that a run keeps for itself


# --- alignment -------------------------------------------------------------------

# Fixed value: how the byte-level vocabulary splits a text before it merges.
A_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable
    Latin-1 ones for themselves, those from U+0100 on for the others in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = sorted(set(range(256)) - set(plain))
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(rest)}}


def byte_level(a_json: str) -> tuple[tiktoken.Encoding, list[bytes]]:
    """The encoder of a byte-level vocabulary file, and each id's bytes."""
    spec, symbols = json.loads(a_json), byte_symbols()
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    before = spec["pre_tokenizer"]
    if spec["normalizer"] is not None or before["type"] != "ByteLevel" or before["add_prefix_space"] \
            or not before["use_regex"]:
        raise ValueError("not a byte-level vocabulary of the known kind")
    pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
    if [vocab[x + y] for x, y in pairs] != list(range(256, 256 + len(merges))):
        raise ValueError("ids of merged tokens must be in the order of the merges")
    ranks = {bytes(symbols[c] for c in t): i for t, i in vocab.items()}
    if any(bytes([k]) not in ranks for k in range(256)):
        raise ValueError("every byte must be a token")
    names = [b""] * (1 + max(ranks.values()))
    for name, i in ranks.items():
        names[i] = name
    return tiktoken.Encoding("bytes", pat_str=A_PATTERN, mergeable_ranks=ranks, special_tokens={}), names


def piece_bytes(b: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    out = []
    for i in range(b.get_piece_size()):
        octet = re.fullmatch("<0x([0-9A-F]{2})>", b.id_to_piece(i))
        out.append(bytes([int(octet[1], 16)]) if octet else b.id_to_piece(i).replace(SPACE, " ").encode())
    return out


class Numbers(dict):
    """Numbers of chunks in the order they are first asked for; ``new`` collects
    those that had none."""

    def __init__(self) -> None:
        self.used = 0
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = self.used
        self.used += 1
        self.new.append(chunk)
        return number


class Aligner:
    """Chunks of texts, each aligned once: per chunk number the counts of tokens
    and groups, the groups' text, and the linked pairs with their links."""

    CHUNKS = re.compile("[ \n]*[^ \n]+|[ \n]+")
    WHOLE = re.compile(f"[\x00-\x09\x0b-\x1f\x7f-\x9f{SPACE}�]|[^\\S \n]")

    def __init__(self, a_json: str, b_model: bytes) -> None:
        self.a, self.a_bytes = byte_level(a_json)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.b_bytes = piece_bytes(self.b)
        self.a_size, self.b_size = (np.array([len(t) for t in names]) for names in (self.a_bytes, self.b_bytes))
        self.lead = self.b.encode("\n")  # a space and a line feed
        pieces = [self.b.id_to_piece(i) for i in range(len(self.b_bytes))]
        if b"".join(self.b_bytes[i] for i in self.lead) != b" \n" or any("\n" in p for p in pieces):
            raise ValueError("the piece vocabulary has pieces with line feeds")
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
            raise ValueError("the piece vocabulary has pieces that go on into a space")
        # Ids as text, before each of the separators that may follow them.
        self.a_text, self.b_text = ({e: np.array([f"{i}{e}" for i in range(len(names))], dtype=object) for e in ends}
                                    for names, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;")))
        self.forget()

    def forget(self) -> None:
        self.numbers = Numbers()
        self.lost: set[int] = set()
        self.groups: list[str | None] = []  # None: a vocabulary loses bytes of the chunk
        self.counts = np.zeros((0, 3), dtype=np.int64)  # tokens of A and B, groups
        self.pair_at = np.zeros(1, dtype=np.int64)  # where each chunk's pairs begin
        self.pairs = self.times = np.zeros(0, dtype=np.int64)  # pairs by number
        self.known = self.number = np.zeros(0, dtype=np.int64)  # the pairs, sorted, and their numbers

    def forget_many(self) -> None:
        """Between runs, as chunks are numbered anew."""
        if len(self.groups) > KEPT_CHUNKS or len(self.pairs) > 10 * KEPT_CHUNKS:
            self.forget()

    def texts(self, texts: list[str | None]) -> list[np.ndarray]:
        """The chunk numbers of each text; none for one without tokens."""
        numbers, out, whole, none = self.numbers, [], [], np.zeros(0, dtype=np.int64)
        new = numbers.new = []
        for k, text in enumerate(texts):
            if not text:
                out.append(none)
            elif self.WHOLE.search(text):
                whole.append(k)
                out.append(none)
            else:
                chunks = self.CHUNKS.findall(" " + text)
                out.append(np.fromiter(map(numbers.__getitem__, chunks), dtype=np.int64, count=len(chunks)))
        # The vocabulary puts a space before what it encodes; a line feed keeps it apart from the chunk.
        n = len(self.lead)
        ids = self.b.encode(["\n" + c for c in new], num_threads=1)
        self.learn(new, [x[n:] if x[:n] == self.lead else None for x in ids])
        lost = self.lost
        if lost:
            whole += [k for k, found in enumerate(out) if not lost.isdisjoint(found.tolist())]
        first = len(self.groups)
        numbers.used += len(whole)
        spaced = [" " + texts[k] for k in whole]
        self.learn(spaced, self.b.encode([texts[k] for k in whole], num_threads=1))
        for i, k in enumerate(whole):
            out[k] = none if self.groups[first + i] is None else np.array([first + i])
        return out

    def learn(self, chunks: list[str], b_ids: list[list[int] | None]) -> None:
        """Number and align new chunks: their ids by B are given."""
        if not chunks:
            return
        # Every byte is a token of A, so A gives back any text; B's bytes are compared.
        wanted = [c.encode() for c in chunks]
        good = np.array([ids is not None for ids in b_ids])
        b, n_b = flat([ids or [] for ids in b_ids])
        b_end = np.cumsum(self.b_size[b])
        ends = np.append(0, b_end)[np.cumsum(n_b)]
        if (ends != np.cumsum([len(w) for w in wanted])).any() \
                or b"".join(map(self.b_bytes.__getitem__, b.tolist())) != b"".join(wanted):  # some differ: which ones
            good &= [b"".join(map(self.b_bytes.__getitem__, ids or [])) == w for ids, w in zip(b_ids, wanted)]
            b, n_b = flat([ids if ok else [] for ids, ok in zip(b_ids, good)])
            b_end = np.cumsum(self.b_size[b])
        a, n_a = flat([self.a.encode_ordinary(c) if ok else [] for c, ok in zip(chunks, good)])
        a_end = np.cumsum(self.a_size[a])
        # Chunks have the same bytes in both, so offsets run on from one to the next.
        ends = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
        chunk = np.repeat(np.arange(len(chunks)), n_a)  # of an A token
        of_group = np.zeros(len(ends), dtype=np.int64)
        of_group[a_group] = chunk
        n_groups = np.bincount(of_group, minlength=len(chunks))

        # The text: A tokens of each group, then its B tokens; the last separator of a chunk is cut off.
        last_a = np.append(a_group[1:] != a_group[:-1], True)[:len(a)]
        last_b = np.append(b_group[1:] != b_group[:-1], True)[:len(b)]
        words = np.concatenate([np.where(last_a, self.a_text["|"][a], self.a_text[","][a]),
                                np.where(last_b, self.b_text[";"][b], self.b_text[","][b])])
        order = np.argsort(np.concatenate([a_group * 2, b_group * 2 + 1]), kind="stable")
        words = words[order].tolist()
        at = np.append(0, np.cumsum(n_a + n_b)).tolist()
        self.lost.update((len(self.groups) + np.flatnonzero(~good)).tolist())
        self.groups += ["".join(words[i:j])[:-1] if ok else None for i, j, ok in zip(at, at[1:], good)]

        of_chunk, pairs, times = linked(a, a_group, b, b_group, of_group)
        pairs = self.pair_numbers(pairs)
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, n_groups], axis=1)])
        self.pair_at = np.append(self.pair_at, len(self.pairs) + np.cumsum(np.bincount(of_chunk, minlength=len(chunks))))
        self.pairs, self.times = np.concatenate([self.pairs, pairs]), np.concatenate([self.times, times])

    def pair_numbers(self, pairs: np.ndarray) -> np.ndarray:
        """Small numbers of the pairs, the same for a pair each time."""
        new = np.setdiff1d(pairs, self.known)
        number = len(self.known) + np.arange(len(new))
        at = np.searchsorted(self.known, new)
        self.known, self.number = np.insert(self.known, at, new), np.insert(self.number, at, number)
        return self.number[np.searchsorted(self.known, pairs)]


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All values in a row, and how many each list has."""
    size = np.array([len(x) for x in lists], dtype=np.int64)
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(size.sum())), size


def linked(a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray,
           of_group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct linked pairs (A id above the B id's bits) of each chunk, sorted by
    chunk and pair, and how often each is linked. Ids are counted per group
    first, so a long group costs the product of its distinct ids only."""

    def per_group(ids: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        key, n = np.unique(group << B_BITS | ids, return_counts=True)
        return key >> B_BITS, key & ((1 << B_BITS) - 1), n

    (ga, a, na), (gb, b, nb) = per_group(a, a_group), per_group(b, b_group)
    first = np.searchsorted(gb, ga)
    size = np.searchsorted(gb, ga, "right") - first
    left = np.repeat(np.arange(len(a)), size)
    right = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
    return summed(of_group[ga[left]], a[left] << B_BITS | b[right], na[left] * nb[right])


def summed(group: np.ndarray, key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``(group, key)``, sorted, with the sums of ``n``."""
    if not len(n):
        return group, key, n
    of_key, of_n = (int(x.max()).bit_length() for x in (key, n))
    if int(group.max()).bit_length() + of_key + of_n < 64:  # one plain sort of all three
        row = group << (of_key + of_n) | key << of_n | n
        row.sort()
        group, key, n = row >> (of_key + of_n), row >> of_n & ((1 << of_key) - 1), row & ((1 << of_n) - 1)
    else:
        order = np.lexsort((key, group))
        group, key, n = group[order], key[order], n[order]
    at = group_starts(group, key)
    return group[at], key[at], np.add.reduceat(n, at)


# --- runs of sorted records ------------------------------------------------------

def write_run(keys: np.ndarray, *cols: np.ndarray) -> bytes:
    """Sorted records as blocks: the sizes of the frames, then the frames."""
    squeeze = zstandard.ZstdCompressor(level=3)
    frames = [squeeze.compress(pack(keys[i:i + BLOCK].astype(np.uint64), *(narrow(c[i:i + BLOCK]) for c in cols)))
              for i in range(0, len(keys), BLOCK)]
    return np.array([len(frames), *map(len, frames)], dtype=np.uint32).tobytes() + b"".join(frames)


def run_blocks(data: bytes, n_cols: int) -> Iterator[list[np.ndarray]]:
    """The blocks of a run, one at a time: keys and columns."""
    view = memoryview(data)
    n = int(np.frombuffer(view[:4], dtype=np.uint32)[0])
    at = 4 * (n + 1)
    squeeze = zstandard.ZstdDecompressor()
    for size in np.frombuffer(view[4:at], dtype=np.uint32).tolist():
        yield unpack(squeeze.decompress(view[at:at + size]), n_cols)
        at += size


def read_run(data: bytes, n_cols: int) -> list[np.ndarray]:
    blocks = list(run_blocks(data, n_cols))
    return [np.concatenate([b[i].astype(np.uint64) for b in blocks]) for i in range(n_cols + 1)]


def heap_merge(runs: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """``(key, count, run)`` of the records of all runs by key; one block of
    each run is open at a time."""

    def records(k: int, data: bytes) -> Iterator[tuple[int, int, int]]:
        for keys, counts in run_blocks(data, 1):
            for key, count in zip(keys.tolist(), counts.tolist()):
                yield key, count, k

    return heapq.merge(*(records(k, data) for k, data in enumerate(runs)))


def sum_runs(runs: list[bytes]) -> bytes:
    """One run with the summed counts."""
    keys, counts = [], []
    for key, same in groupby(heap_merge(runs), key=itemgetter(0)):
        keys.append(key)
        counts.append(sum(c for _, c, _ in same))
    return write_run(np.array(keys, dtype=np.uint64), np.array(counts, dtype=np.uint64))


def total_runs(runs: list[bytes]) -> list[bytes]:
    """For each run its keys with the summed count of all runs and whether that
    is the greatest of the key's A id."""
    back: list[tuple[list[int], list[int], list[int]]] = [([], [], []) for _ in runs]
    for _, of_a in groupby(heap_merge(runs), key=lambda r: r[0] >> B_BITS):
        sums: dict[int, int] = {}
        came: list[tuple[int, int]] = []
        for key, count, k in of_a:
            sums[key] = sums.get(key, 0) + count
            came.append((key, k))
        most = max(sums.values())
        for key, k in came:
            keys, totals, best = back[k]
            keys.append(key)
            totals.append(sums[key])
            best.append(sums[key] == most)
    return [write_run(*(np.array(c, dtype=np.uint64) for c in columns)) for columns in back]


# --- the job ---------------------------------------------------------------------

OWN_ROW = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                     ("n_links", pa.int64()), ("groups", pa.string()), ("n_pairs", pa.int64())])


def _rows(**columns) -> pa.RecordBatch:
    types = {"run": pa.int64(), "grp": pa.int64(), "part": pa.int32(), "data": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) for c, t in types.items()], names=list(types))


def _align_run(aligner: Aligner, ids: list, texts: list, digest: bool) -> tuple[bytes, np.ndarray, np.ndarray]:
    """A run's own row (its documents and, for each, its pairs' places among the
    run's and their links), the run's pairs by part and key, and the number of
    documents that hold each."""
    found = aligner.texts(texts)
    groups = [";".join(map(aligner.groups.__getitem__, x.tolist())) for x in found]
    if digest:
        groups = [hashlib.sha256(x.encode()).hexdigest() if x else x for x in groups]
    n = len(found)
    chunk, doc = np.concatenate([*found, np.zeros(0, np.int64)]), np.repeat(np.arange(n), [len(x) for x in found])
    counts = [np.bincount(doc, aligner.counts[chunk, k], n).astype(np.int64) for k in range(3)]
    # A document's chunks, each once with its times, then their pairs.
    doc, chunk, of_chunk = summed(doc, chunk, np.ones(len(doc), dtype=np.int64))
    first, many = aligner.pair_at[chunk], aligner.pair_at[chunk + 1] - aligner.pair_at[chunk]
    at = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
    doc, number, times = summed(np.repeat(doc, many), aligner.pairs[at], np.repeat(of_chunk, many) * aligner.times[at])
    n_links = np.bincount(doc, times, n).astype(np.int64)
    # The pairs that occur, in the order of their parts and keys, and their places there.
    n_docs = np.bincount(number, minlength=len(aligner.known))
    key = np.empty(len(aligner.known), dtype=np.int64)
    key[aligner.number] = aligner.known
    used = np.flatnonzero(n_docs)
    used = used[np.lexsort((key[used], (key[used] >> B_BITS) % RADIX))]
    places = np.zeros(len(key), dtype=np.uint32)
    places[used] = np.arange(len(used))
    pairs, place = key[used], places[number]
    columns = [ids, *counts, n_links, groups, np.bincount(doc, minlength=n)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, OWN_ROW)], schema=OWN_ROW)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, OWN_ROW) as out:
        out.write_batch(batch)
    table, times = sink.getvalue().to_pybytes(), narrow(times)
    head = np.array([len(table), len(place), times.itemsize], dtype=np.int64).tobytes()
    own = zstandard.ZstdCompressor(level=3).compress(head + table + place.tobytes() + times.tobytes())
    return own, pairs, n_docs[used]


def _own_row(data: bytes) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    size, n, item = np.frombuffer(raw, np.int64, 3).tolist()
    with pa.ipc.open_stream(pa.py_buffer(raw[24:24 + size])) as stream:
        docs = stream.read_all()
    return (docs, np.frombuffer(raw, np.uint32, n, 24 + size),
            np.frombuffer(raw, f"<u{item}", n, 24 + size + 4 * n).astype(np.int64))


def align_tokenizers(docs: DataFrame, a_json: str, b_model: bytes, digest: bool = False) -> DataFrame:
    """For each row of ``docs`` (``doc_id``, ``text``) its A and B tokens, groups
    and links, the links whose count is the greatest of their A id (``n_best``),
    the sum of its links' counts, and ``groups``: the ids of each group as
    ``a1,a2|b1;a3|b2,b3``, or the SHA-256 of that text with ``digest``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((a_json, b_model))
    # So many groups of runs that a merge reads about FAN of them (a run may be shorter than it can be).
    n_groups = max(1, -(-(input_bytes(docs) or 0) // (RUN_BYTES * FAN // 4)))

    def spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*shared.value)
        for batch in slices(batches, limit=RUN_BYTES):
            run = batch.column(0)[0].as_py()
            aligner.forget_many()
            own, pairs, n_docs = _align_run(aligner, batch.column(1).to_pylist(), batch.column(2).to_pylist(), digest)
            part = (pairs >> B_BITS) % RADIX
            at = group_starts(part) if len(part) else np.zeros(0, np.int64)
            ends = np.append(at[1:], len(part))
            data = [own, *(write_run(pairs[i:j], n_docs[i:j]) for i, j in zip(at, ends))]
            n = len(data)
            grp = (run ^ run >> 33) % n_groups
            yield _rows(run=[run] * n, grp=[grp] * n, part=[OWN, *part[at].tolist()], data=data)

    def added(level: DataFrame, next_groups: int) -> DataFrame:
        """The sums of each group of ``level``, as rows of the next level: ``run`` is
        the number of the group, ``grp`` that of the group it meets there."""

        def add(group: pa.Table) -> pa.Table:
            grp, part = group.column("grp")[0].as_py(), group.column("part")[0].as_py()
            return pa.Table.from_batches([_rows(run=[grp], grp=[grp % next_groups], part=[part],
                                                data=[sum_runs(group.column("data").to_pylist())])])

        return level.groupBy("grp", "part").applyInArrow(add, SENT)

    def total(group: pa.Table) -> pa.Table:
        data = total_runs(group.column("data").to_pylist())
        return pa.Table.from_batches([_rows(run=group.column("run").to_pylist(), grp=[None] * len(data),
                                            part=group.column("part").to_pylist(), data=data)])

    def given_back(level: DataFrame, answers: DataFrame, is_last: bool) -> DataFrame:
        """Each row of ``level`` gets the counts of its keys from the answer to its group."""

        def give_back(group: pa.Table) -> pa.Table:
            runs, data = group.column("run").to_pylist(), group.column("data").to_pylist()
            keys, totals, best = read_run(data[runs.index(None)], 2)
            out, to = [], []
            for run, sent in zip(runs, data):
                if run is not None:
                    own = read_run(sent, 1)[0]
                    at = np.searchsorted(keys, own)
                    out.append(write_run(np.arange(len(at)) if is_last else own, totals[at], best[at]))
                    to.append(run)
            n = len(out)
            return pa.Table.from_batches([_rows(run=to, grp=[None] * n, part=[group.column("part")[0].as_py()] * n, data=out)])

        to_group = answers.select(F.lit(None).cast("long").alias("run"), F.col("run").alias("grp"), "part", "data")
        return level.unionByName(to_group).groupBy("grp", "part").applyInArrow(give_back, SENT)

    def gather(group: pa.Table) -> pa.Table:
        data = dict(zip(group.column("part").to_pylist(), group.column("data").to_pylist()))
        docs, place, times = _own_row(data.pop(OWN))
        answers = [read_run(data[p], 2) for p in sorted(data)]  # in the order of the run's pairs
        totals, best = (np.concatenate([a[i] for a in answers] or [np.zeros(0, np.uint64)]).astype(np.int64) for i in (1, 2))
        doc = np.repeat(np.arange(docs.num_rows), docs.column("n_pairs").to_numpy())
        sums = []
        for x in (best, totals):
            found = np.zeros(docs.num_rows, dtype=np.int64)
            np.add.at(found, doc, times * x[place] if len(place) else times)
            sums.append(found)
        docs = docs.append_column("n_best", pa.array(sums[0])).append_column("count_sum", pa.array(sums[1]))
        return docs.select(NAMES)

    rows = docs.select(F.monotonically_increasing_id().alias("run"), "doc_id", "text")
    path = scratch_path(spark, "alignment-runs")
    spilled = rows.mapInArrow(spill, SENT).withColumn("own", F.col("part") == OWN)
    spilled.write.partitionBy("own").parquet(path)
    written = spark.read.schema(spilled.schema).parquet(path)
    own, runs = (written.filter(F.col("own") == is_own).drop("own") for is_own in (True, False))
    levels, n = [runs], n_groups
    while n > FAN:
        n = -(-n // FAN)
        levels.append(cut(added(levels[-1], n), "alignment-sums"))
    sums = added(levels[-1], 1)
    answers = cut(sums.groupBy("part").applyInArrow(total, SENT), "alignment-totals")
    for level in reversed(levels):
        answers = given_back(level, answers, level is runs)
    return own.unionByName(answers).groupBy("run").applyInArrow(gather, DOC)

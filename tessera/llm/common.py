"""Helpers shared by the operators: table binding, written cuts, word hashing.

A *word* is a maximal run of characters outside ``[\\x20\\x09-\\x0D]`` (space and
the five ASCII line and tab characters), the same rule for every operator.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import input_bytes, scratch_path

WORD = r"[^\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SLICE_BYTES = 2 << 20  # texts are handled in slices of about this size


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str, conf: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    The lineage ends at the written files, so a lost executor costs only its
    running tasks, and the shuffle files behind the table are deleted as soon
    as it is written instead of when the driver collects its garbage. ``conf``
    holds while it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    conf = {CLEANUP: "true", **(conf or {})}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


PROPORTIONAL = 512 << 20  # input up to which buckets follow it in proportion
BUCKET_BYTES, BUCKET_MOST = 4 << 20, 128 << 20  # input of a bucket there, and at most
SLICE_MOST = 16 << 20


def bucket_count(size: int, per_bucket: int = BUCKET_BYTES) -> int:
    """Hash buckets (a power of two, 8 at least) for ``size`` input bytes.

    A slice sends a row to each bucket, so rows are slices times buckets. Were
    both in proportion to the input, a row would hold fewer and fewer postings.
    So beyond ``PROPORTIONAL`` buckets, and slices too (``slice_bytes``), grow
    with the square root of the input, up to what one task can hold of each."""
    wanted = -(-size // per_bucket)
    if size > PROPORTIONAL:
        wanted = max(math.ceil(math.sqrt(PROPORTIONAL * size) / per_bucket), -(-size // max(per_bucket, BUCKET_MOST)))
    return 1 << max(3, (max(1, wanted) - 1).bit_length())


def buckets_for(df: DataFrame, per_bucket: int = BUCKET_BYTES) -> int:
    """``bucket_count`` for what ``df`` reads."""
    return bucket_count(input_bytes(df) or 0, per_bucket)


def slice_limit(size: int, least: int = SLICE_BYTES) -> int:
    """Bytes of a slice that sends postings, for ``size`` input bytes."""
    return max(least, min(SLICE_MOST, int(least * math.sqrt(max(1.0, size / PROPORTIONAL)))))


def slice_bytes(df: DataFrame, least: int = SLICE_BYTES) -> int:
    return slice_limit(input_bytes(df) or 0, least)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of about ``limit`` bytes of ``column``
    (one row at least), so memory follows the longest text, not the row count."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def encoded(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column's texts as UTF-8; a null text is empty."""
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    return [x or b"" for x in col.to_pylist()]


# --- vectorised word hashes -------------------------------------------------

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_KEEP = np.array([(1 << (8 * i)) - 1 for i in range(9)], dtype=np.uint64)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3,
                 0x1D8E4E27C47D124F], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, counts)``: a 64-bit hash of every word of every text, in
    order, and the number of words of each text. Reads eight bytes of all
    words at a time, so the cost is a few vector operations per word."""
    buf = np.frombuffer(b" " + b" ".join(texts) + b" " * 9, dtype=np.uint8)
    space = _SPACE[buf]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    begin = np.cumsum([1, *(len(t) + 1 for t in texts)])
    counts = np.diff(np.searchsorted(starts, begin))
    size = ends - starts
    octets = np.ndarray((len(buf) - 7,), dtype="<u8", buffer=buf.data, strides=(1,))
    h = mix((octets[starts] & _KEEP[np.minimum(size, 8)]) + size.astype(np.uint64) * _ODD[0])
    long, off = np.flatnonzero(size > 8), 8
    while long.size:
        part = octets[starts[long] + off] & _KEEP[np.minimum(size[long] - off, 8)]
        h[long] = mix(h[long] * _ODD[1] + part)
        off += 8
        long = long[size[long] > off]
    return h, counts


def window_hashes(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes (empty if there are fewer)."""
    n = len(h) - k + 1
    if n <= 0:
        return h[:0]
    acc = np.full(n, np.uint64((seed * 2 + 1) * int(_ODD[k % 13]) % (1 << 64)))
    for j in range(k):
        acc += h[j:j + n] * (_ODD[(j + seed) % 13] + np.uint64(2 * (j // 13) + 4 * seed))
    return mix(acc)


# --- packed postings --------------------------------------------------------
# A posting list travels as one row per (task slice, bucket): its sorted 64-bit
# keys as byte planes of their differences (the shuffle's compression removes
# the empty planes), then its columns. The bucket is the key's top bits.

def planes(x: np.ndarray) -> bytes:
    x = np.ascontiguousarray(x)
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def unplanes(data: memoryview, n: int, dtype) -> tuple[np.ndarray, memoryview]:
    size = np.dtype(dtype).itemsize * n
    x = np.frombuffer(data[:size], dtype=np.uint8).reshape(-1, n).T if n else np.zeros((0, 1), np.uint8)
    return (np.ascontiguousarray(x).view(dtype).reshape(-1) if n else np.zeros(0, dtype)), data[size:]


def pack(keys: np.ndarray, *cols: np.ndarray) -> bytes:
    """Sorted ``keys`` and their columns as bytes (see ``unpack``)."""
    head = np.array([len(keys), *(c.dtype.itemsize for c in cols)], dtype=np.uint32)
    gaps = np.diff(keys, prepend=np.uint64(0))
    return head.tobytes() + b"".join([planes(gaps), *map(planes, cols)])


def unpack(data: bytes, n_cols: int = 0) -> list[np.ndarray]:
    """Keys and columns (as unsigned integers) of one packed list."""
    view = memoryview(data)
    head = np.frombuffer(view[:4 * (n_cols + 1)], dtype=np.uint32)
    view = view[4 * (n_cols + 1):]
    gaps, view = unplanes(view, int(head[0]), np.uint64)
    out = [np.cumsum(gaps, dtype=np.uint64)]
    for size in head[1:]:
        col, view = unplanes(view, int(head[0]), f"<u{size}")
        out.append(col)
    return out


def narrow(x: np.ndarray) -> np.ndarray:
    """The smallest unsigned type that holds ``x``."""
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else
                    np.uint32 if top < 1 << 32 else np.uint64)


def bucket_ranges(keys: np.ndarray, n_buckets: int) -> Iterator[tuple[int, int, int]]:
    """``(bucket, from, to)`` for each bucket that the sorted keys fall in."""
    shift = np.uint64(64 - (n_buckets.bit_length() - 1))
    top = (keys >> shift).astype(np.int64) if n_buckets > 1 else np.zeros(len(keys), np.int64)
    at = np.flatnonzero(np.diff(top, prepend=-1))
    for a, b in zip(at, [*at[1:], len(keys)]):
        yield int(top[a]), int(a), int(b)


def group_starts(*sorted_cols: np.ndarray) -> np.ndarray:
    """Index of the first row of each run of equal rows."""
    n = len(sorted_cols[0])
    if not n:
        return np.zeros(0, np.int64)
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for c in sorted_cols:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def crc_fold(id_col, parts: int):
    """``crc32(id as text) mod parts``: the split of rows that are held out."""
    return F.crc32(id_col.cast("string").cast("binary")) % parts

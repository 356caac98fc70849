"""Quality rules by compression bands.

A text's zstandard ratio (bytes before / bytes after) is high when it repeats
itself and near one when it is noise. The ratio of clean prose grows with the
length of the text, so the limits go by length. Each text is judged twice:

* the whole document against the band of its length;
* fixed chunks of ``part_bytes`` and again of ``chunk_bytes`` bytes (noise shows
  in short ones, a repeated long line only in long ones), each compressed alone against the
  band of a chunk, so a repeated or random part of a text is seen; the last
  chunk reaches back from the end, so every byte is judged. A text up to
  ``part_bytes`` is one chunk, one up to ``chunk_bytes`` has no long chunk
  besides itself. The document fails when more than ``max_bad_chunks`` of its
  chunks of one size fail.

Texts below ``min_bytes`` are too short for a ratio to mean anything and pass
this test (the word count rule of the base statistics sees to them).

Defined results: a null or empty text has no words, ratio 1.0 and no chunks,
and fails the base rule. Rows are judged one by one, so repeated rows give
equal rows, an empty table gives none, and other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tessera.llm.common import slices

# (bytes from, least ratio, greatest ratio) of a whole text of that length or more.
BANDS = ((0, 0.0, 9.9), (128, 0.8, 2.2), (256, 1.0, 2.1), (512, 1.2, 2.15), (1024, 1.35, 2.25), (2048, 1.5, 2.35),
         (4096, 1.6, 2.45), (8192, 1.65, 2.6), (16384, 1.7, 2.8), (32768, 1.7, 3.0), (131072, 1.7, 3.4))
SYMBOLS = b"#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long")


@dataclass(frozen=True)
class CompressionBands:
    """Limits of the method: ``bands`` by length, ``level`` of the compressor,
    ``part_bytes`` and ``chunk_bytes`` per chunk and the share of bad chunks that is accepted."""
    bands: tuple = BANDS
    level: int = 3
    min_bytes: int = 128
    part_bytes: int = 512
    chunk_bytes: int = 4096
    max_bad_chunks: float = 0.2

    def within(self, size: int, ratio: float) -> bool:
        low, high = next((lo, hi) for at, lo, hi in reversed(self.bands) if size >= at)
        return low <= ratio <= high


def chunks(data: bytes, size: int) -> list[bytes]:
    """``data`` in chunks of ``size`` bytes, the last one overlapping to the end."""
    last = max(0, len(data) - size)
    return [data[a:a + size] for a in (*range(0, last, size), last)] if data else []


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice in ``words``."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    hit = np.fromiter((counts[w] > 1 for w in windows), dtype=bool, count=len(windows))
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[k:k + len(windows)] |= hit
    return int(covered.sum())


def base_stats(text: str, data: bytes) -> tuple[int, int, int, int, int]:
    words = data.split()  # splits bytes at the same six characters
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            dup += line in seen
            seen.add(line)
    chars = len(text) - sum(text.count(c) for c in BLANKS)
    return len(words), chars, sum(data.count(c) for c in SYMBOLS), dup, repeated_words(words)


def compression_quality(docs: DataFrame, limits: CompressionBands = CompressionBands()) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``) with the base
    statistics, the ratio of the whole text, the number of chunks and of bad
    chunks, and the verdict ``kept``. One narrow pass, no shuffle."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=limits.level, write_content_size=False)
        for part in slices(batches):
            rows = []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                text = text or ""
                data = text.encode()
                stats = base_stats(text, data)
                size = len(data)
                ratio = size / len(press.compress(data)) if size else 1.0
                sets = [chunks(data, limits.part_bytes)]
                if size > limits.chunk_bytes:
                    sets.append(chunks(data, limits.chunk_bytes))
                bad = [sum(not limits.within(len(c), len(c) / len(press.compress(c))) for c in cuts) for cuts in sets]
                failed = stats[0] < 50 or 100 * stats[4] > 50 * stats[0]
                fine = size < limits.min_bytes or (limits.within(size, ratio) and
                                                   all(b <= limits.max_bad_chunks * len(c) for b, c in zip(bad, sets)))
                rows.append((doc_id, *stats, failed, not failed and fine, ratio, sum(map(len, sets)), sum(bad)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), OUT)], schema=OUT)

    return docs.select("doc_id", "text").mapInArrow(judge, SCHEMA)


OUT = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("base_failed", pa.bool_()),
    ("kept", pa.bool_()), ("ratio", pa.float64()), ("n_chunks", pa.int64()), ("n_bad_chunks", pa.int64())])

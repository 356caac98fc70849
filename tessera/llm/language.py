"""Language identification by compression.

For each language a zstandard raw-content dictionary is built from a bounded
sample of labelled texts. A text is compressed once with each dictionary, in
chunks of ``chunk_bytes`` so that the dictionary, not the text's own history,
decides on long texts too; the smallest total wins. Letter case is folded on
both sides. The margin is
``(second - best) / second``: the share of the output that the best dictionary
saves against the runner-up. A text is rejected (``accepted`` is false) when
its margin is below ``min_margin``.

Defined results: a null text, or one without any letter, is ``und`` with score
0 and rejected; with a single learned language the margin is 1; ties go to the
first language in alphabetical order. Without any training row every text is
``und``. Repeated rows give equal rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import slices

SCHEMA = "doc_id long, lang_pred string, score double, margin double, accepted boolean"
OUT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
                 ("margin", pa.float64()), ("accepted", pa.bool_())])


@dataclass(frozen=True)
class LanguageParams:
    """``sample_docs`` texts per language (the bound of the training sample),
    ``sample_chars`` of each, ``dict_bytes`` per dictionary: each sampled text
    has an equal share of those bytes, and shorter ones leave theirs to the rest."""
    sample_docs: int = 200
    sample_chars: int = 2000
    dict_bytes: int = 96 << 10
    chunk_bytes: int = 2048
    level: int = 6
    min_margin: float = 0.0005
    full_margin: float = 0.08


def fit_dictionaries(train: DataFrame, params: LanguageParams = LanguageParams()) -> dict[str, bytes]:
    """Raw dictionary content per language from rows ``(doc_id, text, lang)``.

    The sample is the ``sample_docs`` rows of each language with the smallest
    hash of the id (a fixed random choice), so at most that many texts per
    language reach the driver; the group limit is applied before the shuffle.
    """
    rows = (train.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}"))
            .select("lang", F.xxhash64(F.lit("lang"), "doc_id").alias("o"),
                    F.lower(F.substring("text", 1, params.sample_chars)).alias("part")))
    top = Window.partitionBy("lang").orderBy("o", "part")
    picked = rows.withColumn("r", F.row_number().over(top)).filter(F.col("r") <= params.sample_docs)
    by: dict[str, list[tuple[int, str]]] = {}
    for r in picked.select("lang", "r", "part").collect():
        by.setdefault(r["lang"], []).append((r["r"], r["part"]))
    return {k: shared_bytes([t.encode() for _, t in sorted(v)], params.dict_bytes) for k, v in sorted(by.items())}


def shared_bytes(texts: list[bytes], limit: int) -> bytes:
    """All ``texts``, a line each, the longer ones cut to one length so that the
    whole has at most ``limit`` bytes."""
    room, longest = limit, 0
    for k, size in enumerate(sorted(len(t) + 1 for t in texts)):
        longest = room // (len(texts) - k)  # of those that are left, if they are all cut
        if size > longest:
            break
        room -= size
        longest = limit
    return b"".join(t[:max(0, longest - 1)] + b"\n" for t in texts)[:limit]


class Classifier:
    """Prediction of one text at a time, inside a task."""

    def __init__(self, dictionaries: dict[str, bytes], params: LanguageParams) -> None:
        self.langs, self.params = sorted(dictionaries), params
        self.press = []
        for k in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=params.level)
            self.press.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False))

    def __call__(self, text: str | None) -> tuple[str, float, float, bool]:
        """Language, score, margin and whether the text is accepted."""
        if not self.press or text is None or not any(map(str.isalpha, text)):
            return "und", 0.0, 0.0, False
        data, step = text.lower().encode(), self.params.chunk_bytes
        chunks = [data[a:a + step] for a in range(0, len(data), step)]
        sizes = [sum(len(p.compress(c)) for c in chunks) for p in self.press]
        order = sorted(range(len(sizes)), key=sizes.__getitem__)
        best = sizes[order[0]]
        margin = (sizes[order[1]] - best) / sizes[order[1]] if len(sizes) > 1 else 1.0
        return (self.langs[order[0]], min(1.0, margin / self.params.full_margin), margin,
                margin >= self.params.min_margin)


def identify_language(docs: DataFrame, dictionaries: dict[str, bytes],
                      params: LanguageParams = LanguageParams()) -> DataFrame:
    """``doc_id, lang_pred, score, margin, accepted`` for each row of ``docs``
    (``doc_id``, ``text``). ``score`` in 0..1 is the margin against
    ``full_margin``, at most 1. One narrow pass, no shuffle."""

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = Classifier(dictionaries, params)
        for part in slices(batches):
            found = [predict(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).cast(pa.int64()), *(pa.array(c, t.type) for c, t in zip(zip(*found), list(OUT)[1:]))],
                schema=OUT)

    return docs.select("doc_id", "text").mapInArrow(classify, SCHEMA)


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes],
                    params: LanguageParams = LanguageParams()) -> DataFrame:
    """The rows of ``docs`` whose language is accepted, all columns unchanged
    but for ``lang``, which is filled in where it is null."""
    text, lang = docs.columns.index("text"), docs.columns.index("lang")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = Classifier(dictionaries, params)
        for part in slices(batches):
            found = [predict(t) for t in part.column(text).to_pylist()]
            named = pc.coalesce(part.column(lang), pa.array([f[0] for f in found], part.column(lang).type))
            full = pa.RecordBatch.from_arrays([named if i == lang else c for i, c in enumerate(part.columns)],
                                              schema=part.schema)
            yield full.filter(pa.array([f[3] for f in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)

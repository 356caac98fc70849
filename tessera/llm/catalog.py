"""Queries of this subpackage: ``name -> f(spark, sf_dir) -> DataFrame``.

Each applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (alignment, ann, html, jaccard_join, language, licenses, lm, mixing, oracle, packing, periodic, pii,
                         quality, substring_dedup)
from tessera.llm.common import crc_fold, table


def q_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.compression_quality(table(spark, sf, "documents"))


def q_substring(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf, "documents"))


def q_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf, "documents"))


def q_mixing(spark: SparkSession, sf: str) -> DataFrame:
    out = mixing.mix_sources(table(spark, sf, "documents"))
    return out.withColumns({c: F.round(c, 9) for c in ("share", "weight")})


def q_html(spark: SparkSession, sf: str) -> DataFrame:
    return html.extract_main_text(table(spark, sf, "pages"))


def q_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held = crc_fold(F.col("doc_id"), 5) == 0
    found = language.identify_language(docs, language.fit_dictionaries(docs.filter(~held)))
    return found.withColumn("held_out", held)


def tokenizer_json(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def q_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"), tokenizer_json())


def q_ann(spark: SparkSession, sf: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf, "embeddings"), k=20, query_every=20)


PPM_ORDER = 5


def q_lm(spark: SparkSession, sf: str) -> DataFrame:
    held = crc_fold(F.col("doc_id"), 10) == 0
    out = lm.score_documents(table(spark, sf, "documents").select("doc_id", "text"), ~held, PPM_ORDER)
    return out.withColumn("held_out", held)


def q_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf, "documents"))


def plant_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of every tenth id (by CRC-32) made periodic from one on; a row
    without an id keeps its words."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * -(-(n - a) // p))[:n - a]


def q_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic.periodic_runs(table(spark, sf, "documents"), edit=plant_period)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.col2")).alias("start"),
        F.col("best.length"), (-F.col("best.col3")).alias("period"),
        F.expr("1000 * best.length div -best.col3").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def q_licenses(spark: SparkSession, sf: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["start"])

    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"),
        "score")


def q_alignment(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        pieces = f.read()
    found = alignment.align_tokenizers(table(spark, sf, "documents"), tokenizer_json("byte_bpe_50k.json"), pieces, digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_compression_quality": q_quality,
    "op2_substring_dedup": q_substring,
    "op3_ngram_jaccard_join": q_jaccard,
    "op4_source_mixing": q_mixing,
    "op5_html_main_text": q_html,
    "op6_cutting_stock_packing": q_packing,
    "op7_language_id": q_language,
    "op8_hnsw_neighbours": q_ann,
    "op9_ppm_score": q_lm,
    "op10_pii": q_pii,
    "op11_periodic_runs": q_runs,
    "op12_license_scan": q_licenses,
    "op13_tokenizer_alignment": q_alignment,
}

SQL: dict[str, str] = {
    "op4_source_mixing": oracle.mixing_sql(),
    "op10_pii": oracle.pii_sql(),
}

"""Word counts over text lines.

Tokenising is ``explode(split(...))`` inside whole-stage codegen; counting is
a partial + final hash aggregate, so frequent words (a third of all tokens can
be "the") are combined per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import split_rows

# The seven helper words removed by the sorted word count.
STOP_WORDS = ["the", "you", "a", "on", "in", "to", "of"]


def tokens(lines: DataFrame, regex: str = " ", col: str = "value", lower: bool = False,
           stop_words: Iterable[str] | None = None, case_sensitive_stop: bool = True) -> DataFrame:
    """One row per token: ``word``.

    ``stop_words`` are removed; with ``case_sensitive_stop=True`` the test runs
    before lowercasing (so "The" survives and is then counted as "the"), which
    is what the original sorted word count does.
    """
    words = split_rows(lines, col, regex, "word")
    if stop_words is not None and case_sensitive_stop:
        words = words.filter(~F.col("word").isin(list(stop_words)))
    if lower:
        words = words.select(F.lower("word").alias("word"))
    if stop_words is not None and not case_sensitive_stop:
        words = words.filter(~F.col("word").isin([w.lower() for w in stop_words]))
    return words


def word_count(lines: DataFrame, regex: str = " ", col: str = "value", lower: bool = False,
               stop_words: Iterable[str] | None = None, case_sensitive_stop: bool = True,
               count_col: str = "count") -> DataFrame:
    """Occurrences of each token (empty tokens included, as a split yields them)."""
    words = tokens(lines, regex, col, lower, stop_words, case_sensitive_stop)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias(count_col))


def word_count_space(lines: DataFrame, col: str = "value") -> DataFrame:
    """Split on a single space, count each token."""
    return word_count(lines, " ", col)


def word_count_regex(lines: DataFrame, col: str = "value") -> DataFrame:
    """Split on runs of non-word characters, lowercase, count."""
    return word_count(lines, r"\W+", col, lower=True)


def word_count_stop_sorted(lines: DataFrame, col: str = "value", stop_words: Iterable[str] = STOP_WORDS,
                           case_sensitive_stop: bool = True) -> DataFrame:
    """Regex words minus stop words, lowercased, counted, ascending by count then word."""
    counts = word_count(lines, r"\W+", col, lower=True, stop_words=stop_words,
                        case_sensitive_stop=case_sensitive_stop)
    return counts.orderBy("count", "word")


def remove_words(words: DataFrame, banned: DataFrame, col: str = "word", banned_col: str = "word") -> DataFrame:
    """Anti join against a word list (e.g. a stop-word file). The list is
    deduplicated first; Catalyst broadcasts it when its size is small."""
    b = banned.select(F.col(banned_col).alias("_banned")).distinct()
    return words.join(b, words[col] == b["_banned"], "left_anti")

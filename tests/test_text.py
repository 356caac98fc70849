from pyspark.sql import functions as F

from conftest import rows
from tessera.functions.text import java_split, split_rows, text_lines
from tessera.operators import wordcount


def _split(spark, values, regex):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["t"] for r in df.select("i", java_split(F.col("v"), regex).alias("t")).orderBy("i").collect()]


def test_java_split_rules(spark):
    got = _split(spark, ["", " ", "  a b  ", " a", "a  b", "x"], " ")
    assert got == [[""], [], ["", "", "a", "b"], ["", "a"], ["a", "", "b"], ["x"]]


def test_java_split_regex_ascii_word(spark):
    got = _split(spark, ["Hello, world.", "...", ", a", "naïve"], r"\W+")
    assert got == [["Hello", "world"], [], ["", "a"], ["na", "ve"]]


def test_split_rows_equal_java_split(spark):
    """The word-count delimiters against the general rule, and their plan."""
    import random

    rnd = random.Random(3)
    values = ["", " ", "   ", " a ", "...", ", a", "a,", "x" * 50 + " " * 400, "!" * 500 + "b" + "!" * 500] + [
        "".join(rnd.choice("ab ,.é") for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    for regex in (" ", r"\W+", ","):
        got = rows(split_rows(df, "value", regex, "word"))
        assert got == rows(df.select(F.explode(java_split(F.col("value"), regex)).alias("word")))
    plan = wordcount.word_count_regex(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1


def test_text_lines(spark):
    df = spark.createDataFrame([(0, "a\nb\n"), (1, "a\r\nb"), (2, ""), (3, "\n"), (4, "a\n\nb\n\n")], "i int, t string")
    got = [r["l"] for r in df.select("i", text_lines("t").alias("l")).orderBy("i").collect()]
    assert got == [["a", "b"], ["a", "b"], [], [""], ["a", "", "b", ""]]


def test_word_count_space_counts_empty_tokens(spark):
    lines = spark.createDataFrame([("the cat  sat",), ("",), ("   ",), (" the",)], "value string")
    got = dict(rows(wordcount.word_count_space(lines), "word", "count"))
    assert got == {"the": 2, "cat": 1, "": 3, "sat": 1}


def test_word_count_regex_lowercases(spark):
    lines = spark.createDataFrame([("The cat, the CAT!",), ("don't",)], "value string")
    got = dict(rows(wordcount.word_count_regex(lines), "word", "count"))
    assert got == {"the": 2, "cat": 2, "don": 1, "t": 1}


def test_stop_words_filter_before_lowercase(spark):
    lines = spark.createDataFrame([("The the a A of Of cat",)], "value string")
    out = wordcount.word_count_stop_sorted(lines)
    # Case-sensitive removal first: "The", "A", "Of" survive and count lowercased.
    assert [(r["word"], r["count"]) for r in out.collect()] == [("a", 1), ("cat", 1), ("of", 1), ("the", 1)]
    out2 = wordcount.word_count_stop_sorted(lines, case_sensitive_stop=False)
    assert [(r["word"], r["count"]) for r in out2.collect()] == [("cat", 1)]


def test_remove_words_anti_join(spark):
    words = spark.createDataFrame([("a",), ("b",), ("c",), ("b",)], "word string")
    banned = spark.createDataFrame([("b",), ("b",)], "word string")
    assert rows(wordcount.remove_words(words, banned)) == [("a",), ("c",)]


def test_java_split_random_strings_match_java_rule(spark):
    """Java's rule: split, drop trailing empty tokens, "" -> [""]; ASCII \\W."""
    import random
    import re

    def java(s, regex):
        if s == "":
            return [""]
        parts = re.split(regex, s, flags=re.ASCII)
        while parts and parts[-1] == "":
            parts.pop()
        return parts

    rnd = random.Random(3)
    values = ["".join(rnd.choice("ab ,.é") for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    values += ["=" * 5000 + "x" + " " * 3000, " " * 4000]
    for regex in (" ", r"\W+"):
        assert _split(spark, values, regex) == [java(v, regex) for v in values]

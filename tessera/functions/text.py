"""String helpers expressed as built-in Column expressions (no Python UDF).

``java_split`` reproduces ``java.lang.String.split(regex)`` with limit 0, which
is what every line parser in the original programs calls:

* the empty string splits to one empty token;
* leading empty tokens are kept;
* trailing empty tokens are dropped, so a line made only of delimiters gives
  no token at all.

``F.split`` keeps trailing empty tokens. ``java_split`` cuts the split array
after its last non-empty token (found with ``transform`` + ``array_max``): one
regex pass per line, linear in its length however long a delimiter run is.
``split_rows`` explodes the tokens; it cuts the trailing delimiters off the line
first, so everything stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Line terminators recognised by Hadoop's line reader (what a text scan uses).
LINE_BREAK = "\r\n|\r|\n"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_string_array() -> Column:
    return F.array_remove(F.array(F.lit("")), "")


def java_split(c, regex: str) -> Column:
    """``String.split(regex)`` semantics as a Column of ``array<string>``."""
    c = _col(c)
    parts = F.split(c, regex)
    last = F.array_max(F.transform(parts, lambda x, i: F.when(x != "", i + 1).otherwise(F.lit(0))))
    return F.when(c == "", F.array(F.lit(""))).otherwise(F.slice(parts, F.lit(1), last))


def split_rows(lines: DataFrame, col: str, regex: str, out: str) -> DataFrame:
    """One row per token of ``java_split``, for the delimiters of the word counts.

    The trailing delimiters go before the split (lines of delimiters only have
    no token), so a plain ``split`` is exploded: it is evaluated once and the
    generator stays inside whole-stage codegen. Other delimiters take the
    general expression.
    """
    c = F.col(col)
    if regex == " ":
        kept, body = F.rtrim(c) != "", F.rtrim(c)
    elif regex == r"\W+":
        # Only tried at the start of a run of non-word characters: linear in the line.
        kept, body = c.rlike(r"\w"), F.regexp_replace(c, r"(?<!\W)\W++\z", "")
    else:
        return lines.select(F.explode(java_split(c, regex)).alias(out))
    return lines.filter((c == "") | kept).select(F.explode(F.split(body, regex)).alias(out))


def text_lines(c) -> Column:
    """Lines of a whole text, as a line-oriented text scan would return them.

    One final terminator does not start a new line; an empty text has no line.
    """
    c = _col(c)
    body = F.regexp_replace(c, f"(?:{LINE_BREAK})\\z", "")
    return F.when(c == "", empty_string_array()).otherwise(F.split(body, LINE_BREAK))


def hashtags(c) -> Column:
    """All ``#word`` tokens of a text, in order (``\\w`` is ASCII, as in Java)."""
    return F.regexp_extract_all(_col(c), F.lit(r"#\w+"), F.lit(0))

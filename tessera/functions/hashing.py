"""Order-independent, engine-portable row hashing for deterministic splits.

A split must not depend on partition layout (a recomputed task after executor
loss has to put every row on the same side), and the SQL oracle must be able to
recompute it. Both hold for the first 32 bits of ``md5`` over a ``|``-joined
key string: Spark and DuckDB compute md5 identically, and comparing fixed-width
lowercase hex strings is the same as comparing the numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 8
SCALE = 16 ** HEX_DIGITS


def hash_prefix(cols: Sequence, seed: int | str = 0) -> Column:
    """First 8 hex digits of md5(seed|c1|c2|...). Keys should be integer or
    string columns so their text form is the same in every engine."""
    parts = [F.lit(str(seed))] + [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, HEX_DIGITS)


def weight_thresholds(weights: Sequence[float]) -> list[str]:
    """Upper bounds (exclusive, as hex strings) of each bucket of a weighted split."""
    total = float(sum(weights))
    if total <= 0 or any(w < 0 for w in weights):
        raise ValueError("weights must be non-negative with a positive sum")
    bounds, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        bounds.append(format(min(int(acc * SCALE), SCALE - 1), f"0{HEX_DIGITS}x"))
    return bounds


def weighted_bucket(cols: Sequence, weights: Sequence[float], seed: int | str = 0) -> Column:
    """Bucket index 0..len(weights)-1 with probabilities proportional to weights."""
    h = hash_prefix(cols, seed)
    bounds = weight_thresholds(weights)
    expr = F.lit(len(weights) - 1)
    for i in reversed(range(len(bounds))):
        expr = F.when(h < F.lit(bounds[i]), F.lit(i)).otherwise(expr)
    return expr.cast("int")


def weighted_bucket_sql(key_sql: Sequence[str], weights: Sequence[float], seed: int | str = 0) -> str:
    """The same bucket as a SQL expression (for the DuckDB oracle)."""
    joined = " || '|' || ".join([f"'{seed}'"] + [f"CAST({k} AS VARCHAR)" for k in key_sql])
    h = f"substr(md5({joined}), 1, {HEX_DIGITS})"
    bounds = weight_thresholds(weights)
    cases = " ".join(f"WHEN {h} < '{b}' THEN {i}" for i, b in enumerate(bounds))
    return f"(CASE {cases} ELSE {len(weights) - 1} END)" if cases else "0"

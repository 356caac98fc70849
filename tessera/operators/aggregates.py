"""Keyed counts, sums, averages and extremes.

All of these are one hash aggregate: a partial aggregate runs before the
shuffle (map-side combine), so a key holding a third of the rows costs one
partial row per task, not a third of the data in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rating_histogram(ratings: DataFrame, rating_col: str = "rating", count_col: str = "count") -> DataFrame:
    """Number of ratings per rating value, ordered by the value's text form
    (the original program counts the raw string field)."""
    return (ratings.select(F.col(rating_col).cast("string").alias("rating"))
                   .groupBy("rating").agg(F.count(F.lit(1)).alias(count_col))
                   .orderBy("rating"))


def customer_spend(orders: DataFrame, key: str = "customer", amount: str = "amount",
                   out: str = "total_spent", digits: int | None = 2) -> DataFrame:
    """Total amount per customer, ascending by total (then key).

    Summed in double (the original summed 32-bit floats, whose drift is an
    artefact, not a result) and rounded to cents.
    """
    total = F.sum(F.col(amount).cast("double"))
    if digits is not None:
        total = F.round(total, digits)
    return orders.groupBy(key).agg(total.alias(out)).orderBy(out, key)


def avg_by_key(df: DataFrame, key: str = "age", value: str = "friends", exact: bool = False,
               out: str = "avg_friends") -> DataFrame:
    """Average of ``value`` per ``key``, sorted by key.

    Default: integer sum divided by integer count, truncated, as the original
    (``Int / Int``). ``exact=True`` returns the double average.
    """
    agg = df.groupBy(key).agg(F.sum(F.col(value).cast("long")).alias("_s"), F.count(F.lit(1)).alias("_n"))
    avg = (F.col("_s") / F.col("_n")) if exact else F.expr("_s div _n")
    return agg.select(key, avg.alias(out)).orderBy(key)


def extreme_by_key(readings: DataFrame, key: str = "station", value: str = "value", type_col: str = "type",
                   entry_type: str | None = "PRCP", agg: str = "max", out: str = "extreme",
                   fahrenheit: bool = False) -> DataFrame:
    """Per key, the max (or min) ``value`` among rows of one entry type.

    The original is named for minimum temperatures but keeps ``PRCP`` rows and
    takes the maximum; both choices are parameters. ``fahrenheit`` applies the
    tenths-of-degree Celsius conversion ``v * 0.1 * 9/5 + 32``.
    """
    rows = readings if entry_type is None else readings.filter(F.col(type_col) == F.lit(entry_type))
    v = F.col(value)
    if fahrenheit:
        v = v.cast("double") * F.lit(0.1) * F.lit(9.0 / 5.0) + F.lit(32.0)
    fn = {"max": F.max, "min": F.min}[agg]
    return rows.groupBy(key).agg(fn(v).alias(out)).orderBy(key)

"""Top-k, argmax and name lookup.

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: every task keeps
its own k best rows and only those reach the final merge, so a global top-k
never sorts the whole input. The id is always the last sort key, so ties are
deterministic.

Name lookups join a bounded key set (a top-k result) with a names table of any
size: the names are first filtered by a broadcast semi join against the k keys,
and only the matching names meet the result. The broadcast is used only when
Catalyst proves the key set's row bound from the plan (the limit of a top-k);
an unbounded key set gets a plain semi join sized by AQE at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import proven_max_rows

# Largest proven key count that is broadcast for a name lookup.
MAX_BROADCAST_KEYS = 100_000


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(int(k))


def lookup_names(small: DataFrame, names: DataFrame, key: str, names_key: str = "id",
                 name_col: str = "title", how: str = "left") -> DataFrame:
    """Attach names to a result whose row count is bounded (top-k).

    ``how="left"`` keeps rows without a name (name is null); ``"inner"`` drops
    them; ``"strict"`` fails the job on a row without a name (like a map
    lookup of a missing key); duplicate names for one id multiply rows, as an
    equi join does.
    """
    if how == "strict":
        out = lookup_names(small, names, key, names_key, name_col, "left")
        missing = F.raise_error(F.concat(F.lit(f"no {name_col} for {key} "), F.col(key).cast("string")))
        return out.withColumn(name_col, F.when(F.col(name_col).isNull(), missing).otherwise(F.col(name_col)))
    keys = small.select(F.col(key).alias("_k")).distinct()
    bound = proven_max_rows(small)
    if bound is not None and bound <= MAX_BROADCAST_KEYS:
        keys = F.broadcast(keys)
    matched = (names.join(keys, names[names_key] == keys["_k"], "left_semi")
                    .select(F.col(names_key).alias("_nk"), F.col(name_col)))
    joined = small.join(matched, small[key] == matched["_nk"], how)
    return joined.drop("_nk")


def item_popularity(ratings: DataFrame, item: str = "item", count_col: str = "count") -> DataFrame:
    """Ratings per item, ascending by (count, item)."""
    return ratings.groupBy(item).agg(F.count(F.lit(1)).alias(count_col)).orderBy(count_col, item)


def top_items(ratings: DataFrame, titles: DataFrame, k: int = 10, item: str = "item",
              count_col: str = "count") -> DataFrame:
    """The k most rated items with counts and titles (null title when unknown)."""
    counts = ratings.groupBy(item).agg(F.count(F.lit(1)).alias(count_col))
    top = top_k(counts, k, F.col(count_col).desc(), F.col(item).asc())
    return lookup_names(top, titles, item, "id", "title", "left").orderBy(F.col(count_col).desc(), F.col(item))


def top_item_names(ratings: DataFrame, titles: DataFrame, k: int = 10, item: str = "item") -> DataFrame:
    """Titles of the k most rated items; the limit applies before the lookup,
    so an item without a title leaves fewer than k rows."""
    counts = ratings.groupBy(item).agg(F.count(F.lit(1)).alias("_n"))
    top = top_k(counts, k, F.col("_n").desc(), F.col(item).asc())
    ranked = top.select(item, "_n")
    named = lookup_names(ranked, titles, item, "id", "title", "inner")
    return named.orderBy(F.col("_n").desc(), F.col(item)).select(F.col(item), "title")


def connection_totals(line_counts: DataFrame, key: str = "id", value: str = "connections",
                      out: str = "connections") -> DataFrame:
    """Sum of per-line co-appearance counts per vertex (64-bit)."""
    return line_counts.groupBy(key).agg(F.sum(F.col(value).cast("long")).alias(out))


def most_connected(totals: DataFrame, names: DataFrame, key: str = "id", value: str = "connections") -> DataFrame:
    """The single vertex with the most connections (ties: the larger id, like
    ``max`` over ``(count, id)`` tuples) and its name.

    When several names exist for the id the smallest is taken; when none
    exists the row is dropped (the original lookup would throw).
    """
    best = top_k(totals, 1, F.col(value).desc(), F.col(key).desc())
    named = lookup_names(best, names, key, "id", "name", "inner")
    return (named.groupBy(key, value).agg(F.min("name").alias("name"))
                 .select(key, "name", value))


def top_connected(totals: DataFrame, names: DataFrame, k: int = 10, key: str = "id",
                  value: str = "connections") -> DataFrame:
    """Totals joined with names (vertices without a name drop out), top k."""
    joined = totals.join(names.select(F.col("id").alias(key), "name"), key)
    return top_k(joined, k, F.col(value).desc(), F.col(key).asc(), F.col("name").asc()).select(key, "name", value)

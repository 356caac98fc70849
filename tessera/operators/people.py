"""Projection, filter and SQL-text queries over a people table
``(id, name, age, friends)``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AGE_RANGE_SQL = "SELECT * FROM {view} WHERE age >= {lo} AND age <= {hi}"


def select_name(people: DataFrame) -> DataFrame:
    return people.select("name")


def under_age(people: DataFrame, limit: int = 21) -> DataFrame:
    """Rows with ``age < limit`` (strictly: the limit itself is dropped)."""
    return people.filter(F.col("age") < F.lit(limit))


def plus_years(people: DataFrame, years: int = 10, out: str = "age_plus_10") -> DataFrame:
    return people.select("name", (F.col("age") + F.lit(years)).alias(out))


def count_by_age(people: DataFrame) -> DataFrame:
    return people.groupBy("age").count()


def sql_age_range(spark: SparkSession, people: DataFrame, lo: int = 13, hi: int = 19) -> DataFrame:
    """SQL text over a temp view. The view has a name of its own and goes as
    soon as the text is analysed, so no view of the caller is replaced."""
    view = f"people_{uuid.uuid4().hex[:12]}"
    people.createOrReplaceTempView(view)
    try:
        return spark.sql(AGE_RANGE_SQL.format(view=view, lo=int(lo), hi=int(hi)))
    finally:
        spark.catalog.dropTempView(view)

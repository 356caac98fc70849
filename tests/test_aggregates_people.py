import os

import pytest

from conftest import rows, write_lines
from tessera.operators import aggregates, people
from tessera.sources import readers


def test_customer_spend_sorted_and_rounded(spark):
    orders = spark.createDataFrame([(1, 0.1), (1, 0.2), (2, 5.0), (3, 0.15), (3, 0.15)], "customer int, amount float")
    out = [tuple(r) for r in aggregates.customer_spend(orders).collect()]
    assert out == [(1, 0.3), (3, 0.3), (2, 5.0)]


def test_rating_histogram_sorted_as_text(spark):
    r = spark.createDataFrame([(5,), (3,), (3,), (10,)], "rating int")
    out = [tuple(x) for x in aggregates.rating_histogram(r).collect()]
    assert out == [("10", 1), ("3", 2), ("5", 1)]


def test_avg_by_key_truncates_and_keys_are_parameters(spark):
    p = spark.createDataFrame([(0, "Will", 33, 385), (1, "Will", 33, 2), (2, "Jean", 20, 3)],
                              "id int, name string, age int, friends int")
    assert [tuple(r) for r in aggregates.avg_by_key(p, "age").collect()] == [(20, 3), (33, 193)]
    # The original keys on the name field by mistake; that is the same operator with key="name".
    assert [tuple(r) for r in aggregates.avg_by_key(p, "name").collect()] == [("Jean", 3), ("Will", 193)]
    exact = aggregates.avg_by_key(p, "age", exact=True).collect()
    assert exact[1]["avg_friends"] == pytest.approx(193.5)


def test_extreme_by_key_type_and_direction(spark):
    r = spark.createDataFrame([("s1", "TMIN", -50), ("s1", "PRCP", 10), ("s1", "PRCP", 30), ("s2", "PRCP", 0),
                               ("s2", "TMAX", 99)], "station string, type string, value int")
    assert [tuple(x) for x in aggregates.extreme_by_key(r).collect()] == [("s1", 30), ("s2", 0)]
    mins = aggregates.extreme_by_key(r, entry_type="TMIN", agg="min").collect()
    assert [tuple(x) for x in mins] == [("s1", -50)]
    f = aggregates.extreme_by_key(r, entry_type="TMIN", agg="min", fahrenheit=True).collect()
    assert f[0]["extreme"] == pytest.approx(-50 * 0.1 * 9 / 5 + 32)


def _people(spark):
    return spark.createDataFrame([(0, "A", 13, 1), (1, "B", 19, 2), (2, "C", 20, 3), (3, "D", 21, 4), (4, "E", 12, 5)],
                                 "id int, name string, age int, friends int")


def test_people_queries(spark):
    p = _people(spark)
    assert rows(people.select_name(p)) == [("A",), ("B",), ("C",), ("D",), ("E",)]
    assert [r["age"] for r in people.under_age(p, 21).orderBy("age").collect()] == [12, 13, 19, 20]
    assert rows(people.plus_years(p), "name", "age_plus_10")[0] == ("A", 23)
    assert dict(rows(people.count_by_age(p), "age", "count"))[21] == 1
    assert sorted(r["id"] for r in people.sql_age_range(spark, p, 13, 19).collect()) == [0, 1]


def test_people_reader_inline(spark, tmpdir_path):
    import random

    rnd = random.Random(1)
    made = [(i, rnd.choice(["Ann", "Bob", "Cy"]), rnd.randint(10, 69), rnd.randint(0, 500)) for i in range(200)]
    path = write_lines(tmpdir_path, "people.csv", [",".join(map(str, r)) for r in made])
    p = readers.read_people(spark, path)
    assert rows(p, "id", "name", "age") == sorted(r[:3] for r in made)
    assert people.sql_age_range(spark, p).count() == sum(13 <= r[2] <= 19 for r in made)
    assert people.under_age(p).count() == sum(r[2] < 21 for r in made)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("people")]


def test_csv_readers_inline(spark, tmpdir_path):
    path = write_lines(tmpdir_path, "orders.csv", ["44,8602,37.19", "35,5368,65.89", "44,1,0.01"], newline="\r\n")
    o = readers.read_customer_orders(spark, path)
    assert [tuple(r) for r in aggregates.customer_spend(o).collect()] == [(44, 37.2), (35, 65.89)]
    st = write_lines(tmpdir_path, "st.csv", ["ITE00100554,18000101,TMAX,-75,,,E,", "ITE00100554,18000101,PRCP,0,,,E,"])
    s = readers.read_station_readings(spark, st)
    assert [tuple(r) for r in aggregates.extreme_by_key(s).collect()] == [("ITE00100554", 0)]

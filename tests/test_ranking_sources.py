from pyspark.sql import functions as F

from conftest import rows, write_lines
from tessera.operators import graph, ranking
from tessera.sources import readers


def test_top_items_left_lookup_and_ties(spark):
    r = spark.createDataFrame([(u, i) for u, i in [(1, 5), (2, 5), (3, 7), (4, 7), (5, 9), (6, 1)]], "user int, item int")
    titles = spark.createDataFrame([(5, "five"), (9, "nine"), (1, "one")], "id int, title string")
    out = [tuple(x) for x in ranking.top_items(r, titles, 3).collect()]
    assert out == [(5, 2, "five"), (7, 2, None), (1, 1, "one")]
    names = [tuple(x) for x in ranking.top_item_names(r, titles, 3).collect()]
    # the limit applies before the lookup: item 7 has no title and leaves a gap
    assert names == [(5, "five"), (1, "one")]


def test_item_popularity_ascending(spark):
    r = spark.createDataFrame([(1, 5), (2, 5), (3, 7)], "user int, item int")
    assert [tuple(x) for x in ranking.item_popularity(r).collect()] == [(7, 1), (5, 2)]


def test_most_connected_ties_to_largest_id(spark, tmpdir_path):
    g = write_lines(tmpdir_path, "g.txt", ["1 2 3", "2 1", "3 1", "2 3", "4 1 2"])
    names = write_lines(tmpdir_path, "n.txt", ['1 "ONE"', '2 "TWO"', '3 "THREE"', "4 no quotes", '4 "FOUR"'])
    counts = readers.adjacency_line_counts(readers.read_text(spark, g))
    totals = ranking.connection_totals(counts)
    n = readers.read_quoted_names(spark, names)
    # vertex 1, 2 and 4 all have 2 connections: the largest id wins
    assert [tuple(x) for x in ranking.most_connected(totals, n).collect()] == [(4, "FOUR", 2)]
    top = [tuple(x) for x in ranking.top_connected(totals, n, 2).collect()]
    assert top == [(1, "ONE", 2), (2, "TWO", 2)]


def test_quoted_names_cutoff_and_bad_lines(spark, tmpdir_path):
    path = write_lines(tmpdir_path, "names.txt", ['1 "A B"', 'bad line', '6487 "NOT REAL"', '7 ""', '8 "X"'])
    all_names = rows(readers.read_quoted_names(spark, path))
    assert all_names == [(1, "A B"), (8, "X"), (6487, "NOT REAL")]
    assert rows(readers.read_quoted_names(spark, path, id_below=6487)) == [(1, "A B"), (8, "X")]


def test_adjacency_edges_multi_line_vertex(spark, tmpdir_path):
    path = write_lines(tmpdir_path, "adj.txt", ["1 2 3 ", "  1 2", "3 1", ""])
    e = readers.read_adjacency(spark, path)
    assert rows(e) == [(1, 2), (1, 2), (1, 3), (3, 1)]
    d = dict(rows(graph.degrees(e)))
    assert sum(d.values()) == 2 * 4 and d[1] == 4


def test_titles_latin1_and_short_lines(spark, tmpdir_path):
    path = tmpdir_path + "/items.txt"
    with open(path, "wb") as fh:
        fh.write("1|Toy Story (1995)|01-Jan-1995||x|0|0\n".encode("latin-1"))
        fh.write("2|Café Olé (1996)|x\n".encode("latin-1"))
        fh.write("3\n".encode("latin-1"))
    t = rows(readers.read_titles(spark, path))
    assert t == [(1, "Toy Story (1995)"), (2, "Café Olé (1996)")]


def test_stop_words_and_json(spark, tmpdir_path):
    sw = write_lines(tmpdir_path, "stop.txt", ["a", "the"])
    assert rows(readers.read_stop_words(spark, sw)) == [("a",), ("the",)]
    js = write_lines(tmpdir_path, "p.json", ['{"id": 1, "name": "x"}', '{"id": 2, "name": "y"}'])
    assert readers.read_json(spark, js, "id int, name string").count() == 2


def test_sinks_round_trip(spark, tmpdir_path):
    from tessera.sources import sinks

    df = spark.createDataFrame([(1, 2, 0.5), (3, 4, 1.0)], "item1 long, item2 long, score double")
    sinks.write_table(df, tmpdir_path + "/sims", partition_by=["item1"])
    assert spark.read.parquet(tmpdir_path + "/sims").count() == 2
    sinks.write_text_lines(df, tmpdir_path + "/sims.txt")
    assert rows(spark.read.text(tmpdir_path + "/sims.txt")) == [("1,2,0.5",), ("3,4,1.0",)]


def test_lookup_names_broadcasts_only_proven_bounded_keys(spark):
    from tessera.session import proven_max_rows

    names = spark.createDataFrame([(i, f"n{i}") for i in range(50)], "id long, title string")
    counts = spark.createDataFrame([(i % 7, i) for i in range(100)], "item long, c long")
    top = ranking.top_k(counts, 3, F.col("c").desc(), F.col("item"))
    assert proven_max_rows(top) == 3
    assert proven_max_rows(counts.groupBy("item").count()) is None
    hinted = ranking.lookup_names(top, names, "item")._jdf.queryExecution().optimizedPlan().toString()
    plain = ranking.lookup_names(counts, names, "item")._jdf.queryExecution().optimizedPlan().toString()
    assert "BROADCAST" in hinted.upper() and "broadcast" not in plain.lower()
    got = sorted(tuple(r) for r in ranking.lookup_names(counts.groupBy("item").count(), names, "item").collect())
    assert got == [(i, len([j for j in range(100) if j % 7 == i]), f"n{i}") for i in range(7)]


def test_strict_lookup_fails_on_missing_name(spark):
    import pytest

    names = spark.createDataFrame([(1, "one")], "id long, title string")
    ok = spark.createDataFrame([(1, 5)], "item long, c long")
    assert [tuple(r) for r in ranking.lookup_names(ok, names, "item", how="strict").collect()] == [(1, 5, "one")]
    bad = spark.createDataFrame([(1, 5), (2, 3)], "item long, c long")
    with pytest.raises(Exception, match="no title for item 2"):
        ranking.lookup_names(bad, names, "item", how="strict").collect()

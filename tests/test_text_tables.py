"""Tables written in the original text formats and read back."""

import random
from collections import Counter

from conftest import rows, write_lines
from tessera.sources import readers, text_tables


def test_lines_that_do_not_fit_are_kept_apart(spark, tmpdir_path):
    lines = ["0,Will,33,385", "1,Jean-Luc,26,2", "", "2,Hugh,old,221", "3,Deanna,40", "4,Quark,68,21,x", "5,,30,", 'x"y', "6, a ,1,2"]
    text = readers.read_text(spark, write_lines(tmpdir_path, "people.csv", lines))
    found = text_tables.checked_rows(text, readers.PEOPLE_SCHEMA)
    assert sorted(map(str, found.rows.collect())) == sorted(map(str, [
        found.rows.collect()[0].__class__(**{"id": i, "name": n, "age": a, "friends": f}) for i, n, a, f in
        [(0, "Will", 33, 385), (1, "Jean-Luc", 26, 2), (5, None, 30, None), (6, " a ", 1, 2)]]))
    assert rows(found.bad) == [("2,Hugh,old,221",), ("3,Deanna,40",), ("4,Quark,68,21,x",), ('x"y',)]


def test_checked_tab_and_pipe_rows(spark, tmpdir_path):
    tab = readers.read_text(spark, write_lines(tmpdir_path, "u.data", ["196\t242\t3\t881250949", "196 242 3 881250949", "1\t2\t3.5\t4"]))
    found = text_tables.checked_rows(tab, readers.RATINGS_SCHEMA, sep="\t")
    assert rows(found.rows) == [(196, 242, 3, 881250949)] and found.bad.count() == 2
    pipe = readers.read_text(spark, write_lines(tmpdir_path, "u.user", ["1|24|M|technician|85711", "2|x|F|other|T8H1N"]))
    found = text_tables.checked_rows(pipe, readers.USERS_SCHEMA, sep="|")
    assert rows(found.rows) == [(1, 24, "M", "technician", "85711")] and rows(found.bad) == [("2|x|F|other|T8H1N",)]


def test_adjacency_lines_are_bounded_and_whole(spark):
    rnd = random.Random(1)
    edges = [(1, rnd.randint(0, 3000)) for _ in range(5000)] + [(2, 7)] * 1000 + [(k, k + 1) for k in range(3, 60)]
    df = spark.createDataFrame(edges, "src long, dst long").repartition(5)
    path = text_tables.write_adjacency(df, text_tables.round_trip(spark, "adj"), per_line=100)
    assert Counter(rows(readers.read_adjacency(spark, path))) == Counter(edges)
    longest = max(len(r["value"].split()) for r in readers.read_text(spark, path).collect())
    assert longest <= 401  # many parallel edges share lines by chance
    counts = Counter()
    for src, n in rows(readers.adjacency_line_counts(readers.read_text(spark, path))):
        counts[src] += n
    assert counts == Counter(s for s, _ in edges)


def test_quoted_names_and_nulls(spark):
    names = spark.createDataFrame([(1, "SPIDER-MAN/PETER PAR"), (2, "Éa"), (3, "a, b|c")], "id long, name string")
    path = text_tables.write_quoted_names(names, text_tables.round_trip(spark, "names"))
    assert rows(readers.read_quoted_names(spark, path)) == rows(names)
    people = spark.createDataFrame([(1, None, 5, None)], "id int, name string, age int, friends int")
    path = text_tables.write_delimited(people, text_tables.round_trip(spark, "p"))
    assert rows(readers.read_people(spark, path)) == [(1, None, 5, None)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "src long, dst long")
    assert readers.read_adjacency(spark, text_tables.write_adjacency(none, text_tables.round_trip(spark, "e"))).count() == 0


def test_scratch_is_deleted_on_request(spark):
    import os

    from tessera.session import delete_scratch, materialize, scratch_path

    kept = materialize(spark.range(5), "kept")
    out = scratch_path(spark, "named-only")
    folder = kept.inputFiles()[0].rsplit("/", 1)[0].replace("file://", "")
    assert os.path.isdir(folder) and kept.count() == 5
    assert delete_scratch(spark) >= 2
    assert not os.path.isdir(folder) and not os.path.isdir(out.replace("file:", "")) and delete_scratch(spark) == 0

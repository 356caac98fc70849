"""Threshold pruning of item similarity, genre masks and the genre boost."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows, write_lines
from test_similarity import brute_force
from tessera.operators import similarity
from tessera.plans import catalog
from tessera.sources import bindings, readers, text_tables


def skewed_ratings(seed, items=40, light=120, heavy=6):
    """Many users of a few items and some heavy users that rate nearly all; a
    group of items shares its own users."""
    rnd = random.Random(seed)
    out = [(u, i, rnd.randint(1, 5)) for u in range(light) for i in rnd.sample(range(items), rnd.randint(1, 3))]
    out += [(1000 + h, i, rnd.randint(1, 5)) for h in range(heavy) for i in range(items) if rnd.random() < 0.95]
    out += [(2000 + u, i, rnd.randint(1, 5)) for u in range(25) for i in (0, 1, 2, 3)]
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("min_pairs,min_score", [(6, 0.9), (8, 0.95), (20, None), (200, 0.5)])
def test_pruned_pairs_equal_the_full_join(spark, seed, min_pairs, min_score):
    data = skewed_ratings(seed)
    df = spark.createDataFrame(data, "user long, item long, rating int")
    got = {(r["item1"], r["item2"]): (r["score"], r["n"]) for r in
           similarity.item_similarity(df, min_score=min_score, min_pairs=min_pairs).collect()}
    want = {k: v for k, v in brute_force(data).items() if v[1] > min_pairs and (min_score is None or v[0] > min_score)}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k][0], want[k][0], rel_tol=1e-9) and got[k][1] == want[k][1] for k in want)


def test_pruning_makes_fewer_pairs(spark):
    data = skewed_ratings(7)
    ui = similarity.user_item_ratings(spark.createDataFrame(data, "user long, item long, rating int"))
    sums, work = similarity.pruned_pair_sums(ui, 8, 0.9)
    assert work["early"] * similarity.PRUNING_GAIN <= work["of_items"] <= work["all"]
    # The early ratings' pairs and the ratings counted again for the candidates are fewer than all pairs.
    counted = sums.agg(F.sum("n")).first()[0]
    assert work["early"] + counted < 0.7 * work["all"]
    # All pairs with enough co-raters are there, whatever their score.
    every, _ = similarity.pruned_pair_sums(ui, 8)
    want = {k for k, v in brute_force(data).items() if v[1] > 8}
    assert want <= {(r["item1"], r["item2"]) for r in every.collect()}


def test_score_bound_holds():
    """Against the best of many ways to share more raters."""
    rnd = random.Random(3)

    def cosine(pairs):
        xy, xx, yy = (sum(f(x, y) for x, y in pairs) for f in (lambda x, y: x * y, lambda x, y: x * x, lambda x, y: y * y))
        return xy / math.sqrt(xx * yy)

    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    cases, best = [], []
    for _ in range(200):
        shared = [(rnd.randint(1, 5), rnd.randint(1, 5)) for _ in range(rnd.randint(1, 4))]
        rest = [(rnd.randint(1, 5), rnd.randint(1, 5)) for _ in range(rnd.randint(0, 5))]
        s = [sum(f(x, y) for x, y in shared) for f in (lambda x, y: x * y, lambda x, y: x * x, lambda x, y: y * y)]
        cases.append((len(best), *map(float, s), float(s[1] + sum(x * x for x, _ in rest)), float(s[2] + sum(y * y for _, y in rest))))
        best.append(max(cosine(shared + [p for k, p in enumerate(rest) if m >> k & 1]) for m in range(1 << len(rest))))
    df = spark.createDataFrame(cases, "k int, sxy double, sxx double, syy double, norm1 double, norm2 double")
    bounds = dict(rows(df.select("k", similarity.score_bound(*(F.col(c) for c in df.columns[1:])).alias("b"))))
    assert all(best[k] <= b + 1e-9 <= 1 + 2e-9 for k, b in bounds.items())
    assert any(b < 0.999 for b in bounds.values())


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_strong_pairs_exist_at_every_scale(sf):
    import os

    from oracle_compare import duck
    from tessera.plans.oracle import SQL

    folder = f"/root/testdata/sf{sf}"
    if not os.path.isdir(folder):
        pytest.skip("test tables not present")
    assert duck(folder).execute(f"SELECT count(*) FROM ({SQL['item_similarity_strong']}) t").fetchone()[0] > 0


def test_genre_masks_of_the_item_file(spark, tmpdir_path):
    flags = ["0"] * 19
    drama, comedy = list(flags), list(flags)
    drama[8] = "1"
    comedy[5] = comedy[18] = "1"
    lines = ["1|Toy (1995)|01-Jan-1995||http://x|" + "|".join(comedy), "2|Éa|01-Jan-1996||http://y|" + "|".join(drama),
             "3|no flags", "4", "", "5|short|d||u|1"]
    got = rows(readers.read_genres(spark, write_lines(tmpdir_path, "u.item", lines)))
    assert got == [(1, "Toy (1995)", 1 << 5 | 1 << 18), (2, "Éa", 1 << 8), (3, "no flags", 0), (5, "short", 1)]


def test_genre_boost(spark):
    sims = spark.createDataFrame([(1, 2, 0.5, 3), (1, 3, 0.9, 4), (2, 9, 0.4, 1)], "item1 long, item2 long, score double, n long")
    genres = spark.createDataFrame([(1, "a", 0b111), (2, "b", 0b011), (3, "c", 0)], "id long, title string, genres long")
    got = rows(similarity.with_genres(sims, genres, 0.25), "item1", "item2", "genre_overlap", "boosted")
    assert got == [(1, 2, 2 / 3, pytest.approx(0.75 * 0.5 + 0.25 * 2 / 3)), (1, 3, 0.0, pytest.approx(0.675)),
                   (2, 9, 0.0, pytest.approx(0.3))]
    with pytest.raises(ValueError):
        similarity.with_genres(sims, genres, 1.5)


def test_genres_survive_the_pipe_rows(spark):
    want = rows(bindings.titles_with_genres(spark, SF_SMALL))
    path = text_tables.write_titles(bindings.titles_with_genres(spark, SF_SMALL), text_tables.round_trip(spark, "t"), flags=30)
    assert rows(readers.read_genres(spark, path, flags=30)) == want
    assert len({g for _, _, g in want}) > 1 and catalog.PARAMS["genre_weight"] > 0


def test_genre_masks_are_joined_by_their_real_size(spark):
    """A joined table's estimate is the product of its inputs' sizes: the pairs
    were planned to be shuffled for each of the two joins."""
    wide = spark.range(40000).select("id", (F.col("id") % 7).alias("k"))
    genres = wide.join(spark.range(3000).select(F.col("id").alias("k"), F.lit(3).cast("long").alias("genres")), "k")
    pairs = spark.range(50).selectExpr("id AS item1", "id + 1 AS item2", "0.5D AS score", "1L AS n")
    out = similarity.with_genres(pairs, genres.select("id", "genres"), 0.2)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
    assert {(r["genre_overlap"], round(r["boosted"], 6)) for r in out.collect()} == {(1.0, 0.6)}


def test_genre_masks_are_broadcast_whatever_the_threshold(spark, monkeypatch):
    pairs = spark.range(50).selectExpr("id AS item1", "id + 1 AS item2", "0.5D AS score", "1L AS n")
    genres = spark.range(40).selectExpr("id", "1L << CAST(id % 3 AS INT) AS genres")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = []
        for most, join in ((similarity.BROADCAST_ITEMS, "BroadcastHashJoin"), (39, "SortMergeJoin")):
            monkeypatch.setattr(similarity, "BROADCAST_ITEMS", most)
            out = similarity.with_genres(pairs, genres, 0.2)
            assert out._jdf.queryExecution().sparkPlan().toString().count(join) == 2
            got.append(rows(out))
        assert got[0] == got[1] and len(got[0]) == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_pruning_leaves_no_shuffle_files_of_its_steps(spark, monkeypatch):
    freed = {}
    write = similarity.materialize
    monkeypatch.setattr(similarity, "materialize",
                        lambda df, name, free=False: freed.update({name: free}) or write(df, name, free))
    ui = spark.createDataFrame([(u, i, float(u % 5)) for u in range(30) for i in range(u % 3, 12, 2)], "user long, item long, r double")
    sums, work = similarity.pruned_pair_sums(ui, 3)
    assert {"items", "late-raters", "rated", "rated-degree", "user-degree"} <= {n for n, f in freed.items() if f}
    every = similarity.chunked_pair_sums(ui).filter("n > 3")
    assert rows(sums.filter("n > 3"), "item1", "item2", "n") == rows(every, "item1", "item2", "n")
    assert work["all"] == work["of_items"] == 20 * 15 + 10 * 10  # 6 or 5 items a user

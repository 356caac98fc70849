import math
import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.operators import similarity
from tessera.session import CLEANUP, materialize


def brute_force(ratings):
    """Self-join reference implementation on Python lists (small inputs only)."""
    per = defaultdict(list)
    acc = defaultdict(lambda: defaultdict(list))
    for u, i, r in ratings:
        acc[u][i].append(r)
    for u, items in acc.items():
        for i, rs in items.items():
            per[u].append((i, sum(rs) / len(rs)))
    sums = defaultdict(lambda: [0.0, 0.0, 0.0, 0])
    for u, lst in per.items():
        for i, x in lst:
            for j, y in lst:
                if i < j:
                    s = sums[(i, j)]
                    s[0] += x * y
                    s[1] += x * x
                    s[2] += y * y
                    s[3] += 1
    out = {}
    for k, (xy, xx, yy, n) in sums.items():
        d = math.sqrt(xx) * math.sqrt(yy)
        out[k] = (0.0 if d == 0 else xy / d, n)
    return out


def _random_ratings(seed, users=40, items=60, per_user=(1, 25), heavy_user=True):
    rnd = random.Random(seed)
    out = []
    for u in range(users):
        k = rnd.randint(*per_user)
        for i in rnd.sample(range(items), k):
            out.append((u, i, rnd.randint(0, 5)))
    if heavy_user:  # one user rates every item, some twice
        out += [(999, i, rnd.randint(1, 5)) for i in range(items)]
        out += [(999, i, 5) for i in range(0, items, 7)]
    return out


def test_similar_to_item_matches_full_table(spark):
    data = _random_ratings(11)
    df = spark.createDataFrame(data, "user long, item long, rating int")
    titles = spark.createDataFrame([(i, f"t{i}") for i in range(0, 60, 2)], "id long, title string")
    top = similarity.similar_to_item(df, titles, 3, min_score=0.5, min_pairs=3, k=5).collect()
    want = brute_force(data)
    cands = sorted(((s, n, j if i == 3 else i) for (i, j), (s, n) in want.items()
                    if 3 in (i, j) and s > 0.5 and n > 3), key=lambda t: (-t[0], -t[1], t[2]))[:5]
    assert [(r["item"], r["n"]) for r in top] == [(c[2], c[1]) for c in cands]
    for r in top:
        assert r["title"] == (f"t{r['item']}" if r["item"] % 2 == 0 else None)


def test_histogram_and_top_on_inline_ratings(spark):
    """Counts from independent Python over the same rows."""
    from collections import Counter

    from tessera.operators import aggregates, ranking

    data = _random_ratings(13, users=80)
    r = spark.createDataFrame(data, "user long, item long, rating int")
    hist = {x["rating"]: x["count"] for x in aggregates.rating_histogram(r).collect()}
    assert hist == {str(k): v for k, v in Counter(x[2] for x in data).items()}
    titles = spark.createDataFrame([(50, "a"), (25, "b")], "id int, title string")
    top = [(x["item"], x["count"]) for x in ranking.top_items(r, titles, 5).collect()]
    assert top == sorted(Counter(x[1] for x in data).items(), key=lambda t: (-t[1], t[0]))[:5]


def test_thresholds_keep_the_strong_pairs(spark):
    data = _random_ratings(17)
    df = spark.createDataFrame(data, "user long, item long, rating int")
    got = {(r["item1"], r["item2"]) for r in similarity.item_similarity(df, min_score=0.9, min_pairs=3).collect()}
    assert got == {k for k, (s, n) in brute_force(data).items() if s > 0.9 and n > 3} and got


def _brute_metric(ratings, metric):
    acc = defaultdict(lambda: defaultdict(list))
    for u, i, r in ratings:
        acc[u][i].append(r)
    per = {u: {i: sum(v) / len(v) for i, v in items.items()} for u, items in acc.items()}
    raters = defaultdict(set)
    for u, items in per.items():
        for i in items:
            raters[i].add(u)
    out = {}
    items = sorted(raters)
    for a in items:
        for b in items:
            if a >= b:
                continue
            co = raters[a] & raters[b]
            if not co:
                continue
            xs = [per[u][a] for u in co]
            ys = [per[u][b] for u in co]
            n = len(co)
            if metric == "pearson":
                sx, sy = sum(xs), sum(ys)
                num = n * sum(x * y for x, y in zip(xs, ys)) - sx * sy
                den = math.sqrt(n * sum(x * x for x in xs) - sx * sx) * math.sqrt(n * sum(y * y for y in ys) - sy * sy)
                out[(a, b)] = 0.0 if den == 0 else num / den
            else:
                out[(a, b)] = n / len(raters[a] | raters[b])
    return out


@pytest.mark.parametrize("chunk_items", [1024, 4, 7])
def test_chunked_join_similarity_equals_self_join(spark, chunk_items):
    """Tiny chunks put the heavy user (and the busier light users) into many
    (user, a, b) groups; every item pair must still be counted once."""
    data = _random_ratings(7)
    df = spark.createDataFrame(data, "user long, item long, rating int")
    got = {(r["item1"], r["item2"]): (r["score"], r["n"])
           for r in similarity.item_similarity(df, chunk_items=chunk_items).collect()}
    want = brute_force(data)
    assert set(got) == set(want)
    for k, (s, n) in want.items():
        assert got[k][1] == n
        assert got[k][0] == pytest.approx(s, abs=1e-9)


def test_chunk_groups_bound_a_heavy_user(spark):
    """The heavy user's largest join group holds about chunk_items rows per
    side, not its whole degree."""
    items, c = 300, 10
    heavy = [(0, i, 3.0) for i in range(items)]
    light = [(u, (u * 7 + k) % items, 1.0) for u in range(1, 40) for k in range(5)]
    ui = spark.createDataFrame(heavy + light, "user long, item long, r double")
    g = -(-items // c)
    rated = ui.filter("user = 0").select("item", F.pmod(F.xxhash64(F.col("item"), F.lit(13)), F.lit(g)).alias("c"))
    biggest = max(r["count"] for r in rated.groupBy("c").count().collect())
    assert biggest <= 3 * c
    sums = similarity.chunked_pair_sums(ui, c)
    assert sums.filter("n >= 1").count() == len(brute_force([(u, i, r) for u, i, r in heavy + light]))


@pytest.mark.parametrize("metric", ["pearson", "jaccard"])
def test_other_metrics_match_brute_force(spark, metric):
    data = _random_ratings(5, users=25, items=20, per_user=(1, 15))
    df = spark.createDataFrame(data, "user long, item long, rating int")
    want = _brute_metric(data, metric)
    got = {(r["item1"], r["item2"]): r["score"]
           for r in similarity.item_similarity(df, metric=metric, chunk_items=4).collect()}
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-9)
    one = {r["item"]: r["score"] for r in similarity.item_similarity_to(df, 3, metric=metric).collect()}
    for (a, b), v in want.items():
        if 3 in (a, b):
            assert one[b if a == 3 else a] == pytest.approx(v, abs=1e-9)


def test_min_rating_floor(spark):
    data = [(1, 1, 5), (1, 2, 2), (1, 3, 4), (2, 1, 4), (2, 3, 5), (2, 2, 1)]
    df = spark.createDataFrame(data, "user long, item long, rating int")
    got = {(r["item1"], r["item2"]) for r in similarity.item_similarity(df, min_rating=3).collect()}
    assert got == {(1, 3)}


@pytest.mark.parametrize("blocks", [1, 3])
def test_pair_sums_of_item_blocks_meet_in_one_task(spark, blocks):
    """With blocks no sum of a pair is shuffled; rows without an item make no pair."""
    data = _random_ratings(11, users=25, items=30, per_user=(1, 25))
    ui = similarity.user_item_ratings(spark.createDataFrame(data + [(1, None, 3), (None, 2, 3)], "user long, item long, rating int"))
    sums = similarity.chunked_pair_sums(ui, 8, blocks=blocks)
    want = brute_force([r for r in data])
    assert {(r["item1"], r["item2"]): r["n"] for r in sums.collect()} == {k: n for k, (_, n) in want.items()}
    above = sums._jdf.queryExecution().executedPlan().toString().split("Generate explode(arrays_zip")[0]
    assert ("Exchange" in above) == (blocks == 1)


def test_more_blocks_only_where_pairs_share_users(spark):
    """Ratings are copied for blocks where many users share a pair; where each pair
    has users of its own, the copies would outnumber the pairs."""
    shared = spark.range(400).crossJoin(spark.range(60).withColumnRenamed("id", "item"))
    shared = shared.select(F.col("id").alias("user"), "item", F.lit(1.0).alias("r"))
    assert similarity._block_count(spark, shared, 400 * 60 * 59 // 2, 400 * 60) > 1
    assert similarity._block_count(spark, shared, 400, 800) == 1
    assert similarity._distinct_pairs(shared, 400 * 60 * 59 // 2) <= 1.1 ** 2 * 66 ** 2 // 2


def test_item_blocks_neither_shuffle_nor_copy_ratings(spark, monkeypatch):
    """Each pair of blocks is a task that reads two columns of lists, whether
    users are cut or not; the sums are those of the shuffled pairs."""
    data = _random_ratings(19, users=30, items=40, per_user=(1, 30))
    ui = similarity.user_item_ratings(spark.createDataFrame(data, "user long, item long, rating int"))
    names = ["item1", "item2", "sxy", "sxx", "syy", "sx", "sy", "n"]

    def sums(df):
        return {tuple(round(r[c], 6) for c in names) for r in df.collect()}

    want = sums(similarity.chunked_pair_sums(ui, 6, blocks=1))
    for chunk_items in (6, 1000):
        df = similarity.chunked_pair_sums(ui, chunk_items, blocks=4)
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.columns == names and df.rdd.getNumPartitions() == 10 and sums(df) == want
    monkeypatch.setattr(similarity, "TASKS_OF_A_PLAN", 4)
    assert sums(similarity.chunked_pair_sums(ui, 6, blocks=4)) == want


def test_shuffle_files_go_once_a_table_is_written(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",")
        return {f for f in files.split(",") if "/shuffle_" in f}

    df = spark.range(5000).groupBy((F.col("id") % 100).alias("k")).count()
    before, setting = shuffled(), spark.conf.get(CLEANUP, None)
    assert materialize(df, "kept").count() == 100 and shuffled() - before
    before = shuffled()
    assert materialize(df, "freed", free=True).filter("count = 50").columns == ["k", "count"]
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before and spark.conf.get(CLEANUP, None) == setting

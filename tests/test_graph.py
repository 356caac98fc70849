from collections import deque

from conftest import rows
from tessera.operators import graph


def brute_bfs(edges, root, max_rounds):
    adj = {}
    for s, d in edges:
        adj.setdefault(s, []).append(d)
    dist = {root: 0}
    q = deque([root])
    while q:
        v = q.popleft()
        if dist[v] >= max_rounds:
            continue
        for w in adj.get(v, []):
            if w not in dist:
                dist[w] = dist[v] + 1
                q.append(w)
    return dist


def _edges():
    # chain 0->1->...->13 (longer than 10), a cycle, parallel edges, a back edge,
    # an unreachable component and a shortcut
    e = [(i, i + 1) for i in range(13)]
    e += [(3, 0), (2, 5), (2, 5), (5, 2), (100, 101), (101, 100), (0, 7)]
    return e


def test_bfs_matches_brute_force(spark):
    e = _edges()
    df = spark.createDataFrame(e, "src long, dst long")
    for rounds in (1, 3, 10):
        got = dict(rows(graph.bfs_distances(df, 0, rounds)))
        assert got == brute_bfs(e, 0, rounds)
    got = dict(rows(graph.bfs_distances(df, 0, 10)))
    # edge rule: d(dst) <= d(src) + 1 when src is reached within the cap
    for s, d in e:
        if s in got and got[s] < 10:
            assert d in got and got[d] <= got[s] + 1
    assert 100 not in got


def test_bfs_with_unreached_is_infinite(spark):
    df = spark.createDataFrame(_edges(), "src long, dst long")
    names = spark.createDataFrame([(0, "zero"), (100, "far")], "id long, name string")
    verts = graph.graph_vertices(df, names)
    full = dict(rows(graph.with_unreached(graph.bfs_distances(df, 0, 10), verts)))
    assert full[100] == float("inf") and full[0] == 0.0
    assert dict(rows(verts))[5] == "Nobody"


def test_bfs_early_stop_rounds(spark):
    df = spark.createDataFrame(_edges(), "src long, dst long")
    out = [tuple(r) for r in graph.bfs_early_stop(df, 0, 6).orderBy("round").collect()]
    # round 1: expand {0} (edges 0->1, 0->7); round 2: {1, 7}; round 3: {2, 8}, 2->5 twice;
    # round 4: {3, 5, 9}: 5->6 hits once
    assert out[0] == (1, 1, 2, 0)
    assert out[-1][0] == 4 and out[-1][3] == 1
    assert len(out) == 4


def test_degrees_top_and_sum(spark):
    e = _edges()
    df = spark.createDataFrame(e, "src long, dst long")
    d = dict(rows(graph.degrees(df)))
    assert sum(d.values()) == 2 * len(e)
    names = spark.createDataFrame([(2, "two"), (5, "five"), (0, "zero")], "id long, name string")
    top = [tuple(r) for r in graph.degrees_top(df, names, 2).collect()]
    assert top == [(2, "two", d[2]), (5, "five", d[5])]


def test_bfs_distance_to_stops_early(spark):
    e = _edges()
    df = spark.createDataFrame(e, "src long, dst long")
    want = brute_bfs(e, 0, 10)
    for target in (0, 6, 10, 13, 100):
        got = rows(graph.bfs_distance_to(df, 0, target, 10))
        assert got == ([(target, want[target])] if target in want else [])


def test_symmetric_bfs_matches_brute_force(spark):
    """Both directions of every edge: the anti join against the last two
    frontiers only must give the same distances, probes and round stats."""
    import random

    rnd = random.Random(5)
    und = _edges() + [(rnd.randrange(40), rnd.randrange(40)) for _ in range(60)] + [(14, 15), (15, 16)]
    e = und + [(d, s) for s, d in und]
    df = spark.createDataFrame(e, "src long, dst long")
    for rounds in (1, 2, 4, 10):
        assert dict(rows(graph.bfs_distances(df, 0, rounds, symmetric=True))) == brute_bfs(e, 0, rounds)
    want = brute_bfs(e, 0, 10)
    for target in (6, 16, 100):
        got = rows(graph.bfs_distance_to(df, 0, target, 10, symmetric=True))
        assert got == ([(target, want[target])] if target in want else [])
        assert (rows(graph.bfs_early_stop(df, 0, target, 10, symmetric=True))
                == rows(graph.bfs_early_stop(df, 0, target, 10)))


def test_bfs_runs_until_nothing_is_new(spark):
    e = [(i, i + 1) for i in range(25)] + [(50, 51)]
    df = spark.createDataFrame(e, "src long, dst long")
    assert dict(rows(graph.bfs_distances(df, 0))) == {i: i for i in range(26)}
    assert rows(graph.bfs_distance_to(df, 0, 25)) == [(25, 25)]
    assert rows(graph.bfs_distance_to(df, 0, 51)) == []


def test_hub_edges_are_dealt_over_chunks(spark):
    """A hub with a third of the edges: no join key holds more than about the
    chunk size, light vertices keep one key, and the distances are right."""
    import random

    rnd = random.Random(8)
    e = [(0, k) for k in range(1, 600)] + [(rnd.randrange(1, 600), rnd.randrange(1, 700)) for _ in range(1200)]
    df = spark.createDataFrame(e, "src long, dst long")
    prepared, heavy = graph._prepared_edges(df, 50)
    largest = max(r["count"] for r in prepared.groupBy("src", "chunk").count().collect())
    assert largest <= 100 and rows(heavy) == [(0, 12)]
    assert prepared.count() == len(e)
    assert dict(rows(graph.bfs_distances(df, 0, chunk_edges=50))) == brute_bfs(e, 0, 10**6)
    assert dict(rows(graph.bfs_distances(df, 5, chunk_edges=50))) == brute_bfs(e, 5, 10**6)


def test_bfs_leaves_no_scratch_tables(spark):
    import os

    from tessera.session import checkpoint_root

    df = spark.createDataFrame(_edges(), "src long, dst long")
    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    d = graph.bfs_distances(df, 0, 3)
    p = graph.bfs_distance_to(df, 0, 2, 10)
    assert dict(rows(d)) == brute_bfs(_edges(), 0, 3) and rows(p) == [(2, 2)]
    left = {n for n in os.listdir(root) if n not in before and not n.startswith("bfs-reached")}
    assert not [n for n in left if os.listdir(os.path.join(root, n)) and n.startswith(("bfs-edges", "bfs-frontier"))]


def test_rounds_shuffle_the_frontier_only(spark, monkeypatch):
    """No exchange lies between the edge scan and the join of a round."""
    plans = []
    plain = graph._expand

    def noted(prepared, heavy, frontier):
        hop = plain(prepared, heavy, frontier)
        plans.append(hop._jdf.queryExecution().executedPlan().toString())
        return hop

    monkeypatch.setattr(graph, "_expand", noted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a large frontier
    try:
        e = _edges() + [(0, k) for k in range(200, 260)]
        df = spark.createDataFrame(e, "src long, dst long")
        assert dict(rows(graph.bfs_distances(df, 0, chunk_edges=20))) == brute_bfs(e, 0, 99)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(plans) > 5
    for plan in plans:
        lines = plan.splitlines()
        scan = next(i for i, line in enumerate(lines) if "bfs_edges" in line)
        depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-*()0123456789"))
        above = []  # the scan's ancestors up to the join
        for line in reversed(lines[:scan]):
            d = len(line) - len(line.lstrip(" :+-*()0123456789"))
            if d < depth:
                depth = d
                above.append(line)
                if "Join" in line:
                    break
        assert above and "Join" in above[-1] and not any("Exchange" in line for line in above), plan


def test_bucket_count_stays_below_the_limit(spark, monkeypatch):
    df = spark.createDataFrame([(1, 2)], "src long, dst long")
    monkeypatch.setattr(graph, "partitions_for", lambda *_: 10**7)  # a huge byte estimate
    assert graph.edge_buckets(df) == 100_000
    monkeypatch.setattr(graph, "partitions_for", lambda *_: 30)
    assert graph.edge_buckets(df) == 30


def test_search_leaves_no_table(spark):
    df = spark.createDataFrame(_edges(), "src long, dst long")
    before = {t.name for t in spark.catalog.listTables()}
    graph.bfs_early_stop(df, 0, 6)
    graph.bfs_distance_to(df, 0, 6)
    assert {t.name for t in spark.catalog.listTables()} == before

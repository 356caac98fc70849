"""Substring removal and the Jaccard join against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_data import documents, rows

from tessera.llm import jaccard_join, substring_dedup
from tessera.llm.components import connected_components


def brute_removal(table, window=13):
    first = {}
    for i, t, *_ in sorted((r for r in table if r[0] is not None), key=lambda r: r[0]):
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k:k + window]), i)
    out = []
    for i, t, *_ in table:
        w, gone = (t or "").encode().split(), set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def order(values):
    return sorted(values, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("seed", [1, 2])
def test_removal_matches_brute_force(spark, seed):
    table = rows(seed)
    got = [tuple(r) for r in substring_dedup.remove_repeats(documents(spark, table)).collect()]
    want = brute_removal(table)
    assert order(got) == order(want)
    assert sum(r[2] for r in want) > 100


@pytest.mark.parametrize("params", [
    substring_dedup.CoverParams(5, 3, (0, 1)), substring_dedup.CoverParams(13, 13, (0, 1, 3, 9))])
def test_removal_with_other_covers(spark, params):
    rng = random.Random(5)
    table = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))), "en", "a") for i in range(60)]
    got = [tuple(r) for r in substring_dedup.remove_repeats(documents(spark, table), params).collect()]
    assert order(got) == order(brute_removal(table, params.window))


def test_cover_must_hold_every_difference():
    with pytest.raises(ValueError):
        substring_dedup.CoverParams(13, 7, (0, 1, 2))


def brute_components(table, percent=80):
    sets = {}
    for i, t, *_ in table:
        w = (t or "").encode().lower().split()
        if i is not None:
            sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset(
                [tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for q in s:
            holders[q].append(i)
    overlap = Counter((a, b) for v in holders.values() for a in v for b in v if a < b)
    for (a, b), o in overlap.items():
        if 100 * o >= percent * (len(sets[a]) + len(sets[b]) - o):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_copies(seed):
    rng = random.Random(seed)
    table, i = [], 100
    for g in range(6):
        base = [f"g{g}w{rng.randint(0, 60)}" for _ in range(rng.randint(6, 150))]
        for _ in range(rng.randint(2, 25)):
            w = list(base)
            for _ in range(rng.randint(0, 1 + len(w) // 25)):
                w[rng.randrange(len(w))] = f"e{rng.randint(0, 10**6)}"
            if rng.random() < 0.3:
                w += [f"p{q}" for q in range(60)]
            table.append((i, " ".join(w), "en", "a"))
            i += 1
    return table


@pytest.mark.parametrize("seed,tile", [(3, 2_000_000), (4, 300)])
def test_components_match_brute_force(spark, seed, tile):
    """The small tile size forces blocks, representatives and block pairs."""
    table = rows(seed, 15) + near_copies(seed)
    got = jaccard_join.jaccard_components(documents(spark, table), jaccard_join.JoinParams(tile_tokens=tile)).collect()
    want = brute_components(table)
    assert len(got) == len(table)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
    assert len({c for _, c in want.values()}) < len(want) - 20


def test_linked_components_equal_all_pairs():
    rng = np.random.default_rng(7)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 1 << 62, rng.integers(1, 400)).astype(np.uint64)
        for _ in range(3):
            keep = rng.random(len(base)) > rng.random() * 0.2
            keep[0] = True
            sets.append(np.unique(base[keep]))
    ids = np.arange(len(sets), dtype=np.int64) * 3
    got = jaccard_join.linked_components(ids, sets, 80)
    want = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            o = len(np.intersect1d(sets[i], sets[j]))
            if 100 * o >= 80 * (len(sets[i]) + len(sets[j]) - o):
                a, b = sorted((want[i], want[j]))
                want = [a if x == b else x for x in want]
    assert got.tolist() == [ids[w] for w in want]


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 90), (90, 101), (7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 90: 90, 100: 90, 101: 90, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_tables(spark):
    none = documents(spark, [])
    assert substring_dedup.remove_repeats(none).count() == 0
    assert jaccard_join.jaccard_components(none).count() == 0
    only_null = documents(spark, [(None, None, None, None), (5, "", "en", "a")])
    assert substring_dedup.remove_repeats(only_null).count() == 2
    assert sorted((r.doc_id or 0, r.component_id) for r in
                  jaccard_join.jaccard_components(only_null).collect()) == [(0, None), (5, 5)]


def test_rows_of_the_exchange_stay_large():
    """Postings of one row (a slice's share of a bucket), at one per eight bytes
    of text: as many at 1 TB as at a few GB, and a bucket fits one task."""
    from tessera.llm.common import BUCKET_MOST, bucket_count, slice_limit

    sizes = [1 << 20, 512 << 20, 30 << 30, 1 << 40]
    per_row = [min(slice_limit(s), s) / 8 / bucket_count(s) for s in sizes]
    assert all(n >= 230 for n in per_row), per_row
    assert [bucket_count(s) for s in sizes[:2]] == [8, 128]
    assert all(s / bucket_count(s) <= BUCKET_MOST for s in [*sizes, 100 << 40])


def test_results_do_not_depend_on_slices_and_buckets(spark, monkeypatch):
    from tessera.llm import common

    docs = documents(spark, [(i, t, g, s) for i, t, g, s in rows(n=16) if i is not None])
    want = [sorted(map(str, f(docs).collect())) for f in (substring_dedup.remove_repeats, jaccard_join.jaccard_components)]
    monkeypatch.setattr(common, "PROPORTIONAL", 1 << 10)
    monkeypatch.setattr(common, "SLICE_MOST", 1 << 30)
    for size in (1 << 12, 1 << 22):
        monkeypatch.setattr(common, "input_bytes", lambda df: size)
        assert [sorted(map(str, f(docs).collect())) for f in (substring_dedup.remove_repeats, jaccard_join.jaccard_components)] == want

"""Mixing, packing, model scores, neighbours and the pipeline."""

import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from llm_data import documents, rows
from pyspark.sql import functions as F

from tessera.llm import ann, catalog, lm, mixing, oracle, packing
from tessera.llm.common import crc_fold


# --- mixing -------------------------------------------------------------------------------

def mix_table(n=300):
    rng = random.Random(9)
    out = [(k, " ".join(["t"] * rng.randint(0, 60)), "en", rng.choice(["hot"] * 6 + ["b", "c", "d", None])) for k in range(n)]
    return out + [(5000, "", "en", "empty"), (5001, None, "en", "empty")]


@pytest.mark.parametrize("params", [mixing.MixParams(), mixing.MixParams(entropy_gain=0.95, max_repeats=1.5),
                                    mixing.MixParams(entropy_gain=0.7, block_tokens=200)])
def test_mixing_matches_sql(spark, params):
    docs = documents(spark, mix_table())
    con = duckdb.connect()
    con.register("rows_", docs.select("doc_id", "text", "source").toPandas())
    con.execute("CREATE VIEW documents AS SELECT * FROM rows_")
    got = mixing.mix_sources(docs, params).withColumns({c: F.round(c, 9) for c in ("share", "weight")})
    key = lambda r: r[0]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(con.execute(oracle.mixing_sql(params)).fetchall(), key=key)


@pytest.mark.parametrize("params,bind", [(mixing.MixParams(entropy_gain=0.6, max_repeats=99), "entropy"),
                                         (mixing.MixParams(entropy_gain=1.0, max_repeats=2.0), "repeats")])
def test_mixing_meets_its_target(spark, params, bind):
    docs = documents(spark, mix_table())
    got = mixing.mix_sources(docs, params).collect()
    t, w, b = Counter(), {}, {}
    for r in got:
        t[r.source] += r.n_tokens
        w[r.source], b[r.source] = r.weight, r.budget
    used = [k for k in t if t[k]]
    p = [t[k] / sum(t.values()) for k in used]
    entropy = lambda x: -sum(v * math.log(v) for v in x)
    if bind == "entropy":
        goal = entropy(p) + 0.6 * (math.log(len(p)) - entropy(p))
        assert entropy([w[k] for k in used]) == pytest.approx(goal, abs=1e-8)
    else:
        assert max(b[k] / t[k] for k in used) == pytest.approx(2.0, abs=0.02)
    assert sum(w.values()) == pytest.approx(1.0)
    assert min(r.copies for r in got) == 1  # every document is used
    drawn = Counter()
    for r in got:
        drawn[r.source] += r.n_tokens * r.copies
    for k in used:  # whole blocks and documents: at most one document over the budget
        assert b[k] - 1 <= drawn[k] <= b[k] + 60


def test_mixing_draw_and_small_budget(spark):
    docs = documents(spark, mix_table())
    params = mixing.MixParams(budget_tokens=3000)
    plan = {r.doc_id: r.copies for r in mixing.mix_sources(docs, params).collect()}
    out = mixing.draw_mixture(docs, params)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.select("doc_id").collect()) == Counter({k: v for k, v in plan.items() if v})
    assert min(plan.values()) == 0


def test_mixing_edge_tables(spark):
    assert mixing.mix_sources(documents(spark, [])).count() == 0
    no_tokens = [(1, None, "en", "a"), (2, "", "en", None)]
    assert {r.doc_id: (r.weight, r.copies) for r in mixing.mix_sources(documents(spark, no_tokens)).collect()} == {
        1: (0.0, 1), 2: (0.0, 1)}
    one = mixing.mix_sources(documents(spark, [(1, "a b", "en", "a"), (2, "c", "en", "a")])).collect()
    assert {(r.weight, r.copies) for r in one} == {(1.0, 1)}
    twice = mixing.mix_sources(documents(spark, [(1, "a b", "en", "a")] * 2)).collect()
    assert [(r.copies) for r in twice] == [1, 1]


# --- packing ---------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cutting_stock_covers_and_is_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    capacity = 64
    demand = np.zeros(capacity + 1, dtype=np.int64)
    np.add.at(demand, rng.integers(1, capacity + 1 if seed < 3 else 22, 5000), 1)
    plan = packing.cutting_stock(demand, capacity)
    assert (sum(p * n for p, n in plan) == demand).all()
    assert all((p * np.arange(capacity + 1)).sum() <= capacity and n > 0 for p, n in plan)
    used = sum(n for _, n in plan)
    halves = int(demand[capacity // 2 + 1:].sum())  # no two of these share a sequence
    bound = max(halves, math.ceil((demand * np.arange(capacity + 1)).sum() / capacity))
    assert used <= bound * 1.02 + 3
    assert packing.cutting_stock(np.zeros(9, dtype=np.int64), 8) == []


def test_best_pattern_is_the_best():
    rng = np.random.default_rng(4)
    for _ in range(20):
        values = np.concatenate([[0], rng.random(12)])
        best, pattern = packing.best_pattern(values, 12)
        assert (pattern * np.arange(13)).sum() <= 12 and pattern @ values == pytest.approx(best)
        table = [0.0] * 13
        for c in range(1, 13):
            table[c] = max([table[c - 1], *(table[c - b] + values[b] for b in range(1, c + 1))])
        assert best == pytest.approx(table[12])


def encoded(text, tokenizer):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("params", [packing.PackParams(), packing.PackParams(seq_len=64, unit=4, rank_rows=40)])
def test_packing_holds_every_token_once(spark, params):
    from tokenizers import Tokenizer

    table = rows(3) + [(30_000, "Σίσυφος ΟΔΟΣ <|endoftext|> x İ", "", ""), (30_001, "can't 'S 12345 !!?? é a b\x1cc", "", "")]
    spec = catalog.tokenizer_json()
    tokenizer = Tokenizer.from_str(spec)
    got = packing.pack_documents(documents(spark, table), spec, params).collect()
    ids = {(i, t): encoded(t, tokenizer) for i, t, *_ in table}
    want = Counter()
    for i, t, *_ in table:
        x = ids[i, t]
        for a in range(0, len(x), params.seq_len):
            piece = x[a:a + params.seq_len]
            want[i, a, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()), len(x)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= params.seq_len
    tokens = sum(r.length for r in got)
    assert len(sequences) <= tokens / params.seq_len * 1.25 + 3


def test_packing_empty(spark):
    assert packing.pack_documents(documents(spark, []), catalog.tokenizer_json()).count() == 0


# --- scores ---------------------------------------------------------------------------------

def brute_ppm(texts):
    counts = [defaultdict(Counter) for _ in range(3)]
    for x in texts:
        y = b"\0\0" + x
        for i in range(2, len(y)):
            for k in range(3):
                counts[k][y[i - k:i]][y[i]] += 1

    def log10(context, symbol):
        out, p = set(), 1.0
        for k in (2, 1, 0):
            seen = {s: c for s, c in counts[k].get(context[2 - k:], {}).items() if s not in out}
            total, distinct = sum(seen.values()), len(seen)
            if total:
                if symbol in seen:
                    return math.log10(p * seen[symbol] / (total + distinct))
                p *= distinct / (total + distinct)
            out |= set(seen)
        return math.log10(p / (256 - len(out)))

    return lambda x: sum(log10((b"\0\0" + x)[i:i + 2], x[i]) for i in range(len(x)))


def test_scores_match_brute_force(spark):
    table = [r for r in rows(4, 20) if r[0] is not None and (r[1] is None or len(r[1]) < 3000)]
    table = list(dict.fromkeys(table)) + [table[0]]
    train = crc_fold(F.col("doc_id"), 4) != 0
    got = lm.score_documents(documents(spark, table), train).collect()
    used = [(t or "").encode() for i, t, *_ in table if zlib.crc32(str(i).encode()) % 4]
    c = Counter(w for t in used for w in t.lower().split())
    n, v = sum(c.values()) + len(used), len(c) + 1
    ppm = brute_ppm(used)
    by = {i: (t or "").encode() for i, t, *_ in table}
    assert len(got) == len(table)
    for r in got:
        words = by[r.doc_id].lower().split()
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        base += math.log10((len(used) + 0.1) / (n + 0.1 * (v + 1)))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words) + 1, sum(c[w] > 0 for w in words) + 1, n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(ppm(by[r.doc_id]), rel=1e-4, abs=1e-4)


def brute_ppm_of(texts, order):
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    for x in texts:
        y = b"\0" * order + x
        for i in range(order, len(y)):
            for k in range(order + 1):
                counts[k][y[i - k:i]][y[i]] += 1

    def log10(context, symbol):
        out, p = set(), 1.0
        for k in range(order, -1, -1):
            seen = {s: c for s, c in counts[k].get(context[order - k:], {}).items() if s not in out}
            total, distinct = sum(seen.values()), len(seen)
            if total:
                if symbol in seen:
                    return math.log10(p * seen[symbol] / (total + distinct))
                p *= distinct / (total + distinct)
            out |= set(seen)
        return math.log10(p / (256 - len(out)))

    return lambda x: sum(log10((b"\0" * order + x)[i:i + order], x[i]) for i in range(len(x)))


@pytest.mark.parametrize("order", [3, 5, 7])
def test_long_contexts_match_brute_force(spark, monkeypatch, order):
    monkeypatch.setattr(lm, "buckets_for", lambda df: 16)
    table = [r for r in rows(4, 20) if r[0] is not None and (r[1] is None or len(r[1]) < 3000)]
    table += [(40_000, "\0\0a \U0001f600\xff", "", ""), (40_001, "\0\0a \U0001f600\xfe", "", "")]
    table = list(dict.fromkeys(table)) + [table[0]]
    got = lm.score_documents(documents(spark, table), crc_fold(F.col("doc_id"), 4) != 0, order).collect()
    ppm = brute_ppm_of([(t or "").encode() for i, t, *_ in table if zlib.crc32(str(i).encode()) % 4], order)
    by = {i: (t or "").encode() for i, t, *_ in table}
    assert len(got) == len(table)
    for r in got:
        assert r.score == pytest.approx(ppm(by[r.doc_id]), rel=1e-5, abs=1e-4)


def test_long_contexts_are_a_distribution():
    keys, _, inside = lm.context_keys([b"abracadabra", b"banana \xc3\xa9", b""], 5)
    trained, n = np.unique(keys[inside], return_counts=True)
    codes, _, real = lm.byte_grams([b"abracadabra", b"banana \xc3\xa9", b""])
    low = lm.LowTrie(*np.unique(codes[real], return_counts=True))
    for context in (b"abrac", b"zzabr", b"xxxan", b"\0\0\0\0\0", b"qqqqq"):
        top = int.from_bytes(context[::-1], "big") << 8
        asked = np.array([top | s for s in range(256)], dtype=np.uint64)
        every = np.unique(np.concatenate([trained, asked]))
        count = np.zeros(len(every))
        count[np.searchsorted(every, trained)] = n
        costs = lm.gram_costs(every, count, 5, low)[np.searchsorted(every, asked)]
        assert (10.0 ** costs).sum() == pytest.approx(1.0, abs=1e-4)


def test_the_query_scores_long_contexts(spark, monkeypatch):
    """The query's score is that of its long order: a learned passage costs less than by trigrams."""
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu") for b in ("ra", "so", "ti", "ve")]
    rng = random.Random(5)
    train = [(k, " ".join(rng.choices(words, k=60)), "", "") for k in range(60)]
    passage = " ".join(rng.sample(words, 16))
    same = [k for k in range(100, 200) if zlib.crc32(str(k).encode()) % 10 == 0][:1]
    table = train + [(k, passage, "", "") for k in range(60, 100) if zlib.crc32(str(k).encode()) % 10] + [
        (same[0], passage, "", "")]
    monkeypatch.setattr(catalog, "table", lambda *a: documents(spark, table, extra=False))
    got = {r.doc_id: r for r in catalog.QUERIES["op9_ppm_score"](spark, "").collect()}
    used = [t.encode() for i, t, *_ in table if zlib.crc32(str(i).encode()) % 10]
    assert got[same[0]].held_out
    assert got[same[0]].score == pytest.approx(brute_ppm_of(used, catalog.PPM_ORDER)(passage.encode()), rel=1e-5)
    assert got[same[0]].score > 0.9 * brute_ppm(used)(passage.encode())


def test_ppm_is_a_distribution():
    codes, _, inside = lm.byte_grams([b"abracadabra", b"banana \xc3\xa9", b""])
    gram, n = np.unique(codes[inside], return_counts=True)
    table = 10.0 ** lm.trie_costs(gram, n).reshape(-1, 256).astype(float)
    for context in (b"ab", b"zq", b"za", b"\0\0", b"na"):
        assert table[context[0] * 256 + context[1]].sum() == pytest.approx(1.0, abs=1e-4)


def test_scores_edge_tables(spark):
    assert lm.score_documents(documents(spark, []), F.lit(True)).count() == 0
    untrained = lm.score_documents(documents(spark, [(1, "a b", "", ""), (None, None, None, None)]), F.lit(False)).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in untrained} == {(1, 3, 0, 0), (None, 1, 0, 0)}
    assert {round(r.score, 5) for r in untrained} == {round(3 * math.log10(1 / 256), 5), 0.0}


def test_heavy_words_are_scored_in_place(spark, monkeypatch):
    """Whatever the split between broadcast and bucketed words, the sums agree."""
    docs = documents(spark, [(k, "the " * (k % 5) + f"rare{k}", "", "") for k in range(50)])
    results = []
    for bits in (1, 17):
        monkeypatch.setattr(lm, "HEAVY_BITS", bits)
        results.append({r.doc_id: (r.n_known, round(r.base_score, 9)) for r in
                        lm.score_documents(docs, F.col("doc_id") % 2 == 0).collect()})
    assert results[0] == results[1]


# --- neighbours ---------------------------------------------------------------------------------

def brute_neighbours(ids, vectors, k, every):
    out = {}
    for i, v in zip(ids, vectors):
        if i % every == 0:
            score = vectors @ v
            order = sorted((-round(float(s), 12), j) for j, s in zip(ids, score) if j != i)
            out[i] = [j for _, j in order[:k]]
    return out


@pytest.mark.parametrize("scale", [0.0, 0.7])
def test_neighbours_recall_and_scores(spark, scale):
    """Vectors of equal and of very different lengths, over several shards."""
    rng = np.random.default_rng(11)
    v = rng.normal(size=(1500, 24))
    v = v / np.linalg.norm(v, axis=1, keepdims=True) * np.exp(scale * rng.normal(size=(1500, 1)))
    v[200:500] = v[7]  # a group of equal vectors
    ids = rng.permutation(5000)[:1500].tolist()
    df = spark.createDataFrame([(i, x.tolist(), 1) for i, x in zip(ids, v)], "vec_id long, embedding array<double>, shard int")
    got = ann.nearest_neighbours(df, 10, 20, ann.GraphParams(shard_rows=400, query_block=20)).collect()
    want = brute_neighbours(ids, v, 10, 20)
    by = defaultdict(list)
    at = {i: x for i, x in zip(ids, v)}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        assert r.score == pytest.approx(float(at[r.query_id] @ at[r.vec_id]), rel=1e-12, abs=1e-12)
        by[r.query_id].append(r.vec_id)
    assert set(by) == set(want) and all(len(x) == 10 == len(set(x)) for x in by.values())
    hits = sum(len(set(by[q]) & set(want[q])) for q in want)
    assert hits >= 0.95 * 10 * len(want)


def test_neighbours_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    table = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (5, [0.5, 0.5]), (3, [2.0, 0.0]), (40, None), (60, [0.0, 0.0]),
             (80, [nan, 1.0]), (100, [inf, 1.0]), (120, [None, 1.0]), (140, [1.0]), (None, [1.0, 1.0]), (0, [1.0, 0.0])]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest_neighbours(df, 20).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert got == {0: {1: (3, 2.0), 2: (20, 1.0), 3: (5, 0.5)}, 20: {1: (3, 2.0), 2: (0, 1.0), 3: (5, 0.5)}}
    assert ann.nearest_neighbours(df.limit(0)).count() == 0


def test_a_repeated_id_has_its_smallest_vector(spark):
    rows_ = [(0, [1.0, 0.0]), (1, [0.5, 2.0]), (1, [0.5, 1.0]), (1, [0.9, 0.0]), (2, [0.6, 9.0]), (0, [1.0, 0.0])]
    for seed in range(3):
        random.Random(seed).shuffle(rows_)
        df = spark.createDataFrame(rows_, "vec_id long, embedding array<double>").repartition(4)
        assert [(r.query_id, r.vec_id, r.score) for r in ann.nearest_neighbours(df).orderBy("rank").collect()] == [
            (0, 2, 0.6), (0, 1, 0.5)]


# --- pipeline -------------------------------------------------------------------------------------

def test_pipeline_stages_take_effect(spark, tmpdir_path):
    import corpus_pipeline

    rng = random.Random(2)
    vocab = {"en": "the of and that with from this have river stone".split(),
             "fr": "le la les dans avec pour être pierre fleuve été".split()}
    table = []
    for k in range(120):
        g = rng.choice(sorted(vocab))
        words = [rng.choice(vocab[g]) + rng.choice(["", "s", "x"]) for _ in range(rng.randint(20, 120))]
        table.append((k, " ".join(words), g, rng.choice(["hot"] * 4 + ["b", "c"])))
    near = table[5][1].split()
    near[-1] = "changed"
    table += [(200, table[3][1], "en", "b"), (201, " ".join(near * 1), "en", "b"), (202, "12 34", "en", "b"),
              (203, None, "en", "b"), (204, table[7][1] + " mail a.b@c.org", "en", "c")]
    docs = documents(spark, table, extra=False)
    docs.write.parquet(f"{tmpdir_path}/documents.parquet")
    seen, step = [], spark.read.parquet(f"{tmpdir_path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, step, tmpdir_path)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmpdir_path}/stage{k}")
        step = spark.read.parquet(f"{tmpdir_path}/stage{k}")
        seen.append(step.collect())
    first = {r.doc_id for r in seen[0]}
    assert {202, 203}.isdisjoint(first) and len(first) >= 120
    second = {r.doc_id for r in seen[1]}
    assert 200 not in second and 3 in second and len(second & {5, 201}) == 1 and len(seen[1]) == len(second)
    third = {r.doc_id: r for r in seen[2]}
    assert set(third) == second and all("@" not in r.text for r in third.values())
    assert all(r.n_chars == len(r.text) for r in third.values())
    assert {r.doc_id for r in seen[3]} == second and len(seen[3]) > len(second)
    assert sum(r.length for r in seen[4]) == sum(
        next(p.doc_tokens for p in seen[4] if p.doc_id == r.doc_id) for r in seen[3])
    whole = Counter(tuple(r) for r in corpus_pipeline.run(spark, tmpdir_path).select(
        "doc_id", "start", "length", "ids_crc32").collect())
    assert whole == Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in seen[4])


def test_pipeline_keeps_every_row_that_is_no_copy(spark, tmpdir_path):
    """Repeated and missing ids, extra columns, null and empty texts: only
    similarity decides which rows the second stage drops."""
    import corpus_pipeline

    words = [f"w{k}" for k in range(300)]
    text = {c: " ".join(words[a:a + 60]) for c, a in zip("abcd", (0, 70, 140, 210))}
    near = text["a"].replace("w59", "x")
    table = [(1, text["a"], "en", "s"), (1, text["b"], "en", "s"), (1, text["a"], "en", "s"), (2, near, "en", "s"),
             (None, text["c"], "en", "s"), (None, text["d"], "en", "s"), (None, text["b"], "en", "s"), (0, text["c"], "en", "s"),
             (7, None, "en", "s"), (7, "", "en", "s"), (7, "  ", "en", "s")]
    docs = documents(spark, table, partitions=3)
    docs = docs.withColumn("_row", F.lit(1)).withColumn("component_id", F.lit(2)).withColumn("none", F.lit(3))
    got = corpus_pipeline.near_duplicates(spark, docs, tmpdir_path)
    assert got.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in got.collect()) == sorted([
        (False, 1, text["a"]), (False, 1, text["b"]), (False, 0, text["c"]), (True, 0, text["d"]),
        (False, 7, ""), (False, 7, ""), (False, 7, "  ")])


@pytest.mark.parametrize("table", [[], [(None, None, None, None)] * 3, [(5, "one", "en", "s")] * 2 + [(None, "a " * 50, None, "t")]])
def test_pipeline_on_odd_tables(spark, tmpdir_path, table):
    import corpus_pipeline

    documents(spark, table, extra=False).write.parquet(f"{tmpdir_path}/documents.parquet")
    out = corpus_pipeline.run(spark, tmpdir_path)
    assert {"doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out.columns)
    assert out.count() <= 40


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_other_tokenizer_files_give_their_own_ids(name):
    """A file whose normalizer or words differ is not taken for the known kind."""
    import public_tokenizers
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        spec = f.read()
    words, tok = packing.WordIds(spec), Tokenizer.from_str(spec)
    assert (words.words is None) is (name != "word_bpe_49k.json")
    for text in ("The Quick brown fox's 42 jumps", "Über  Straße\n\tNaïve e\u0301", "<|endoftext|> x", "", "日本語 🙂"):
        assert np.frombuffer(words.text_ids(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids


def test_word_ids_outlive_a_full_table(monkeypatch):
    """A full table keeps what is still in use, ids stay right over the turns, and a
    worker's next task gets the same tables."""
    import public_tokenizers
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    monkeypatch.setattr(packing, "CACHE_CHUNKS", 5)
    words, tok = packing.WordIds(spec), Tokenizer.from_str(spec)
    merged = []
    merge = words._word
    monkeypatch.setattr(words, "_word", lambda w: merged.append(w) or merge(w))
    for k in range(40):
        text = f"Always kept, always: w{'xyz'[k % 3]}{'abcdefgh' [k % 8]}q{'lmnop'[k % 5]}r don't!!"
        assert np.frombuffer(words.text_ids(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
    assert merged.count("always") == 1
    assert packing.word_ids(spec) is packing.word_ids(spec)

"""Periodic runs, license scans and tokenizer alignment against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from llm_data import documents, rows
from tokenizers import Tokenizer

from tessera.llm import catalog, licenses, periodic
from tessera.llm import alignment as al


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def run_query(monkeypatch, spark, name, df):
    """A registered query's rows over ``df`` as its documents table."""
    monkeypatch.setattr(catalog, "table", lambda *_: df)
    return [r.asDict() for r in catalog.QUERIES[name](spark, "unused").collect()]


def same_rows(got, want):
    def key(row):
        return sorted((k, str(v)) for k, v in row.items())

    assert sorted(map(key, got)) == sorted(map(key, want))


# --- periodic runs ----------------------------------------------------------------

def brute_runs(words, least=12):
    """Every run by sliding each period over the words; smaller periods first."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def periodic_words(rng):
    kind, n = rng.randrange(6), rng.randint(0, 130)
    if kind < 2:
        return [rng.choice("abc"[:2 + kind]) for _ in range(n)]
    if kind == 2:
        return ([rng.choice("ab") for _ in range(rng.randint(1, 20))] * 30)[:n]
    if kind == 3:  # squares whose roots are themselves periodic
        root = "ab" * rng.randint(1, 9) + "a"
        return list("ab" * rng.randint(0, 3) + root * 2 + "ba" * rng.randint(0, 3))
    if kind == 4:  # Fibonacci word: a run at nearly every place
        a, b = "a", "b"
        for _ in range(9):
            a, b = a + b, a
        return list(a)[:n]
    root = [rng.choice("abcd") for _ in range(rng.randint(1, 25))] * rng.randint(1, 5)
    root[rng.randrange(len(root))] = "z"
    return root + ["x", "y"] + root


def test_runs_equal_brute_force():
    rng = random.Random(11)
    total = 0
    for _ in range(700):
        docs = [[w.encode() for w in periodic_words(rng)] for _ in range(rng.randint(1, 5))]
        doc, start, length, period = periodic.find_runs(docs)
        got = [sorted((int(s), int(n), int(q)) for d, s, n, q in zip(doc, start, length, period) if d == k)
               for k in range(len(docs))]
        assert got == [brute_runs(d) for d in docs]
        total += len(doc)
    assert total > 2000


def test_runs_need_a_long_enough_minimum():
    with pytest.raises(ValueError):
        periodic.find_runs([[b"a"]], min_length=8)


def test_query_runs(spark, monkeypatch):
    rng = random.Random(2)
    # Odd and repeated rows, then ids whose texts are made periodic.
    data = [r for r in rows() if r[1] is None or len(r[1]) < 20_000]
    data += [(50_000 + k, " ".join(periodic_words(rng)) if k % 3 else " ".join(str(rng.randrange(300)) for _ in range(k)),
              None, None) for k in range(240)]
    want = []
    for doc_id, text, _, _ in data:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n = len(words)
        h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute_runs(words)
        gone = {i for s, size, q in runs for i in range(s + q, s + size)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        want.append({"doc_id": doc_id, "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
                     "exponent_milli": 1000 * best[1] // best[2] if runs else None,
                     "runs_sha256": sha("".join("%d,%d,%d\n" % r for r in runs)),
                     "collapsed_sha256": sha(" ".join(w for i, w in enumerate(words) if i not in gone))})
    assert sum(w["n_runs"] > 0 for w in want) > 60
    same_rows(run_query(monkeypatch, spark, "op11_periodic_runs", documents(spark, data)), want)


def test_long_periodic_text(spark):
    text = " ".join(f"w{k % 7001}" for k in range(60_000))
    row = periodic.periodic_runs(documents(spark, [(1, text, None, None)])).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 60_000, 7001)]
    assert row["collapsed"] == " ".join(f"w{k}" for k in range(7001))


# --- license scans ------------------------------------------------------------------

LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def license_words(text):
    return re.findall(LICENSE_WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base_places(words):
    phrases = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
    return [(i, label) for i in range(len(words)) for label, p in phrases.items()
            if words[i:i + len(p.split())] == p.split()]


def template_regex(text):
    """A template as a regular expression over words, each followed by a space."""
    out = []
    for mark in re.findall(r"\[|\]|\{\d+-\d+\}|[^\[\]{}]+", text):
        if mark in "[]":
            out.append("(?:" if mark == "[" else ")?")
        elif mark[0] == "{":
            out.append(r"(?:\S+ ){%s}" % mark[1:-1].replace("-", ","))
        else:
            out += [re.escape(w) + " " for w in license_words(mark)]
    return re.compile("".join(out))


def fill(rng, text, spoil):
    """A text that a template accepts, or with one mandatory word changed."""
    out, skip, mandatory = [], 0, []
    for mark in re.findall(r"\[|\]|\{\d+-\d+\}|[^\[\]{}]+", text):
        if mark == "[":
            skip = skip + 1 if skip or rng.random() < 0.5 else 0
        elif mark == "]":
            skip = max(0, skip - 1)
        elif skip:
            continue
        elif mark[0] == "{":
            low, high = map(int, mark[1:-1].split("-"))
            out += [f"name{rng.randrange(9)}" for _ in range(rng.randint(low, high))]
        else:
            mandatory += range(len(out), len(out) + len(license_words(mark)))
            out += license_words(mark)
    if spoil and mandatory:
        out[rng.choice(mandatory)] = "other"
    return " ".join(out)


@pytest.mark.parametrize("seed", range(3))
def test_templates_equal_regular_expressions(seed):
    rng = random.Random(seed)
    every = licenses.BASE + licenses.TEMPLATES
    automaton = licenses.Automaton(every)
    found = 0
    for _ in range(120):
        text = " ".join(fill(rng, rng.choice(every).text, rng.random() < 0.3) if rng.random() < 0.7 else
                        rng.choice(["the", "licensed", "under the", "cc by", "This software", "4 0"])
                        for _ in range(rng.randint(1, 3)))
        words = license_words(text)
        spaced = "".join(w + " " for w in words)
        at = [0]
        for w in words:
            at.append(at[-1] + len(w) + 1)
        want = set()
        for t in every:
            pattern = template_regex(t.text)
            if any(pattern.match(spaced, a) for a in at[:-1]):
                want.add(t.label)
        got = automaton.matches([w.encode() for w in words])
        assert {m[0] for m in got} == want, text
        assert sorted((m[1], m[0]) for m in got if m[3]) == sorted(base_places(words))
        found += len(want)
    assert found > 100


def test_mandatory_wording_is_exact():
    automaton = licenses.Automaton(licenses.BASE + licenses.TEMPLATES)

    def labels(text):
        return {m[0] for m in automaton.matches([w.encode() for w in license_words(text)])}

    mit = licenses.TEMPLATES[0].text.replace("[", "").replace("]", "").replace("{0-20}", "Jane Doe")
    assert labels("Copyright 2020 Jane Doe. " + mit) == {"mit"}
    assert labels(mit.replace("merge", "burn")) == set()
    assert labels("under the terms of the MIT license") == {"mit"}  # without a base phrase
    assert labels("Licensed under CC BY-NC 4.0.") == {"cc-by-nc"}
    assert labels("Licensed under CC BY 4.0.") == {"cc-by"}
    assert labels("licensed under the GNU General Public License, version 3.") == {"gpl-3"}
    assert labels("we licensed the software and gave a copy") == set()


def test_templates_are_checked():
    with pytest.raises(ValueError):
        licenses.Automaton([licenses.Template("x", "[a]")])
    with pytest.raises(ValueError):
        licenses.Automaton([licenses.Template("x", "a [b")])


def test_query_licenses(spark, monkeypatch):
    data = rows() + [
        (60_000, "Released under the MIT License.", None, None), (60_001, "cc by nc CC-BY-NC", None, None),
        (60_002, "Apache License, Version 2.0; under the mit license", None, None), (60_003, "É under THE mit license", None, None),
        (60_004, "underthe mit license ÀB", None, None), (60_005, "licensed under the GNU GPL version 3", None, None),
        (60_006, "Licensed under the GNU General Public License, version 3.", None, None)]
    got = run_query(monkeypatch, spark, "op12_license_scan", documents(spark, data))
    want = []
    for doc_id, text, _, _ in data:
        words = license_words(text)
        places = base_places(words)
        want.append({"doc_id": doc_id, "n_words": len(words), "n_base": len(places),
                     "first_word": min([p[0] for p in places], default=None),
                     "last_word": max([p[0] for p in places], default=None),
                     "base_labels": ",".join(sorted({p[1] for p in places}))})
    same_rows([{k: r[k] for k in want[0]} for r in got], want)
    assert all(0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "") for r in got)
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[60_006]["labels"] == "gpl-3" and by_id[60_005]["labels"] == "" and by_id[60_001]["labels"] == "cc-by-nc"


# --- tokenizer alignment ------------------------------------------------------------

A_JSON = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
B_MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()


@pytest.fixture(scope="module")
def encoders():
    a = Tokenizer.from_str(A_JSON)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=B_MODEL)
    symbols = al.byte_symbols()
    a_bytes = {i: bytes(symbols[c] for c in t) for t, i in a.get_vocab().items() if all(c in symbols for c in t)}
    return a, b, a_bytes, al.piece_bytes(b)


def brute_groups(encoders, text):
    """Groups of a text by walking both token lists; none if bytes are lost."""
    a, b, a_bytes, b_bytes = encoders
    if not text:
        return []
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    if {b"".join(a_bytes[i] for i in a_ids), b"".join(b_bytes[i] for i in b_ids)} != {(" " + text).encode()}:
        return []
    out, ends, k = [([], [])], [0, 0], 0
    for i in a_ids:
        out[-1][0].append(i)
        ends[0] += len(a_bytes[i])
        while ends[1] < ends[0]:
            out[-1][1].append(b_ids[k])
            ends[1] += len(b_bytes[b_ids[k]])
            k += 1
        if ends[0] == ends[1]:
            out.append(([], []))
    return out[:-1]


def spelled(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def odd_texts(seed, n):
    rng = random.Random(seed)
    parts = [" ", "  ", "\n", "\t", "a", "bc", "the", "'s", "123", "€", "é", "日本", "　", " ", "<|endoftext|>", "<s>",
             "</s>", "<unk>", "<0x0A>", "▁", "\x00", "\x1c", "\x85", "😀", "​", "...", "Ab", "\r\n", "�", "zzzz"]
    for k in range(n):
        yield "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        yield "".join(chr(rng.choice([rng.randrange(32, 592), rng.randrange(32, 0xD800), rng.randrange(0xE000, 0x1FA00)]))
                      for _ in range(rng.randint(1, 12))) + " x"


def test_chunks_align_like_whole_texts(encoders):
    aligner = al.Aligner(A_JSON, B_MODEL)
    texts = list(odd_texts(5, 900))
    found = aligner.texts(texts)
    for text, chunks in zip(texts, found):
        assert ";".join(aligner.groups[i] for i in chunks.tolist()) == spelled(brute_groups(encoders, text)), repr(text)


def test_merge_counts_and_maxima():
    rng = random.Random(4)
    runs, want = [], Counter()
    for _ in range(7):
        counts = Counter({rng.randrange(60) << al.B_BITS | rng.randrange(50): rng.randint(1, 9) for _ in range(1500)})
        want += counts
        runs.append(al.write_run(*map(al.np.array, zip(*sorted(counts.items())))))
    merged = al.read_run(al.sum_runs(runs), 1)
    assert dict(zip(*(c.tolist() for c in merged))) == want
    most = defaultdict(int)
    for key, n in want.items():
        most[key >> al.B_BITS] = max(most[key >> al.B_BITS], n)
    for run, back in zip(runs, al.total_runs(runs)):
        keys, totals, best = (c.tolist() for c in al.read_run(back, 2))
        assert keys == al.read_run(run, 1)[0].tolist()
        assert totals == [want[k] for k in keys] and best == [want[k] == most[k >> al.B_BITS] for k in keys]


@pytest.mark.parametrize("n_groups", [1, 40])
def test_query_alignment(spark, monkeypatch, encoders, n_groups):
    monkeypatch.setattr(al, "RUN_BYTES", 4096)
    monkeypatch.setattr(al, "FAN", 4)  # 40 groups of runs are merged to 10, 3 and 1
    monkeypatch.setattr(al, "input_bytes", lambda df: 4096 * n_groups)
    data = [r for r in rows(n=20)] + [(70_000 + k, t, None, None) for k, t in enumerate(odd_texts(9, 40))]
    groups = [brute_groups(encoders, t) for _, t, _, _ in data]
    links = [Counter((x, y) for xs, ys in g for x in xs for y in ys) for g in groups]
    counts = Counter(pair for found in links for pair in found)
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    want = [{"doc_id": r[0], "n_a": sum(len(x) for x, _ in g), "n_b": sum(len(y) for _, y in g), "n_groups": len(g),
             "n_links": sum(found.values()), "n_best": sum(n for p, n in found.items() if counts[p] == most[p[0]]),
             "count_sum": sum(n * counts[p] for p, n in found.items()), "groups_sha256": sha(spelled(g)) if g else ""}
            for r, g, found in zip(data, groups, links)]
    same_rows(run_query(monkeypatch, spark, "op13_tokenizer_alignment", documents(spark, data)), want)


def test_whole_groups_are_returned(spark, encoders):
    text = "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich."
    row = al.align_tokenizers(documents(spark, [(1, text, None, None)]), A_JSON, B_MODEL).first()
    assert row["groups"] == spelled(brute_groups(encoders, text))


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op12_license_scan", "op13_tokenizer_alignment"])
def test_empty_tables(spark, monkeypatch, name):
    assert run_query(monkeypatch, spark, name, documents(spark, [])) == []

"""Compression bands, language id, personal data and HTML extraction."""

import hashlib
import random
import re

import duckdb
import pytest
from llm_data import documents, rows

from pyspark.sql import functions as F

from tessera.llm import html, language, oracle, pii, quality
from tessera.llm.common import crc_fold, word_hashes, window_hashes


# --- shared helpers ---------------------------------------------------------------------

def test_word_hashes_follow_the_words():
    texts = [t.encode() for _, t, *_ in rows(8) if t is not None]
    h, per = word_hashes(texts)
    words = [w for t in texts for w in t.split()]
    assert per.tolist() == [len(t.split()) for t in texts]
    by = {}
    for w, x in zip(words, h.tolist()):
        assert by.setdefault(w, x) == x
    assert len(set(by.values())) == len(by)
    assert len(window_hashes(h[:3], 4)) == 0


# --- quality ----------------------------------------------------------------------------

def brute_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    triples = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = set()
    for i, t in enumerate(triples):
        if triples.count(t) > 1 if len(triples) < 400 else t in set(triples[:i] + triples[i + 1:]):
            hit.update((i, i + 1, i + 2))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit))


def test_quality_base_statistics(spark):
    table = [r for r in rows(2) if r[1] is None or len(r[1]) < 20_000]
    table += [(30_001, "a b c\na b c\n\n \nx", "en", "a"), (30_002, "a a a a", "en", "a"), (30_003, "é# <&>|\n" * 3, "en", "a")]
    got = quality.compression_quality(documents(spark, table)).collect()
    assert len(got) == len(table)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted([tuple(r)[:6] for r in got], key=key) == sorted([(i, *brute_stats(t)) for i, t, *_ in table], key=key)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_quality_bands(spark):
    rng = random.Random(3)
    syllables = [a + b + c for a in "tmlskpdr" for b in "aeiou" for c in ("", "n", "s", "r")]
    prose = " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(4000))
    line = " ".join("".join(rng.choices(syllables, k=3)) for _ in range(120))
    noise = " ".join("".join(chr(rng.randint(33, 126)) for _ in range(9)) for _ in range(3000))
    half = prose[:14000] + "\n" + (line + "\n") * 40
    table = [(1, prose, "", ""), (2, (line + "\n") * 60, "", ""), (3, noise, "", ""), (4, half, "", ""), (5, prose[:900], "", "")]
    got = {r.doc_id: r for r in quality.compression_quality(documents(spark, table)).collect()}
    assert got[1].kept and got[5].kept
    assert not got[2].kept and not got[3].kept and not got[4].kept
    assert got[4].n_bad_chunks > 0 and got[1].n_bad_chunks == 0
    fails = quality.CompressionBands(max_bad_chunks=1.0, bands=((0, 0.0, 1e9),))
    only_base = quality.compression_quality(documents(spark, table), fails).collect()
    assert all(r.kept != r.base_failed for r in only_base)


def test_quality_judges_every_byte(spark):
    assert quality.chunks(b"", 4) == [] and quality.chunks(b"abc", 4) == [b"abc"] and quality.chunks(b"abcd", 4) == [b"abcd"]
    assert quality.chunks(b"abcdefghij", 4) == [b"abcd", b"efgh", b"ghij"]
    rng = random.Random(6)
    syllables = [a + b + c for a in "tmlskpdr" for b in "aeiou" for c in ("", "n", "s", "r")]
    prose = " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(4000))
    noise = "".join(chr(rng.randint(33, 126)) for _ in range(4000))
    table = [(1, prose[:3000], "", ""), (2, prose[:1800] + noise[:1200], "", ""), (3, prose[:8191], "", ""),
             (4, prose[:4915] + noise[:3276], "", "")]
    got = {r.doc_id: r for r in quality.compression_quality(documents(spark, table)).collect()}
    assert {k: r.kept for k, r in got.items()} == {1: True, 2: False, 3: True, 4: False}
    assert {k: r.n_chunks for k, r in got.items()} == {1: 6, 2: 6, 3: 18, 4: 18}


# --- language ----------------------------------------------------------------------------

WORDS = {"aa": "the of and that with from this have river stone".split(),
         "bb": "der die und nicht auch werden fluss stein über".split(),
         "cc": "le la les dans avec pour être pierre fleuve été".split()}


def sentences(seed, n, labels=True):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        g = rng.choice(sorted(WORDS))
        text = " ".join(rng.choice(WORDS[g]) for _ in range(rng.randint(8, 80)))
        out.append((k, text if k % 3 else text.upper(), g if labels else None, "a"))
    return out


def test_language_held_out_accuracy(spark):
    table = sentences(1, 400) + [(1000, None, "aa", "a"), (1001, "", "aa", "a"), (1002, "12 34 !!", "bb", "a"),
                                 (1003, "x", None, "a"), (None, "der die und nicht", "bb", "a")]
    docs = documents(spark, table)
    held = crc_fold(docs["doc_id"], 5) == 0
    found = language.identify_language(docs, language.fit_dictionaries(docs.filter(~held)))
    got = found.join(docs.select("doc_id", "lang", held.alias("held")), "doc_id").filter("doc_id < 1000 and held")
    right = got.filter("lang = lang_pred").count()
    assert got.count() > 50 and right >= 0.97 * got.count()
    rest = {r.doc_id: r for r in found.filter("doc_id >= 1000 or doc_id is null").collect()}
    assert [rest[k].lang_pred for k in (1000, 1001, 1002)] == ["und"] * 3
    assert not rest[1000].accepted and rest[1000].score == 0.0
    assert rest[None].lang_pred == "bb"
    assert found.filter("score < 0 or score > 1").count() == 0


def test_language_without_training_rows(spark):
    docs = documents(spark, sentences(2, 5, labels=False))
    found = language.identify_language(docs, language.fit_dictionaries(docs))
    assert {r.lang_pred for r in found.collect()} == {"und"}
    assert language.identify_language(documents(spark, []), {"aa": b"the of"}).count() == 0


def test_language_filter_keeps_columns(spark):
    docs = documents(spark, sentences(3, 60) + [(900, None, "aa", "a"), (901, "the of and that", None, "a")])
    kept = language.keep_identified(docs, language.fit_dictionaries(docs))
    assert kept.columns == docs.columns
    got = {r.doc_id: r.lang for r in kept.collect()}
    assert 900 not in got and got[901] == "aa" and len(got) >= 58


# --- personal data -----------------------------------------------------------------------

PII_ROWS = [
    (1, "a.b@c.de_x@y.org 1.2.3.4.5.6.7.8 999.1.1.1 and 0000255.1.1.1", "", ""),
    (2, None, "", ""), (3, "", "", ""),
    (4, "card 4111 1111 1111 1111 é🙂 +1 (988) 555-2485. my iban DE89 3704 0044 0532 0130 00 ok ssn: 078-05-1120"
        + " " * 60 + "219-09-9999", "", ""),
    (5, "XDE89370400440532013000 GB82WEST12345698765432x GB82WEST12345698765432 1078-05-1120 ssn 078-05-1120-", "", ""),
    (6, "5" * 30_000 + " " + "a" * 50_000 + "@" + "x." * 3, "", ""),
    (7, "4111111111111112 4111111111111111 41-11 1111 1111 1111-11 +12 345 +123456789012345 +1234567890123456", "", ""),
    (9, "account BE68 5390 0754 7034 BIC, AT61 1904 3002 3457 3201 BIC NO93 8601 1117 947 iban XX68 5390 0754 7034 BE68 5390 0754 7034x"
        " BE68539007547034 BE685390075470341 BE68 5390 0754 7034 ABCD EFGH", "", ""),
    (8, "1.1.1.1 1.1.1.1\n1.1.1.1@x.y.z 0.0.0.0a@b.c", "", ""),
]
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (2 if k % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                  "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def pii_table():
    rng = random.Random(6)
    pieces = ["a@b.c", "@", ".", "1.2.3.4", "256.1.1.1", "4111111111111111", "+", "1", "12", " ", "-", "é", "🙂", "(", "x",
              "+1 (456) 555-2186", "55.63.178.142", "_", "4041894974608795"]
    made = [(100 + k, "".join(rng.choices(pieces, k=rng.randint(1, 40))), "", "") for k in range(300)]
    return PII_ROWS + made + PII_ROWS[3:5]


def test_pii_base_spans_match_regular_expressions(spark):
    table = pii_table()
    got = pii.pii_digest(documents(spark, table)).collect()
    want = {i: brute_spans(t) for i, t, *_ in table}
    assert len(got) == len(table)
    for r in got:
        spans = want[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest(), (r, spans)
        assert [s for s in r.spans.split(",") if s.split(":")[0] in BASE] == spans
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(
            sum(s.startswith(k + ":") for s in spans) for k in ("email", "ip", "card", "phone"))
    by = {r.doc_id: r.spans for r in got}
    assert by[4].split(",")[2:] == ["iban:55:82", "ssn:91:102"]  # the last number has no context
    assert by[5] == "iban:48:70"
    text = dict((i, t) for i, t, *_ in PII_ROWS)[9]
    places = [(text.index(v), v) for v in ("BE68 5390 0754 7034 BIC", "AT61 1904 3002 3457 3201", "NO93 8601 1117 947", "BE68539007547034 ",
                                           "BE68 5390 0754 7034 ABCD")]
    want = [f"iban:{a}:{a + len(v.replace(' BIC', '').replace(' ABCD', '').strip())}" for a, v in places]
    assert [s for s in by[9].split(",") if s.startswith("iban")] == want


def test_pii_keeps_columns_named_like_its_own(spark):
    docs = documents(spark, PII_ROWS)
    own = ["_pii_text", "_pii_spans", "_PII_email", "__pii_x", "_spans", "_spans2"]
    for k, c in enumerate(own):
        docs = docs.withColumn(c, F.lit(f"own{k}"))
    found, masked = pii.find_pii(docs), pii.mask_pii(docs)
    assert masked.columns == docs.columns and set(found.columns) == set(docs.columns)
    for df in (found, masked):
        assert {tuple(r) for r in df.select(*own).collect()} == {tuple(f"own{k}" for k in range(len(own)))}
    plain = pii.mask_pii(documents(spark, PII_ROWS))
    assert sorted(str(r.text) for r in masked.collect()) == sorted(str(r.text) for r in plain.collect())


def test_pii_of_a_text_with_many_spans(spark):
    import time

    text = " ".join(f"user{k}@mail.example{k % 7}.org" for k in range(8000))
    docs = documents(spark, [(1, text, "", "")], extra=False)
    pii.pii_digest(docs.limit(1)).collect()  # compiled
    began = time.perf_counter()
    row = pii.pii_digest(docs).first()
    took = time.perf_counter() - began
    want = [f"email:{m.start()}:{m.end()}" for m in re.finditer(BASE["email"], text)]
    assert row.spans == ",".join(want) and row.n_email == 8000
    assert took < 10  # the quadratic form took half a minute


def test_pii_matches_sql(spark):
    docs = documents(spark, pii_table())
    con = duckdb.connect()
    con.register("rows_", docs.select("doc_id", "text").toPandas())
    con.execute("CREATE VIEW documents AS SELECT doc_id, text FROM rows_")
    assert sorted(map(tuple, pii.pii_digest(docs).collect())) == sorted(con.execute(oracle.pii_sql()).fetchall())


def test_pii_scores_and_mask(spark):
    docs = documents(spark, PII_ROWS)
    spans = {r.doc_id: r.spans for r in pii.find_pii(docs.select("doc_id", "text")).selectExpr(
        "doc_id", "pii_spans as spans").collect()}
    assert [round(s.score, 2) for s in spans[4]][0] == 0.9  # "card" stands before it
    masked = pii.mask_pii(docs)
    assert masked.columns == docs.columns
    assert {r.pii_spans for r in masked.collect()} == {r.pii_spans for r in docs.collect()}  # a column of that name
    text = {r.doc_id: r.text for r in masked.collect()}
    assert text[1] == "<EMAIL><EMAIL> <IP>.<IP> 999.1.1.1 and <IP>"
    assert text[2] is None and text[3] == ""
    assert text[4].startswith("card <CARD> é🙂 <PHONE>. my iban <IBAN> ok ssn: <SSN> ")
    assert text[8] == "<IP> <IP>\n<EMAIL> <EMAIL>"
    assert pii.pii_digest(documents(spark, [])).count() == 0


@pytest.mark.parametrize("value,ok", [("GB82WEST12345698765432", True), ("GB82 WEST 1234 5698 7654 32", True),
                                      ("GB82WEST12345698765433", False), ("DE89370400440532013000", True)])
def test_mod97(spark, value, ok):
    from pyspark.sql import functions as F

    assert spark.range(1).select(pii.mod97(F.lit(value)).alias("x")).first()["x"] is ok


# --- HTML ---------------------------------------------------------------------------------

def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


NAV = "<nav><ul>" + "".join(f'<li><a href="/{k}">Link {k}</a></li>' for k in range(6)) + "</ul></nav>"
PAGES = [
    ("", ""), (None, ""), ("plain  text", "plain text"), ("<p>", ""),
    (page(NAV + '<div class="ad">Buy now</div><article><h1>Title &amp; more</h1><p><b>First\n para<br><p>Second  one</p>'
          '<p>Sh.</p></article><footer>&copy; x</footer><script>var a="</p>";</script>'),
     "Title & more\nFirst para\nSecond one\nSh."),
    (page(NAV + "<div id='content'><p>" + "A long paragraph of the story. " * 5 + "</p><p>Short.</p></div>"
          "<aside><p>Side notes</p></aside><div class='comments'><p>" + "I disagree strongly. " * 9 + "</p></div>"),
     ("A long paragraph of the story. " * 5).strip() + "\nShort."),
    (page("<article><header><h1>In</h1></header><p>a<br>b</p><aside>x</aside><form><p>Name</p></form><p>c</p></article>"),
     "In\na b\nc"),
    ("<![foo[ x ]]> y<p>a</p>", "y\na"),
    (page("<article><p>" + "word " * 40_000 + "</p></article>"), ("word " * 40_000).strip()),
]


def test_html_main_text(spark):
    table = [(k, f"http://h/{k}", h) for k, (h, _) in enumerate(PAGES)] + [(None, None, PAGES[4][0]), (4, "http://h/4", PAGES[4][0])]
    df = spark.createDataFrame(table, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars")
    got = html.extract_main_text(df).collect()
    assert len(got) == len(table)
    for r in got:
        want = PAGES[4 if r.page_id is None else r.page_id][1]
        assert r.text == want, r.page_id
        assert r.n_chars == len(want)
    assert html.extract_main_text(df.limit(0)).count() == 0


LONG = "<p>" + "A long paragraph of the story. " * 5 + "</p>"


def main_text(source):
    return html.main_lines(*html.page_lines(source))


def test_html_head_left_open():
    want = [("A long paragraph of the story. " * 5).strip()]
    for start in ("<html><head><title>T</title><body>", "<head><meta charset=x><script>1<2</script>", "<head><head><title>T</title><body>",
                  "<head><title>T</title><noscript><p>no</p></noscript><body>", "<head><title>T</title></head><body>"):
        assert main_text(start + LONG) == want, start
    assert main_text("<head><title>T</title>text at once" + LONG)[-1:] == want


@pytest.mark.parametrize("box", ["<article>%s</article>", "<main>%s</main>", "<div id='text'>%s</div>",
                                 "<main><div><a href='/'>x</a></div><article><div>%s</div></article></main>"])
def test_html_keeps_tables_quotes_and_short_blocks(box):
    table = "<table>" + "".join("<tr>" + f"<td>cell {r} a</td><td>cell {r} b</td><td>cell {r} c</td></tr>" for r in range(4)) + "</table>"
    rest = table + "<blockquote>" + "<p>Verse.</p>" * 6 + "</blockquote><div>" + "<div>Word.</div>" * 6 + "</div>"
    story = "<p>" + "x" * 300 + "</p>"
    got = main_text(page(NAV + box % (story * 6 + rest + story * 6)))
    assert len(got) == 12 + 12 + 6 + 6 and got[:6] == got[-6:] == ["x" * 300] * 6


NAMED = ['<main class="no-sidebar">%s</main>', '<div class="layout with-sidebar">%s</div>', '<article class="post has-banner">%s</article>',
         '<form id="aspnetForm"><input name="x"><article>%s</article></form>', '<form id="aspnetForm"><div>%s</div></form>',
         '<div class="page-banner"><main>%s</main></div>', '<div id="search" class="menu">%s</div>',
         '<div class="sidebar"><div class="nav">%s</div></div>', '<div class="comments-open"><article>%s</article></div>']


@pytest.mark.parametrize("box", NAMED)
def test_html_names_lose_no_article(box):
    story = LONG * 6
    want = [("A long paragraph of the story. " * 5).strip()] * 6
    assert main_text(page(NAV + box % story)) == want
    assert main_text(page(NAV + box % story + '<div class="comments"><p>' + "I disagree strongly. " * 90 + "</p></div>")) == want
    assert main_text(page('<div class="related-posts"><article><p>Teaser of a story</p></article></div>' + box % story)) == want


@pytest.mark.parametrize("block,kept", [
    ('<div id="market-share"><p>%s</p></div>', True), ('<section id="related-work"><p>%s</p></section>', True),
    ('<section id="search"><p>%s</p></section>', True), ('<div class="shared"><p>%s</p></div>', True),
    ('<div class="comment-list"><p>%s</p></div>', False), ('<section id="comments"><p>%s</p></section>', False),
    ('<div class="share-buttons"><p>%s</p></div>', False), ('<div class="ad"><p>%s</p></div>', False),
    ('<div class="cookie-notice"><p>%s</p></div>', False), ('<form><p>%s</p></form>', False), ('<aside><p>%s</p></aside>', False),
    ('<article class="comment"><p>%s</p></article>', False), ('<div role="navigation"><p>%s</p></div>', False),
    ('<p>a <span class="ad">%s</span></p>', False)])
def test_html_blocks_inside_an_article(block, kept):
    text = "Words of the block that stand in it."
    got = main_text(page(NAV + "<article>" + LONG * 3 + block % text + LONG * 3 + "</article>"))
    assert (text in got) is kept and sum("long paragraph" in t for t in got) == 6


def test_html_generated_pages_keep_the_article_only():
    """Known articles among known boilerplate, with random class names that do not mark anything."""
    import random

    rng = random.Random(6)
    plain = ["no-sidebar", "has-banner", "post", "entry-content", "market-share", "sharepoint", "adventure", "menus", "navy",
             "modality", "cookies-recipe", "hentry", "with-nav", "commentary", "searchable", "related-work", "socialism"]
    junk = ["<nav><ul><li><a href=/>%s</a></li></ul></nav>", "<footer><p>%s</p></footer>", "<div class='ad-slot'>%s</div>",
            "<aside><p>%s</p></aside>", "<div class='cookie-notice'><p>%s</p></div>", "<div id='sidebar'><p>%s</p></div>",
            "<form><p>%s</p><input></form>", "<div class='comments'><p>%s</p></div>", "<header><p>%s</p></header>",
            "<div class='newsletter-signup'><p>%s</p></div>", "<script>%s</script>", "<div class='social share'>%s</div>"]
    for _ in range(150):
        want, body = [], ""
        for k in range(rng.randint(3, 12)):
            text = " ".join(f"word{rng.randrange(500)}" for _ in range(rng.choice([3, 30, 60])))
            want.append(text)
            body += rng.choice(["<p>%s</p>", "<h2>%s</h2>", "<ul><li>%s</li></ul>", f"<p class='{rng.choice(plain)}'>%s</p>"]) % text
        name = f'class="{rng.choice(plain)} {rng.choice(plain)}" id="{rng.choice(plain)}"'
        box = rng.choice(["<article %s>%s</article>", "<main %s>%s</main>", "<div %s><article>%s</article></div>",
                          "<form %s><article>%s</article></form>", "<main %s><article>%s</article></main>"]) % (name, body)
        around = [j % "boiler plate" for j in rng.sample(junk, rng.randint(0, 6))]
        cut = rng.randint(0, len(around))
        assert main_text(page("".join(around[:cut]) + box + "".join(around[cut:]))) == want


def test_html_smoothing_keeps_constant_and_sums_to_one():
    assert html.smoothed([3.0] * 7, 1.0) == pytest.approx([3.0] * 7)
    assert html.smoothed([0, 0, 0, 1.0, 0, 0, 0], 1.0)[3] == max(html.smoothed([0, 0, 0, 1.0, 0, 0, 0], 1.0))


def test_language_sample_uses_every_text():
    import random

    rng = random.Random(3)
    for limit in (50, 1000, 96 << 10):
        texts = [b"%d:" % k + b"x" * rng.randint(0, 900) for k in range(rng.randint(1, 200))]
        made = language.shared_bytes(texts, limit)
        assert len(made) <= limit
        if limit > 20 * len(texts):  # room for the start of each
            lines = made.split(b"\n")[:-1]
            assert [t[:len(x)] for t, x in zip(texts, lines)] == lines and len(lines) == len(texts)
            cut = [len(x) for x, t in zip(lines, texts) if len(x) < len(t)]
            assert len(set(cut)) <= 1 and all(len(x) <= max(cut, default=limit) for x in lines)
            assert len(made) > limit - len(texts) or not cut
    assert language.shared_bytes([], 10) == b""

"""Small inputs with the awkward cases: nulls, empty and very long texts, ties,
repeated rows, and extra columns named like the operators' own."""

import random

EXTRA = ("bucket", "data", "rid", "block", "skey", "copies", "n", "t", "places", "grp", "comp", "start", "length", "bin",
         "rank", "key", "value", "pii_spans", "doc", "h", "score", "accepted", "weight", "part")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, partitions=3, extra=True):
    """A documents table from ``(doc_id, text, lang, source)`` rows."""
    full = [(i, t, g, s, None if t is None else len(t)) for i, t, g, s in rows]
    df = spark.createDataFrame(full, SCHEMA).repartition(partitions)
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit(f"x{k}") for k, c in enumerate(EXTRA)})
    return df


def texts(seed=1, n=40):
    """Texts with shared passages, near copies, exact copies and odd characters."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Éa", "ß", "naïve", "x,", "|", "###"]
    passage = " ".join(f"p{i}" for i in range(40))
    out = []
    for k in range(n):
        base = [rng.choice(words) for _ in range(rng.randint(1, 160))]
        out.append(" ".join(base))
        if k % 4 == 0:
            near = list(base)
            near[rng.randrange(len(near))] = f"edit{k}"
            out.append(" ".join(near))
            out.append(" ".join(base).upper())
        if k % 5 == 0:
            out.append(" ".join(base[:20]) + " " + passage + "\n" + " ".join(base[20:30]))
        if k % 7 == 0:
            out.append("ha " * rng.randint(1, 90))
    return out + ["", " \n\t ", "one", "one two", "ONE  two", "a\x0bb\x0cc", "long " + "z" * 70000, "q r s t u " * 9000]


def rows(seed=1, n=40):
    """Rows with shuffled ids, null fields and repeated rows."""
    all_texts = texts(seed, n)
    rng = random.Random(seed + 1)
    ids = rng.sample(range(10_000), len(all_texts))
    out = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "hot", "hot", "hot", None]))
           for i, t in zip(ids, all_texts)]
    out += [(20_001, None, "en", "a"), (20_002, None, None, None), (None, all_texts[0], "en", "hot"),
            (None, None, None, None)]
    return out + out[3:5]

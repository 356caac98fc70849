"""Personal data: patterns propose spans, validators confirm, context scores.

Each kind has a regular expression; ``regexp_extract_all`` lists its leftmost
non-overlapping matches, ``split`` the gaps between them, and sums of their
lengths say where the matches lie (code points, end exclusive). A validator drops wrong proposals: octets up to
255 for addresses, the Luhn sum for cards, the digit count for telephone
numbers, the country's length and the remainder modulo 97 for bank account numbers
(an account number in groups ends where its country's length does, whatever
word follows). Every span gets a
score: the kind's own confidence, raised when one of the kind's context words
stands in the ``CONTEXT_CHARS`` characters before it. Spans of the four base
kinds are always reported; those of the added kinds need ``MIN_SCORE``, so a
bare 3-2-4 digit group is no social security number without its context.

Everything is a DataFrame expression over one row: one narrow scan, no
shuffle, no Python. Repetitions are possessive and a run of pattern characters
is only tried at its start, so a long text costs linear time and no stack; m
matches in it cost m log m more (sums by doubling, as a fold would copy its
list at every step), and a context is put together from the pieces before it.

Defined results: a null text is empty and has no spans; rows are handled one
by one, so repeated rows give equal rows; an empty table gives none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT_CHARS = 48
CONTEXT_BONUS = 0.2
MIN_SCORE = 0.5


@dataclass(frozen=True)
class Kind:
    """``pattern`` for the JVM; ``plain`` is the same language without
    look-behind or possessive marks (for engines that have neither)."""
    name: str
    pattern: str
    plain: str
    confidence: float
    context: str
    base: bool = True
    apart: str = ""  # characters that must not touch the span on either side


# In one piece, or in groups of four with a shorter last one.
ACCOUNT = r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)"
# Characters of a bank account number by country.
ACCOUNT_LENGTHS = dict(pair.split(":") for pair in (
    "AD:24 AE:23 AL:28 AT:20 AZ:28 BA:20 BE:16 BG:22 BH:22 BR:29 BY:28 CH:21 CR:22 CY:28 CZ:24 DE:22 DK:18 DO:28 EE:20 "
    "EG:29 ES:24 FI:18 FO:18 FR:27 GB:22 GE:22 GI:23 GL:18 GR:27 GT:28 HR:21 HU:28 IE:22 IL:23 IQ:23 IS:26 IT:27 JO:30 "
    "KW:30 KZ:20 LB:28 LC:32 LI:21 LT:20 LU:20 LV:21 LY:25 MC:27 MD:24 ME:22 MK:19 MR:27 MT:31 MU:30 NL:18 NO:15 PK:24 "
    "PL:28 PS:29 PT:25 QA:29 RO:24 RS:22 SA:24 SC:31 SE:24 SI:19 SK:24 SM:27 ST:25 SV:28 TL:23 TN:24 TR:26 UA:29 VA:22 "
    "VG:24 XK:20").split())
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", 0.9, "mail|contact|write to"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", 0.6,
         r"\bip\b|address|host|server|login"),
    Kind("card", r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9])+", 0.7,
         "card|visa|mastercard|amex|credit|debit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", 0.6,
         "phone|tel|call|mobile|cell|fax|whatsapp"),
    Kind("iban", ACCOUNT, ACCOUNT, 0.8,
         "iban|account|bank|konto|cuenta|compte", False, "[A-Za-z0-9]"),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.4,
         "ssn|social security|taxpayer", False, "[0-9-]"),
)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """The Luhn sum of the digits in ``value`` ends in 0."""
    d = _digits(value)

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(d, -i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def mod97(value: Column) -> Column:
    """Account number check: first four characters last, letters as 10..35,
    remainder 1 modulo 97."""
    s = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(s, F.lit(5)), F.substr(s, F.lit(1), F.lit(4)))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c))) == 1


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    return {
        "email": lambda: F.lit(True),
        "ip": lambda: F.forall(F.split(value, r"\."), lambda p: p.cast("double") <= 255),
        "card": lambda: F.when(n.between(13, 19), luhn(value)).otherwise(False),
        "phone": lambda: n.between(9, 15),
        "iban": lambda: F.when(value != "", mod97(value)).otherwise(False),
        "ssn": lambda: ~value.rlike("^(?:000|666|9)|-00-|-0000$"),
    }[kind]()


SPAN = "struct<kind:string,start:int,end:int,value:string,score:double>"


def account_number(value: Column) -> Column:
    """The part of a proposed account number that its country's length allows: up
    to a space or the end, else nothing."""
    table = F.create_map(*[F.lit(x) for pair in ACCOUNT_LENGTHS.items() for x in (pair[0], int(pair[1]))])
    n = F.element_at(table, F.substring(value, F.lit(1), F.lit(2)))
    grouped = F.substring(value, F.lit(5), F.lit(1)) == " "
    size = n + F.when(grouped, F.floor((n - 1) / 4).cast("int")).otherwise(0)
    ends = (F.length(value) >= size) & F.substring(value, size + 1, F.lit(1)).isin("", " ")
    return F.when(ends, F.substring(value, F.lit(1), size)).otherwise(F.lit(""))


def _prefix_sums(values: Column) -> Column:
    """Running sums of an array of ints: in round k each place adds the one 2^k before it."""
    n = F.size(values)

    def add(acc: Column, k: Column) -> Column:
        by = F.least(F.call_function("shiftleft", F.lit(1), k), n)
        moved = F.concat(F.array_repeat(F.lit(0), by), F.slice(acc, F.lit(1), n - by))
        return F.zip_with(acc, moved, lambda a, b: a + b)

    return F.aggregate(F.sequence(F.lit(0), F.ceil(F.log2(n)).cast("int")), values, add)


# Matches before a place that a context may reach into: each takes three characters at least, with its gap.
BACK = CONTEXT_CHARS // 3 + 1


def _with(values: dict[str, Column], body) -> Column:
    """``body`` of a struct of ``values``, each computed once (an expression named
    in a lambda would be computed again for every element)."""
    return F.transform(F.array(F.struct(*[c.alias(k) for k, c in values.items()])), body)[0]


def _located(hits: Column, gaps: Column, kind: Kind) -> Column:
    """Spans of one kind: where each match lies, its validity and score."""
    own = F.slice(gaps, F.lit(1), F.size(hits))  # the gap before each match
    ends = _prefix_sums(F.zip_with(own, hits, lambda g, h: F.length(g) + F.length(h)))
    value = account_number if kind.name == "iban" else (lambda h: h)
    found = F.transform(F.zip_with(ends, hits, lambda e, h: F.struct(e.alias("e"), h.alias("h"))), lambda m, i: F.struct(
        (m["e"] - F.length(m["h"])).cast("int").alias("start"), value(m["h"]).alias("value"),
        (F.length(value(m["h"])) < F.length(m["h"])).alias("cut"), i.alias("i")))
    confirmed = F.filter(found, lambda m: _valid(kind.name, m["value"]))
    # Gaps and matches in turn: their ends make contexts, their first characters what stands behind a match.
    tails = F.flatten(F.zip_with(own, hits, lambda g, h: F.array(F.right(g, F.lit(CONTEXT_CHARS)),
                                                                 F.right(h, F.lit(CONTEXT_CHARS)))))
    heads = F.flatten(F.zip_with(gaps, hits, lambda g, h: F.array(F.left(g, F.lit(1)), F.coalesce(F.left(h, F.lit(1)), F.lit("")))))

    def score(m: Column, context: Column) -> Column:
        return F.round(F.lit(kind.confidence) + F.when(F.lower(context).rlike(kind.context), CONTEXT_BONUS).otherwise(0.0), 3)

    def spans(let: Column) -> Column:
        def context(m: Column) -> Column:
            first = F.greatest(F.lit(0), m["i"] - BACK)
            return F.right(F.array_join(F.slice(let["tails"], 2 * first + 1, 2 * (m["i"] - first) + 1), ""), F.lit(CONTEXT_CHARS))

        def behind(m: Column) -> Column:
            at = 2 * m["i"] + 2
            head = F.get(let["heads"], at)
            return F.when(m["cut"], F.lit(" ")).when(head != "", head).otherwise(F.coalesce(F.get(let["heads"], at + 1), F.lit("")))

        marked = F.transform(let["confirmed"], lambda m: F.struct(m.alias("m"), context(m).alias("context")))
        if kind.apart:
            marked = F.filter(marked, lambda x: ~F.concat(F.right(x["context"], F.lit(1)), behind(x["m"])).rlike(kind.apart))
        out = F.transform(marked, lambda x: F.struct(
            F.lit(kind.name).alias("kind"), x["m"]["start"].alias("start"),
            (x["m"]["start"] + F.length(x["m"]["value"])).alias("end"), x["m"]["value"].alias("value"),
            score(x["m"], x["context"]).alias("score")))
        return out if kind.base else F.filter(out, lambda m: m["score"] >= MIN_SCORE)

    lists = {"confirmed": confirmed, "tails": tails, **({"heads": heads} if kind.apart else {})}
    none = F.array().cast(f"array<{SPAN}>")
    return F.when(F.size(hits) > 0, _with(lists, spans)).otherwise(none)


def _unused(docs: DataFrame, name: str) -> str:
    """``name``, made longer until no column's name begins with it."""
    while any(c.lower().startswith(name) for c in docs.columns):
        name = "_" + name
    return name


def find_pii(docs: DataFrame, text: str = "text", out_col: str = "pii_spans") -> DataFrame:
    """``docs`` with one added column ``out_col``: an array of ``(kind, start,
    end, value, score)`` by kind as in ``KINDS``, then start. A column of that
    name is replaced; all others stay, whatever their names."""
    own = _unused(docs, "_pii")
    body = f"{own}_text"
    out = docs.withColumn(body, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    out = out.withColumns({f"{own}_{k.name}": F.regexp_extract_all(body, F.lit(k.pattern), F.lit(0)) for k in KINDS})
    out = out.withColumns({f"{own}_{k.name}_gaps": F.when(F.size(f"{own}_{k.name}") > 0, F.split(body, k.pattern)) for k in KINDS})
    spans = F.concat(*[_located(F.col(f"{own}_{k.name}"), F.col(f"{own}_{k.name}_gaps"), k) for k in KINDS])
    return out.withColumn(out_col, spans).drop(*[c for c in out.columns if c.startswith(own)])


def mask_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in angle
    brackets (``<EMAIL>``); overlapping spans become one, named by the first.
    A null text stays null. Columns and their order do not change."""
    spans = _unused(docs, "_spans")
    found = find_pii(docs, text, spans)
    ordered = F.array_sort(F.col(spans), lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"])
                           .otherwise(b["end"] - a["end"]))
    body = F.col(text)
    init = F.struct(F.lit(0).cast("int").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.array(F.substring(body, acc["at"] + 1, s["start"] - acc["at"]),
                        F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], F.concat(acc["parts"], piece)).otherwise(acc["parts"])
                        .alias("parts"))

    masked = F.aggregate(ordered, init, step, lambda acc: F.concat(
        F.array_join(acc["parts"], ""), F.substring(body, acc["at"] + 1, F.length(body))))
    return found.withColumn(text, F.when(body.isNull() | (F.size(spans) == 0), body).otherwise(masked)).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def pii_digest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): counts of the base
    kinds, the hash of the base spans and all spans as text."""
    found = find_pii(docs.select("doc_id", "text")).withColumn("s", F.col("pii_spans"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("s", lambda s: s["kind"].isin(*[k.name for k in KINDS if k.base]))
    count = lambda kind: F.size(F.filter("s", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k.name).alias(f"n_{k.name}") for k in KINDS if k.base],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("s")).alias("spans"))

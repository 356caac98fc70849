"""Mixing sources to target weights by temperature.

With token shares ``p`` of the sources, the weights are ``w = p^a / sum(p^a)``
for one exponent ``a`` between 0 (uniform) and 1 (as the corpus is). The
exponent is found by repeated section of ``[0, 1]``: the largest one whose
entropy reaches the target, which lies ``entropy_gain`` of the way from the
corpus's own entropy to the greatest possible one, raised as far as needed for the repetition limit: no source is used more than
``max_repeats`` times. Each step is one small aggregate over the table of
sources; only sums come to the driver.

The weights are realised against a token budget (by default the smallest that
uses every document at least once, so no text is lost): source ``i`` gets
``round(w_i * budget)`` tokens, that is whole epochs plus a rest. Documents
are dealt into slots by a hash of their id, and a source's slots make blocks of
about ``block_tokens`` tokens; the rest takes whole blocks of the source in permuted order and, in the one
block where it ends, documents in permuted order. A hot source has many blocks,
so no task holds a source; the order of all draws is a permutation of blocks
within the epoch and of documents within the block.

Only DataFrame operations run; the driver keeps a few sums. Defined results:
a null source is a source of its own; null or empty texts have 0 tokens; a
source without any token keeps weight 0 and is used once; repeated rows
are drawn together, as rows of one document; an empty table gives an
empty plan.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, cut

SECTIONS = 16
ROUNDS = 11


@dataclass(frozen=True)
class MixParams:
    entropy_gain: float = 0.5
    max_repeats: float = 4.0
    budget_tokens: int | None = None
    block_tokens: int = 2_000_000
    seed: str = "mix"


def tokens(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: str = "source") -> Column:
    """A non-null key: a null source differs from every string."""
    return F.when(F.col(source).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(source)))


def _hex(*parts: Column) -> Column:
    return F.md5(F.concat_ws("/", *parts).cast("binary"))


def _slot(doc_id: Column, n_slots: int, params: MixParams) -> Column:
    return F.conv(F.substring(_hex(F.lit(params.seed), doc_id.cast("string")), 1, 8), 16, 10).cast("long") % n_slots


def _order(epoch: Column, doc_id: Column, params: MixParams) -> Column:
    return _hex(F.lit(params.seed), epoch.cast("string"), doc_id.cast("string"))


def exponent(shares: DataFrame, params: MixParams) -> tuple[float, float]:
    """``(a, sum of p^a)`` for rows ``p`` (shares of sources with tokens).

    Both conditions are monotone in ``a``: entropy falls and the use of the
    smallest source falls as ``a`` grows. Each round narrows the bracket
    ``SECTIONS + 1`` times; ``ROUNDS`` rounds end below 1e-13.
    """
    n, low_p, high_p = shares.agg(F.count("p"), F.min("p"), F.max("p")).first()

    def sums(points: list[float]) -> list[tuple[float, float]]:
        cols = []
        for a in points:
            cols += [F.sum(F.pow("p", F.lit(a))), F.sum(F.pow("p", F.lit(a)) * F.log("p"))]
        row = shares.agg(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()
        return [(row[2 * i], row[2 * i + 1]) for i in range(len(points))]

    def entropy(a: float, s: float, e: float) -> float:
        return math.log(s) - a * e / s

    def entropy_ok(a: float, s: float, e: float) -> bool:
        return entropy(a, s, e) >= target - 1e-12

    def repeats_ok(a: float, s: float, budget_share: float | None) -> bool:
        used = (low_p / high_p) ** (a - 1) if budget_share is None else low_p ** (a - 1) / s * budget_share
        return used <= params.max_repeats + 1e-9

    def section(good_low: bool, test) -> float:
        """The largest good point if low ones are good, else the smallest."""
        lo, hi = 0.0, 1.0
        for _ in range(ROUNDS):
            points = [lo + (hi - lo) * k / SECTIONS for k in range(SECTIONS + 1)]
            good = [test(a, s, e) for a, (s, e) in zip(points, sums(points))]
            if good_low:
                k = max((i for i, g in enumerate(good) if g), default=0)
                lo, hi = points[k], points[min(k + 1, SECTIONS)]
            else:
                k = min((i for i, g in enumerate(good) if g), default=SECTIONS)
                lo, hi = points[max(k - 1, 0)], points[k]
            if lo == hi:
                break
        return lo if good_low else hi

    if n < 2:
        a = 1.0
    else:
        own = entropy(1.0, *sums([1.0])[0])
        target = own + params.entropy_gain * (math.log(n) - own)
        a = section(True, entropy_ok)
        share = None if params.budget_tokens is None else params.budget_tokens / shares.agg(F.sum("t")).first()[0]
        if not repeats_ok(a, sums([a])[0][0], share):
            a = section(False, lambda x, s, _: repeats_ok(x, s, share))
    return a, sums([a])[0][0]


def mixing_plan(docs: DataFrame, params: MixParams = MixParams()) -> tuple[DataFrame, int]:
    """The plan and its number of slots. A row per source and slot: ``skey, slot,
    block, share, weight, budget, full_epochs, part`` with ``part`` of the last,
    partial epoch: ``all``, ``none`` or the greatest order key still drawn.

    A document's slot depends on its id only, so every join is on source and
    slot and no task gets a whole source; a source's blocks are slots put
    together, as many as its tokens ask for.
    """
    counted = cut(docs.select("doc_id", source_key().alias("skey"), tokens().alias("n")), "mix-tokens")
    sources = counted.groupBy("skey").agg(F.sum("n").alias("t"))
    total = sources.agg(F.sum("t")).first()[0] or 0
    n_slots = max(1, -(-total // params.block_tokens))
    shares = cut(sources.filter("t > 0").select("skey", "t", (F.col("t") / F.lit(float(total or 1))).alias("p")),
                 "mix-sources")
    if total:
        a, s = exponent(shares, params)
        top = shares.agg(F.max("p")).first()[0]
        budget = params.budget_tokens if params.budget_tokens is not None else total * s * top ** (1 - a)
    else:
        a, s, budget = 1.0, 1.0, 0.0
    weighted = sources.select(
        "skey", "t", (F.col("t") / F.lit(float(total or 1))).alias("share"),
        F.when(F.col("t") > 0, F.pow(F.col("t") / F.lit(float(total or 1)), F.lit(a)) / F.lit(float(s))).otherwise(0.0)
        .alias("weight"),
        F.greatest(F.lit(1), F.ceil(F.col("t") / F.lit(params.block_tokens))).cast("long").alias("n_blocks"))
    weighted = weighted.withColumn("budget", F.round(F.col("weight") * F.lit(float(budget))).cast("long"))
    weighted = weighted.withColumn("full_epochs", F.when(F.col("t") > 0, F.expr("budget div t")).otherwise(1)) \
        .withColumn("rest", F.when(F.col("t") > 0, F.expr("budget % t")).otherwise(0))
    placed = counted.withColumn("slot", _slot(F.col("doc_id"), n_slots, params))
    slots = placed.groupBy("skey", "slot").agg(F.sum("n").alias("n")).join(weighted, "skey").withColumn(
        "block", F.col("slot") % F.col("n_blocks"))
    slots = cut(slots.drop("n_blocks", "t"), "mix-slots")
    blocks = slots.groupBy("skey", "block", "full_epochs", "rest").agg(F.sum("n").alias("bt"))
    turn = _hex(F.lit(params.seed), F.lit("block"), F.col("full_epochs").cast("string"), F.col("block").cast("string"))
    before = Window.partitionBy("skey").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("turn", turn).withColumn("left", F.col("rest") - F.coalesce(
        F.sum("bt").over(before), F.lit(0)))
    blocks = blocks.withColumn("state", F.when(F.col("left") <= 0, "none").when(F.col("left") >= F.col("bt"), "all")
                               .otherwise("cut")).select("skey", "block", "left", "state")
    # In the block where the rest ends: documents in permuted order until it is used up.
    ends = slots.join(blocks.filter("state = 'cut'"), ["skey", "block"]).select(
        "skey", "slot", "block", "left", "full_epochs")
    docs_in = placed.join(ends, ["skey", "slot"]).groupBy("skey", "block", "left", "full_epochs", "doc_id").agg(
        F.sum("n").alias("n")).withColumn("o", _order(F.col("full_epochs"), F.col("doc_id"), params))
    run = Window.partitionBy("skey", "block").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    last = docs_in.withColumn("used", F.coalesce(F.sum("n").over(run), F.lit(0))).filter("used < left").groupBy(
        "skey", "block").agg(F.max("o").alias("last"))
    plan = slots.join(blocks, ["skey", "block"]).join(last, ["skey", "block"], "left")
    return cut(plan.select("skey", "slot", "block", "share", "weight", "budget", "full_epochs",
                           F.when(F.col("state") == "cut", F.col("last")).otherwise(F.col("state")).alias("part")),
               "mix-plan"), n_slots


def _copies(docs: DataFrame, plan: DataFrame, n_slots: int, params: MixParams) -> DataFrame:
    """``docs`` with the plan's columns and ``copies``, the times it is drawn."""
    keyed = docs.withColumn("skey", source_key()).withColumn("slot", _slot(F.col("doc_id"), n_slots, params))
    last = F.when(F.col("part") == "all", 1).when(F.col("part") == "none", 0).otherwise(
        (_order(F.col("full_epochs"), F.col("doc_id"), params) <= F.col("part")).cast("int"))
    return keyed.join(plan, ["skey", "slot"]).withColumn("copies", F.col("full_epochs") + last)


def mix_sources(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``, ``source``): its
    tokens, the source's share, weight and budget, and how often it is drawn."""
    rows = docs.select("doc_id", "source", tokens().alias("n_tokens"))
    drawn = _copies(rows, *mixing_plan(docs, params), params)
    return drawn.select("doc_id", "source", "n_tokens", "share", "weight", "budget", "full_epochs", "block",
                        F.col("copies").cast("long").alias("copies"))


def draw_mixture(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """``docs`` with each row repeated as often as it is drawn; the columns of
    ``docs`` only. Names that begin with ``_mix`` are used inside."""
    cols = docs.columns
    plan, n_slots = mixing_plan(docs, params)
    plan = plan.select("skey", "slot", "full_epochs", "part")
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_mix_row"), "doc_id", "source")
    drawn = _copies(inner, plan, n_slots, params).filter("copies > 0")
    return drawn.select("_mix_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_mix_n")) \
        .select(*[F.col("_mix_row").getField(c).alias(c) for c in cols])

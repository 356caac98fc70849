"""N-gram Jaccard join: near-duplicate documents as connected components.

A document's set holds the hashes of its distinct runs of ``n`` words (of all
its words, if they are fewer). Two documents link when
``100 * |A & B| >= percent * |A | B|``. The join is exact:

1. *Shared runs.* A document can only have a partner if ``percent`` of its own
   set occurs elsewhere. Every run is sent once, packed, to a hash bucket,
   which counts for each document how many of its runs another one has. Most
   documents end here. Documents with equal sets are one class from here on.
2. *Prefixes.* Linked sets share a run among their rarest
   ``n - ceil(percent * n / 100) + 1``. Rarity is the run's document count
   among the classes left, in powers of two, so runs of a common passage come
   last. Documents that share a prefix run are joined in a star; the connected
   components of the stars are candidate groups that hold every link.
3. *Tiles.* Within a group, sets are sorted by size, and a set is compared with
   the band of sizes that can reach the threshold. Each size band has hashed
   bitmap signatures of its own width: the bits in which two signatures differ
   bound the overlap from above. Only pairs that pass, and are not yet known to be
   connected, go on to the exact intersection of the sorted arrays. A
   cluster of near copies costs about one comparison per member this way.

Groups beyond ``tile_tokens`` set elements are cut into salted blocks: links
within blocks first, then among one representative per block component, and
only what is still apart is compared across all pairs of blocks.

Runs met in several documents of one task's slice are sent once, so a run that
a third of all documents hold is one posting per slice.

Defined results: a null text, or one without words, has the empty set and links
with nothing; rows repeated under one id get equal rows; a null id gives a null
component and takes no part; an empty table gives none. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (bucket_ranges, buckets_for, cut, encoded, group_starts, mix, narrow, pack, slice_bytes, slices,
                                unpack, window_hashes, word_hashes)
from tessera.llm.components import connected_components


@dataclass(frozen=True)
class JoinParams:
    n: int = 5
    percent: int = 80
    tile_tokens: int = 2_000_000


# --- sets --------------------------------------------------------------------------

def shingle_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, counts)``: the sorted distinct run hashes of each text, end to
    end, and how many each has. Letters A-Z are folded."""
    h, per = word_hashes([t.lower() for t in texts])
    start = np.cumsum(per) - per
    row = np.repeat(np.arange(len(per)), per)
    keys = window_hashes(h, n)
    row_of = row[:len(keys)]
    whole = np.arange(len(keys)) - start[row_of] + n <= per[row_of]
    keys, row_of = keys[whole], row_of[whole]
    short = np.flatnonzero((per > 0) & (per < n))
    if len(short):
        keys = np.concatenate([keys, *(window_hashes(h[start[r]:start[r] + per[r]], int(per[r])) for r in short)])
        row_of = np.concatenate([row_of, short])
    order = np.lexsort((keys, row_of))
    keys, row_of = keys[order], row_of[order]
    at = group_starts(row_of, keys)
    return keys[at], np.bincount(row_of[at], minlength=len(texts))


def _sums(x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each run of ``counts`` elements, modulo 2**64."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


FACTS = ["rid", "doc_id", "n_shingles", "set_a", "set_b", "shared"]
FACT_TYPES = "rid long, doc_id long, n_shingles long, set_a long, set_b long, shared long"
SENT = ["first", *FACTS, "data"]


def set_facts(docs: DataFrame, params: JoinParams, n_buckets: int) -> DataFrame:
    """One row per row of ``docs``: its id, set size, 128-bit set hash, and how
    many of its runs occur in another row. ``first`` names a slice of documents
    by its first row; a bucket answers a slice in one row."""

    limit = slice_bytes(docs)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=limit):
            keys, counts = shingle_sets(encoded(part), params.n)
            rid, k = part.column(0).to_numpy(), part.num_rows
            first = int(rid[0])
            row = np.repeat(np.arange(k), counts)
            hash_a = _sums(mix(keys), counts).view(np.int64)
            hash_b = _sums(mix(keys ^ np.uint64(0x9E3779B97F4A7C15)), counts).view(np.int64)
            order = np.lexsort((row, keys))
            by_key, by_row = keys[order], row[order]
            at = group_starts(by_key)
            size_of = np.diff(np.append(at, len(by_key)))
            many = np.repeat(size_of > 1, size_of)
            here = np.bincount(by_row[many], minlength=k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, (first + (first >> 33)) % n_buckets, np.int32)), pa.array(np.full(k, first)), pa.array(rid),
                 part.column(1), pa.array(counts), pa.array(hash_a), pa.array(hash_b), pa.array(here),
                 pa.nulls(k, pa.binary())], names=["bucket", *SENT])
            send = ~many
            send[at] = True
            by_key, col = by_key[send], np.where(many, 0, rid[by_row] - first + 1)[send]
            rows = [(b, pack(by_key[lo:hi], narrow(col[lo:hi]))) for b, lo, hi in bucket_ranges(by_key, n_buckets)]
            m = len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([first] * m, pa.int64()),
                 *(pa.nulls(m, pa.int64()) for _ in FACTS), pa.array([r[1] for r in rows], pa.binary())],
                names=["bucket", *SENT])

    def meet(group: pa.Table) -> pa.Table:
        own = group.filter(pc.is_null(group.column("data"))).select(SENT)
        sent = group.filter(pc.is_valid(group.column("data")))
        if not sent.num_rows:
            return own
        lists = [unpack(d, 1) for d in sent.column("data").to_pylist()]
        keys = np.concatenate([x[0] for x in lists])
        order = np.argsort(keys, kind="stable")
        at = group_starts(keys[order])
        size_of = np.diff(np.append(at, len(keys)))
        shared = np.empty(len(keys), dtype=bool)
        shared[order] = np.repeat(size_of > 1, size_of)
        ends, back = np.cumsum([len(x[0]) for x in lists]), []
        for (_, place), e in zip(lists, ends):
            # 0 stands for several rows of the slice; they know already.
            place = place[shared[e - len(place):e] & (place > 0)].astype(np.int64) - 1
            back.append(np.concatenate(np.unique(place, return_counts=True)).tobytes())
        none = [pa.nulls(len(back), pa.int64()) for _ in FACTS]
        return pa.concat_tables([own, pa.table([sent.column("first"), *none, pa.array(back, pa.binary())], names=SENT)])

    def total(group: pa.Table) -> pa.Table:
        own = group.filter(pc.is_null(group.column("data"))).select(FACTS).combine_chunks()
        place = own.column("rid").to_numpy() - group.column("first")[0].as_py()
        order = np.argsort(place)
        shared = own.column("shared").to_numpy().copy()
        for data in group.filter(pc.is_valid(group.column("data"))).column("data").to_pylist():
            rows, counts = np.frombuffer(data, dtype=np.int64).reshape(2, -1)
            shared[order[np.searchsorted(place, rows, sorter=order)]] += counts
        return own.set_column(len(FACTS) - 1, "shared", pa.array(shared))

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    sent = rows.mapInArrow(post, f"bucket int, first long, {FACT_TYPES}, data binary")
    met = sent.groupBy("bucket").applyInArrow(meet, f"first long, {FACT_TYPES}, data binary")
    return met.groupBy("first").applyInArrow(total, FACT_TYPES)


BLOOM = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
         "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
         "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1t"}
BLOCKS = "block long, ids binary, sizes binary, tokens binary"


def set_blocks(docs: DataFrame, params: JoinParams) -> DataFrame:
    """Sets of ``docs`` in blocks: one row holds the sets of one slice."""

    def pack_slice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            keys, counts = shingle_sets(encoded(part), params.n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.column(0)[0].as_py()], pa.int64()),
                 pa.array([part.column(1).to_numpy().tobytes()], pa.binary()),
                 pa.array([counts.astype(np.int64).tobytes()], pa.binary()), pa.array([keys.tobytes()], pa.binary())],
                names=["block", "ids", "sizes", "tokens"])

    return docs.select(F.monotonically_increasing_id().alias("block"), "doc_id", "text").mapInArrow(pack_slice, BLOCKS)


# --- candidate groups ------------------------------------------------------------------

def run_levels(blocks: DataFrame, n_buckets: int) -> DataFrame:
    """For each block, by bucket: the rarity level (log2 of the document count)
    of each of its distinct runs, in the order of their hashes."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, tokens in zip(*(batch.column(i).to_pylist() for i in range(2))):
                keys, counts = np.unique(np.frombuffer(tokens, dtype=np.uint64), return_counts=True)
                rows = [(b, pack(keys[lo:hi], narrow(counts[lo:hi]))) for b, lo, hi in bucket_ranges(keys, n_buckets)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([block] * len(rows), pa.int64()),
                     pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "block", "data"])

    def meet(group: pa.Table) -> pa.Table:
        lists = [unpack(d, 1) for d in group.column("data").to_pylist()]
        keys = np.concatenate([x[0] for x in lists])
        counts = np.concatenate([x[1].astype(np.int64) for x in lists])
        order = np.argsort(keys, kind="stable")
        at = group_starts(keys[order])
        total = np.repeat(np.add.reduceat(counts[order], at), np.diff(np.append(at, len(keys))))
        level = np.empty(len(keys), dtype=np.uint8)
        level[order] = np.log2(total).astype(np.uint8)
        ends = np.cumsum([len(x[0]) for x in lists])
        return pa.table([group.column("bucket").cast(pa.int32()), group.column("block"),
                         pa.array([level[e - len(x[0]):e].tobytes() for x, e in zip(lists, ends)], pa.binary())],
                        names=["bucket", "block", "levels"])

    return blocks.select("block", "tokens").mapInArrow(post, "bucket int, block long, data binary").groupBy(
        "bucket").applyInArrow(meet, "bucket int, block long, levels binary")


def candidate_edges(blocks: DataFrame, levels: DataFrame, params: JoinParams, n_buckets: int) -> DataFrame:
    """``(a, b)`` edges whose components hold every linked pair: stars of the
    documents that share a run of their prefixes."""
    percent = params.percent

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sizes, tokens, parts in zip(*(batch.column(i).to_pylist() for i in range(4))):
                ids, sizes = np.frombuffer(ids, dtype=np.int64), np.frombuffer(sizes, dtype=np.int64)
                tokens = np.frombuffer(tokens, dtype=np.uint64)
                level = np.frombuffer(b"".join(p["levels"] for p in sorted(parts, key=lambda p: p["bucket"])), np.uint8)
                level = level[np.searchsorted(np.unique(tokens), tokens)]
                row = np.repeat(np.arange(len(ids)), sizes)
                shared = np.bincount(row[level > 0], minlength=len(ids))
                alive = 100 * shared >= percent * sizes
                # Last level that the prefix reaches into: counts by (row, level), summed up.
                table = np.cumsum(np.bincount(row.astype(np.int64) * 64 + level, minlength=len(ids) * 64)
                                  .reshape(-1, 64), axis=1)
                prefix = sizes - -(-percent * sizes // 100) + 1
                last = (table < prefix[:, None]).sum(axis=1)
                use = (level > 0) & (level <= last[row]) & alive[row]
                keys, doc = tokens[use], ids[row[use]]
                order = np.lexsort((doc, keys))
                keys, doc = keys[order], doc[order]
                at = group_starts(keys)
                lead = np.repeat(doc[at], np.diff(np.append(at, len(keys))))
                pairs = np.unique(np.stack([lead, doc], axis=1)[lead != doc], axis=0)
                k = len(pairs)
                if k:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((pairs[:, 1] % n_buckets).astype(np.int32)), pa.array(pairs[:, 0]),
                         pa.array(pairs[:, 1]), pa.nulls(k, pa.binary())], names=["bucket", "a", "b", "data"])
                if len(at):
                    base = int(doc.min())
                    keys, doc = keys[at], doc[at] - base
                    rows = [(b, pack(keys[lo:hi], narrow(doc[lo:hi])))
                            for b, lo, hi in bucket_ranges(keys, n_buckets)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[0] for r in rows], pa.int32()), pa.array([base] * len(rows), pa.int64()),
                         pa.nulls(len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                        names=["bucket", "a", "b", "data"])

    def meet(group: pa.Table) -> pa.Table:
        own = group.filter(pc.is_null(group.column("data"))).select(["a", "b"])
        sent = group.filter(pc.is_valid(group.column("data")))
        if not sent.num_rows:
            return own
        lists = [unpack(d, 1) for d in sent.column("data").to_pylist()]
        keys = np.concatenate([x[0] for x in lists])
        doc = np.concatenate([x[1].astype(np.int64) + f for x, f in zip(lists, sent.column("a").to_pylist())])
        order = np.lexsort((doc, keys))
        keys, doc = keys[order], doc[order]
        at = group_starts(keys)
        lead = np.repeat(doc[at], np.diff(np.append(at, len(keys))))
        pairs = np.unique(np.stack([lead, doc], axis=1)[lead != doc], axis=0)
        return pa.concat_tables([own, pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])])

    by_block = levels.groupBy("block").agg(F.collect_list(F.struct("bucket", "levels")).alias("parts"))
    return blocks.join(by_block, "block").select("ids", "sizes", "tokens", "parts").mapInArrow(
        post, "bucket int, a long, b long, data binary").groupBy("bucket").applyInArrow(meet, "a long, b long")


# --- tiles -------------------------------------------------------------------------------

def signature_words(size: int) -> int:
    """Width in 64-bit words of the signatures of a size band: at least two
    bits per element, a power of two."""
    return 1 << max(0, -(-2 * size // 64) - 1).bit_length()


def signatures(sets: list[np.ndarray], words: int) -> np.ndarray:
    out = np.zeros((len(sets), words), dtype=np.uint64)
    for k, s in enumerate(sets):
        bit = s & np.uint64(words * 64 - 1)
        np.bitwise_or.at(out[k], (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out


def linked_components(comp: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Components after all links among ``sets`` (sorted, distinct, not empty),
    where equal values of ``comp`` are connected already. Returns for each set
    the smallest ``comp`` it is connected with."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    order = np.argsort(size, kind="stable")
    size, root = size[order], comp[order].copy()
    sets = [sets[i] for i in order]
    width = np.array([signature_words(int(n)) for n in size])
    bands = [(int(w), int(np.searchsorted(width, w)), int(np.searchsorted(width, w, "right"))) for w in np.unique(width)]
    sign = {w: signatures(sets[lo:hi], w) for w, lo, hi in bands}
    top = np.searchsorted(size, size * 100 // percent, "right")  # sizes that can still reach the threshold
    for w, lo, hi in bands:
        end = int(top[hi - 1])
        tile = [sign[w]]
        for w2, lo2, hi2 in bands:  # the lower part of the next bands, folded to this width
            if w2 > w and lo2 < end:
                tile.append(np.bitwise_or.reduce(sign[w2][:min(hi2, end) - lo2].reshape(-1, w2 // w, w), axis=1))
        tile = np.concatenate(tile)
        for i in range(lo, hi):
            apart = i + 1 + np.flatnonzero(root[i + 1:top[i]] != root[i])
            if not len(apart):
                continue
            differ = np.bitwise_count(tile[apart - lo] ^ tile[i - lo]).sum(axis=1, dtype=np.int64)
            both = size[apart] + size[i]
            most = (both - differ) // 2  # bound of the overlap
            for j in apart[(100 + percent) * most >= percent * both]:
                if root[j] == root[i]:
                    continue
                overlap = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * overlap >= percent * (size[i] + size[j] - overlap):
                    a, b = min(root[i], root[j]), max(root[i], root[j])
                    root[root == b] = a
    out = np.empty_like(root)
    out[order] = root
    return out


GROUPED = "grp long, doc_id long, comp long"


def join_groups(rows: DataFrame, params: JoinParams) -> DataFrame:
    """``rows``: ``ka, kb`` (the task's key), ``grp``, ``doc_id``, ``comp``,
    ``tokens``. Joins each ``grp`` within a key; returns ``grp, doc_id, comp``."""

    def join(table: pa.Table) -> pa.Table:
        grp, comp = table.column("grp").to_numpy(), table.column("comp").to_numpy()
        tokens = table.column("tokens").to_pylist()
        out = comp.copy()
        order = np.argsort(grp, kind="stable")
        for part in np.split(order, group_starts(grp[order])[1:]):
            if len(part) > 1:
                out[part] = linked_components(comp[part], [np.frombuffer(tokens[i], np.uint64) for i in part],
                                              params.percent)
        return pa.table([table.column("grp"), table.column("doc_id"), pa.array(out)], names=["grp", "doc_id", "comp"])

    return rows.groupBy("ka", "kb").applyInArrow(join, GROUPED)


def keyed(rows: DataFrame, params: JoinParams) -> DataFrame:
    """Adds the task's key: groups that fit together by a hash, salted blocks of
    one group where it does not. ``blocks`` says how many the group has."""
    weights = rows.groupBy("grp").agg(F.sum("n").alias("w"))
    total = weights.agg(F.sum("w")).first()[0] or 0
    tasks = max(1, -(-total // params.tile_tokens))
    weights = weights.select("grp", F.ceil(F.col("w") / params.tile_tokens).cast("long").alias("blocks"))
    small = F.col("blocks") <= 1
    return rows.join(weights, "grp").withColumns({
        "ka": F.when(small, -1 - F.pmod(F.xxhash64("grp"), F.lit(tasks))).otherwise(F.col("grp")),
        "kb": F.when(small, 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("blocks")))})


def join_components(sets: DataFrame, groups: DataFrame, params: JoinParams) -> DataFrame:
    """``doc_id, comp`` for the documents of ``groups`` (``node, component``):
    components by exact links among ``sets`` (``doc_id, n, tokens``)."""
    rows = sets.join(groups.select(F.col("node").alias("doc_id"), F.col("component").alias("grp")), "doc_id")
    rows = cut(keyed(rows.withColumn("comp", F.col("doc_id")), params), "join-groups")
    found = cut(join_groups(rows, params), "join-found")
    large = rows.filter("blocks > 1")
    if large.isEmpty():
        return found.select("doc_id", "comp")
    # One representative for each block's component.
    reps = found.join(large.select("grp").distinct(), "grp", "left_semi").filter("doc_id = comp")
    reps = keyed(reps.join(sets, "doc_id"), params)
    merged = cut(join_groups(reps, params).select("grp", F.col("doc_id").alias("old"), F.col("comp").alias("new")),
                 "join-reps")
    # What is still apart in a group is compared across all pairs of its blocks.
    apart = merged.groupBy("grp").agg(F.min("new").alias("x"), F.max("new").alias("y")).filter("x < y").select("grp")
    left = large.select("grp", "doc_id", "tokens", "blocks", "kb").join(apart, "grp", "left_semi").join(
        found.select("doc_id", F.col("comp").alias("old")), "doc_id").join(merged.select("old", "new"), "old")
    pairs = left.select("grp", "doc_id", "tokens", F.col("new").alias("comp"), F.col("grp").alias("ka"), F.explode(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                    lambda o: F.least(o, "kb") * F.col("blocks") + F.greatest(o, "kb"))).alias("kb"))
    across = cut(join_groups(pairs, params).withColumnRenamed("comp", "linked").join(
        left.select("doc_id", F.col("new").alias("comp")), "doc_id").select("comp", "linked").distinct(), "join-across")
    links = merged.select(F.col("old").alias("a"), F.col("new").alias("b")).unionByName(
        across.select(F.col("comp").alias("a"), F.col("linked").alias("b")))
    final = connected_components(links)
    return found.join(final, found["comp"] == final["node"], "left").select(
        found["doc_id"], F.coalesce("component", "comp").alias("comp"))


def jaccard_components(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs``
    (``doc_id``, ``text``)."""
    n_buckets = buckets_for(docs)
    facts = cut(set_facts(docs.select("doc_id", "text"), params, n_buckets), "set-facts")
    key = ["n_shingles", "set_a", "set_b"]
    can_link = facts.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
                            & (100 * F.col("shared") >= params.percent * F.col("n_shingles")))
    classes = cut(can_link.groupBy(*key).agg(F.min("doc_id").alias("rep")), "set-classes")

    # Few texts are left to look at: a Bloom filter of their ids, of at most a
    # few MB whatever the input, spares the others the shuffle to the semi join.
    reps = classes.filter("n_shingles > 0").select(F.col("rep").alias("doc_id"))
    chosen = docs.select("doc_id", "text").join(reps, "doc_id", "left_semi")
    blocks = cut(set_blocks(chosen, params), "set-blocks", BLOOM)
    n_blocks = buckets_for(blocks)
    levels = cut(run_levels(blocks, n_blocks), "run-levels")
    groups = cut(connected_components(candidate_edges(blocks, levels, params, n_blocks)), "join-candidates")

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sizes, tokens in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ids, sizes = np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int64)
                ends = np.cumsum(sizes) * 8
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(sizes),
                     pa.array([tokens[e - 8 * n:e] for e, n in zip(ends.tolist(), sizes.tolist())], pa.binary())],
                    names=["doc_id", "n", "tokens"])

    sets = blocks.select("ids", "sizes", "tokens").mapInArrow(unpacked, "doc_id long, n long, tokens binary")
    # A document repeated under one id stands in the groups more than once.
    joined = join_components(sets, groups, params).groupBy("doc_id").agg(F.min("comp").alias("comp"))
    named = classes.join(joined, classes["rep"] == joined["doc_id"], "left").select(
        *key, F.coalesce("comp", "rep").alias("component"))
    return facts.join(named, key, "left").select(
        facts["doc_id"], "n_shingles",
        F.when(facts["doc_id"].isNotNull(), F.coalesce("component", facts["doc_id"])).alias("component_id"))

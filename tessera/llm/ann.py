"""Approximate nearest neighbours: a navigable small-world graph per shard.

Vectors are dealt to shards of about ``shard_rows`` by a hash of their id. Each
shard is one task: equal vectors become one node, nodes get geometric levels,
and every level holds a graph of diversified neighbours (a candidate is taken
if it is nearer to the node than to any neighbour taken before). The hierarchy
is stored as flat arrays: nodes are ordered by level, so a level is a prefix of
the nodes, and its neighbours are one matrix. Largest inner product becomes
nearest neighbour by one more coordinate that gives all vectors of a shard the
same length; queries have 0 there.

Queries go to every shard in blocks. A block descends the levels of a shard in
lockstep, each query keeping a beam of the best nodes seen; the beam at the
bottom is scored again in double precision on the original vectors. The
shards' best are merged by a window per query.

Defined results: vectors that are null, zero, hold null or non-finite
components, or have another length than most, take no part, neither as
query nor as candidate; ties go to the smaller id; rows repeated under one id
are one row, with the smallest of their vectors; a query with fewer candidates than ``k`` returns all of them; an
empty table gives none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut, mix


@dataclass(frozen=True)
class GraphParams:
    shard_rows: int = 32768   # nodes of a shard, which choose their neighbours among all of them
    degree: int = 16          # neighbours chosen per node; twice that many at the bottom, plus links back
    build_beam: int = 64      # candidates a node chooses from
    beam: int = 128           # nodes kept per query at the bottom
    upper_beam: int = 16
    expand: int = 4           # nodes of a beam followed at a time
    query_block: int = 32768  # queries that one task takes through one shard, which has a copy for each block


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def clean_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, vector`` (array of doubles) of the rows that take part."""
    rows = table.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    rows = rows.filter(F.size("vector") == (sizes[0]["d"] if sizes else 0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


# --- building -------------------------------------------------------------------------

def _diverse(vectors: np.ndarray, rows: np.ndarray, cand: np.ndarray, sim: np.ndarray, degree: int) -> np.ndarray:
    """For each of ``rows``: ``degree`` of its candidates (nearest first), those
    nearer to it than to a neighbour taken before first, then the nearest."""
    near = vectors[cand]
    between = near @ near.transpose(0, 2, 1)
    taken = np.zeros(cand.shape, dtype=bool)
    count = np.zeros(len(rows), dtype=np.int64)
    for k in range(cand.shape[1]):
        covered = (taken & (between[:, k, :] > sim[:, k, None])).any(axis=1)
        take = ~covered & (count < degree)
        taken[:, k] = take
        count += take
    rank = np.argsort(~taken, axis=1, kind="stable")[:, :degree]
    return np.take_along_axis(cand, rank, axis=1)


def level_graph(vectors: np.ndarray, degree: int, most: int, beam: int) -> np.ndarray:
    """Neighbour matrix (-1: none) of one level: diversified neighbours of each
    node among its nearest, then links back, ``most`` at most."""
    n = len(vectors)
    out = np.full((n, most), -1, dtype=np.int32)
    k = min(beam, n - 1)
    if k <= 0:
        return out
    chosen = np.empty((n, min(degree, k)), dtype=np.int64)
    for a in range(0, n, 512):
        rows = np.arange(a, min(n, a + 512))
        sim = vectors[rows] @ vectors.T
        sim[np.arange(len(rows)), rows] = -np.inf
        cand = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        value = np.take_along_axis(sim, cand, axis=1)
        order = np.argsort(-value, axis=1, kind="stable")
        cand, value = np.take_along_axis(cand, order, axis=1), np.take_along_axis(value, order, axis=1)
        chosen[rows] = _diverse(vectors, rows, cand, value, chosen.shape[1])
    src = np.repeat(np.arange(n), chosen.shape[1])
    dst = chosen.reshape(-1)
    back = np.concatenate([np.zeros(len(src), np.int8), np.ones(len(src), np.int8)])
    src, dst = np.concatenate([src, dst]), np.concatenate([dst, src])
    sim = np.einsum("ij,ij->i", vectors[src], vectors[dst])
    order = np.lexsort((-sim, back, src))
    src, dst = src[order], dst[order]
    _, first = np.unique(src * n + dst, return_index=True)  # a link both ways counts once
    first.sort()
    src, dst = src[first], dst[first]
    place = np.arange(len(src)) - np.searchsorted(src, src)
    fits = place < most
    out[src[fits], place[fits]] = dst[fits]
    return out


def build_graph(ids: np.ndarray, vectors: np.ndarray, params: GraphParams) -> dict[str, object]:
    """The flat arrays of one shard."""
    order = np.lexsort((ids, *vectors.T[::-1]))
    ids, vectors = ids[order], vectors[order]
    new = np.ones(len(ids), dtype=bool)
    new[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
    node_start = np.flatnonzero(new)
    node_len = np.diff(np.append(node_start, len(ids)))
    # Level: geometric, drawn from the smallest id of the node.
    u = (mix(ids[node_start].astype(np.uint64)) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53
    level = np.floor(-np.log(np.maximum(u, 1e-18)) / np.log(params.degree)).astype(np.int64)
    rank = np.argsort(-level, kind="stable")
    level, node_start, node_len = level[rank], node_start[rank], node_len[rank]
    nodes = vectors[node_start]
    norm = np.einsum("ij,ij->i", nodes, nodes)
    even = np.concatenate([nodes, np.sqrt(np.maximum(norm.max() - norm, 0.0))[:, None]], axis=1)
    even = (even / np.sqrt(norm.max())).astype(np.float32)
    sizes, links = [], []
    for lv in range(int(level[0]) + 1):
        n = int((level >= lv).sum())
        most = params.degree * (4 if lv == 0 else 2)
        sizes.append(n)
        links.append(level_graph(even[:n], params.degree * (2 if lv == 0 else 1), most, params.build_beam))
    flat = np.concatenate([ids[a:a + m] for a, m in zip(node_start, node_len)])
    return {"dim": vectors.shape[1], "vectors": nodes.astype("<f8").tobytes(),
            "id_counts": node_len.astype("<i4").tobytes(), "ids": flat.astype("<i8").tobytes(),
            "level_sizes": np.array(sizes, dtype="<i4").tobytes(),
            "neighbours": b"".join(x.astype("<i4").tobytes() for x in links)}


INDEX = ("shard int, dim int, vectors binary, id_counts binary, ids binary, level_sizes binary, neighbours binary")
INDEX_NAMES = [c.split()[0] for c in INDEX.split(", ")]


def build_index(vectors: DataFrame, n_shards: int, params: GraphParams = GraphParams()) -> DataFrame:
    """One row of flat arrays per shard of ``vectors`` (``vec_id, vector``)."""

    def build(shard: pa.Table) -> pa.Table:
        flat = shard.column("vector").combine_chunks().flatten().to_numpy()
        rows = build_graph(shard.column("vec_id").to_numpy(), flat.reshape(shard.num_rows, -1), params)
        number = shard.column("shard")[0].as_py()
        return pa.table([pa.array([number], pa.int32()), pa.array([rows["dim"]], pa.int32()),
                         *(pa.array([rows[c]], pa.binary()) for c in INDEX_NAMES[2:])], names=INDEX_NAMES)

    shard = F.pmod(F.xxhash64("vec_id"), F.lit(n_shards)).cast("int")
    return vectors.withColumn("shard", shard).groupBy("shard").applyInArrow(build, INDEX)


# --- searching --------------------------------------------------------------------------

def _beam_search(queries: np.ndarray, vectors: np.ndarray, links: np.ndarray, beam_ids: np.ndarray,
                 width: int, expand: int) -> np.ndarray:
    """Best ``width`` nodes per query (-1: none) that a search from ``beam_ids``
    (distinct, -1: none) reaches; all queries advance together until none has a node to follow."""
    q, n = len(queries), len(links)
    here = np.arange(q)[:, None]
    seen = np.zeros((q, n + 1), dtype=bool)  # the last column takes the missing nodes
    seen[here, beam_ids] = True
    seen[:, n] = True
    ids = np.full((q, width), -1, dtype=np.int64)
    sims = np.full((q, width), -np.inf, dtype=np.float32)
    keep = min(width, beam_ids.shape[1])
    ids[:, :keep] = beam_ids[:, :keep]
    sims[:, :keep] = np.where(ids[:, :keep] >= 0, np.einsum("qkd,qd->qk", vectors[ids[:, :keep]], queries), -np.inf)
    done = ids < 0
    active = np.arange(q)
    while len(active):
        open_sims = np.where(done[active], -np.inf, sims[active])
        follow = np.argsort(-open_sims, axis=1)[:, :expand]
        rows = np.arange(len(active))[:, None]
        usable_ = np.isfinite(open_sims[rows, follow])
        live = usable_.any(axis=1)
        active, follow, usable_ = active[live], follow[live], usable_[live]
        if not len(active):
            break
        a = active[:, None]
        done[a, follow] = True
        node = np.where(usable_, ids[a, follow], -1)
        near = np.where(node[:, :, None] >= 0, links[node], -1).reshape(len(active), -1).astype(np.int64)
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[seen[a, near]] = -1
        seen[a, near] = True
        near_sims = np.where(near >= 0, np.einsum("qkd,qd->qk", vectors[near], queries[active]), -np.inf).astype(np.float32)
        all_ids = np.concatenate([ids[active], near], axis=1)
        all_sims = np.concatenate([sims[active], near_sims], axis=1)
        all_done = np.concatenate([done[active], near < 0], axis=1)
        best = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        rows = np.arange(len(active))[:, None]
        ids[active], sims[active], done[active] = all_ids[rows, best], all_sims[rows, best], all_done[rows, best]
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.where(np.isfinite(np.take_along_axis(sims, order, 1)), np.take_along_axis(ids, order, 1), -1)


def search_graph(index: dict, query_ids: np.ndarray, queries: np.ndarray, k: int,
                 params: GraphParams) -> Iterator[tuple[int, int, float]]:
    """``(query, id, score)`` of the ``k`` best of one shard for each query."""
    vectors = np.frombuffer(index["vectors"], "<f8").reshape(-1, index["dim"])
    short = vectors.astype(np.float32)
    counts = np.frombuffer(index["id_counts"], "<i4")
    starts = np.cumsum(counts) - counts
    ids = np.frombuffer(index["ids"], "<i8")
    sizes = np.frombuffer(index["level_sizes"], "<i4")
    flat, levels, at = np.frombuffer(index["neighbours"], "<i4"), [], 0
    for lv, n in enumerate(sizes):
        most = params.degree * (4 if lv == 0 else 2)
        levels.append(flat[at:at + n * most].reshape(n, most))
        at += n * most
    for a in range(0, len(query_ids), 256):
        exact = queries[a:a + 256]
        part = exact.astype(np.float32)
        beam = np.zeros((len(part), 1), dtype=np.int64)
        for lv in range(len(levels) - 1, -1, -1):
            width = max(params.beam, 2 * k) if lv == 0 else params.upper_beam
            beam = _beam_search(part, short, levels[lv], beam, width, params.expand)
        for row, own in enumerate(query_ids[a:a + 256].tolist()):
            nodes = beam[row][beam[row] >= 0]
            score = vectors[nodes] @ exact[row]
            # Equal vectors share a node; its smallest ids are enough, one more than k for the query's own.
            found = [(-float(s), int(i)) for s, n in zip(score, nodes)
                     for i in ids[starts[n]:starts[n] + min(counts[n], k + 1)] if i != own]
            found.sort()
            yield from ((own, i, -s) for s, i in found[:k])


def nearest_neighbours(table: DataFrame, k: int = 20, query_every: int = 20,
                       params: GraphParams = GraphParams()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each row
    whose id is divisible by ``query_every``, against all rows."""
    vectors = cut(clean_vectors(table), "ann-vectors")
    queries = vectors.filter(F.col("vec_id") % query_every == 0)
    n, n_queries = vectors.count(), queries.count()
    n_shards, n_blocks = max(1, -(-n // params.shard_rows)), max(1, -(-n_queries // params.query_block))
    index = cut(build_index(vectors, n_shards, params), "ann-index")

    def search(shard: pa.Table, asked: pa.Table) -> pa.Table:
        rows = []
        if shard.num_rows and asked.num_rows:
            flat = asked.column("vector").combine_chunks().flatten().to_numpy()
            rows = list(search_graph(shard.to_pylist()[0], asked.column("vec_id").to_numpy(),
                                     flat.reshape(asked.num_rows, -1), k, params))
        cols = zip(*rows) if rows else ([], [], [])
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))],
                        names=["query_id", "vec_id", "score"])

    def copies(n_: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n_ - 1)))

    left = index.withColumn("block", copies(n_blocks)).groupBy("shard", "block")
    right = queries.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.lit(n_blocks)).cast("int")) \
        .withColumn("shard", copies(n_shards)).groupBy("shard", "block")
    found = left.cogroup(right).applyInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")

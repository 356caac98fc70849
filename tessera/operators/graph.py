"""Graph analytics on an edge table ``(src, dst)`` and a name table ``(id, name)``.

* degrees: in + out degree (parallel edges count), one hash aggregate;
* breadth-first distances: a frontier loop on DataFrames. Each round joins
  only the newly reached vertices with the edges, removes already reached
  vertices, and cuts lineage by writing the new frontier to the shared
  checkpoint folder. Every vertex is expanded exactly once.

With ``symmetric=True`` (every edge also present reversed, as in a
co-appearance graph) a vertex next to the frontier of round r-1 was either
unreached or reached in round r-2 or r-1, so the new vertices are told from the
last two frontiers: each round then shuffles frontier-sized data instead of the
whole reached set.

The edge table is written once, bucketed by its join key, so a round shuffles
the frontier to the edges' buckets and never the edges.

The edges of a vertex with very many of them are dealt over chunks, in
proportion to its degree, so a vertex that holds a third of all edges is many
join keys of bounded size; other vertices are one key and are never copied.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.session import delete_path, materialize, partitions_for, scratch_path

LEVEL_SCHEMA = "id long, distance int"
INFINITY = float("inf")


def degrees(edges: DataFrame) -> DataFrame:
    """``(id, degree)``: number of edge endpoints at each vertex."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def out_connections(edges: DataFrame) -> DataFrame:
    """``(id, connections)``: edges leaving each vertex (co-appearance totals)."""
    return edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("connections"))


def graph_vertices(edges: DataFrame, names: DataFrame, default: str = "Nobody") -> DataFrame:
    """Every vertex of the graph with its name; vertices seen only in edges
    get ``default``. Named vertices without edges are kept too."""
    ids = edges.select(F.explode(F.array("src", "dst")).alias("id")).union(names.select("id")).distinct()
    first_name = names.groupBy("id").agg(F.min("name").alias("name"))
    return ids.join(first_name, "id", "left").select("id", F.coalesce("name", F.lit(default)).alias("name"))


def degrees_top(edges: DataFrame, names: DataFrame, k: int = 10) -> DataFrame:
    """Top-k vertices by degree among named vertices: ``(id, name, degree)``."""
    d = degrees(edges).join(names.select("id", "name"), "id")
    return d.orderBy(F.col("degree").desc(), F.col("id").asc(), F.col("name").asc()).limit(int(k)).select(
        "id", "name", "degree")


CHUNK_EDGES = 1_000_000  # edges of one vertex that one join key may hold


BUCKET_BYTES = 64 << 20  # about the input of one bucket of edges


def edge_buckets(edges: DataFrame) -> int:
    """Buckets of the edge table: by the bytes that ``edges`` reads, at most
    what Spark lets a table have."""
    most = int(edges.sparkSession.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    return min(most, partitions_for(edges, BUCKET_BYTES))


def _prepared_edges(edges: DataFrame, chunk_edges: int, name: str = "bfs_edges") -> tuple[DataFrame, DataFrame]:
    """``(edges, heavy)``: the edge table ``(src, chunk, dst)``, bucketed by
    ``(src, chunk)`` and known to the catalog as ``name`` until the search ends,
    and, for each vertex with more than ``chunk_edges`` edges, its number of
    chunks.

    A light vertex has chunk 0 only, so it meets the frontier as it is. The
    edges of a heavy one are dealt over ``ceil(degree / chunk_edges)`` chunks
    by a hash of their end, and only its frontier row is copied to them.
    """
    plain = edges.select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"))
    heavy = plain.groupBy("src").agg(F.count(F.lit(1)).alias("d")).filter(F.col("d") > F.lit(chunk_edges)).select(
        "src", F.ceil(F.col("d") / F.lit(chunk_edges)).cast("long").alias("chunks"))
    heavy = materialize(heavy, "bfs-heavy")
    chunk = F.pmod(F.xxhash64("dst"), F.coalesce("chunks", F.lit(1).cast("long"))).cast("int")
    dealt = plain.join(heavy, "src", "left").select("src", chunk.alias("chunk"), "dst")
    spark, n = edges.sparkSession, edge_buckets(edges)
    # One file a bucket: rows go to the tasks by the hash that deals them into buckets.
    dealt.repartition(n, "src", "chunk").write.mode("overwrite").bucketBy(n, "src", "chunk").option(
        "path", scratch_path(spark, "bfs-edges")).saveAsTable(name)
    return spark.table(name), heavy


def _expand(prepared: DataFrame, heavy: DataFrame, frontier: DataFrame) -> DataFrame:
    """Edges leaving the frontier, summed per destination: ``(id, mult)``."""
    fr = frontier.select(F.col("id").alias("src")).join(heavy, "src", "left").select(
        "src", F.explode(F.sequence(F.lit(0), (F.coalesce("chunks", F.lit(1).cast("long")) - 1).cast("int"))).alias("chunk"))
    hop = prepared.join(fr, ["src", "chunk"])
    return hop.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("mult"))


class _Search:
    """A frontier search. ``rounds`` yields ``(round, frontier, edges_out,
    hits)`` and grows ``levels``, one written table of new vertices per round.

    Each round is one job: it writes the newly reached vertices, and an
    observation on the written rows brings back their number and, when a
    target is given, the edges out of the frontier and those that hit it.
    ``finish`` writes what was reached as one table and deletes the rest.
    """

    def __init__(self, edges: DataFrame, root: int, max_rounds: int | None = None, target: int | None = None,
                 symmetric: bool = False, chunk_edges: int = CHUNK_EDGES) -> None:
        self.spark = edges.sparkSession
        self.max_rounds, self.target, self.symmetric = max_rounds, target, symmetric
        self.table = f"bfs_edges_{uuid.uuid4().hex}"
        self.prepared, self.heavy = _prepared_edges(edges, chunk_edges, self.table)
        self.levels = [self.spark.createDataFrame([(int(root), 0)], LEVEL_SCHEMA)]
        self.scratch = [self.prepared, self.heavy]

    def _known(self) -> DataFrame:
        # With symmetric edges only the last two frontiers can hold reached neighbours.
        levels = self.levels[-2:] if self.symmetric else self.levels
        known = levels[0].select("id")
        for level in levels[1:]:
            known = known.unionByName(level.select("id"))
        return known

    def rounds(self):
        size, rnd = 1, 0
        while self.max_rounds is None or rnd < self.max_rounds:
            rnd += 1
            if size == 0:
                yield rnd, 0, 0, 0
                if self.max_rounds is None:
                    return
                continue
            cand = _expand(self.prepared, self.heavy, self.levels[-1])
            seen = self._known().select("id", F.lit(True).alias("seen"))
            flagged = cand.join(seen, "id", "left")
            stats = Observation()
            metrics = [F.count(F.when(F.col("seen").isNull(), F.lit(1))).alias("fresh"),
                       F.coalesce(F.sum("mult"), F.lit(0)).alias("out"),
                       F.coalesce(F.sum(F.when(F.col("id") == F.lit(self.target), F.col("mult"))), F.lit(0)).alias("hits")]
            new = materialize(flagged.observe(stats, *metrics).filter(F.col("seen").isNull())
                              .select("id", F.lit(rnd).cast("int").alias("distance")), "bfs-frontier")
            found = stats.get
            self.levels.append(new)
            self.scratch.append(new)
            yield rnd, size, int(found["out"]), int(found["hits"])
            size = int(found["fresh"])

    def finish(self) -> DataFrame:
        reached = self.levels[0]
        for level in self.levels[1:]:
            reached = reached.unionByName(level)
        result = materialize(reached, "bfs-reached")
        self.drop()
        return result

    def drop(self) -> None:
        paths = {p.rsplit("/", 1)[0] for table in self.scratch for p in table.inputFiles()}
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")  # its files lie in the shared folder
        for path in paths:
            delete_path(self.spark, path)


def bfs_distances(edges: DataFrame, root: int, max_rounds: int | None = None, symmetric: bool = False,
                  chunk_edges: int = CHUNK_EDGES) -> DataFrame:
    """Hop distance from ``root`` along directed edges for every vertex that
    can be reached: ``(id, distance)``. The search runs until a round reaches
    nothing new; ``max_rounds`` ends it earlier (a Pregel run capped at so many
    supersteps)."""
    search = _Search(edges, root, max_rounds, symmetric=symmetric, chunk_edges=chunk_edges)
    for _, frontier, _, _ in search.rounds():
        if frontier == 0:
            break
    return search.finish()


def bfs_distance_to(edges: DataFrame, root: int, target: int, max_rounds: int | None = None,
                    symmetric: bool = False, chunk_edges: int = CHUNK_EDGES) -> DataFrame:
    """``(id, distance)`` of ``target`` (no row when it is not reached). The
    search stops at the round that first reaches the target: in a
    breadth-first search that distance is already final."""
    spark = edges.sparkSession
    if root == target:
        return spark.createDataFrame([(int(target), 0)], LEVEL_SCHEMA)
    search = _Search(edges, root, max_rounds, target, symmetric, chunk_edges)
    for _, frontier, _, hits in search.rounds():
        if hits > 0 or frontier == 0:
            break
    return search.finish().filter(F.col("id") == F.lit(target))


def with_unreached(distances: DataFrame, vertices: DataFrame) -> DataFrame:
    """All vertices, unreached ones at +infinity (double), like the Pregel
    initial value."""
    d = distances.select("id", F.col("distance").cast("double").alias("distance"))
    return vertices.select("id").join(d, "id", "left").select(
        "id", F.coalesce("distance", F.lit(INFINITY)).alias("distance"))


def bfs_early_stop(edges: DataFrame, start: int, target: int, max_rounds: int = 10,
                   symmetric: bool = False, chunk_edges: int = CHUNK_EDGES) -> DataFrame:
    """Rounds of a search from ``start`` that stops at the first round whose
    frontier touches ``target``, after ``max_rounds`` at the latest.

    One row per round run: ``(round, frontier, edges_out, hits)`` where
    frontier = vertices expanded (first reached in the previous round),
    edges_out = edges leaving them, hits = those edges that end at ``target``
    (multiplicity kept). The scalars are per-round aggregates; no vertex data
    reaches the driver.
    """
    search = _Search(edges, start, max_rounds, target, symmetric, chunk_edges)
    rows = []
    for row in search.rounds():
        rows.append(row)
        if row[3] > 0:
            break
    search.drop()
    return search.spark.createDataFrame(rows, "round int, frontier long, edges_out long, hits long")

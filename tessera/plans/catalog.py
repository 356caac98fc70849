"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query binds the test tables to an operator's inputs
(``tessera.sources.bindings``) and calls the operator with the parameters of
the original program (or the bound values listed in ``PARAMS`` where the
original constants select nothing on these tables). Computed columns carry
the same names as in ``tessera.plans.oracle``; doubles are rounded where two
engines may sum in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import aggregates, graph, ml, people, ranking, similarity, splits, wordcount
from tessera.operators.wordcount import STOP_WORDS
from tessera.sources import bindings as B
from tessera.sources import readers, text_tables
from tessera.sources.replay import replayed
from tessera.streaming import jobs as S

# Parameters bound to the test tables (the original constants are noted).
PARAMS = {
    "similar_item": 1,          # original: item 180
    "min_score": 0.80,          # original: 0.97 (selects nothing on these tables)
    "min_pairs": 20,            # original: 50
    "rating_user": 10,          # original: user 10
    "bfs_root": 0,              # original: vertex 5306
    "bfs_target": 14,           # original: vertex 14
    "stop_rounds": 10,          # original: 10 iterations of the search that stops early
    "station_entry_type": "error",  # original: PRCP
    "split_seed": 0,
    "kfolds": 5,
    "leave_start": 1, "leave_stop": 10, "leave_max_test": 5000,  # original: 100000 rows of the ua split
    "strong_score": 0.85, "strong_pairs": 20, "genre_weight": 0.2,
    "window": "5 minutes", "slide": "1 second", "top_k": 10,
    "watermark": "10 minutes", "epochs": 3,
}
SPLIT_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
DIGITS = 6


def _rd(c, digits: int = DIGITS):
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# --- keyed aggregates --------------------------------------------------------

def q_customer_spend(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.customer_spend(B.customer_orders(spark, sf))


def q_rating_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.rating_histogram(B.rating_lines(spark, sf))


def q_avg_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.avg_by_key(B.people(spark, sf), key="age", value="friends")


def q_extreme_by_station(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.extreme_by_key(B.station_readings(spark, sf), entry_type=PARAMS["station_entry_type"])


def q_extreme_fahrenheit(spark: SparkSession, sf: str) -> DataFrame:
    out = aggregates.extreme_by_key(B.station_readings(spark, sf), entry_type=PARAMS["station_entry_type"],
                                    fahrenheit=True)
    return out.select("station", _rd("extreme", 4).alias("extreme"))


# --- word counts --------------------------------------------------------------

def q_word_count_space(spark: SparkSession, sf: str) -> DataFrame:
    return wordcount.word_count_space(B.book_lines(spark, sf))


def q_word_count_regex(spark: SparkSession, sf: str) -> DataFrame:
    return wordcount.word_count_regex(B.book_lines(spark, sf))


def q_word_count_stop_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return wordcount.word_count_stop_sorted(B.book_lines(spark, sf))


# --- people: projections, filters, SQL ------------------------------------------

def q_sql_age_range(spark: SparkSession, sf: str) -> DataFrame:
    return people.sql_age_range(spark, B.people(spark, sf), 13, 19)


def q_people_select_name(spark: SparkSession, sf: str) -> DataFrame:
    return people.select_name(B.people(spark, sf))


def q_people_under_21(spark: SparkSession, sf: str) -> DataFrame:
    return people.under_age(B.people(spark, sf), 21)


def q_people_plus_10(spark: SparkSession, sf: str) -> DataFrame:
    return people.plus_years(B.people(spark, sf), 10)


def q_people_count_by_age(spark: SparkSession, sf: str) -> DataFrame:
    return people.count_by_age(B.people(spark, sf))


# --- ranking ----------------------------------------------------------------------

def q_item_popularity(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.item_popularity(B.rating_lines(spark, sf))


def q_top10_items(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.top_items(B.rating_lines(spark, sf), B.titles(spark, sf), 10)


def q_top10_item_names(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.top_item_names(B.rating_lines(spark, sf), B.titles(spark, sf), 10)


def q_top10_items_strict(spark: SparkSession, sf: str) -> DataFrame:
    counts = ranking.item_popularity(B.rating_lines(spark, sf))
    top = ranking.top_k(counts, 10, F.col("count").desc(), F.col("item").asc())
    return ranking.lookup_names(top, B.titles(spark, sf), "item", "id", "title", "strict").select(
        "item", "count", "title")


def q_connection_totals(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.connection_totals(B.order_line_counts(spark, sf))


def q_top_connected(spark: SparkSession, sf: str) -> DataFrame:
    totals = graph.out_connections(B.graph_edges(spark, sf))
    return ranking.most_connected(totals, B.vertex_names(spark, sf))


def q_top10_connected(spark: SparkSession, sf: str) -> DataFrame:
    totals = graph.out_connections(B.graph_edges(spark, sf))
    return ranking.top_connected(totals, B.vertex_names(spark, sf), 10)


# --- similarity -------------------------------------------------------------------

def q_item_similarity(spark: SparkSession, sf: str) -> DataFrame:
    sims = similarity.item_similarity(B.rating_lines(spark, sf))
    return sims.select("item1", "item2", _rd("score").alias("score"), "n")


def q_item_similarity_strong(spark: SparkSession, sf: str) -> DataFrame:
    sims = similarity.item_similarity(B.rating_lines(spark, sf), min_score=PARAMS["strong_score"],
                                      min_pairs=PARAMS["strong_pairs"])
    return sims.select("item1", "item2", _rd("score").alias("score"), "n")


def q_item_similarity_genres(spark: SparkSession, sf: str) -> DataFrame:
    sims = similarity.item_similarity(B.rating_lines(spark, sf))
    out = similarity.with_genres(sims, B.titles_with_genres(spark, sf), PARAMS["genre_weight"])
    return out.select("item1", "item2", "n", *(_rd(c).alias(c) for c in ("score", "genre_overlap", "boosted")))


def q_similar_to_item(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.similar_to_item(B.rating_lines(spark, sf), B.titles(spark, sf), PARAMS["similar_item"],
                                      PARAMS["min_score"], PARAMS["min_pairs"], 10, digits=DIGITS)


# --- regression / recommendation --------------------------------------------------

def q_regression_sgd(spark: SparkSession, sf: str) -> DataFrame:
    w, run = ml.sgd_linear_regression(B.regression_points(spark, sf), iterations=1, step=1.0, reg=0.1)
    return spark.createDataFrame([(round(w, DIGITS), run)], "weight double, iterations int")


def q_regression_sgd_100(spark: SparkSession, sf: str) -> DataFrame:
    w, run = ml.sgd_linear_regression(B.regression_points(spark, sf), iterations=100, step=0.3, reg=0.1, tol=1e-7)
    return spark.createDataFrame([(round(w, DIGITS), run)], "weight double, iterations int")


def q_regression_ridge_two(spark: SparkSession, sf: str) -> DataFrame:
    points = B.regression_points(spark, sf, "l_discount")
    model, pred = ml.elastic_net(points, points, reg=0.3, mixing=0.0, features=("feature", "l_discount"))
    w = model.coefficients
    return pred.agg(F.count(F.lit(1)).alias("n"), F.round(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("label"), 2))),
                                                          DIGITS).alias("rmse")).select(
        F.round(F.lit(float(w[0])), DIGITS).alias("w_quantity"), F.round(F.lit(float(w[1])), DIGITS).alias("w_discount"),
        F.round(F.lit(float(model.intercept)), DIGITS).alias("intercept"), "n", "rmse")


def q_regression_rmse(spark: SparkSession, sf: str) -> DataFrame:
    pts = B.regression_points(spark, sf)
    w, _ = ml.sgd_linear_regression(pts, iterations=1, step=1.0, reg=0.1)
    r = ml.rmse(ml.predict_linear(pts, w))
    return r.select(_rd("rmse").alias("rmse"), "n")


def q_regression_elastic_net(spark: SparkSession, sf: str) -> DataFrame:
    tagged = splits.random_split(B.regression_points(spark, sf, *SPLIT_KEYS), SPLIT_KEYS, (0.5, 0.5),
                                 PARAMS["split_seed"])
    _, pred = ml.elastic_net(tagged.filter(F.col("split") == 0), tagged.filter(F.col("split") == 1),
                             reg=0.3, mixing=0.8, max_iter=200, tol=1e-12)
    return pred.select(_rd("prediction", 4).alias("prediction"), _rd("label").alias("label"))


def q_als_recommend(spark: SparkSession, sf: str) -> DataFrame:
    ratings = similarity.user_item_ratings(B.rating_lines(spark, sf))
    return ml.als_recommend(ratings.withColumnRenamed("r", "rating"), B.titles(spark, sf), PARAMS["rating_user"],
                            k=10, rank=8, max_iter=20)


def q_als_properties(spark: SparkSession, sf: str) -> DataFrame:
    ratings = similarity.user_item_ratings(B.rating_lines(spark, sf))
    return ml.als_properties(ratings.withColumnRenamed("r", "rating"), B.titles(spark, sf), PARAMS["rating_user"],
                             k=10, rank=8, max_iter=20)


def q_recommend_from_factors(spark: SparkSession, sf: str) -> DataFrame:
    factors = B.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))
    top = ml.recommend_for_user(factors, factors, B.titles(spark, sf), PARAMS["rating_user"], 10)
    return top.select("user", "item", "title", _rd(F.col("score").cast("double"), 4).alias("score"))


def q_user_ratings_named(spark: SparkSession, sf: str) -> DataFrame:
    return ml.user_ratings_named(B.rating_lines(spark, sf), B.titles(spark, sf), PARAMS["rating_user"])


# --- graph ---------------------------------------------------------------------------

def q_graph_degrees_top10(spark: SparkSession, sf: str) -> DataFrame:
    return graph.degrees_top(B.graph_edges(spark, sf), B.vertex_names(spark, sf), 10)


def q_graph_build(spark: SparkSession, sf: str) -> DataFrame:
    return graph.graph_vertices(B.graph_edges(spark, sf), B.vertex_names(spark, sf))


def q_graph_build_partial_names(spark: SparkSession, sf: str) -> DataFrame:
    """Only customers are named; parts are known by their edges."""
    return graph.graph_vertices(B.graph_edges(spark, sf), B.customer_names(spark, sf))


def q_bfs_distances(spark: SparkSession, sf: str) -> DataFrame:
    return graph.bfs_distances(B.graph_edges(spark, sf), PARAMS["bfs_root"], symmetric=True)


def q_bfs_vertex_probe(spark: SparkSession, sf: str) -> DataFrame:
    hit = graph.bfs_distance_to(B.graph_edges(spark, sf), PARAMS["bfs_root"], PARAMS["bfs_target"], symmetric=True)
    return ranking.lookup_names(hit, B.vertex_names(spark, sf), "id", "id", "name", "left").select(
        "id", "name", "distance")


def q_bfs_named_first100(spark: SparkSession, sf: str) -> DataFrame:
    """Every vertex has a distance, unreached ones +infinity."""
    vertices = graph.graph_vertices(B.graph_edges(spark, sf), B.vertex_names(spark, sf))
    d = graph.bfs_distances(B.graph_edges(spark, sf), PARAMS["bfs_root"], symmetric=True)
    first = ranking.top_k(graph.with_unreached(d, vertices), 100, F.col("id").asc())
    return ranking.lookup_names(first, vertices, "id", "id", "name", "left").select("id", "name", "distance")


def q_bfs_unreached(spark: SparkSession, sf: str) -> DataFrame:
    """All vertices of the directed graph customer -> part: parts have no way on."""
    directed = B.directed_edges(spark, sf)
    vertices = graph.graph_vertices(directed, B.vertex_names(spark, sf))
    return graph.with_unreached(graph.bfs_distances(directed, 2 * PARAMS["rating_user"]), vertices)


def q_bfs_early_stop(spark: SparkSession, sf: str) -> DataFrame:
    return graph.bfs_early_stop(B.graph_edges(spark, sf), PARAMS["bfs_root"], PARAMS["bfs_target"],
                                PARAMS["stop_rounds"], symmetric=True)


# --- splits -----------------------------------------------------------------------------

_SPLIT_OUT = ["l_orderkey", "l_linenumber", "l_partkey", "user", "item", "rating"]


def q_kfold_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.rating_lines(spark, sf, keep_order_cols=True)
    return splits.kfold_split(rows, B.LINE_ORDER, PARAMS["kfolds"], keep=_SPLIT_OUT).select(*_SPLIT_OUT, "fold")


def q_kfold_files(spark: SparkSession, sf: str) -> DataFrame:
    """All base and test sets of the folds, written in one pass and read back."""
    rows = B.rating_lines(spark, sf, keep_order_cols=True)
    folds = splits.kfold_split(rows, B.LINE_ORDER, PARAMS["kfolds"], keep=_SPLIT_OUT).select(*_SPLIT_OUT, "fold")
    path = splits.write_folds(folds, PARAMS["kfolds"], text_tables.round_trip(spark, "folds"), ["user", "item"])
    return spark.read.parquet(path).withColumnRenamed("set", "split")


def q_leave_n_out_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.rating_lines(spark, sf, keep_order_cols=True)
    out = splits.leave_n_out_split(rows, "user", B.LINE_ORDER, PARAMS["leave_start"], PARAMS["leave_stop"])
    return out.select(*_SPLIT_OUT, "role")


def q_leave_n_out_capped(spark: SparkSession, sf: str) -> DataFrame:
    """The cap on the size of the test set is the feature here."""
    rows = B.rating_lines(spark, sf, keep_order_cols=True)
    out = splits.leave_n_out_split(rows, "user", B.LINE_ORDER, PARAMS["leave_start"], PARAMS["leave_stop"],
                                   PARAMS["leave_max_test"])
    return out.select(*_SPLIT_OUT, "role")


def q_random_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.rating_lines(spark, sf, keep_order_cols=True)
    return splits.random_split(rows, SPLIT_KEYS, (0.5, 0.5), PARAMS["split_seed"]).select(*_SPLIT_OUT, "split")


# --- streaming ----------------------------------------------------------------------------

# Each stream is a table replayed in PARAMS["epochs"] micro-batches, over one checkpoint.

def _conversations(spark: SparkSession, sf: str, job: Callable[..., str], name: str, **kw) -> str:
    out = text_tables.round_trip(spark, name)
    return replayed(B.conversation_texts(spark, sf), F.col("conv_id"), PARAMS["epochs"],
                    lambda stream: job(spark, stream, out_path=out, **kw))


def _hashtags(spark: SparkSession, sf: str, mode: str) -> str:
    out = text_tables.round_trip(spark, "hashtags")
    return replayed(B.hashtag_events(spark, sf), F.unix_micros("ts"), PARAMS["epochs"],
                    lambda stream: S.run_hashtag_stream(
                        spark, stream, out, PARAMS["window"], PARAMS["slide"], PARAMS["watermark"], PARAMS["top_k"], mode))


def q_stream_top_lengths(spark: SparkSession, sf: str) -> DataFrame:
    out = _conversations(spark, sf, S.run_top_lengths_stream, "lengths", k=PARAMS["top_k"])
    return S.every_epoch(spark, out, S.LENGTH_SCHEMA).select("batch", "rank", "length")


def q_stream_allowed_words(spark: SparkSession, sf: str) -> DataFrame:
    """Per micro-batch, the most frequent words that a file of stop words does not list."""
    banned = text_tables.round_trip(spark, "banned")
    spark.createDataFrame([(w,) for w in STOP_WORDS], "value string").write.text(banned)
    out = _conversations(spark, sf, S.run_allowed_words, "allowed", k=PARAMS["top_k"], banned_path=banned)
    return S.every_epoch(spark, out, S.WORD_SCHEMA).select("batch", "rank", "word", "count")


def _windows(top: DataFrame) -> DataFrame:
    return top.select(F.unix_seconds("window_start").alias("window_start"), "hashtag", "count", "rank")


def q_stream_hashtags_5m(spark: SparkSession, sf: str) -> DataFrame:
    return _windows(S.latest(spark, _hashtags(spark, sf, "complete")))


def q_stream_hashtags_final(spark: SparkSession, sf: str) -> DataFrame:
    """Windows that are final when the stream ends; state is bounded by window and watermark."""
    return _windows(S.every_epoch(spark, _hashtags(spark, sf, "append"), S.WINDOW_SCHEMA))


def q_hashtags_5m_batch(spark: SparkSession, sf: str) -> DataFrame:
    statuses = B.hashtag_events(spark, sf)
    return _windows(S.hashtag_top_windows(statuses, PARAMS["window"], PARAMS["slide"], PARAMS["top_k"]))


def q_stream_popular_word(spark: SparkSession, sf: str) -> DataFrame:
    out = _conversations(spark, sf, S.run_popular_words, "words", k=PARAMS["top_k"])
    return S.latest(spark, out).select("word", "count")


def q_stream_avg_length(spark: SparkSession, sf: str) -> DataFrame:
    out = _conversations(spark, sf, S.run_avg_length, "length")
    return S.latest(spark, out).select(_rd("avg_length").alias("avg_length"), "n")


# --- text formats -------------------------------------------------------------------------
# Each writes a table in one of the original formats, reads it back and computes on that.

def q_text_comma_people(spark: SparkSession, sf: str) -> DataFrame:
    people_rows = B.people(spark, sf).select("id", "name", "age", "friends")
    path = text_tables.write_delimited(people_rows, text_tables.round_trip(spark, "people"))
    return aggregates.avg_by_key(readers.read_people(spark, path), key="age", value="friends")


def q_text_comma_stations(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.station_readings(spark, sf).select("station", F.lit("18000101").alias("date"), "type", "value")
    path = text_tables.write_delimited(rows, text_tables.round_trip(spark, "stations"))
    found = text_tables.checked_rows(readers.read_text(spark, path), readers.STATION_SCHEMA)
    out = aggregates.extreme_by_key(found.rows, entry_type=PARAMS["station_entry_type"])
    return out.select(F.col("station").cast("long").alias("station"), "extreme")


def q_text_tab_ratings(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.rating_lines(spark, sf).select("user", "item", "rating", F.lit(881250949).alias("ts"))
    path = text_tables.write_delimited(rows, text_tables.round_trip(spark, "ratings"), sep="\t")
    return aggregates.rating_histogram(readers.read_ratings(spark, path))


def q_text_pipe_genres(spark: SparkSession, sf: str) -> DataFrame:
    path = text_tables.write_titles(B.titles_with_genres(spark, sf), text_tables.round_trip(spark, "items"),
                                    flags=B.REGIONS + B.NATIONS)
    return readers.read_genres(spark, path, flags=B.REGIONS + B.NATIONS)


def q_text_adjacency_connections(spark: SparkSession, sf: str) -> DataFrame:
    path = text_tables.write_adjacency(B.graph_edges(spark, sf), text_tables.round_trip(spark, "graph"))
    return ranking.connection_totals(readers.adjacency_line_counts(readers.read_text(spark, path)))


def q_text_adjacency_edges(spark: SparkSession, sf: str) -> DataFrame:
    path = text_tables.write_adjacency(B.graph_edges(spark, sf), text_tables.round_trip(spark, "graph"))
    return readers.read_adjacency(spark, path).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def q_text_quoted_names(spark: SparkSession, sf: str) -> DataFrame:
    path = text_tables.write_quoted_names(B.vertex_names(spark, sf), text_tables.round_trip(spark, "names"))
    return readers.read_quoted_names(spark, path)


def q_text_labeled_points(spark: SparkSession, sf: str) -> DataFrame:
    path = text_tables.write_delimited(B.regression_points(spark, sf), text_tables.round_trip(spark, "points"))
    points = readers.read_labeled_points(spark, path)
    w, _ = ml.sgd_linear_regression(points, iterations=1, step=1.0, reg=0.1)
    return ml.rmse(ml.predict_linear(points, w)).select(_rd("rmse").alias("rmse"), "n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "customer_spend": q_customer_spend,
    "rating_histogram": q_rating_histogram,
    "word_count_space": q_word_count_space,
    "sql_age_range": q_sql_age_range,
    "people_select_name": q_people_select_name,
    "people_under_21": q_people_under_21,
    "people_plus_10": q_people_plus_10,
    "people_count_by_age": q_people_count_by_age,
    "word_count_regex": q_word_count_regex,
    "word_count_stop_sorted": q_word_count_stop_sorted,
    "avg_by_key": q_avg_by_key,
    "extreme_by_station": q_extreme_by_station,
    "extreme_fahrenheit": q_extreme_fahrenheit,
    "item_popularity": q_item_popularity,
    "top10_items": q_top10_items,
    "top10_item_names": q_top10_item_names,
    "top10_items_strict": q_top10_items_strict,
    "connection_totals": q_connection_totals,
    "top_connected": q_top_connected,
    "top10_connected": q_top10_connected,
    "item_similarity": q_item_similarity,
    "item_similarity_strong": q_item_similarity_strong,
    "item_similarity_genres": q_item_similarity_genres,
    "similar_to_item": q_similar_to_item,
    "regression_sgd": q_regression_sgd,
    "regression_sgd_100": q_regression_sgd_100,
    "regression_ridge_two": q_regression_ridge_two,
    "regression_rmse": q_regression_rmse,
    "regression_elastic_net": q_regression_elastic_net,
    "als_recommend": q_als_recommend,
    "als_properties": q_als_properties,
    "recommend_from_factors": q_recommend_from_factors,
    "user_ratings_named": q_user_ratings_named,
    "graph_degrees_top10": q_graph_degrees_top10,
    "graph_build": q_graph_build,
    "graph_build_partial_names": q_graph_build_partial_names,
    "bfs_unreached": q_bfs_unreached,
    "bfs_distances": q_bfs_distances,
    "bfs_vertex_probe": q_bfs_vertex_probe,
    "bfs_named_first100": q_bfs_named_first100,
    "bfs_early_stop": q_bfs_early_stop,
    "kfold_split": q_kfold_split,
    "kfold_files": q_kfold_files,
    "leave_n_out_split": q_leave_n_out_split,
    "leave_n_out_capped": q_leave_n_out_capped,
    "random_split": q_random_split,
    "stream_top_lengths": q_stream_top_lengths,
    "stream_hashtags_5m": q_stream_hashtags_5m,
    "stream_hashtags_final": q_stream_hashtags_final,
    "stream_allowed_words": q_stream_allowed_words,
    "hashtags_5m_batch": q_hashtags_5m_batch,
    "stream_popular_word": q_stream_popular_word,
    "stream_avg_length": q_stream_avg_length,
    "text_comma_people": q_text_comma_people,
    "text_comma_stations": q_text_comma_stations,
    "text_tab_ratings": q_text_tab_ratings,
    "text_pipe_genres": q_text_pipe_genres,
    "text_adjacency_connections": q_text_adjacency_connections,
    "text_adjacency_edges": q_text_adjacency_edges,
    "text_quoted_names": q_text_quoted_names,
    "text_labeled_points": q_text_labeled_points,
}

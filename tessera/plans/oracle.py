"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each string runs on views named after the test tables. Column names and
rounding match ``tessera.plans.catalog``. ``als_recommend`` has no SQL form
(iterative factorisation with random initialisation) and is checked on rows.
"""

from __future__ import annotations

from tessera.functions.hashing import weighted_bucket_sql
from tessera.operators.wordcount import STOP_WORDS
from tessera.plans.catalog import PARAMS, SPLIT_KEYS

RATINGS = """(SELECT o_custkey AS "user", l_suppkey AS item, CAST(ceil(l_quantity / 10) AS INTEGER) AS rating,
  l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag, l_linestatus, l_shipdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

LINE_ORDER = ("l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, "
              "l_tax, l_returnflag, l_linestatus, l_shipdate")

PEOPLE = """(SELECT c_custkey AS id, c_name AS name, CAST(10 + c_custkey % 60 AS INTEGER) AS age,
  CAST(floor(abs(c_acctbal)) AS INTEGER) AS friends, c_mktsegment AS segment FROM customer)"""

# Every line of every document (one final terminator does not start a line).
LINES = r"""(SELECT unnest(CASE WHEN text = '' THEN []::VARCHAR[]
  ELSE regexp_split_to_array(regexp_replace(text, '(?:\r\n|\r|\n)\z', ''), '\r\n|\r|\n') END) AS value
  FROM documents)"""


def _java_split(col: str, regex: str) -> str:
    stripped = f"regexp_replace({col}, '(?:{regex})+\\z', '')"
    return (f"(CASE WHEN {col} = '' THEN [''] WHEN {stripped} = '' THEN []::VARCHAR[] "
            f"ELSE regexp_split_to_array({stripped}, '{regex}') END)")


EDGES = """(SELECT c AS src, p AS dst FROM pairs UNION ALL SELECT p AS src, c AS dst FROM pairs)"""
PAIRS = """pairs AS (SELECT o_custkey * 2 AS c, l_partkey * 2 + 1 AS p
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
NAMES = """(SELECT c_custkey * 2 AS id, c_name AS name FROM customer
  UNION ALL SELECT p_partkey * 2 + 1 AS id, p_name AS name FROM part)"""


def _bfs(root: int, rounds: int, edges: str = EDGES) -> str:
    return f"""WITH RECURSIVE {PAIRS}, e AS {edges},
  walk(id, d) AS (SELECT CAST({root} AS BIGINT), 0 UNION SELECT e.dst, walk.d + 1 FROM walk JOIN e ON e.src = walk.id
                  WHERE walk.d < {rounds}),
  dist AS (SELECT id, CAST(min(d) AS INTEGER) AS distance FROM walk GROUP BY id)"""


def _points(where: str = "", keep: str = "") -> str:
    return f"""stats AS (SELECT avg(l_quantity) AS mx, stddev_pop(l_quantity) AS sx,
  avg(l_extendedprice) AS my, stddev_pop(l_extendedprice) AS sy FROM lineitem),
  pts AS (SELECT {', '.join(SPLIT_KEYS)}, {keep}(l_extendedprice - my) / sy AS label, (l_quantity - mx) / sx AS feature
  FROM lineitem, stats {where})"""


def _leave_n_out(max_test: int) -> str:
    return f"""WITH r AS {RATINGS},
      p AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY {LINE_ORDER}) AS pos FROM r),
      e AS (SELECT *, pos BETWEEN {PARAMS["leave_start"]} AND {PARAMS["leave_stop"]} AS elig FROM p),
      c AS (SELECT *, sum(CASE WHEN elig THEN 1 ELSE 0 END) OVER (ORDER BY {LINE_ORDER}
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS taken FROM e)
      SELECT {_SPLIT_OUT}, CASE WHEN elig AND ({max_test} <= 0 OR taken <= {max_test})
                               THEN 'test' ELSE 'base' END AS role FROM c"""


_SPLIT_OUT = 'l_orderkey, l_linenumber, l_partkey, "user", item, rating'
_BUCKET = weighted_bucket_sql(SPLIT_KEYS, (0.5, 0.5), PARAMS["split_seed"])
_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_ROOT, _TARGET, _ROUNDS = PARAMS["bfs_root"], PARAMS["bfs_target"], PARAMS["stop_rounds"]
# The recursion needs an end; no shortest path of these graphs is as long.
_FAR = 20

HASHTAGS_5M = """WITH t AS (SELECT CAST(floor(epoch(ts)) AS BIGINT) AS bs, '#' || event_type AS hashtag FROM events),
      b AS (SELECT bs, hashtag, count(*) AS c FROM t GROUP BY 1, 2),
      w AS (SELECT bs - k AS window_start, hashtag, sum(c) AS count FROM b, range(0, 300) r(k) GROUP BY 1, 2)
      SELECT window_start, hashtag, count,
             CAST(row_number() OVER (PARTITION BY window_start ORDER BY count DESC, hashtag) AS INTEGER) AS rank
      FROM w QUALIFY rank <= 10"""

SIMILAR = f"""WITH ui AS (SELECT "user", item, avg(rating) AS x FROM {RATINGS} r GROUP BY 1, 2),
      s AS (SELECT a.item AS item1, b.item AS item2, sum(a.x * b.x) AS sxy, sum(a.x * a.x) AS sxx,
                   sum(b.x * b.x) AS syy, count(*) AS n
            FROM ui a JOIN ui b ON a."user" = b."user" AND a.item < b.item GROUP BY 1, 2),
      sc AS (SELECT item1, item2, CASE WHEN sqrt(sxx) * sqrt(syy) = 0 THEN 0.0
                                       ELSE sxy / (sqrt(sxx) * sqrt(syy)) END AS score, n FROM s)"""

GENRES = """(SELECT s_suppkey AS id, s_name AS title,
  CASE WHEN n_nationkey IS NULL THEN 0::BIGINT ELSE (1::BIGINT << n_regionkey) | (1::BIGINT << (n_nationkey + 5)) END AS genres
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)"""


def _epochs(value: str, table: str) -> str:
    """The number of the micro-batch that replays each row of a table."""
    return f"""replay AS (SELECT *, CAST(coalesce(floor(({value} - low) * {PARAMS["epochs"]} / (high - low + 1)), 0) AS INTEGER) AS batch
      FROM {table}, (SELECT min({value}) AS low, max({value}) AS high FROM {table}) ends)"""


# Windows that end by the last watermark, ten minutes before the last event.
HASHTAGS_FINAL = f"""SELECT w.* FROM ({HASHTAGS_5M}) w
      WHERE (window_start + 300) * 1000 <= (SELECT epoch_ms(max(ts)) FROM events) - 600000"""

SQL: dict[str, str] = {
    "customer_spend": """SELECT o_custkey AS customer, round(sum(o_totalprice), 2) AS total_spent
      FROM orders GROUP BY o_custkey ORDER BY total_spent, customer""",
    "rating_histogram": f"""SELECT CAST(rating AS VARCHAR) AS rating, count(*) AS count FROM {RATINGS} r
      GROUP BY 1 ORDER BY 1""",
    "word_count_space": f"""SELECT word, count(*) AS count FROM
      (SELECT unnest({_java_split('value', ' ')}) AS word FROM {LINES} l) t GROUP BY word""",
    "word_count_regex": f"""SELECT word, count(*) AS count FROM
      (SELECT lower(unnest({_java_split('value', chr(92) + 'W+')})) AS word FROM {LINES} l) t GROUP BY word""",
    "word_count_stop_sorted": f"""SELECT lower(word) AS word, count(*) AS count FROM
      (SELECT unnest({_java_split('value', chr(92) + 'W+')}) AS word FROM {LINES} l) t
      WHERE word NOT IN ({_STOP}) GROUP BY lower(word) ORDER BY count, word""",
    "sql_age_range": f"SELECT * FROM {PEOPLE} p WHERE age >= 13 AND age <= 19",
    "people_select_name": f"SELECT name FROM {PEOPLE} p",
    "people_under_21": f"SELECT * FROM {PEOPLE} p WHERE age < 21",
    "people_plus_10": f"SELECT name, age + 10 AS age_plus_10 FROM {PEOPLE} p",
    "people_count_by_age": f"SELECT age, count(*) AS count FROM {PEOPLE} p GROUP BY age",
    "avg_by_key": f"""SELECT age, CAST(sum(friends) AS BIGINT) // count(*) AS avg_friends FROM {PEOPLE} p
      GROUP BY age ORDER BY age""",
    "extreme_by_station": f"""SELECT user_id AS station, max(CAST(floor(value) AS INTEGER)) AS extreme FROM events
      WHERE event_type = '{PARAMS["station_entry_type"]}' GROUP BY user_id ORDER BY station""",
    "extreme_fahrenheit": f"""SELECT user_id AS station,
      round(max(CAST(CAST(floor(value) AS INTEGER) AS DOUBLE) * 0.1 * 1.8 + 32.0), 4) AS extreme FROM events
      WHERE event_type = '{PARAMS["station_entry_type"]}' GROUP BY user_id ORDER BY station""",
    "item_popularity": f"""SELECT item, count(*) AS count FROM {RATINGS} r GROUP BY item ORDER BY count, item""",
    "top10_items": f"""WITH top AS (SELECT item, count(*) AS count FROM {RATINGS} r GROUP BY item
      ORDER BY count DESC, item LIMIT 10)
      SELECT item, count, s_name AS title FROM top LEFT JOIN supplier ON item = s_suppkey
      ORDER BY count DESC, item""",
    "top10_item_names": f"""WITH top AS (SELECT item, count(*) AS n FROM {RATINGS} r GROUP BY item
      ORDER BY n DESC, item LIMIT 10)
      SELECT item, s_name AS title FROM top JOIN supplier ON item = s_suppkey ORDER BY n DESC, item""",
    "top_connected": f"""WITH {PAIRS}, e AS {EDGES},
      tot AS (SELECT src AS id, count(*) AS connections FROM e GROUP BY src),
      best AS (SELECT * FROM tot ORDER BY connections DESC, id DESC LIMIT 1)
      SELECT best.id, min(n.name) AS name, best.connections FROM best JOIN {NAMES} n ON n.id = best.id
      GROUP BY best.id, best.connections""",
    "top10_connected": f"""WITH {PAIRS}, e AS {EDGES},
      tot AS (SELECT src AS id, count(*) AS connections FROM e GROUP BY src)
      SELECT tot.id, n.name, tot.connections FROM tot JOIN {NAMES} n ON n.id = tot.id
      ORDER BY connections DESC, tot.id, n.name LIMIT 10""",
    "graph_degrees_top10": f"""WITH {PAIRS}, e AS {EDGES},
      deg AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM e UNION ALL SELECT dst FROM e) x GROUP BY id)
      SELECT deg.id, n.name, deg.degree FROM deg JOIN {NAMES} n ON n.id = deg.id
      ORDER BY degree DESC, deg.id, n.name LIMIT 10""",
    "item_similarity": f"{SIMILAR} SELECT item1, item2, round(score, 6) AS score, n FROM sc",
    "item_similarity_strong": f"""{SIMILAR} SELECT item1, item2, round(score, 6) AS score, n FROM sc
      WHERE score > {PARAMS["strong_score"]} AND n > {PARAMS["strong_pairs"]}""",
    "item_similarity_genres": f"""{SIMILAR}, g AS {GENRES},
      pair AS (SELECT sc.*, coalesce(a.genres, 0) AS m1, coalesce(b.genres, 0) AS m2
               FROM sc LEFT JOIN g a ON a.id = item1 LEFT JOIN g b ON b.id = item2),
      o AS (SELECT *, CASE WHEN m1 | m2 = 0 THEN 0.0 ELSE bit_count(m1 & m2) / bit_count(m1 | m2) END AS overlap FROM pair)
      SELECT item1, item2, n, round(score, 6) AS score, round(overlap, 6) AS genre_overlap,
             round((1 - {PARAMS["genre_weight"]}::DOUBLE) * score + {PARAMS["genre_weight"]}::DOUBLE * overlap, 6) AS boosted FROM o""",
    "similar_to_item": f"""WITH ui AS (SELECT "user", item, avg(rating) AS x FROM {RATINGS} r GROUP BY 1, 2),
      t AS (SELECT "user", x FROM ui WHERE item = {PARAMS["similar_item"]}),
      s AS (SELECT ui.item, sum(t.x * ui.x) AS sxy, sum(t.x * t.x) AS sxx, sum(ui.x * ui.x) AS syy, count(*) AS n
            FROM ui JOIN t ON ui."user" = t."user" WHERE ui.item <> {PARAMS["similar_item"]} GROUP BY ui.item),
      sc AS (SELECT item, CASE WHEN sqrt(sxx) * sqrt(syy) = 0 THEN 0.0 ELSE sxy / (sqrt(sxx) * sqrt(syy)) END AS score, n
             FROM s),
      top AS (SELECT * FROM sc WHERE score > {PARAMS["min_score"]} AND n > {PARAMS["min_pairs"]}
              ORDER BY score DESC, n DESC, item LIMIT 10)
      SELECT item, s_name AS title, round(score, 6) AS score, n FROM top LEFT JOIN supplier ON item = s_suppkey
      ORDER BY top.score DESC, n DESC, item""",
    "regression_sgd": f"""WITH {_points()}
      SELECT round(avg(label * feature), 6) AS weight, 1 AS iterations FROM pts""",
    "regression_sgd_100": f"""WITH RECURSIVE {_points()},
      m AS (SELECT avg(feature * feature) AS a, avg(label * feature) AS b FROM pts),
      it(t, w, done) AS (
        SELECT 0, 0::DOUBLE, false
        UNION ALL
        SELECT t, w, t > 1 AND abs(w - old) < 1e-7 * greatest(abs(w), 1.0) FROM (
          SELECT t + 1 AS t, w AS old, w * (1 - 0.3 / sqrt(t + 1) * 0.1) - 0.3 / sqrt(t + 1) * (a * w - b) AS w
          FROM it, m WHERE NOT done AND t < 100))
      SELECT round(w, 6) AS weight, t AS iterations FROM it ORDER BY t DESC LIMIT 1""",
    "regression_ridge_two": f"""WITH {_points(keep="l_discount, ")},
      m AS (SELECT avg(label) AS my, avg(feature) AS m1, avg(l_discount) AS m2, stddev_pop(label) AS sy,
                   stddev_pop(feature) AS s1, stddev_pop(l_discount) AS s2, count(*) AS n,
                   covar_pop(feature, label) / (stddev_pop(feature) * stddev_pop(label)) AS r1,
                   covar_pop(l_discount, label) / (stddev_pop(l_discount) * stddev_pop(label)) AS r2,
                   covar_pop(feature, l_discount) / (stddev_pop(feature) * stddev_pop(l_discount)) AS r12 FROM pts),
      c AS (SELECT *, 1 + 0.3 / sy AS q FROM m),
      w AS (SELECT *, (q * r1 - r12 * r2) / (q * q - r12 * r12) * sy / s1 AS w1,
                      (q * r2 - r12 * r1) / (q * q - r12 * r12) * sy / s2 AS w2 FROM c),
      f AS (SELECT *, my - w1 * m1 - w2 * m2 AS w0 FROM w)
      SELECT round(any_value(w1), 6) AS w_quantity, round(any_value(w2), 6) AS w_discount,
             round(any_value(w0), 6) AS intercept, count(*) AS n,
             round(sqrt(avg(power(w1 * feature + w2 * l_discount + w0 - label, 2))), 6) AS rmse FROM pts, f""",
    "als_properties": """SELECT least(10, count(*)) AS items, least(10, count(*)) AS titled, true AS better_than_mean,
             true AS solves_normal_equation
      FROM supplier""",
    "recommend_from_factors": f"""WITH me AS (SELECT embedding AS v FROM embeddings WHERE vec_id = {PARAMS["rating_user"]}),
      s AS (SELECT vec_id AS item, list_dot_product(embedding::DOUBLE[], v::DOUBLE[]) AS score FROM embeddings, me),
      top AS (SELECT * FROM s ORDER BY score DESC, item LIMIT 10)
      SELECT CAST({PARAMS["rating_user"]} AS BIGINT) AS "user", item, s_name AS title, round(score, 4) AS score
      FROM top LEFT JOIN supplier ON item = s_suppkey""",
    "top10_items_strict": f"""WITH top AS (SELECT item, count(*) AS count FROM {RATINGS} r GROUP BY item
      ORDER BY count DESC, item LIMIT 10)
      SELECT item, count, s_name AS title FROM top JOIN supplier ON item = s_suppkey""",
    "connection_totals": """WITH l AS (SELECT o_custkey * 2 AS id, o_orderkey, count(*) AS connections
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
      SELECT id, CAST(sum(connections) AS BIGINT) AS connections FROM l GROUP BY id""",
    "regression_rmse": f"""WITH {_points()}, w AS (SELECT avg(label * feature) AS w FROM pts)
      SELECT round(sqrt(avg(power(w * feature - label, 2))), 6) AS rmse, count(*) AS n FROM pts, w""",
    "regression_elastic_net": f"""WITH {_points()},
      sp AS (SELECT *, {_BUCKET} AS split FROM pts),
      tr AS (SELECT avg(feature) AS mx, stddev_pop(feature) AS sx, avg(label) AS my, stddev_pop(label) AS sy,
                    covar_pop(feature, label) AS cxy FROM sp WHERE split = 0),
      c AS (SELECT *, cxy / (sx * sy) AS corr, 0.3 / sy AS lam FROM tr),
      w AS (SELECT *, sign(corr) * greatest(abs(corr) - lam * 0.8, 0) / (1 + lam * 0.2) * sy / sx AS coef FROM c)
      SELECT round(coef * feature + (my - coef * mx), 4) AS prediction, round(label, 6) AS label
      FROM sp, w WHERE split = 1""",
    "user_ratings_named": f"""SELECT "user", item, rating, s_name AS title FROM {RATINGS} r
      LEFT JOIN supplier ON item = s_suppkey WHERE "user" = {PARAMS["rating_user"]}""",
    "bfs_distances": f"""{_bfs(_ROOT, _FAR)} SELECT id, distance FROM dist""",
    "bfs_vertex_probe": f"""{_bfs(_ROOT, _FAR)}
      SELECT dist.id, n.name, dist.distance FROM dist LEFT JOIN {NAMES} n ON n.id = dist.id
      WHERE dist.id = {_TARGET}""",
    "bfs_named_first100": f"""{_bfs(_ROOT, _FAR)},
      v AS (SELECT id FROM {NAMES} n UNION SELECT src FROM e),
      names AS (SELECT id, min(name) AS name FROM {NAMES} n GROUP BY id)
      SELECT v.id, coalesce(names.name, 'Nobody') AS name, coalesce(dist.distance::DOUBLE, 'Infinity'::DOUBLE) AS distance
      FROM v LEFT JOIN names USING (id) LEFT JOIN dist USING (id) ORDER BY v.id LIMIT 100""",
    "bfs_unreached": f"""{_bfs(2 * PARAMS["rating_user"], _FAR, "(SELECT c AS src, p AS dst FROM pairs)")},
      v AS (SELECT id FROM {NAMES} n UNION SELECT src FROM e UNION SELECT dst FROM e)
      SELECT v.id, coalesce(dist.distance::DOUBLE, 'Infinity'::DOUBLE) AS distance FROM v LEFT JOIN dist USING (id)""",
    "graph_build": f"""WITH {PAIRS}, e AS {EDGES}, n AS {NAMES},
      names AS (SELECT id, min(name) AS name FROM n GROUP BY id),
      v AS (SELECT id FROM n UNION SELECT src FROM e)
      SELECT v.id, coalesce(names.name, 'Nobody') AS name FROM v LEFT JOIN names USING (id)""",
    "graph_build_partial_names": f"""WITH {PAIRS}, e AS {EDGES}, n AS (SELECT c_custkey * 2 AS id, c_name AS name FROM customer),
      v AS (SELECT id FROM n UNION SELECT src FROM e)
      SELECT v.id, coalesce(n.name, 'Nobody') AS name FROM v LEFT JOIN n USING (id)""",
    "bfs_early_stop": f"""{_bfs(_ROOT, _ROUNDS)},
      rounds AS (SELECT CAST(r AS INTEGER) AS r FROM range(1, {_ROUNDS + 1}) t(r)),
      per AS (SELECT r AS round,
        (SELECT count(*) FROM dist WHERE distance = r - 1) AS frontier,
        (SELECT count(*) FROM e JOIN dist ON e.src = dist.id WHERE distance = r - 1) AS edges_out,
        (SELECT count(*) FROM e JOIN dist ON e.src = dist.id WHERE distance = r - 1 AND e.dst = {_TARGET}) AS hits
        FROM rounds),
      stop AS (SELECT coalesce(min(round), {_ROUNDS}) AS s FROM per WHERE hits > 0)
      SELECT round, frontier, edges_out, hits FROM per, stop WHERE round <= s""",
    "kfold_split": f"""WITH r AS {RATINGS}, b AS (SELECT CAST(ceil(count(*) / {PARAMS["kfolds"]}.0) AS BIGINT) AS blk FROM r)
      SELECT {_SPLIT_OUT}, CAST((row_number() OVER (ORDER BY {LINE_ORDER}) - 1) // blk AS INTEGER) AS fold
      FROM r, b""",
    "kfold_files": f"""WITH r AS {RATINGS}, b AS (SELECT CAST(ceil(count(*) / {PARAMS["kfolds"]}.0) AS BIGINT) AS blk FROM r),
      f AS (SELECT {_SPLIT_OUT}, CAST((row_number() OVER (ORDER BY {LINE_ORDER}) - 1) // blk AS INTEGER) AS fold FROM r, b)
      SELECT {_SPLIT_OUT}, CAST(s AS INTEGER) AS split, CASE WHEN s = fold THEN 'test' ELSE 'base' END AS role
      FROM f, range(0, {PARAMS["kfolds"]}) t(s)""",
    "leave_n_out_split": _leave_n_out(0),
    "leave_n_out_capped": _leave_n_out(PARAMS["leave_max_test"]),
    "random_split": f"""SELECT {_SPLIT_OUT}, {_BUCKET} AS split FROM {RATINGS} r""",
    "stream_top_lengths": f"""WITH {_epochs("conv_id", "conversations")}
      SELECT batch, CAST(row_number() OVER (PARTITION BY batch ORDER BY length(text) DESC) AS INTEGER) AS rank,
             CAST(length(text) AS INTEGER) AS length FROM replay QUALIFY rank <= 10""",
    "stream_allowed_words": rf"""WITH {_epochs("conv_id", "conversations")},
      w AS (SELECT batch, unnest(regexp_split_to_array(lower(text), '[ \t\n\r\f]+')) AS word FROM replay),
      c AS (SELECT batch, word, count(*) AS count FROM w WHERE word <> '' AND word NOT IN
              (SELECT lower(x) FROM (SELECT unnest([{_STOP}]) AS x) s) GROUP BY batch, word)
      SELECT batch, word, count, CAST(row_number() OVER (PARTITION BY batch ORDER BY count DESC, word) AS INTEGER) AS rank
      FROM c QUALIFY rank <= 10""",
    "stream_hashtags_5m": HASHTAGS_5M,
    "hashtags_5m_batch": HASHTAGS_5M,
    "stream_hashtags_final": HASHTAGS_FINAL,
    "stream_popular_word": r"""SELECT word, count(*) AS count FROM
      (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS word FROM conversations) t
      WHERE word <> '' GROUP BY word ORDER BY count DESC, word LIMIT 10""",
    "stream_avg_length": """SELECT round(avg(length(text)), 6) AS avg_length, count(*) AS n FROM conversations""",
}

# The text formats give the results of the tables they were written from.
SQL |= {
    "text_comma_people": SQL["avg_by_key"],
    "text_comma_stations": SQL["extreme_by_station"],
    "text_tab_ratings": SQL["rating_histogram"],
    "text_pipe_genres": f"SELECT * FROM {GENRES} g",
    "text_adjacency_connections": f"""WITH {PAIRS}, e AS {EDGES}
      SELECT src AS id, count(*) AS connections FROM e GROUP BY src""",
    "text_adjacency_edges": f"""WITH {PAIRS}, e AS {EDGES} SELECT src, dst, count(*) AS n FROM e GROUP BY src, dst""",
    "text_quoted_names": f"SELECT * FROM {NAMES} n",
    "text_labeled_points": SQL["regression_rmse"],
}

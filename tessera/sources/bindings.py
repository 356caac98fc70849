"""Bindings of the driver's parquet tables to the operators' inputs.

The original programs read files that are not shipped (ratings, titles, a
book, weather readings, orders, a co-appearance graph, a tweet stream). Each
binding below derives the same shape from the test tables, lazily, so every
registered query's work grows with the tables. Column pruning and filters
reach the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import text_lines
from tessera.session import is_directory

# Lineitem order used wherever "file order" matters (splits). The key pair is
# not unique, so every remaining column breaks ties.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rating_lines(spark: SparkSession, sf_dir: str, keep_order_cols: bool = False) -> DataFrame:
    """One rating per order line: user = customer, item = supplier,
    rating = ceil(quantity / 10) in 1..5."""
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cols = [F.col("o_custkey").alias("user"), F.col("l_suppkey").alias("item"),
            F.ceil(F.col("l_quantity") / 10).cast("int").alias("rating")]
    if keep_order_cols:
        cols += [F.col(c) for c in LINE_ORDER]
    return li.join(orders, li.l_orderkey == orders.o_orderkey).select(*cols)


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item names: ``(id, title)`` from the supplier table."""
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"))


REGIONS, NATIONS = 5, 25


def titles_with_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, title, genres)``: an item's genres are its region (bits 0 to 4) and
    its nation (bits 5 to 29), so items of one nation share both and items of
    one region share one."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey"))
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    one = F.lit(1).cast("long")
    mask = F.call_function("shiftleft", one, F.col("n_regionkey")).bitwiseOR(
        F.call_function("shiftleft", one, F.col("n_nationkey") + REGIONS))
    return s.join(n, "n_nationkey", "left").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"), F.coalesce(mask, F.lit(0).cast("long")).alias("genres"))


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(customer, amount)`` from orders."""
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer"),
                                                 F.col("o_totalprice").alias("amount"))


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, name, age, friends)``: age = 10 + custkey mod 60, friends = floor(|balance|)."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        (F.lit(10) + F.pmod(F.col("c_custkey"), F.lit(60))).cast("int").alias("age"),
        F.floor(F.abs(F.col("c_acctbal"))).cast("int").alias("friends"),
        F.col("c_mktsegment").alias("segment"),
    )


def station_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(station, type, value)``: station = user, type = event type, value truncated to int."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("station"), F.col("event_type").alias("type"),
                    F.floor(F.col("value")).cast("int").alias("value"))


def book_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document, whole texts: ``value STRING``."""
    d = table(spark, sf_dir, "documents").select("text")
    return d.select(F.explode(text_lines(F.col("text"))).alias("value"))


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer-part co-appearance graph, both directions, parallel edges kept.

    Vertex ids: customers 2*custkey, parts 2*partkey+1. One edge pair per
    order line.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    pairs = li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        (F.col("o_custkey") * 2).alias("c"), (F.col("l_partkey") * 2 + 1).alias("p"))
    return pairs.select(F.explode(F.array(
        F.struct(F.col("c").alias("src"), F.col("p").alias("dst")),
        F.struct(F.col("p").alias("src"), F.col("c").alias("dst")))).alias("e")).select("e.src", "e.dst")


def vertex_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, name)`` for every customer and part vertex (part names repeat; ids do not)."""
    c = table(spark, sf_dir, "customer").select((F.col("c_custkey") * 2).alias("id"), F.col("c_name").alias("name"))
    p = table(spark, sf_dir, "part").select((F.col("p_partkey") * 2 + 1).alias("id"), F.col("p_name").alias("name"))
    return c.unionByName(p)


def customer_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, name)`` of the customer vertices only: a name table that lacks
    vertices, as parts are known by their edges alone."""
    return table(spark, sf_dir, "customer").select((F.col("c_custkey") * 2).alias("id"), F.col("c_name").alias("name"))


def directed_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst)`` from customers to parts only, one edge per order line."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        (F.col("o_custkey") * 2).alias("src"), (F.col("l_partkey") * 2 + 1).alias("dst"))


def order_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, connections)``, one row per order: its customer's vertex and the
    number of parts on the order (the per-line counts of an adjacency file)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = li.join(orders, li.l_orderkey == orders.o_orderkey)
    return lines.groupBy((F.col("o_custkey") * 2).alias("id"), "o_orderkey").agg(
        F.count(F.lit(1)).alias("connections")).select("id", "connections")


def regression_points(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """``(label, feature)`` and the columns ``keep``: standardised extended price
    against standardised quantity.

    The population moments come back as one aggregate row (a scalar, not
    data), then every row is scaled JVM-side.
    """
    li = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice", *keep)
    m = li.agg(F.avg("l_quantity").alias("mx"), F.stddev_pop("l_quantity").alias("sx"),
               F.avg("l_extendedprice").alias("my"), F.stddev_pop("l_extendedprice").alias("sy")).first()
    return li.select(
        *keep,
        ((F.col("l_extendedprice") - F.lit(m["my"])) / F.lit(m["sy"])).alias("label"),
        ((F.col("l_quantity") - F.lit(m["mx"])) / F.lit(m["sx"])).alias("feature"),
    )


def _table_stream(spark: SparkSession, sf_dir: str, name: str, schema) -> DataFrame:
    """A file stream over one table of the folder: the part files of a table
    that is a folder, or the single file of that name. New files are picked up
    as they arrive."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    reader = spark.readStream.schema(schema)
    if is_directory(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir.rstrip("/"))


def hashtag_events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """``(ts TIMESTAMP, text)`` with one hashtag per event: ``#<event_type>``.

    The parquet timestamp has no zone (TIMESTAMP_NTZ); watermarks need
    TIMESTAMP, so it is cast (session zone UTC).
    """
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    if stream:
        schema = table(spark, sf_dir, "events").schema
        src = _table_stream(spark, sf_dir, "events", schema)
    else:
        src = spark.read.parquet(path)
    return src.select(F.col("ts").cast("timestamp").alias("ts"),
                      F.concat(F.lit("#"), F.col("event_type")).alias("text"))


def conversation_texts(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """``(conv_id, turn, text)`` status-like texts."""
    path = f"{sf_dir.rstrip('/')}/conversations.parquet"
    if stream:
        schema = table(spark, sf_dir, "conversations").schema
        src = _table_stream(spark, sf_dir, "conversations", schema)
    else:
        src = spark.read.parquet(path)
    return src.select("conv_id", "turn", "text")

"""Regression and collaborative filtering.

* ``sgd_linear_regression``: least squares by full-batch gradient descent
  with an L2 updater, no intercept (the update rule of the classic MLlib
  trainer). For squared loss the gradient is ``A w - b`` with the second
  moments ``A = avg(x x')`` and ``b = avg(x y)``, so one aggregate over the
  points serves all iterations; only d * (d + 3) / 2 moments travel.
* ``elastic_net``: ``pyspark.ml.regression.LinearRegression``.
* ``als_recommend``: ``pyspark.ml.recommendation.ALS``; one user's items are
  scored by a dot product with the user's factor vector (no cross join).
"""

from __future__ import annotations

import gc
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ranking import lookup_names
from tessera.session import checkpoint_root, materialize

FEW_RATINGS = 1_000_000
# Ratings of one ALS block: 8 bytes each, about 50 while it is made, and beside
# it the other side's factors of all ids in it.
BLOCK_RATINGS = 6_000_000
DISK_RATINGS = 10_000_000  # from so many on, what an iteration reads again is kept on disk
SPLIT_BYTES = 16 << 20  # of ratings that one task deals to the blocks
BROADCAST_FACTORS = 8_000_000  # numbers of a factor table that is broadcast at most


def sgd_weights(points: DataFrame, features: list[str], iterations: int = 100, step: float = 1.0,
                reg: float = 0.01, tol: float = 0.001, label: str = "label") -> tuple[list[float], int]:
    """Fit ``y ~ w . x`` (no intercept) for a vector of features. Returns
    ``(w, iterations_run)``.

    Iteration t: ``w <- w * (1 - eta*reg) - eta * mean((w.x - y) * x)`` with
    ``eta = step / sqrt(t)``; from the second iteration on, stop when
    ``|w_t - w_(t-1)| < tol * max(|w_t|, 1)`` (Euclidean norms).
    """
    x = [F.col(f).cast("double") for f in features]
    y, d = F.col(label).cast("double"), len(features)
    cells = {(i, j): F.avg(x[i] * x[j]) for i in range(d) for j in range(i, d)}
    row = points.agg(*[c.alias(f"a{i}_{j}") for (i, j), c in cells.items()],
                     *[F.avg(x[i] * y).alias(f"b{i}") for i in range(d)]).first()
    moment = [[row[f"a{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(d)] for i in range(d)]
    cross = [row[f"b{i}"] or 0.0 for i in range(d)]
    w, run = [0.0] * d, 0
    for t in range(1, int(iterations) + 1):
        eta = step / math.sqrt(t)
        gradient = [sum(a * v for a, v in zip(moment[i], w)) - cross[i] for i in range(d)]
        new = [v * (1.0 - eta * reg) - eta * g for v, g in zip(w, gradient)]
        run = t
        moved = math.dist(new, w)
        w = new
        if t > 1 and moved < tol * max(math.hypot(*w), 1.0):
            break
    return w, run


def sgd_linear_regression(points: DataFrame, iterations: int = 100, step: float = 1.0, reg: float = 0.01,
                          tol: float = 0.001, label: str = "label", feature: str = "feature") -> tuple[float, int]:
    """``sgd_weights`` for one feature: ``(w, iterations_run)``."""
    w, run = sgd_weights(points, [feature], iterations, step, reg, tol, label)
    return w[0], run


def predict_linear(points: DataFrame, w: float, label: str = "label", feature: str = "feature",
                   intercept: float = 0.0) -> DataFrame:
    """``(prediction, label, squared_error)`` for each point."""
    pred = F.lit(w) * F.col(feature) + F.lit(intercept)
    return points.select(pred.alias("prediction"), F.col(label).alias("label"),
                         F.pow(pred - F.col(label), 2).alias("squared_error"))


def rmse(predictions: DataFrame) -> DataFrame:
    """One row ``(rmse, n)`` from a predictions table."""
    return predictions.agg(F.sqrt(F.avg("squared_error")).alias("rmse"), F.count(F.lit(1)).alias("n"))


def elastic_net(train: DataFrame, test: DataFrame, reg: float = 0.3, mixing: float = 0.8, max_iter: int = 100,
                tol: float = 1e-6, label: str = "label", features=("feature",)):
    """Fit on ``train``, return ``(model, test predictions (prediction, label))``."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    lr = LinearRegression(featuresCol="features", labelCol=label, regParam=reg, elasticNetParam=mixing,
                          maxIter=max_iter, tol=tol)
    model = lr.fit(assembler.transform(train))
    pred = model.transform(assembler.transform(test)).select("prediction", F.col(label).alias("label"))
    return model, pred


INT32 = (-(2 ** 31), 2 ** 31 - 1)


def dense_ids(df: DataFrame, col: str, out: str) -> DataFrame:
    """``(col, out)``: a dense 0-based 32-bit index of the distinct values of
    ``col`` in ascending order (distributed numbering, no driver collect)."""
    from tessera.operators.splits import numbered_rows

    ids, _ = numbered_rows(df.select(col).distinct(), [col], "_rn")
    return ids.select(col, (F.col("_rn") - 1).cast("int").alias(out))


def als_blocks(cores: int, ratings: int, users: int, items: int) -> tuple[int, int]:
    """Factor blocks of users and of items: one per core, more where a block
    would hold too many ratings. In every iteration each user's factors go to
    all blocks with items of theirs, and the other way round, so that is what
    is shuffled; the side with fewer ids has a third of the blocks, unless the
    ratings are so few that it does not matter."""
    most = max(1, cores, -(-ratings // BLOCK_RATINGS))
    if ratings < FEW_RATINGS:
        return most, most
    few = max(-(-most // 3), -(-ratings // BLOCK_RATINGS), 1)
    return (most, few) if items < users else (few, most)


def fit_als(ratings: DataFrame, rank: int = 8, max_iter: int = 20, reg: float = 0.01, seed: int = 42,
            user: str = "user", item: str = "item", rating: str = "rating", blocks: int | None = None):
    """``(model, data, users, items)``: an ALS model, the ratings it was fitted
    on, and the index tables when ids were re-indexed (else None).

    Factor blocks are checkpointed to the shared folder every 10 iterations,
    from a million ratings on in each: the shuffle files of the iterations since
    the last checkpoint, which hold each id's factors once for each block, stay
    until the next. From ``DISK_RATINGS`` on, rating blocks are kept on disk, as
    in memory they would leave too little of it to the tasks.
    ALS takes 32-bit ids: when the keys do not fit, users and items are
    re-indexed densely first (joins with the index tables).
    """
    from pyspark.ml.recommendation import ALS

    checkpoint_root(ratings.sparkSession)
    # Written once: the fit and what is asked of its ratings later read it again.
    base = materialize(ratings.select(F.col(user).cast("long").alias("user"), F.col(item).cast("long").alias("item"),
                                      F.col(rating).cast("float").alias("rating")), "als-ratings", free=True)
    known = base.agg(F.min("user").alias("u0"), F.max("user").alias("u1"), F.min("item").alias("i0"),
                     F.max("item").alias("i1"), F.count(F.lit(1)).alias("n"), F.approx_count_distinct("user").alias("users"),
                     F.approx_count_distinct("item").alias("items")).first()
    fits = all(INT32[0] <= known[c] <= INT32[1] for c in ("u0", "u1", "i0", "i1") if known[c] is not None)
    users = items = None
    if fits:
        data = base.select(F.col("user").cast("int").alias("user"), F.col("item").cast("int").alias("item"), "rating")
    else:
        users, items = dense_ids(base, "user", "uid"), dense_ids(base, "item", "iid")
        data = materialize(base.join(users, "user").join(items, "item").select(
            F.col("uid").alias("user"), F.col("iid").alias("item"), "rating"), "als-dense-ratings", free=True)
    user_blocks, item_blocks = (blocks, blocks) if blocks else als_blocks(
        ratings.sparkSession.sparkContext.defaultParallelism, known["n"], known["users"], known["items"])
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, userCol="user", itemCol="item", ratingCol="rating",
              seed=seed, coldStartStrategy="drop", checkpointInterval=10 if known["n"] < FEW_RATINGS else 1,
              numUserBlocks=user_blocks, numItemBlocks=item_blocks)
    if known["n"] >= DISK_RATINGS:
        als = als.setIntermediateStorageLevel("DISK_ONLY").setFinalStorageLevel("DISK_ONLY")
    conf = ratings.sparkSession.conf
    before = conf.get(SPLITS, None)
    conf.set(SPLITS, str(SPLIT_BYTES))
    try:
        return als.fit(data), data, users, items
    finally:
        conf.unset(SPLITS) if before is None else conf.set(SPLITS, before)


SPLITS = "spark.sql.files.maxPartitionBytes"


def _written_factors(model) -> tuple[DataFrame, DataFrame]:
    """The factor tables ``(id, features)`` of users and items, written. Nothing
    reads the model after that: once the caller drops it, ``_free_dropped`` has
    the blocks and shuffle files that it was fitted with deleted."""
    return materialize(model.userFactors, "als-user-factors"), materialize(model.itemFactors, "als-item-factors")


def _free_dropped(spark) -> None:
    """Have Spark delete the files of what the driver no longer refers to."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def squared_errors(data: DataFrame, user_factors: DataFrame, item_factors: DataFrame, rank: int) -> DataFrame:
    """``(e)``: the squared error of each rating's prediction, the dot product of
    its factors. A rating without a prediction has no row. Ratings meet the larger
    factor table first and the smaller one is broadcast if it is small enough, so
    that they are not shuffled with factors beside them."""
    sides = sorted(((factors.count(), key, name, factors.select(F.col("id").alias(key), F.col("features").alias(name)))
                    for factors, key, name in ((user_factors, "user", "w"), (item_factors, "item", "v"))), reverse=True)
    (_, large_key, _, large), (rows, small_key, _, small) = sides
    if rows * rank <= BROADCAST_FACTORS:
        small = F.broadcast(small)
    both = data.join(large, large_key).join(small, small_key)
    dot = sum((F.get("v", F.lit(k)).cast("double") * F.get("w", F.lit(k)) for k in range(rank)), F.lit(0.0))
    return both.select(F.pow(dot - F.col("rating"), 2).alias("e")).filter(~F.isnan("e"))


def als_recommend(ratings: DataFrame, titles: DataFrame, user_id: int, k: int = 10, **fit) -> DataFrame:
    """Top-k items for one user from an ALS factorisation: ``(user, item, title,
    score)``. Already rated items are not removed (as in the original). ``fit``
    as in ``fit_als``."""
    model, _, users, items = fit_als(ratings, **fit)
    factors = _written_factors(model)
    del model
    _free_dropped(ratings.sparkSession)
    return _recommend(*factors, users, items, titles, user_id, k)


def _recommend(user_factors: DataFrame, item_factors: DataFrame, users, items, titles: DataFrame, user_id: int,
               k: int) -> DataFrame:
    target = int(user_id)
    if items is not None:
        hit = users.filter(F.col("user") == F.lit(target)).select("uid").first()
        target = int(hit["uid"]) if hit is not None else INT32[1]
        item_factors = item_factors.join(items.select(F.col("iid").alias("id"), F.col("item").alias("_orig")), "id") \
                                   .select(F.col("_orig").alias("id"), "features")
    return recommend_for_user(user_factors, item_factors, titles, int(user_id), k, factor_id=target)


def normal_equation_residual(data: DataFrame, user_factors: DataFrame, item_factors: DataFrame, user_id: int,
                             reg: float) -> DataFrame:
    """One row ``(residual, n)``: how far a user's factors are from solving the
    least-squares problem that the item factors pose for them.

    For ratings r of items with factors v, the user's vector w solves
    sum(v (v.w - r)) + reg * n * w = 0. The left side is summed over the user's
    ratings, one sum per component, and the greatest absolute component per
    rating is the residual. A solver's last half step makes it zero but for
    rounding; no other vector does."""
    mine = data.filter(F.col("user") == F.lit(int(user_id))).join(
        item_factors.select(F.col("id").alias("item"), F.col("features").alias("v")), "item").join(
        user_factors.filter(F.col("id") == F.lit(int(user_id))).select(F.col("id").alias("user"), F.col("features").alias("w")),
        "user")
    dot = F.aggregate(F.zip_with("v", "w", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, x: s + x)
    parts = mine.withColumn("e", dot - F.col("rating")).select(F.col("e"), "w", F.posexplode("v").alias("k", "vk"))
    sums = parts.groupBy("k").agg(
        (F.sum(F.col("vk").cast("double") * F.col("e"))
         + F.lit(float(reg)) * F.count(F.lit(1)) * F.first(F.get("w", F.col("k"))).cast("double")).alias("g"),
        F.count(F.lit(1)).alias("n"))
    return sums.agg(F.max(F.abs(F.col("g") / F.col("n"))).alias("residual"), F.max("n").alias("n"))


def als_properties(ratings: DataFrame, titles: DataFrame, user_id: int, k: int = 10, **fit) -> DataFrame:
    """One row of what must hold for any good factorisation: distinct items
    recommended, how many have a title, whether the training error is below
    that of predicting the mean rating, and whether the user's factors solve the
    normal equation that the item factors pose (residual below 1e-3)."""
    model, data, users, items = fit_als(ratings, **fit)
    rank = model.rank
    user_factors, item_factors = _written_factors(model)
    del model
    _free_dropped(ratings.sparkSession)
    top = _recommend(user_factors, item_factors, users, items, titles, user_id, k).agg(
        F.count_distinct("item").alias("items"), F.count("title").alias("titled"))
    error = squared_errors(data, user_factors, item_factors, rank).agg(F.sqrt(F.avg("e")).alias("e"))
    spread = data.agg(F.stddev_pop("rating").alias("s"))
    target = int(user_id)
    if users is not None:
        hit = users.filter(F.col("user") == F.lit(target)).select("uid").first()
        target = int(hit["uid"]) if hit is not None else INT32[1]
    residual = normal_equation_residual(data, user_factors, item_factors, target, fit.get("reg", 0.01))
    return top.join(error).join(spread).join(residual).select(
        "items", "titled", (F.col("e") < F.col("s")).alias("better_than_mean"),
        (F.col("residual") < F.lit(1e-3)).alias("solves_normal_equation"))


def recommend_for_user(user_factors: DataFrame, item_factors: DataFrame, titles: DataFrame, user_id: int,
                       k: int = 10, factor_id: int | None = None) -> DataFrame:
    """Top-k items of one user by predicted rating: ``(user, item, title, score)``.

    The user's factor vector has ``rank`` entries (a bounded value, like a
    regression weight), so it is read once and every item is scored by a
    JVM-side dot product: one linear pass over the item factors and a
    per-task top k, instead of the cross join of factor blocks that the
    library's ``recommendForUserSubset`` plans. ``factor_id`` is the user's id
    in the factor table when ids were re-indexed (default: ``user_id``).
    """
    fid = int(user_id if factor_id is None else factor_id)
    row = user_factors.filter(F.col("id") == F.lit(fid)).select("features").first()
    spark = item_factors.sparkSession
    schema = "user long, item long, title string, score float"
    if row is None:
        return spark.createDataFrame([], schema)
    vec = F.array(*[F.lit(float(v)).cast("float") for v in row["features"]])
    dot = F.aggregate(F.zip_with(F.col("features"), vec, lambda a, b: a * b), F.lit(0.0).cast("float"),
                      lambda acc, v: acc + v)
    scored = item_factors.select(F.lit(int(user_id)).cast("long").alias("user"), F.col("id").cast("long").alias("item"),
                                 dot.alias("score"))
    top = scored.orderBy(F.col("score").desc(), F.col("item").asc()).limit(int(k))
    named = lookup_names(top, titles, "item", "id", "title", "left")
    return named.orderBy(F.col("score").desc(), F.col("item").asc()).select("user", "item", "title", "score")


def user_ratings_named(ratings: DataFrame, titles: DataFrame, user_id: int, user: str = "user",
                       item: str = "item", rating: str = "rating") -> DataFrame:
    """One user's ratings with item titles (left join: unknown titles are null)."""
    mine = ratings.filter(F.col(user) == F.lit(user_id)).select(
        F.col(user).alias("user"), F.col(item).alias("item"), F.col(rating).alias("rating"))
    t = titles.select(F.col("id").alias("_id"), "title")
    return mine.join(t, mine["item"] == t["_id"], "left").drop("_id")

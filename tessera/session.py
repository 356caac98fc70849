"""Session construction, the shared checkpoint folder, and lineage cuts.

Operators never build their own session; the caller owns it. ``build_session``
is a convenience for tests, the bench and local runs. On a cluster the job
launcher supplies the session and ``spark.checkpoint.dir`` names the shared
folder (HDFS/S3/ABFS) used to cut lineage and to hold streaming state.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale: AQE re-plans joins from runtime sizes,
# splits skewed shuffle partitions, and coalesces tiny ones; UTC keeps
# timestamp arithmetic identical to the SQL oracle.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the scale settings above."""
    master = master or os.environ.get("TESSERA_MASTER", "local[*]")
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SCALE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring the context if needed.

    Order: a directory already set on the SparkContext, then the session's
    ``spark.checkpoint.dir``. Only a local-mode session (tests, laptop) may fall
    back to a fresh temporary folder; a cluster session without the setting is
    an error, because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_scratch: dict[str, list[str]] = {}  # folders named so far, by application


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (sink tables, cut tables)."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def delete_scratch(spark: SparkSession) -> int:
    """Delete every folder that ``scratch_path`` has named in this application,
    and return their number. Results are lazy and read those folders, so the
    caller does this once what it wanted is written or collected."""
    paths = _scratch.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete_path(spark, path)
    return len(paths)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Used where a result is read several times (sizing statistics, then the
    job) or where lineage must be cut: the data is computed exactly once,
    survives executor loss, and the re-read plan carries real file statistics.
    With ``free`` the shuffle files behind it are deleted once it is written,
    not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    if free:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if free:
            spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    # The schema is known: no footer has to be read to infer it again.
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def partitions_for(df: DataFrame, target_bytes: int = 256 << 20) -> int:
    """Partition count for an explicit repartition of ``df``: about
    ``target_bytes`` per partition from Catalyst's size estimate, never fewer
    than ``spark.sql.shuffle.partitions`` (AQE does not resize explicit
    counts, so a fixed setting would make huge partitions at scale)."""
    base = shuffle_partitions(df.sparkSession)
    size = input_bytes(df)
    if not size or size <= 0:
        return base
    return max(base, -(-size // target_bytes))


def input_bytes(df: DataFrame) -> int | None:
    """Bytes the plan reads: the sum of its leaves' sizes (file sizes for
    scans). The plan-level estimate is not used because without cost-based
    statistics a join's estimate is the product of its inputs' sizes."""
    try:
        unknown = int(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str(2 ** 63 - 1)))
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
        total = 0
        while leaves.hasNext():
            size = int(str(leaves.next().stats().sizeInBytes()))
            if size >= unknown:  # a leaf without statistics (e.g. an RDD)
                return None
            total += size
        return total
    except AttributeError:  # Spark Connect: no JVM plan to ask
        return None


def proven_max_rows(df: DataFrame) -> int | None:
    """Upper bound on the rows of ``df`` that Catalyst can prove from the plan
    (a ``limit``, a global aggregate, a local relation), or None."""
    try:
        bound = df._jdf.queryExecution().optimizedPlan().maxRows()
        return int(bound.get()) if bound.isDefined() else None
    except AttributeError:  # Spark Connect: no JVM plan to ask
        return None


def _filesystem(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def is_directory(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder, asked of the file system it lies in."""
    fs, target = _filesystem(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def make_directory(spark: SparkSession, path: str) -> None:
    fs, target = _filesystem(spark, path)
    fs.mkdirs(target)


def rename_path(spark: SparkSession, path: str, to: str) -> None:
    """Move a file or folder within its file system, in one step where that has one."""
    fs, source = _filesystem(spark, path)
    if not fs.rename(source, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"could not move {path} to {to}")


def create_empty(spark: SparkSession, path: str) -> None:
    """An empty file, replacing one of that name."""
    fs, target = _filesystem(spark, path)
    fs.create(target, True).close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds (none if there is no such folder)."""
    fs, target = _filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch file or folder (nothing happens if it is not there)."""
    fs, target = _filesystem(spark, path)
    fs.delete(target, True)

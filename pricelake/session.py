"""Session helpers: one place for the time zone, AQE and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every pricelake job relies on. They are SQL confs, so they can be
# applied to a session someone else built (the driver's, a notebook's).
# Dynamic partition overwrite is passed per write instead, so the caller's
# own writes keep their semantics.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "pricelake", checkpoint: str | None = None) -> SparkSession:
    """Session for tests and local runs; on a cluster use the cluster's own builder."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in SQL_CONF.items():
        builder = builder.config(k, v)
    if checkpoint:
        builder = builder.config("spark.checkpoint.dir", checkpoint)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL confs pricelake needs to an existing session. What the
    session was built with (its SparkConf) is left as it is."""
    given = spark.sparkContext.getConf()
    for k, v in SQL_CONF.items():
        if not given.contains(k):
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the cluster (a folder every executor can
    reach). Only when it is unset, as in local tests, do we pick a folder
    ourselves and register it with ``setCheckpointDir`` (the conf itself
    cannot be changed on a running session). Off local mode an unset folder is
    an error: executors would each write to their own disk.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(base)
        return base
    if not sc.getCheckpointDir():
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="pricelake-ckpt-"))
    return sc.getCheckpointDir()


def is_local(master: str) -> bool:
    """Whether driver and executors are one process on one machine."""
    return master == "local" or master.startswith("local[")


# Scratch paths handed out by this process, for ``release_scratch``.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/pricelake/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch paths this process created (materialised
    intermediates, round-trip outputs, stream checkpoints) once their
    DataFrames are no longer needed. Uses the Hadoop FileSystem API, so it
    works on any shared file system. Returns the number of paths removed."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while _SCRATCH:
        p = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
            removed += 1
    return removed


def materialize(df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: cuts the lineage before a plan fans out into several branches
    (each branch then scans this table instead of recomputing the upstream
    aggregates), survives lost executors, and gives AQE real size statistics."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)

"""Batch ingest of a raw zone that reads each file once and knows where every row came from.

``<table>/rows/run=<n>/kind=<good|quarantine>/`` holds the normalised rows with
their file (``origin``), its time (``arrived``) and, for rejects, reason and raw
text; ``<table>/files/run=<n>/`` the files of the run with their counts. A run is
committed by its file list, which is written last: a run that died before it is
done again under the same number and replaces what it left behind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.sources.messages import ZONE

GOOD, QUARANTINE = "good", "quarantine"
_FILES = "origin string, arrived timestamp, bytes bigint, n_good bigint, n_rejected bigint, run bigint"


def processed_files(spark: SparkSession, table: str) -> DataFrame:
    """The files of all committed runs: origin, arrived, bytes, n_good, n_rejected, run."""
    try:
        return spark.read.schema(_FILES).parquet(f"{table}/files")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], _FILES)


def ingest_new(spark: SparkSession, zone: str, table: str, normalize: Callable[[DataFrame], DataFrame]) -> int | None:
    """Normalise the messages of files that no committed run has read; the run's number, None if there were none.

    Files older than the newest processed one are skipped by their metadata and
    never opened; of those of the same moment or later, the processed ones are
    taken out by name. ``normalize`` gets topic, key, value, origin, arrived and
    bytes and keeps the last three beside its ``reject_reason``."""
    done = processed_files(spark, table)
    run, last = done.agg(F.max("run"), F.max("arrived")).first()
    run = (run or 0) + 1
    where = [F.col(f"_metadata.{f}").alias(name) for f, name in (("file_path", "origin"), ("file_modification_time", "arrived"), ("file_size", "bytes"))]
    new = spark.read.schema(ZONE).json(zone)
    if last is not None:
        new = new.filter(F.col("_metadata.file_modification_time") >= F.lit(last))
    new = new.select("topic", "key", "value", *where).join(done.select("origin"), "origin", "left_anti")
    kind = F.when(F.col("reject_reason").isNull(), F.lit(GOOD)).otherwise(F.lit(QUARANTINE))
    rows = normalize(new).withColumn("kind", kind).withColumn("run", F.lit(run).cast("bigint"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "kind").parquet(f"{table}/rows")
    try:
        written = spark.read.parquet(f"{table}/rows").filter(F.col("run") == run)
    except AnalysisException as e:  # the first run found no message: there is no row file yet
        if "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return None
    counts = [F.count_if(F.col("kind") == k).alias(n) for k, n in ((GOOD, "n_good"), (QUARANTINE, "n_rejected"))]
    files = written.groupBy("origin", "arrived", "bytes").agg(*counts).withColumn("run", F.lit(run).cast("bigint"))
    if files.isEmpty():
        return None
    files.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(f"{table}/files")
    return run


def read_rows(spark: SparkSession, table: str, kind: str) -> DataFrame:
    """The good rows or the quarantine of all committed runs."""
    runs = processed_files(spark, table).select("run").distinct()
    return spark.read.parquet(f"{table}/rows").filter(F.col("kind") == kind).drop("kind").join(runs, "run", "left_semi")

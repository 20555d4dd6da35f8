"""A published series with look-back features that is refreshed block by block.

The table is partitioned by ``(symbol, block)``, a block being a span of dates
(a calendar month unless told otherwise). A row holds its values, its features
and its position inside the block; a small table beside it holds each block's
number of rows and the number of rows before it, so a late date shifts the
later positions without a later row being written.

A refresh merges new, changed and removed dates. It recomputes the blocks that
hold them and the blocks that begin within ``k`` rows behind such a block (their
first rows look back into it), reading besides these only the blocks that end
within ``k`` rows before one of them. Everything else stays as it is on disk.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.operators.ordering import month_bucket, series_index, with_lookback
from pricelake.session import materialize

Features = Callable[[DataFrame, object], DataFrame]


def price_features(d: DataFrame, w) -> DataFrame:
    """The 20-row mean (NULL until 20 rows are there) and the log return of ``close``."""
    frame = w.rowsBetween(-19, 0)
    mean = F.when(F.count("close").over(frame) == 20, F.avg("close").over(frame))
    ratio = F.try_divide(F.col("close"), F.lag("close", 1).over(w))
    return d.withColumn("ma_20", mean).withColumn("log_return", F.when(ratio > 0, F.ln(ratio)))


def _offsets(counts: DataFrame) -> DataFrame:
    before = Window.partitionBy("symbol").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("symbol", "block", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))


def _write(rows: DataFrame, path: str) -> None:
    w = rows.repartition("symbol", "block").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    w.partitionBy("symbol", "block").parquet(f"{path}/rows")


def _computed(rows: DataFrame, build: Features, k: int, block_rows: int) -> DataFrame:
    """Features of indexed rows, and their position inside their block."""
    d = with_lookback(series_index(rows), build, k=k, block_rows=block_rows)
    inside = Window.partitionBy("symbol", "block").orderBy("date")
    return d.withColumn("pos", (F.row_number().over(inside) - 1).cast("bigint")).drop("idx")


def publish(series: DataFrame, path: str, build: Features = price_features, k: int = 19, block: Column | None = None, block_rows: int = 8192) -> None:
    """Write the whole table: (symbol, date, ...) with one row per symbol and date, the features of ``build`` (which look back ``k`` rows at most) added."""
    rows = materialize(series.withColumn("block", (month_bucket("date") if block is None else block).cast("bigint")), "publish-input")
    _write(_computed(rows, build, k, block_rows), path)
    _offsets(rows.groupBy("symbol", "block").agg(F.count("*").alias("n"))).write.mode("overwrite").parquet(f"{path}/blocks")


def refresh(spark: SparkSession, path: str, changes: DataFrame, build: Features = price_features, k: int = 19, block: Column | None = None, block_rows: int = 8192, gone: str = "close") -> None:
    """Merge ``changes`` (the published columns, one row per symbol and date; ``gone`` is NULL for a date to take out)."""
    base: Sequence[str] = changes.columns
    changes = materialize(changes.withColumn("block", (month_bucket("date") if block is None else block).cast("bigint")), "refresh-changes")
    blocks = spark.read.parquet(f"{path}/blocks")
    # The blocks of the changes, those that exist and those that are new, each with the rows before it.
    hit = changes.select("symbol", "block").distinct()
    counts = blocks.select("symbol", "block", "n").join(hit.withColumn("_hit", F.lit(True)), ["symbol", "block"], "full_outer")
    known = _offsets(counts.select("symbol", "block", F.coalesce("n", F.lit(0)).alias("n"))).join(hit.withColumn("_hit", F.lit(True)), ["symbol", "block"], "left")
    # The end of the last block hit before a block, and the start of the next block to write after it.
    earlier = Window.partitionBy("symbol").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("symbol").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    known = known.withColumn("_end", F.col("start") + F.col("n"))
    known = known.withColumn("_since", F.col("start") - F.max(F.when(F.col("_hit"), F.col("_end"))).over(earlier))
    known = known.withColumn("written", F.coalesce(F.col("_hit"), F.col("_since") < k, F.lit(False)))
    known = known.withColumn("_until", F.min(F.when(F.col("written"), F.col("start"))).over(later) - F.col("_end"))
    use = known.withColumn("read", F.col("written") | F.coalesce(F.col("_until") < k, F.lit(False))).where("read")
    use = materialize(use.select("symbol", "block", "written", (F.col("n") > 0).alias("_there")), "refresh-blocks")

    rows = spark.read.schema(_schema(spark, path)).parquet(f"{path}/rows").select(*base, "block").join(use.where("_there"), ["symbol", "block"])
    rows = rows.join(changes.select("symbol", "date"), ["symbol", "date"], "left_anti").select(*base, "block", "written")
    new = changes.filter(F.col(gone).isNotNull()).select(*base, "block", F.lit(True).alias("written"))
    rows = materialize(rows.unionByName(new), "refresh-input")
    done = materialize(_computed(rows, build, k, block_rows).filter("written").drop("written"), "refresh-rows")
    counts = blocks.join(use.where("written"), ["symbol", "block"], "left_anti").select("symbol", "block", "n").unionByName(done.groupBy("symbol", "block").agg(F.count("*").alias("n")))
    # A block that has lost all its rows keeps its last files: the table of blocks no longer names it, so nobody reads them.
    offsets = materialize(_offsets(counts), "refresh-offsets")
    _write(done, path)
    offsets.write.mode("overwrite").parquet(f"{path}/blocks")


def _schema(spark: SparkSession, path: str):
    """The rows' columns with the types that were written: partition values are not guessed from their names."""
    found = spark.read.parquet(f"{path}/rows").drop("symbol", "block").schema
    return found.add("symbol", T.StringType()).add("block", T.LongType())


def read(spark: SparkSession, path: str) -> DataFrame:
    """The published rows with their position ``idx`` in the series."""
    rows = spark.read.schema(_schema(spark, path)).parquet(f"{path}/rows")
    blocks = spark.read.parquet(f"{path}/blocks").select("symbol", "block", "start")
    return rows.join(blocks, ["symbol", "block"]).withColumn("idx", F.col("start") + F.col("pos")).drop("pos", "start", "block")

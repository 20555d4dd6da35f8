"""File sources and sinks: CSV, Parquet, JSON records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.functions.strings import normalize_header
from pricelake.schemas import CSV_FILE


class PublishedTableNotFound(FileNotFoundError):
    """The published table does not exist (yet): a distinct outcome, not a crash."""


def read_price_csv(spark: SparkSession, path: str, schema: T.StructType = CSV_FILE, sep: str = ";") -> DataFrame:
    """Semicolon CSV with a header, declared schema, bad lines kept in
    ``_corrupt_record``; headers normalised (strip, lower, blank -> '_')."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    df = (
        spark.read.schema(full)
        .option("sep", sep)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .csv(path)
    )
    return normalize_headers(df)


def normalize_headers(df: DataFrame) -> DataFrame:
    """Column names stripped, lower-cased, blanks to '_' (metadata only, no job)."""
    return df.toDF(*[normalize_header(c) for c in df.columns])


def write_price_csv(df: DataFrame, path: str, sep: str = ";", mode: str = "overwrite") -> None:
    df.write.mode(mode).option("sep", sep).option("header", True).csv(path)


def publish_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("symbol",), files_per_value: int = 4
) -> None:
    """Publish a table as Parquet, partitioned by symbol; with dynamic
    partition overwrite a re-run replaces only the symbols it writes (an
    idempotent load).

    Rows are clustered first by (symbol, hash of the row modulo
    ``files_per_value``), so a symbol gets at most that many files, and a hot
    symbol is still written by several tasks. Raise it for large symbols; for
    millions of symbols pass ``partition_by=()`` instead of a directory each."""
    out = df
    if partition_by:
        part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(int(files_per_value)))
        out = df.repartition(*[F.col(c) for c in partition_by], part)
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def drop_table(spark: SparkSession, name: str) -> None:
    """Reset a catalog table (``DROP TABLE IF EXISTS``); path-based tables are
    reset by an overwrite instead."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """Scan the published table (the whole directory, every file)."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise PublishedTableNotFound(path) from e
        raise


def export_json(df: DataFrame, path: str, keep_nulls: bool = True, mode: str = "overwrite") -> None:
    """JSON records, one object per line, written in parallel; NULL fields
    are kept (as ``null``) by default."""
    df.write.mode(mode).option("ignoreNullFields", str(not keep_nulls).lower()).json(path)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_predictions_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def read_predictions_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_supervised(samples: DataFrame, params: DataFrame, path: str) -> None:
    """Samples partitioned by split, scaler parameters as a small table next to them."""
    samples.write.mode("overwrite").partitionBy("split").parquet(f"{path}/samples")
    params.write.mode("overwrite").parquet(f"{path}/scaler")


def read_supervised(spark: SparkSession, path: str, split: str | None = None) -> tuple[DataFrame, DataFrame]:
    s = spark.read.parquet(f"{path}/samples")
    if split is not None:
        s = s.filter(F.col("split") == split)  # partition pruning on the split directory
    return s, spark.read.parquet(f"{path}/scaler")


def read_external(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """External columnar dataset (one split)."""
    return spark.read.format(fmt).load(path)

"""Document-store tables (S14, S15): a format-parameterised reader and writer.

``fmt='mongodb'`` needs the store's Spark connector (absent in this image);
tests use ``json`` files, which exercise the same code path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_documents(
    df: DataFrame, fmt: str = "mongodb", path: str | None = None, mode: str = "append", **options: str
) -> bool:
    """Bulk insert; an empty frame writes nothing and is not an error
    (``isEmpty`` reads at most one row). Returns whether anything was written."""
    if df.isEmpty():
        return False
    w = df.write.mode(mode).format(fmt).options(**options)
    if path is not None:
        w.save(path)
    else:
        w.save()
    return True


def read_documents(
    spark: SparkSession, schema: T.StructType | str, fmt: str = "mongodb", path: str | None = None, **options: str
) -> DataFrame:
    """Scan with a declared schema instead of sampling documents."""
    r = spark.read.format(fmt).schema(schema).options(**options)
    return r.load(path) if path is not None else r.load()

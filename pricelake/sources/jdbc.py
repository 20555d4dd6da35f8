"""Relational tables over JDBC.

Needs a JDBC driver and a reachable database; none is started here, so these
thin readers/writers are not exercised by the tests (see README).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Column types for a new table (the prices table of the SQL source).
PRICE_TABLE_TYPES = (
    "date VARCHAR(50), open DOUBLE PRECISION, high DOUBLE PRECISION, low DOUBLE PRECISION, "
    "close DOUBLE PRECISION, volume DOUBLE PRECISION, source VARCHAR(20), ingested_at VARCHAR(50)"
)


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    mode: str = "append",
    column_types: str | None = PRICE_TABLE_TYPES,
    batch_size: int = 10000,
) -> None:
    """Create-if-absent and bulk insert (batched, one connection per partition).
    ``mode='overwrite'`` resets the target by truncating it (keeping its
    definition) rather than dropping it."""
    w = df.write.mode(mode).option("batchsize", batch_size).option("truncate", str(mode == "overwrite").lower())
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    w.jdbc(url, table, properties=properties or {})


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """JDBC scan; with a numeric ``partition_column`` and bounds the table is
    read by ``num_partitions`` parallel range queries instead of one."""
    props = properties or {}
    if partition_column is not None:
        return spark.read.jdbc(
            url,
            table,
            column=partition_column,
            lowerBound=lower_bound,
            upperBound=upper_bound,
            numPartitions=num_partitions,
            properties=props,
        )
    return spark.read.jdbc(url, table, properties=props)

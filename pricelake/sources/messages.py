"""Records <-> keyed JSON messages, and topic readers/writers.

The message broker's connector is a deployment choice: ``fmt='kafka'`` needs
the Kafka connector on the classpath (absent in this image, so it is not
exercised by the tests); file formats (``json``, ``parquet``, ``text``) with a
``topic=...`` directory per topic stand in for it and are tested.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A file zone's columns; ``topic`` is its partition directory. Declared, so nothing is read to infer it.
ZONE = "key string, value string, topic string"

RECORD_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def json_safe(df: DataFrame) -> DataFrame:
    """Make every column JSON-safe: numbers -> DOUBLE, dates and timestamps ->
    'yyyy-MM-dd HH:mm:ss' text, everything else kept."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.NumericType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, RECORD_TIME_FORMAT)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def to_messages(df: DataFrame, topic: str | Column, key: str | Column, ignore_nulls: bool = False) -> DataFrame:
    """``(topic, key, value)`` with ``value`` = one JSON object per row."""
    t = F.lit(topic) if isinstance(topic, str) else topic
    k = F.lit(key) if isinstance(key, str) else key
    safe = json_safe(df)
    opts = {"ignoreNullFields": str(ignore_nulls).lower()}
    value = F.to_json(F.struct(*[F.col(f"`{c}`") for c in safe.columns]), opts)
    return safe.select(t.alias("topic"), k.alias("key"), value.alias("value"))


def parse_records(messages: DataFrame, schema: T.StructType | str, keep: Sequence[str] = ("topic", "key")) -> DataFrame:
    """JSON values back to typed columns with a declared schema (no sampling)."""
    return messages.select(*keep, F.from_json("value", schema).alias("_r")).select(*keep, "_r.*")


def publish(
    messages: DataFrame,
    fmt: str = "kafka",
    path: str | None = None,
    mode: str = "append",
    skip_empty: bool = True,
    **options: str,
) -> bool:
    """Write messages to a broker (``kafka``: topic/key/value columns) or to a
    file zone partitioned by topic. An empty source publishes nothing
    (``isEmpty`` reads at most one row); returns whether anything was written."""
    m = messages.select("topic", "key", "value")
    if skip_empty and m.isEmpty():
        return False
    if fmt == "kafka":
        m.write.format("kafka").options(**options).save()
    else:
        m.write.mode(mode).partitionBy("topic").format(fmt).options(**options).save(path)
    return True


def read_topics(
    spark: SparkSession, topics: Sequence[str], fmt: str = "kafka", path: str | None = None, **options: str
) -> DataFrame:
    """Batch read of every message of the given topics, earliest first."""
    if fmt == "kafka":
        df = (
            spark.read.format("kafka")
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", "earliest")
            .options(**options)
            .load()
        )
        return df.select("topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    df = spark.read.format(fmt).options(**options).schema(ZONE).load(path)
    return df.filter(F.col("topic").isin(list(topics))).select("topic", "key", "value")


def read_raw_zone(spark: SparkSession, path: str, topics: Sequence[str] | None = None) -> DataFrame:
    """Every landed record of the raw zone (all files, no listing limit), with
    its topic from the ``topic=`` directory and the file it came from.

    Reading the sink's root directory goes through its ``_spark_metadata``
    log, so only files of committed micro-batches are read: partial output of
    a failed batch never shows up, and a replayed batch is not read twice."""
    df = spark.read.schema(ZONE).json(path)
    df = df.select("topic", "key", "value", F.col("_metadata.file_path").alias("file_path"))
    return df if topics is None else df.filter(F.col("topic").isin(list(topics)))

"""Consume topics and land every message in a raw zone partitioned by topic.

The original consumer polled forever with in-memory counters and stopped at
hard-coded totals. Here a checkpointed ``availableNow`` query reads
everything available, lands it exactly once (file sink + checkpoint), and
stops; counts are reconciled afterwards against the landed data itself.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

# Schema of message files in a topic-partitioned file zone (the file stand-in for a broker).
MESSAGE_FILE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
    ]
)


def message_stream(
    spark: SparkSession,
    topics: Sequence[str],
    fmt: str = "kafka",
    path: str | None = None,
    max_files_per_trigger: int = 1000,
    origin: bool = False,
    **options: str,
) -> DataFrame:
    """Streaming ``(topic, key, value)`` from a broker (earliest offsets) or
    from a topic-partitioned file zone. With ``origin`` also where and when a
    message came in: ``origin`` (file, or partition and offset) and ``arrived``."""
    if fmt == "kafka":
        df = (
            spark.readStream.format("kafka")
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", "earliest")
            .options(**options)
            .load()
        )
        where = [F.concat_ws(":", "partition", "offset").alias("origin"), F.col("timestamp").alias("arrived")] if origin else []
        return df.select("topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), *where)
    df = (
        spark.readStream.schema(MESSAGE_FILE)
        .format(fmt)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .options(**options)
        .load(path)
    )
    where = [F.col("_metadata.file_path").alias("origin"), F.col("_metadata.file_modification_time").alias("arrived")] if origin else []
    return df.filter(F.col("topic").isin(list(topics))).select("topic", "key", "value", *where)


def once(stream: DataFrame, dedupe_on: str, within: str | None = None, time_col: str = "arrived") -> DataFrame:
    """The stream without redelivered messages, by an id column.

    With ``within`` (an interval such as '1 hour') a message is dropped if one
    with its id came at most that long before, by ``time_col``; ids older than
    the watermark leave the state, which stays as large as the messages of that
    interval. Without it every id ever seen stays in the state."""
    if within is None:
        return stream.dropDuplicates([dedupe_on])
    return stream.withWatermark(time_col, within).dropDuplicatesWithinWatermark([dedupe_on])


def land(stream: DataFrame, raw_path: str, checkpoint: str, dedupe_on: str | None = None, within: str | None = None, time_col: str = "arrived") -> StreamingQuery:
    """Land every message once under ``raw_path/topic=<t>/`` and stop when
    everything available has been written. ``dedupe_on`` optionally drops
    redelivered messages by an id column, for ever or ``within`` a delay (see
    ``once``). Returns the ended query (its progress tells the state's size)."""
    s = once(stream, dedupe_on, within, time_col) if dedupe_on else stream
    q = (
        s.writeStream.format("json")
        .partitionBy("topic")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(raw_path)
    )
    q.awaitTermination()
    return q


GOOD, QUARANTINE = "good", "quarantine"


def land_normalized(stream: DataFrame, path: str, checkpoint: str, normalize: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Normalise a stream of messages into a table of good and rejected rows and
    stop when everything available has been written.

    Every micro-batch is normalised and written in one pass, split by outcome:
    ``path/kind=good/batch=<id>/`` and ``path/kind=quarantine/batch=<id>/``
    (reject reason, raw text, origin). A batch that is repeated after a crash
    has the same id and the same messages, and replaces its own directories, so
    no row is doubled or lost whatever a failed attempt left behind.
    ``normalize`` gives rows with a ``reject_reason`` (NULL for good ones)."""

    def write(batch: DataFrame, number: int) -> None:
        rows = normalize(batch)
        kind = F.when(F.col("reject_reason").isNull(), F.lit(GOOD)).otherwise(F.lit(QUARANTINE))
        w = rows.withColumn("kind", kind).withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite")
        w.option("partitionOverwriteMode", "dynamic").partitionBy("kind", "batch").parquet(path)

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def read_normalized(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The good rows or the quarantine of ``land_normalized`` (a scan of that kind's directories only)."""
    return spark.read.parquet(path).filter(F.col("kind") == kind).drop("kind")


class _Landed(StreamingQueryListener):
    """Adds up the observed counts of a query's batches; ``reached`` is set when all topics have what is expected.

    A batch is counted once, by its number, however often it was tried."""

    NAME = "landed"

    def __init__(self, expected: dict[str, int], before: dict[str, int]):
        self.expected, self.before, self.batches = expected, before, {}
        self.run_id, self.reached, self.last = None, threading.Event(), time.monotonic()

    def counts(self) -> dict[str, int]:
        return {t: self.before.get(t, 0) + sum(b[t] for b in self.batches.values()) for t in self.expected}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if self.run_id in (None, str(p.runId)) and self.NAME in p.observedMetrics:
            row = p.observedMetrics[self.NAME]
            self.batches[p.batchId] = {t: int(row[i] or 0) for i, t in enumerate(self.expected)}
            self.last = time.monotonic()
            if all(n >= self.expected[t] for t, n in self.counts().items()):
                self.reached.set()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def land_until(stream: DataFrame, raw_path: str, checkpoint: str, expected: dict[str, int], patience: float = 60.0, every: str = "0 seconds") -> list[tuple[str, int, int, str]]:
    """Land messages until every topic has as many as ``expected``, then stop.

    The counts are metrics that the landing itself observes, batch by batch, so
    nothing is read a second time; a listener adds them up and the running query
    is ended at the counts. It is also ended when no batch came for ``patience``
    seconds. A query that goes on from an earlier run's checkpoint first counts
    what that run landed. Returns (topic, landed, expected, ``ok`` / ``short`` /
    ``over``) per expected topic: the check is a small table known on the driver."""
    spark = stream.sparkSession
    before: dict[str, int] = {}
    try:
        before = {r.topic: r.n for r in spark.read.schema("topic string").json(raw_path).groupBy("topic").agg(F.count(F.lit(1)).alias("n")).collect()}
    except AnalysisException as e:  # nothing landed yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
    seen = _Landed(expected, before)
    if all(before.get(t, 0) >= n for t, n in expected.items()):
        seen.reached.set()
    spark.streams.addListener(seen)
    try:
        if not seen.reached.is_set():
            counted = stream.observe(seen.NAME, *[F.count_if(F.col("topic") == t).alias(f"n{i}") for i, t in enumerate(expected)])
            q = counted.writeStream.format("json").partitionBy("topic").option("checkpointLocation", checkpoint).trigger(processingTime=every).start(raw_path)
            seen.run_id = str(q.runId)
            while q.isActive and not seen.reached.wait(0.1) and time.monotonic() - seen.last < patience:
                pass
            q.stop()
            if q.exception() is not None:
                raise q.exception()
    finally:
        spark.streams.removeListener(seen)
    return [(t, n, expected[t], "ok" if n == expected[t] else "short" if n < expected[t] else "over") for t, n in seen.counts().items()]


def topic_counts(stream: DataFrame, out_path: str, checkpoint: str) -> None:
    """Running message count per topic (stateful aggregate, complete mode);
    every micro-batch overwrites the small result table."""

    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    q = (
        stream.groupBy("topic")
        .agg(F.count(F.lit(1)).alias("n"))
        .writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def reconcile(landed: DataFrame, expected: DataFrame) -> DataFrame:
    """Landed vs expected messages per topic -> ``ok`` / ``short`` / ``over``.

    ``landed`` is ``(topic, n)``, ``expected`` is ``(topic, expected)``; a topic
    missing on either side counts as 0 there."""
    j = landed.join(expected, "topic", "full_outer")
    n = F.coalesce(F.col("n"), F.lit(0)).cast("long")
    e = F.coalesce(F.col("expected"), F.lit(0)).cast("long")
    status = F.when(n == e, F.lit("ok")).when(n < e, F.lit("short")).otherwise(F.lit("over"))
    return j.select("topic", n.alias("landed"), e.alias("expected"), status.alias("status"))

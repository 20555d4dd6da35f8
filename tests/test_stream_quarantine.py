"""Normalising streams into good and rejected rows, stopping at counts, bounded dedupe, table reset."""

import json

import pytest
from pyspark.sql import functions as F

from pricelake.plans import ingest
from pricelake.session import scratch_path
from pricelake.sources import files, messages
from pricelake.streaming import land


def _publish(spark, path, rows):
    messages.publish(spark.createDataFrame(rows, "topic string, key string, value string").coalesce(1), fmt="json", path=path)


def record(i, **changes):
    return json.dumps({"date": f"2020.01.{i + 1:02d} 00:00", "open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5, "volume": 10.0, "source": "csv", "ingested_at": "t"} | changes)


def normalize(batch):
    return ingest.normalized(batch, "ALL", keep=("origin", "arrived"))


def tables(spark, out):
    good = sorted(str(r.date) for r in land.read_normalized(spark, out, land.GOOD).collect())
    bad = sorted((r.reject_reason, r.raw, r.topic) for r in land.read_normalized(spark, out, land.QUARANTINE).collect())
    return good, bad


def test_good_and_rejected_rows_of_every_batch(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    _publish(spark, src, [(ingest.TOPIC_CSV, "k", record(0)), (ingest.TOPIC_CSV, "k", "{broken"), (ingest.TOPIC_CSV, "k", "")])
    _publish(spark, src, [(ingest.TOPIC_CSV, "k", record(1)), (ingest.TOPIC_CSV, "k", record(2, close="n/a"))])
    stream = lambda: land.message_stream(spark, [ingest.TOPIC_CSV], fmt="json", path=src, max_files_per_trigger=1, origin=True)
    land.land_normalized(stream(), out, ckpt, normalize)
    good, bad = tables(spark, out)
    assert good == ["2020-01-01", "2020-01-02"]
    assert bad == [("bad_number", record(2, close="n/a"), ingest.TOPIC_CSV), ("malformed_json", "", ingest.TOPIC_CSV), ("malformed_json", "{broken", ingest.TOPIC_CSV)]
    origins = land.read_normalized(spark, out, land.QUARANTINE).select("origin", "arrived").collect()
    assert all(r.origin.startswith("file:") and f"topic={ingest.TOPIC_CSV}/" in r.origin and r.arrived is not None for r in origins)
    land.land_normalized(stream(), out, ckpt, normalize)  # nothing new
    assert tables(spark, out) == (good, bad)


def test_a_batch_that_died_after_writing_is_replaced_not_doubled(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    for i in range(3):
        _publish(spark, src, [(ingest.TOPIC_CSV, "k", record(i)), (ingest.TOPIC_CSV, "k", f"broken {i}")])
    stream = lambda: land.message_stream(spark, [ingest.TOPIC_CSV], fmt="json", path=src, max_files_per_trigger=1, origin=True)
    tried = []

    def dies_once(batch):
        tried.append(1)
        if len(tried) == 2:
            # what a crash leaves behind: rows of this batch are written, the batch is not committed
            rows = normalize(batch).withColumn("kind", F.when(F.col("reject_reason").isNull(), "good").otherwise("quarantine")).withColumn("batch", F.lit(1).cast("long"))
            rows.write.mode("append").partitionBy("kind", "batch").parquet(out)
            raise RuntimeError("executor lost")
        return normalize(batch)

    with pytest.raises(Exception, match="executor lost"):
        land.land_normalized(stream(), out, ckpt, dies_once)
    land.land_normalized(stream(), out, ckpt, normalize)
    good, bad = tables(spark, out)
    assert good == ["2020-01-01", "2020-01-02", "2020-01-03"] and [b[1] for b in bad] == ["broken 0", "broken 1", "broken 2"]


def test_landing_stops_at_the_expected_counts(spark):
    src, raw, ckpt = (scratch_path(spark, n) for n in ("src", "raw", "ckpt"))
    _publish(spark, src, [("exact", "k", "{}")] * 5 + [("over", "k", "{}")] * 7 + [("short", "k", "{}")] * 2 + [("other", "k", "{}")])
    stream = lambda: land.message_stream(spark, ["exact", "over", "short"], fmt="json", path=src)
    expected = {"exact": 5, "over": 4, "short": 3}
    got = land.land_until(stream(), raw, ckpt, expected, patience=4.0)
    assert got == [("exact", 5, 5, "ok"), ("over", 7, 4, "over"), ("short", 2, 3, "short")]
    _publish(spark, src, [("short", "k", "{}")])
    got = land.land_until(stream(), raw, ckpt, expected, patience=30.0)  # goes on from the checkpoint and ends by itself
    assert got == [("exact", 5, 5, "ok"), ("over", 7, 4, "over"), ("short", 3, 3, "ok")]
    assert messages.read_raw_zone(spark, raw).count() == 15
    assert land.land_until(stream(), raw, ckpt, expected, patience=30.0) == got  # all there already


def test_redelivery_within_the_delay_is_dropped_and_the_state_is_bounded(spark):
    src, raw, ckpt = (scratch_path(spark, n) for n in ("src", "raw", "ckpt"))

    def run(hour, ids):
        _publish(spark, src, [("t", str(i), json.dumps({"i": i})) for i in ids])
        s = land.message_stream(spark, ["t"], fmt="json", path=src)
        s = s.withColumn("arrived", F.timestamp_seconds(F.lit(1_700_000_000 + 3600 * hour))).withColumn("msg_id", F.xxhash64("topic", "key"))
        q = land.land(s, raw, ckpt, dedupe_on="msg_id", within="2 hours")
        return q.lastProgress["stateOperators"][0]["numRowsTotal"] if q.lastProgress and q.lastProgress["stateOperators"] else None

    count = lambda: messages.read_raw_zone(spark, raw).count()
    run(0, range(10))
    assert count() == 10
    run(1, range(5, 15))  # five of them again, an hour later
    assert count() == 15
    states = [run(h, range(100 * h, 100 * h + 10)) for h in range(2, 12)]
    assert count() == 115
    assert max(s for s in states if s is not None) <= 60  # ids of the last hours, not of all


def test_drop_table_resets_a_table_that_exists(spark):
    name, path = "reset_me", scratch_path(spark, "reset")
    spark.range(5).write.option("path", path).mode("overwrite").saveAsTable(name)
    assert spark.catalog.tableExists(name)
    files.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)
    files.drop_table(spark, name)  # absent: nothing happens
    spark.range(2).write.option("path", path).mode("overwrite").saveAsTable(name)
    assert spark.table(name).count() == 2
    files.drop_table(spark, name)

"""Refreshing a published table by blocks, and reading a raw zone's files once."""

import datetime as dt
import json
import os
import random
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricelake.operators import incremental
from pricelake.plans import ingest
from pricelake.session import scratch_path
from pricelake.sources import messages, processed

D0 = dt.date(2020, 1, 1)
SCHEMA = "symbol string, date date, close double"


def rebuilt(rows):
    """(symbol, date, idx, close, ma_20, log_return) of a full rebuild by plain windows."""
    w = Window.partitionBy("symbol").orderBy("date")
    m = w.rowsBetween(-19, 0)
    d = rows.withColumn("idx", F.row_number().over(w) - 1).withColumn("ma_20", F.when(F.count("close").over(m) == 20, F.avg("close").over(m)))
    return d.withColumn("log_return", F.ln(F.col("close") / F.lag("close").over(w))).select("symbol", "date", "idx", "close", "ma_20", "log_return")


def same(spark, path, rows):
    key = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select("symbol", "date", "idx", "close", "ma_20", "log_return").collect())
    assert key(incremental.read(spark, path)) == key(rebuilt(rows))


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def series(days, symbol="a", seed=1):
    rnd = random.Random(seed)
    return {(symbol, D0 + dt.timedelta(days=i)): 100 + rnd.random() for i in days}


def frame(spark, rows):
    return spark.createDataFrame([(*k, v) for k, v in rows.items()], SCHEMA)


def folder(path):
    return path.removeprefix("file:")


def test_one_late_date_touches_its_block_and_the_next(spark):
    rows = series(range(400)) | series(range(400), "b", 2)
    late = ("a", D0 + dt.timedelta(days=100))  # April 2020
    path = scratch_path(spark, "inc")
    incremental.publish(frame(spark, {k: v for k, v in rows.items() if k != late}), path)
    before = files_of(f"{folder(path)}/rows")
    incremental.refresh(spark, path, frame(spark, {late: rows[late]}))
    after = files_of(f"{folder(path)}/rows")
    touched = {f.split("/rows/")[1].rsplit("/", 1)[0] for f in before.keys() ^ after.keys()}
    assert touched == {f"symbol=a/block={2020 * 12 + m}" for m in (4, 5)}
    assert all(before[f] == after[f] for f in before.keys() & after.keys())
    same(spark, path, frame(spark, rows))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_refreshes_equal_rebuilds(spark, seed):
    rnd = random.Random(seed)
    sparse = sorted(rnd.sample(range(900), 160))  # blocks of few rows: a look-back crosses several
    rows = series(sparse, "a", seed) | series(range(0, 300, 2), "b", seed)
    path = scratch_path(spark, "inc")
    incremental.publish(frame(spark, rows), path, block_rows=32)
    for _ in range(3):
        changes = {k: None for k in rnd.sample(sorted(rows), 6)} | {k: 50.0 + rnd.random() for k in rnd.sample(sorted(rows), 6)}
        changes |= {("a", D0 + dt.timedelta(days=rnd.randrange(1200))): 70.0 + rnd.random() for _ in range(3)} | {("new", D0 + dt.timedelta(days=rnd.randrange(90))): 1.0 + rnd.random()}
        incremental.refresh(spark, path, frame(spark, changes), block_rows=32)
        rows = {k: v for k, v in (rows | changes).items() if v is not None}
        same(spark, path, frame(spark, rows))


def test_a_refresh_done_twice_and_one_that_empties_a_block(spark):
    rows = series(range(90))
    path = scratch_path(spark, "inc")
    incremental.publish(frame(spark, rows), path)
    out = {k: None for k in rows if k[1].month == 2}
    for _ in range(2):
        incremental.refresh(spark, path, frame(spark, out))
        same(spark, path, frame(spark, {k: v for k, v in rows.items() if k not in out}))
    incremental.refresh(spark, path, frame(spark, {k: rows[k] for k in list(out)[:3]}))
    same(spark, path, frame(spark, {k: v for k, v in rows.items() if k not in list(out)[3:]}))


# ---------------------------------------------------------------- a raw zone, file by file


def record(i, **changes):
    return json.dumps({"date": f"2020.01.{i + 1:02d} 00:00", "open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5, "volume": 10.0, "source": "csv", "ingested_at": "t"} | changes)


def test_files_are_read_once_and_rejects_name_their_file(spark):
    zone, table, seen = scratch_path(spark, "zone"), scratch_path(spark, "processed"), spark.sparkContext.accumulator(0)

    def counted(parts):
        for p in parts:
            seen.add(p.num_rows)
            yield p

    def normalize(batch):
        return ingest.normalized(batch.mapInArrow(counted, batch.schema), "ALL", keep=("origin", "arrived", "bytes"))

    def add(*values):
        rows = spark.createDataFrame([(ingest.TOPIC_CSV, "k", v) for v in values], "topic string, key string, value string").coalesce(1)
        messages.publish(rows, fmt="json", path=zone)
        time.sleep(0.02)

    add(record(0), "broken", "")
    add(record(1))
    assert processed.ingest_new(spark, zone, table, normalize) == 1
    assert processed.ingest_new(spark, zone, table, normalize) is None
    first = seen.value
    add(record(2, close="x"))
    assert processed.ingest_new(spark, zone, table, normalize) == 2
    assert first == 4 and seen.value == 5
    files = {r.origin: (r.n_good, r.n_rejected, r.run) for r in processed.processed_files(spark, table).collect()}
    assert sorted(files.values()) == [(0, 1, 2), (1, 0, 1), (1, 2, 1)]
    bad = processed.read_rows(spark, table, processed.QUARANTINE).collect()
    assert sorted((r.reject_reason, r.raw, r.run) for r in bad) == [("bad_number", record(2, close="x"), 2), ("malformed_json", "", 1), ("malformed_json", "broken", 1)]
    assert all(r.origin in files for r in bad) and processed.read_rows(spark, table, processed.GOOD).count() == 2


def test_a_run_that_died_before_its_file_list_is_done_again(spark):
    zone, table = scratch_path(spark, "zone"), scratch_path(spark, "processed")
    rows = spark.createDataFrame([(ingest.TOPIC_CSV, "k", record(0)), (ingest.TOPIC_CSV, "k", "broken")], "topic string, key string, value string")
    messages.publish(rows, fmt="json", path=zone)
    normalize = lambda batch: ingest.normalized(batch, "ALL", keep=("origin", "arrived", "bytes"))
    half = normalize(spark.read.schema("topic string, key string, value string").json(zone).withColumns({"origin": F.lit("x"), "arrived": F.current_timestamp(), "bytes": F.lit(1)}))
    half.withColumns({"kind": F.lit("good"), "run": F.lit(1)}).write.partitionBy("run", "kind").parquet(f"{table}/rows")
    assert processed.processed_files(spark, table).count() == 0
    assert processed.ingest_new(spark, zone, table, normalize) == 1
    assert processed.read_rows(spark, table, processed.GOOD).count() == processed.read_rows(spark, table, processed.QUARANTINE).count() == 1


def test_an_empty_zone_has_no_run(spark):
    zone, table = scratch_path(spark, "zone"), scratch_path(spark, "processed")
    os.makedirs(folder(zone))
    normalize = lambda batch: ingest.normalized(batch, "ALL", keep=("origin", "arrived", "bytes"))
    assert processed.ingest_new(spark, zone, table, normalize) is None

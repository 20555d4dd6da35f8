"""Deterministic price-series inputs derived by Spark from the driver's tables (FIXTURES.md).

These are test adapters: they turn the TPC-H-style ``orders`` / ``lineitem``
tables into the shapes the price operators work on, so every operator has a
real input whose size grows with the data. Each builder reads the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixtures (FIXTURES.md part B).
FIXED_INGESTED_AT = "2024-01-01T00:00:00+00:00"
FROM_DATE = "1997-01-01"
SINGLE_SYMBOL = "ALL"
ONE_SYMBOL = "1-URGENT"
EXTERNAL_SYMBOL = "EXT"
SEQ_WINDOW = 30
FORECAST_HORIZON = 365
TICKS_A_DAY = 10**13
TUNE_STRENGTH = 5.0
TICK_BLOCK_ROWS = 64
TICK_BUCKET_ROWS = 4096
ONE_DAY_MICROS = 865_123_200_000_000  # 1997-06-01


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _daily_ohlcv(orders: DataFrame, *group: str) -> DataFrame:
    """One OHLCV row per group and day: open/close are the prices of the
    first/last order key of the day, volume the number of orders."""
    return orders.groupBy(*group, F.col("o_orderdate").cast("date").alias("date")).agg(
        F.min_by("o_totalprice", "o_orderkey").alias("open"),
        F.max("o_totalprice").alias("high"),
        F.min("o_totalprice").alias("low"),
        F.max_by("o_totalprice", "o_orderkey").alias("close"),
        F.count(F.lit(1)).cast("double").alias("volume"),
    )


def two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """two overlapping daily sources of one series (symbol 'ALL')."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    src = F.when(F.col("o_orderkey") % 2 == 0, F.lit("csv")).otherwise(F.lit("yfinance"))
    d = _daily_ohlcv(o.withColumn("source", src), "source")
    return d.select(
        F.lit(SINGLE_SYMBOL).alias("symbol"),
        "date",
        "open",
        "high",
        "low",
        "close",
        "volume",
        "source",
        F.lit(FIXED_INGESTED_AT).alias("ingested_at"),
    )


def multi_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1m: one daily series per order priority."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    d = _daily_ohlcv(o.withColumnRenamed("o_orderpriority", "symbol"), "symbol")
    return d.select("symbol", "date", "open", "high", "low", "close", "volume")


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1m written once: ``series_index`` reads its input in two branches that
    need different columns, so Spark would aggregate ``orders`` twice."""
    from pricelake.session import materialize

    return materialize(multi_symbol(spark, sf_dir), "daily")


def multi_symbol_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1m in the unified layout (one source, fixed ingestion time)."""
    return multi_symbol(spark, sf_dir).select(
        "*", F.lit("yfinance").alias("source"), F.lit(FIXED_INGESTED_AT).alias("ingested_at")
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one row per order line, so a series grows with the data: symbol = return
    flag, ``t`` = a unique, increasing time (day, order, line); the highest price where lines repeat."""
    li = table(spark, sf_dir, "lineitem")
    t = F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint") * F.lit(TICKS_A_DAY) + F.col("l_orderkey") * 10 + F.col("l_linenumber")
    day = F.col("l_shipdate").cast("date")
    return li.where("l_shipdate is not null").groupBy(F.col("l_returnflag").alias("symbol"), t.alias("t"), day.alias("date")).agg(F.max("l_extendedprice").alias("close"))


def tick_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 with its position, from buckets whose bounds come from the data. F6 is written first: sketch, counts and rows read it."""
    from pricelake.operators.ordering import data_buckets, series_index
    from pricelake.session import materialize

    rows = materialize(ticks(spark, sf_dir), "ticks")
    return series_index(data_buckets(rows, order_col="t", rows=TICK_BUCKET_ROWS), order_col="t")


def one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the order lines as events of one and the same day, microseconds apart: what a calendar bucket cannot cut."""
    li = table(spark, sf_dir, "lineitem")
    micros = F.lit(ONE_DAY_MICROS) + F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return li.groupBy(F.col("l_linestatus").alias("symbol"), F.timestamp_micros(micros).alias("ts")).agg(F.max("l_extendedprice").alias("close"))


def external_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 as the external table looks on disk: ``Date``, ``Close`` and other columns."""
    li = table(spark, sf_dir, "lineitem")
    order = F.struct("l_orderkey", "l_linenumber", "l_extendedprice")
    return li.groupBy(F.col("l_shipdate").alias("Date")).agg(
        F.max_by("l_extendedprice", order).alias("Close"),
        F.max("l_extendedprice").alias("High"),
        F.count(F.lit(1)).alias("Volume"),
    )


def prediction_table(spark: SparkSession, sf_dir: str, block_rows: int | None = None) -> DataFrame:
    """long predictions of three simple models on the F1m series.

    ``naive`` = previous close, ``ma5`` / ``ma20`` = mean of the previous 5 / 20
    closes. Rows without a prediction are dropped.
    """
    from pricelake.operators.evaluate import baseline_predictions
    from pricelake.operators.ordering import series_index

    series = series_index(daily_series(spark, sf_dir))
    kw = {} if block_rows is None else {"block_rows": block_rows}
    return baseline_predictions(series, value_col="close", **kw)


def linear_weights(window: int = SEQ_WINDOW) -> list[float]:
    """weights 2*i/(w*(w+1)) for i = 1..w (oldest first); they sum to 1."""
    return [2.0 * i / (window * (window + 1)) for i in range(1, window + 1)]


def expected_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """expected messages per topic; the csv count is exact, the provider
    count is deliberately 10 too high, so reconciliation must report it short."""
    from pricelake.plans.ingest import TOPIC_CSV, TOPIC_PROVIDER

    f1 = two_sources(spark, sf_dir)
    topic = F.when(F.col("source") == "csv", F.lit(TOPIC_CSV)).otherwise(F.lit(TOPIC_PROVIDER))
    return (
        f1.groupBy(topic.alias("topic"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("topic", (F.col("n") + F.when(F.col("topic") == TOPIC_PROVIDER, 10).otherwise(0)).alias("expected"))
    )


def _q(sql: str) -> str:
    """SQL: the text value wrapped in double quotes (a JSON string; the fixture texts need no escaping)."""
    return f"""concat('"', {sql}, '"')"""


def _kv(key_sql: str, value_sql: str) -> str:
    """SQL: one ``"key":value`` member of a JSON object."""
    return f"""concat('"', {key_sql}, '":', {value_sql})"""


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every F1 row rendered as the JSON message its producer would send,
    with faults injected by day of year (``f = dayofyear % 23``):

    f=1 truncated JSON; f=2 unknown keys; f=3 packed text with 5 parts;
    f=4 non-numeric close; f=5 explicit null high (empty part when packed);
    f=6 missing low (a short packed text); f=7 NaN volume.
    CSV rows use the packed one-key layout when ``day % 5 = 0``.
    Columns: ``topic, key, value`` (as a message source delivers them).
    The message text is one Spark SQL expression per layout.
    """
    from pricelake.plans.ingest import TOPIC_CSV, TOPIC_PROVIDER

    f1 = two_sources(spark, sf_dir).selectExpr(
        "*",
        "dayofyear(date) % 23 AS f",
        "dayofmonth(date) % 5 = 0 AS packed",
        "date_format(date, 'yyyy.MM.dd HH:mm') AS csv_date",
        "date_format(date, 'yyyy-MM-dd HH:mm:ss') AS prov_date",
        *[f"CAST({c} AS STRING) AS s_{c}" for c in ("open", "high", "low", "close", "volume")],
    )
    tail_csv = [_kv("'source'", _q("'csv'")), _kv("'ingested_at'", _q("ingested_at"))]
    regular = "concat_ws(',', " + ", ".join(
        [
            _kv("CASE WHEN f = 2 THEN 'fecha' ELSE 'date' END", _q("csv_date")),
            _kv("'open'", "s_open"),
            _kv("'high'", "CASE WHEN f = 5 THEN 'null' ELSE s_high END"),
            f"CASE WHEN f <> 6 THEN {_kv("'low'", 's_low')} END",
            _kv("'close'", """CASE WHEN f = 4 THEN '"n/a"' ELSE s_close END"""),
            _kv("'volume'", "CASE WHEN f = 7 THEN 'NaN' ELSE s_volume END"),
            *tail_csv,
        ]
    ) + ")"
    packed_text = (
        "concat_ws(';', csv_date, s_open, CASE WHEN f = 5 THEN '' ELSE s_high END, "
        "CASE WHEN f <> 6 THEN s_low END, CASE WHEN f = 4 THEN 'n/a' ELSE s_close END, "
        "CASE WHEN f = 3 THEN NULL WHEN f = 7 THEN 'NaN' ELSE s_volume END)"
    )
    packed_key = "CASE WHEN f = 2 THEN 'date,open,high,low,close,volume' ELSE 'date;open;high;low;close;volume' END"
    packed_msg = "concat_ws(',', " + ", ".join([_kv(packed_key, _q(packed_text)), *tail_csv]) + ")"

    def prov_key(name: str) -> str:
        return f"concat('{name}_', symbol)"

    provider = "concat_ws(',', " + ", ".join(
        [
            _kv("CASE WHEN f = 2 THEN 'Fecha' ELSE 'Date' END", _q("prov_date")),
            _kv(prov_key("Open"), "s_open"),
            _kv(prov_key("High"), "CASE WHEN f = 5 THEN 'null' ELSE s_high END"),
            f"CASE WHEN f <> 6 THEN {_kv(prov_key('Low'), 's_low')} END",
            _kv(prov_key("Close"), """CASE WHEN f = 4 THEN '"n/a"' ELSE s_close END"""),
            _kv(prov_key("Volume"), "CASE WHEN f = 7 THEN 'NaN' ELSE s_volume END"),
            _kv("'source'", _q("'yfinance'")),
            _kv("'ticker'", _q("symbol")),
            _kv("'ingested_at'", _q("ingested_at")),
        ]
    ) + ")"
    body = f"CASE WHEN source = 'csv' AND packed THEN {packed_msg} WHEN source = 'csv' THEN {regular} ELSE {provider} END"
    return f1.selectExpr(
        f"CASE WHEN source = 'csv' THEN '{TOPIC_CSV}' ELSE '{TOPIC_PROVIDER}' END AS topic",
        "source AS key",
        f"concat('{{', {body}, '}}') AS _text",
        "f",
    ).selectExpr(
        "topic", "key", "CASE WHEN f = 1 THEN substring(_text, 1, CAST(length(_text) / 2 AS INT)) ELSE _text END AS value"
    )

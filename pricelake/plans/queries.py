"""Registered queries: one per operator of the inventory, each over the whole
driver tables (or data Spark derives from them).

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame. Those that
write intermediate tables (quantiles, histogram, the supervised chain, sources
and sinks) run jobs while they build it; the others are lazy.
Computed doubles whose value depends on summation order are rounded to 6
digits so they compare exactly with the SQL oracle; the library operators
themselves never round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake import fixtures
from pricelake.functions.dates import format_csv_date, format_provider_date, parse_date
from pricelake.functions.strings import flatten_label, normalize_label
from pricelake.operators import evaluate, features, forecast, incremental, normalize, ordering, profile, reshape, supervised
from pricelake.operators.clean import clean_series, series_head
from pricelake.operators.unify import canonical, dedupe_by_date, stamp_provenance, unify_sources
from pricelake.plans import analysis, ingest
from pricelake.schemas import PREDICTIONS, PRICE_FIELDS
from pricelake.session import configure, materialize, scratch_path
from pricelake.sources import documents, files, messages, processed
from pricelake.streaming import land

W = fixtures.SEQ_WINDOW
W_FIT = 2  # lags of the fitted models: few enough to solve their normal equations in SQL


def r6(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _ready(spark: SparkSession) -> None:
    configure(spark)


# ---------------------------------------------------------------- unify / clean


def q_unify_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 + U1: a SQL-table-like source (text date, FLOAT prices, ``id``) and a
    document-like source (other layout, ``ticker``) unified by name."""
    _ready(spark)
    f1 = fixtures.two_sources(spark, sf_dir)
    table_like = f1.filter(F.col("source") == "csv").select(
        F.xxhash64("date").alias("id"),
        format_csv_date("date").alias("date"),
        *[F.col(c).cast("float").alias(c) for c in ("open", "high", "low", "close", "volume")],
        "source",
        "ingested_at",
    )
    doc_like = f1.filter(F.col("source") == "yfinance").select(
        "ingested_at",
        F.lit("GC=F").alias("ticker"),
        "volume",
        "close",
        "low",
        "high",
        "open",
        format_provider_date("date").alias("date"),
        "source",
    )
    return unify_sources(canonical(table_like, fixtures.SINGLE_SYMBOL), canonical(doc_like, fixtures.SINGLE_SYMBOL))


def q_dedupe_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    return dedupe_by_date(fixtures.two_sources(spark, sf_dir))


def q_clean_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    return analysis.clean_two_sources(spark, sf_dir, fixtures.FROM_DATE)


def q_series_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9 on every symbol of F1m (no from-date filter)."""
    _ready(spark)
    return ordering.series_index(fixtures.multi_symbol(spark, sf_dir)).select("symbol", "date", "idx")


def q_tick_series_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9 on F6, whose series grow with the data, in buckets made from the data."""
    _ready(spark)
    return fixtures.tick_series(spark, sf_dir).select("symbol", "t", "idx")


def q_one_day_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9 on F9: every row of every series lies in one day."""
    _ready(spark)
    rows = materialize(fixtures.one_day(spark, sf_dir), "one-day")
    s = ordering.series_index(ordering.data_buckets(rows, order_col="ts", rows=fixtures.TICK_BUCKET_ROWS), order_col="ts")
    return s.select("symbol", F.unix_micros("ts").alias("micros"), "close", "idx")


def q_series_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    return series_head(analysis.clean_multi(spark, sf_dir), 5)


def q_series_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 on the external series: date range and row count."""
    _ready(spark)
    ext = analysis.external_series(spark, sf_dir)
    return ext.groupBy("symbol").agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count(F.lit(1)).alias("n_rows")
    )


# ---------------------------------------------------------------- features


def q_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: two sources -> unify -> one row per date -> clean from a date
    on -> volatility, calendar, guarded 20-row mean, logs."""
    _ready(spark)
    f = analysis.feature_table(analysis.clean_two_sources(spark, sf_dir, fixtures.FROM_DATE))
    return f.select(
        "symbol",
        "idx",
        "date",
        "open",
        "high",
        "low",
        "close",
        "volume",
        "volatility",
        "year",
        "month",
        "dayofweek",
        r6("ma_20").alias("ma_20"),
        r6("log_close").alias("log_close"),
        r6("log_volume").alias("log_volume"),
    )


def q_rolling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    s = ordering.series_index(fixtures.daily_series(spark, sf_dir))
    return features.rolling_mean(s, "close", 20).select("symbol", "date", "close", r6("ma_20").alias("ma_20"))


def q_log_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    s = ordering.series_index(fixtures.daily_series(spark, sf_dir))
    return features.log_return(s, "close").select("symbol", "date", "close", r6("log_return").alias("log_return"))


def q_tick_rolling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 on series that grow with the data, in blocks of 64 rows with halos."""
    _ready(spark)
    s = fixtures.tick_series(spark, sf_dir)
    m = features.rolling_mean(s, "close", 20, block_rows=fixtures.TICK_BLOCK_ROWS)
    return m.select("symbol", "t", "idx", "close", r6("ma_20").alias("ma_20"))


def q_tick_log_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 on F6, in blocks of 64 rows."""
    _ready(spark)
    s = features.log_return(fixtures.tick_series(spark, sf_dir), "close", block_rows=fixtures.TICK_BLOCK_ROWS)
    return s.select("symbol", "t", r6("log_return").alias("log_return"))


def q_tick_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 on F6: five-step samples, in blocks of 64 rows."""
    _ready(spark)
    s = supervised.make_sequences(fixtures.tick_series(spark, sf_dir), "close", 5, block_rows=fixtures.TICK_BLOCK_ROWS)
    return s.select("symbol", "idx", "date", "y", *[F.expr(f"X[{j}] AS x_{j:02d}") for j in range(5)])


def q_tick_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + A10 on F6: naive and trailing means scored per symbol."""
    _ready(spark)
    p = evaluate.baseline_predictions(fixtures.tick_series(spark, sf_dir), block_rows=fixtures.TICK_BLOCK_ROWS)
    m = evaluate.regression_metrics(p, by=("model", "symbol"))
    return m.select("model", "symbol", "n", *[r6(c).alias(c) for c in ("mae", "rmse", "r2")])


def q_tick_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A2 on F6."""
    _ready(spark)
    d = profile.describe(fixtures.ticks(spark, sf_dir), ["close"])
    return d.select("symbol", "column", "count", *[r6(c).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def q_future_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 + X12: the 365 calendar days after each series' last date."""
    _ready(spark)
    last = forecast.last_dates(fixtures.multi_symbol(spark, sf_dir))
    return forecast.future_dates(last, fixtures.FORECAST_HORIZON).select("symbol", "step", "date")


# ---------------------------------------------------------------- profile

PROFILE_COLS = ("open", "high", "low", "close", "volume")


def q_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    d = profile.describe(analysis.clean_multi(spark, sf_dir), PROFILE_COLS)
    return d.select("symbol", "column", "count", *[r6(c).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def q_corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    c = profile.corr_matrix(analysis.clean_two_sources(spark, sf_dir), PROFILE_COLS)
    return c.select("symbol", "col_a", "col_b", r6("r").alias("r"))


def q_outlier_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    o = profile.outlier_stats(analysis.clean_multi(spark, sf_dir), PROFILE_COLS)
    return o.select(
        "symbol", "column", "n", "n_outliers",
        *[r6(c).alias(c) for c in ("q1", "q3", "iqr", "lo_fence", "hi_fence", "whisker_lo", "whisker_hi")],
    )


def q_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    h = profile.histogram(analysis.clean_multi(spark, sf_dir), PROFILE_COLS, bins=50)
    return h.select("symbol", "column", "bin", r6("bin_lo").alias("bin_lo"), r6("bin_hi").alias("bin_hi"), "count")


# ---------------------------------------------------------------- supervised


def _f1_supervised(spark: SparkSession, sf_dir: str, window: int = W, **kw) -> analysis.Supervised:
    feat = analysis.feature_table(analysis.clean_two_sources(spark, sf_dir))
    return analysis.supervised(feat, "close", window, **kw)


def _x_columns(window: int) -> list[Column]:
    return [F.expr(f"round(X[{j}], 6) AS x_{j:02d}") for j in range(window)]


def q_minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 + X4, scaler fitted on the training rows only (fit_on='train')."""
    _ready(spark)
    sv = _f1_supervised(spark, sf_dir)
    return sv.scaled.join(sv.params, "symbol").select(
        "symbol", "idx", "date", "close", "min", "max", r6("close_scaled").alias("close_scaled")
    )


def q_minmax_scale_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 with the scaler fitted on every row (fit_on='all')."""
    _ready(spark)
    sv = _f1_supervised(spark, sf_dir, fit_on="all")
    return sv.scaled.join(sv.params, "symbol").select(
        "symbol", "idx", "date", "close", "min", "max", r6("close_scaled").alias("close_scaled")
    )


def q_minmax_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + X5: scale then map back with the broadcast-joined parameters."""
    _ready(spark)
    sv = _f1_supervised(spark, sf_dir)
    back = supervised.apply_minmax(sv.scaled, sv.params, "close_scaled", "restored", inverse=True)
    return back.select("symbol", "idx", "date", "close", r6("close_scaled").alias("close_scaled"), r6("restored").alias("restored"))


def q_make_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    s = _f1_supervised(spark, sf_dir).samples
    return s.select("symbol", "idx", "date", r6("y").alias("y"), "split", *_x_columns(W))


def q_make_sequences_60(spark: SparkSession, sf_dir: str) -> DataFrame:
    """60-step samples of scaled log returns."""
    _ready(spark)
    feat = analysis.feature_table(analysis.clean_two_sources(spark, sf_dir))
    lr = features.log_return(feat, "close").filter(F.col("log_return").isNotNull()).drop("idx")
    lr = ordering.series_index(lr)
    sv = analysis.supervised(lr, "log_return", 60)
    return sv.samples.select("symbol", "idx", "date", r6("y").alias("y"), "split", *_x_columns(60))


def q_temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    return _f1_supervised(spark, sf_dir).samples.select("symbol", "idx", "date", "split")


def q_temporal_split_3way(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    return _f1_supervised(spark, sf_dir, val_pct_of_train=10).samples.select("symbol", "idx", "date", "split")


def _ext_supervised(spark: SparkSession, sf_dir: str, window: int = W) -> analysis.Supervised:
    return analysis.supervised(analysis.external_series(spark, sf_dir), "close", window, train_pct=85)


def q_temporal_split_85(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    return _ext_supervised(spark, sf_dir).samples.select("symbol", "idx", "date", "split")


def q_external_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S21 + P10: external table -> (symbol, date, close) sorted and indexed."""
    _ready(spark)
    return analysis.external_series(spark, sf_dir).select("symbol", "idx", "date", "close")


def q_forecast_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    sv = _f1_supervised(spark, sf_dir)
    seed = supervised.forecast_seed(sv.scaled, "close_scaled", W)
    return seed.select("symbol", "pos", "date", r6("value").alias("value"))


# ---------------------------------------------------------------- scoring / forecast


def _test_scores(spark: SparkSession, sf_dir: str, sv: analysis.Supervised | None = None):
    sv = sv or _f1_supervised(spark, sf_dir)
    test = sv.samples.filter(F.col("split") == "test")
    scored = forecast.score_linear(test, fixtures.linear_weights(W))
    return sv, scored


def q_score_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    _, scored = _test_scores(spark, sf_dir)
    return scored.select("symbol", "idx", "date", r6("y").alias("y"), r6("pred").alias("pred"))


def _aligned(spark: SparkSession, sf_dir: str, sv: analysis.Supervised | None = None) -> DataFrame:
    """Positional predictions (symbol, idx, pred) joined back to dated test
    samples, both mapped back to price units."""
    sv, scored = _test_scores(spark, sf_dir, sv)
    positional = scored.select("symbol", "idx", "pred")
    dated = sv.samples.filter(F.col("split") == "test").select("symbol", "idx", "date", "y")
    a = evaluate.align_by_position(dated, positional)
    a = supervised.apply_minmax(a, sv.params, "y", "real", inverse=True)
    return supervised.apply_minmax(a, sv.params, "pred", "pred_usd", inverse=True)


def q_align_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    a = _aligned(spark, sf_dir)
    return a.select("symbol", "date", r6("real").alias("real"), r6("pred_usd").alias("pred"))


def _future(spark: SparkSession, sf_dir: str, sv: analysis.Supervised | None = None) -> DataFrame:
    sv = sv or _f1_supervised(spark, sf_dir)
    seeds = supervised.seed_arrays(supervised.forecast_seed(sv.scaled, "close_scaled", W))
    fc = forecast.recursive_forecast(seeds, fixtures.linear_weights(W), fixtures.FORECAST_HORIZON)
    return forecast.forecast_in_units(fc, sv.params)


def q_recursive_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 + M5: 365-step recursive forecast with given weights, dated and in price units."""
    _ready(spark)
    return _future(spark, sf_dir).select("symbol", "step", "date", r6("pred").alias("pred"), r6("pred_usd").alias("pred_usd"))


def q_forecast_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: real, predicted (test) and future values on one axis."""
    _ready(spark)
    sv = _f1_supervised(spark, sf_dir)
    real = sv.scaled.select("symbol", "date", F.col("close").alias("value"))
    pred = _aligned(spark, sf_dir, sv).select("symbol", "date", F.col("pred_usd").alias("value"))
    fut = _future(spark, sf_dir, sv).select("symbol", "date", F.col("pred_usd").alias("value"))
    return forecast.timeline(real, pred, fut).select("kind", "symbol", "date", r6("value").alias("value"))


# ---------------------------------------------------------------- evaluation


def q_regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    m = evaluate.regression_metrics(fixtures.prediction_table(spark, sf_dir), by=("model", "symbol"))
    return m.select("model", "symbol", "n", *[r6(c).alias(c) for c in ("mae", "rmse", "r2")])


def q_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 + U2 + X6: all models of the long table ranked by MAE, 4 digits."""
    _ready(spark)
    return evaluate.leaderboard(fixtures.prediction_table(spark, sf_dir))


def q_model_compare_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    w = evaluate.compare_wide(fixtures.prediction_table(spark, sf_dir), ["naive", "ma5", "ma20"])
    return w.select("symbol", "date", "real", "naive", r6("ma5").alias("ma5"), r6("ma20").alias("ma20"))


# ---------------------------------------------------------------- messages, normalisation


def _normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.normalized(fixtures.raw_messages(spark, sf_dir), fixtures.SINGLE_SYMBOL)


def q_normalize_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + X8 + X9: CSV-producer messages (packed / regular / unknown)."""
    _ready(spark)
    m = fixtures.raw_messages(spark, sf_dir).filter(F.col("topic") == ingest.TOPIC_CSV)
    return normalize.normalize_csv(m, fixtures.SINGLE_SYMBOL).drop("raw")


def q_normalize_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 + X13: provider messages with ticker-suffixed keys."""
    _ready(spark)
    m = fixtures.raw_messages(spark, sf_dir).filter(F.col("topic") == ingest.TOPIC_PROVIDER)
    return normalize.normalize_provider(m).drop("raw")


def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 + G4: outcome counts per topic (good rows and each reject reason)."""
    _ready(spark)
    return normalize.reject_counts(_normalized(spark, sf_dir))


def q_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 + A4 over the normalised messages (NULLs from rejects, NaN volumes)."""
    _ready(spark)
    return profile.null_counts(_normalized(spark, sf_dir).drop("raw"))


def q_parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates in both source layouts and one unknown layout (-> NULL)."""
    _ready(spark)
    m = fixtures.multi_symbol(spark, sf_dir)
    k = F.dayofyear("date") % 3
    text = (
        F.when(k == 0, format_csv_date("date"))
        .when(k == 1, format_provider_date("date"))
        .otherwise(F.date_format("date", "yyyy/MM/dd"))
    )
    return m.select("symbol", text.alias("date_text")).select("symbol", "date_text", parse_date("date_text").alias("date"))


def q_records_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + X10: records -> JSON-safe messages -> parsed back with a schema."""
    _ready(spark)
    f1 = fixtures.two_sources(spark, sf_dir)
    msgs = messages.to_messages(f1, "records", F.col("source"))
    schema = "symbol string, date string, open double, high double, low double, close double, volume double, source string, ingested_at string"
    return messages.parse_records(msgs, schema, keep=("key",))


def q_stamp_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + X11: source, ticker and one ingestion time per load (a parameter,
    so a re-run is reproducible)."""
    _ready(spark)
    m = fixtures.multi_symbol(spark, sf_dir).withColumn("ticker", F.col("symbol"))
    return stamp_provenance(m, "yfinance", ingested_at=fixtures.FIXED_INGESTED_AT)


def q_string_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X7 + S2: label normalisation and two-level label flattening, per symbol."""
    _ready(spark)
    m = fixtures.multi_symbol(spark, sf_dir)
    return m.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "symbol",
        normalize_label("symbol").alias("label"),
        flatten_label(F.lit("Close"), F.col("symbol")).alias("close_key"),
        "n_rows",
    )


def q_flatten_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: long multi-ticker frame -> flat ``Field_TICKER`` columns per date."""
    _ready(spark)
    m = fixtures.multi_symbol(spark, sf_dir)
    return reshape.flatten(m, reshape.values_of(m, "symbol"))


def q_provider_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ticker from a start date (filters reach the scan)."""
    _ready(spark)
    m = fixtures.multi_symbol(spark, sf_dir)
    return m.filter((F.col("symbol") == fixtures.ONE_SYMBOL) & (F.col("date") >= F.to_date(F.lit(fixtures.FROM_DATE))))


def q_guarded_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each ticker's slice is published unless it is empty; what was published, and how many messages came in."""
    _ready(spark)
    m = materialize(fixtures.multi_symbol(spark, sf_dir), "daily")
    path, told = scratch_path(spark, "guarded"), []
    for ticker in (fixtures.ONE_SYMBOL, "ABSENT"):
        records = messages.to_messages(m.filter(F.col("symbol") == ticker), ticker, F.col("symbol"))
        told.append((ticker, messages.publish(records, fmt="json", path=path)))
    topics = spark.createDataFrame(told, "topic string, published boolean")
    counts = messages.read_topics(spark, [t for t, _ in told], fmt="json", path=path).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    return topics.join(counts, "topic", "left").select("topic", "published", F.coalesce("n", F.lit(0)).alias("n_messages"))


# ---------------------------------------------------------------- sources and sinks (round trips)


def q_src_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2: semicolon CSV with a header, read back with a declared schema."""
    _ready(spark)
    f1 = fixtures.two_sources(spark, sf_dir)
    path = scratch_path(spark, "csv")
    out = f1.select(
        format_csv_date("date").alias("Date"),
        *[F.col(c).alias(c.capitalize()) for c in ("open", "high", "low", "close", "volume")],
    )
    files.write_price_csv(out, path)
    back = files.read_price_csv(spark, path)
    return back.select(
        parse_date("date").alias("date"), "open", "high", "low", "close", "volume", "_corrupt_record"
    )


def q_parquet_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S16 + S17 + S23: publish partitioned by symbol (dynamic overwrite), read back."""
    _ready(spark)
    path = scratch_path(spark, "published")
    files.publish_parquet(fixtures.multi_symbol_unified(spark, sf_dir), path)
    files.publish_parquet(fixtures.multi_symbol_unified(spark, sf_dir), path)  # a re-run replaces, never appends
    return files.read_published(spark, path)


def q_export_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S18 + S19: JSON records (nulls kept) and back with a declared schema."""
    _ready(spark)
    path = scratch_path(spark, "export")
    files.export_json(analysis.clean_two_sources(spark, sf_dir), path)
    schema = "symbol string, date date, open double, high double, low double, close double, volume double, idx long"
    return files.read_json_records(spark, path, schema)


def q_predictions_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long prediction table to CSV and back."""
    _ready(spark)
    path = scratch_path(spark, "predictions")
    files.write_predictions_csv(fixtures.prediction_table(spark, sf_dir), path)
    back = files.read_predictions_csv(spark, path, PREDICTIONS)
    return back.select("model", "symbol", "date", "real", r6("pred").alias("pred"))


def q_supervised_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples by split + scaler table persisted; all splits read back."""
    _ready(spark)
    sv = _f1_supervised(spark, sf_dir)
    path = scratch_path(spark, "supervised")
    files.write_supervised(sv.samples, sv.params, path)
    test, params = files.read_supervised(spark, path)
    return test.join(params, "symbol").select("symbol", "idx", "date", r6("y").alias("y"), "split", "min", "max")


def q_doc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S14 + S15 with the file stand-in for the document store."""
    _ready(spark)
    path = scratch_path(spark, "documents")
    docs = fixtures.two_sources(spark, sf_dir).withColumn("ticker", F.lit("GC=F"))
    documents.write_documents(docs, fmt="json", path=path)
    schema = "symbol string, date date, open double, high double, low double, close double, volume double, source string, ticker string, ingested_at string"
    return documents.read_documents(spark, schema, fmt="json", path=path)


# ---------------------------------------------------------------- streaming


def _publish_fixture(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "topics")
    messages.publish(fixtures.raw_messages(spark, sf_dir), fmt="json", path=path)
    return path


def q_publish_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 + S9 (batch): publish keyed JSON messages, read both topics back, normalise."""
    _ready(spark)
    path = _publish_fixture(spark, sf_dir)
    back = messages.read_topics(spark, [ingest.TOPIC_CSV, ingest.TOPIC_PROVIDER], fmt="json", path=path)
    return ingest.normalized(back, fixtures.SINGLE_SYMBOL).drop("raw")


def _landed(spark: SparkSession, sf_dir: str) -> str:
    src = _publish_fixture(spark, sf_dir)
    raw = scratch_path(spark, "raw")
    stream = land.message_stream(spark, [ingest.TOPIC_CSV, ingest.TOPIC_PROVIDER], fmt="json", path=src)
    land.land(stream, raw, scratch_path(spark, "ckpt-land"))
    return raw


def q_stream_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 + S10 + G5: availableNow stream lands every message once; the raw
    zone normalises to the same rows as the batch read."""
    _ready(spark)
    raw = messages.read_raw_zone(spark, _landed(spark, sf_dir))
    return ingest.normalized(raw, fixtures.SINGLE_SYMBOL).drop("raw")


def q_raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11 + A11: every landed record, counted per topic."""
    _ready(spark)
    raw = messages.read_raw_zone(spark, _landed(spark, sf_dir))
    return raw.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def q_stream_topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running per-topic counts from a stateful streaming aggregate."""
    _ready(spark)
    src = _publish_fixture(spark, sf_dir)
    out = scratch_path(spark, "topic-counts")
    stream = land.message_stream(spark, [ingest.TOPIC_CSV, ingest.TOPIC_PROVIDER], fmt="json", path=src)
    land.topic_counts(stream, out, scratch_path(spark, "ckpt-counts"))
    return spark.read.parquet(out)


def q_reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed counts vs expected counts per topic -> ok / short / over."""
    _ready(spark)
    raw = messages.read_raw_zone(spark, _landed(spark, sf_dir))
    landed = raw.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    return land.reconcile(landed, fixtures.expected_counts(spark, sf_dir))


def q_land_until(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running query is ended at the expected counts, which the landing pass itself observes."""
    _ready(spark)
    src = _publish_fixture(spark, sf_dir)
    expected = {r.topic: r.expected for r in fixtures.expected_counts(spark, sf_dir).collect()}  # a row per topic
    stream = land.message_stream(spark, list(expected), fmt="json", path=src)
    done = land.land_until(stream, scratch_path(spark, "raw"), scratch_path(spark, "ckpt-until"), expected, patience=5.0)
    return spark.createDataFrame(done, "topic string, landed bigint, expected bigint, status string")


def q_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4 + P3 + S11 on the stream: good rows and the quarantine (reason, raw text, origin) written in one pass per micro-batch."""
    _ready(spark)
    topics = [ingest.TOPIC_CSV, ingest.TOPIC_PROVIDER]
    stream = land.message_stream(spark, topics, fmt="json", path=_publish_fixture(spark, sf_dir), max_files_per_trigger=4, origin=True)
    out = scratch_path(spark, "normalized")
    land.land_normalized(stream, out, scratch_path(spark, "ckpt-normalized"), lambda batch: ingest.normalized(batch, fixtures.SINGLE_SYMBOL, keep=("origin", "arrived")))
    good = land.read_normalized(spark, out, land.GOOD).select(F.lit("good").alias("kind"), "topic", "symbol", "date", *PRICE_FIELDS)
    # The origin is a path of this run: that it names a file of the message's topic is what can be compared.
    known = F.contains("origin", F.concat(F.lit("topic="), F.col("topic"), F.lit("/")))
    bad = land.read_normalized(spark, out, land.QUARANTINE).select(F.lit("quarantine").alias("kind"), "topic", "reject_reason", "raw", known.alias("origin_known"))
    return good.unionByName(bad, allowMissingColumns=True)


def q_stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message is delivered twice; the second one within the delay is dropped, with state bounded by a watermark."""
    _ready(spark)
    path = scratch_path(spark, "topics")
    for _ in range(2):
        messages.publish(fixtures.raw_messages(spark, sf_dir), fmt="json", path=path)
    raw = scratch_path(spark, "raw")
    stream = land.message_stream(spark, [ingest.TOPIC_CSV, ingest.TOPIC_PROVIDER], fmt="json", path=path, origin=True)
    stream = stream.withColumn("msg_id", F.xxhash64("topic", "key", "value"))
    land.land(stream, raw, scratch_path(spark, "ckpt-once"), dedupe_on="msg_id", within="1 hour")
    return ingest.normalized(messages.read_raw_zone(spark, raw), fixtures.SINGLE_SYMBOL).drop("raw")


def q_publish_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End to end: landed messages -> normalised -> quarantine table, and good
    rows unified -> one per date -> clean -> published; both tables read back."""
    _ready(spark)
    raw = messages.read_raw_zone(spark, _landed(spark, sf_dir))
    norm = materialize(ingest.normalized(raw, fixtures.SINGLE_SYMBOL), "normalized")
    rejected, published = scratch_path(spark, "quarantine"), scratch_path(spark, "published")
    files.publish_parquet(normalize.quarantined(norm), rejected, partition_by=("topic",))
    files.publish_parquet(clean_series(ingest.unified(norm)), published)
    clean = files.read_published(spark, published).select(F.lit("clean").alias("kind"), "symbol", "date", *PRICE_FIELDS, "idx")
    bad = files.read_published(spark, rejected)
    return clean.unionByName(bad.select(F.lit("quarantine").alias("kind"), "topic", "reject_reason"), allowMissingColumns=True)


def q_raw_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11 + P3: two loads of a raw zone and a third without new files; every reject with its run, reason, text and file."""
    _ready(spark)
    zone, table = scratch_path(spark, "zone"), scratch_path(spark, "processed")
    raw = fixtures.raw_messages(spark, sf_dir)
    normalize_ = lambda batch: ingest.normalized(batch, fixtures.SINGLE_SYMBOL, keep=("origin", "arrived", "bytes"))
    for topic in (ingest.TOPIC_CSV, ingest.TOPIC_PROVIDER):
        messages.publish(raw.filter(F.col("topic") == topic), fmt="json", path=zone)
        processed.ingest_new(spark, zone, table, normalize_)
    processed.ingest_new(spark, zone, table, normalize_)
    # The origin is a path of this run: that the file list holds it, and its topic's folder, is what can be compared.
    files_ = processed.processed_files(spark, table).select("origin", F.col("run").alias("file_run"))
    bad = processed.read_rows(spark, table, processed.QUARANTINE).join(files_, "origin", "left")
    known = F.contains("origin", F.concat(F.lit("topic="), F.col("topic"), F.lit("/"))) & F.col("file_run").eqNullSafe(F.col("run"))
    return bad.select("run", "topic", "reject_reason", "raw", known.alias("origin_known"))


def q_publish_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S16 + W1 + W2: a table published without some dates and with wrong closes on others, then refreshed with late, corrected and removed rows."""
    _ready(spark)
    path = scratch_path(spark, "incremental")
    full = materialize(fixtures.multi_symbol(spark, sf_dir).select("symbol", "date", "close"), "daily")
    day = F.dayofyear("date")
    late, wrong = day % 37 == 0, day % 41 == 0
    too_many = full.filter(day % 43 == 0).withColumn("date", F.date_add("date", 4000))
    first = full.filter(~late).withColumn("close", F.when(wrong, F.col("close") + 1).otherwise(F.col("close")))
    incremental.publish(first.unionByName(too_many), path)
    incremental.refresh(spark, path, full.filter(late | wrong).unionByName(too_many.withColumn("close", F.lit(None).cast("double"))))
    return incremental.read(spark, path).select("symbol", "date", "idx", "close", r6("ma_20").alias("ma_20"), r6("log_return").alias("log_return"))


# ---------------------------------------------------------------- ML


def q_ml_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 + X14: sample arrays as ML feature vectors."""
    _ready(spark)
    from pyspark.ml.functions import vector_to_array

    s = forecast.ml_frame(_f1_supervised(spark, sf_dir).samples).withColumn("X", vector_to_array("features"))
    return s.select("symbol", "idx", "date", "split", r6("label").alias("y"), *_x_columns(W))


def q_fit_lag_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 + M3 + M7: fit a linear lag model on train, score test, rank it
    against the given-weights model and the naive baseline."""
    _ready(spark)
    frame = forecast.ml_frame(_f1_supervised(spark, sf_dir, window=W_FIT).samples)
    model = forecast.fit_lag_model(frame.filter(F.col("split") == "train"))
    test = frame.filter(F.col("split") == "test")
    fitted = forecast.score_model(model, test, "linear_fit")
    given = forecast.score_linear(test, fixtures.linear_weights(W_FIT)).select(
        F.lit("linear_given").alias("model"), "symbol", "date", F.col("y").alias("real"), "pred"
    )
    naive = test.select(
        F.lit("naive").alias("model"), "symbol", "date", F.col("y").alias("real"), F.element_at("X", -1).alias("pred")
    )
    return evaluate.leaderboard(fitted.unionByName(given).unionByName(naive))


def q_refit_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: before/after adding the external series at lower weight."""
    _ready(spark)
    own = _f1_supervised(spark, sf_dir, window=W_FIT).samples
    ext = _ext_supervised(spark, sf_dir, W_FIT).samples
    m = forecast.refit_compare(own, ext, external_weight=0.1)
    return m.select("stage", "n", *[r6(c).alias(c) for c in ("mae", "rmse", "r2")])


def _multi_supervised(spark: SparkSession, sf_dir: str) -> analysis.Supervised:
    return analysis.supervised(analysis.clean_multi(spark, sf_dir), "close", W_FIT)


def _models(sv: analysis.Supervised) -> DataFrame:
    return forecast.solve_models(forecast.lag_statistics(sv.samples.filter(F.col("split") == "train"), W_FIT), W_FIT)


def q_fit_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: one model per series from its sufficient statistics, with its scores on the test samples."""
    _ready(spark)
    sv = _multi_supervised(spark, sf_dir)
    models = materialize(_models(sv), "models")
    scored = forecast.score_models(sv.samples.filter(F.col("split") == "test"), models, W_FIT).withColumnRenamed("y", "real")
    scores = evaluate.regression_metrics(scored, by=("symbol",)).withColumnRenamed("n", "n_test")
    slopes = [r6(F.get("coef", F.lit(i))).alias(f"b{i}") for i in range(W_FIT)]
    d = models.select("symbol", F.col("n").cast("bigint").alias("n"), *slopes, r6("intercept").alias("intercept")).join(scores, "symbol")
    return d.select("symbol", "n", *[f"b{i}" for i in range(W_FIT)], "intercept", "n_test", *[r6(c).alias(c) for c in ("mae", "rmse", "r2")])


def q_forecast_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 with the model of each series: 365 recursive steps."""
    _ready(spark)
    sv = _multi_supervised(spark, sf_dir)
    seeds = supervised.seed_arrays(supervised.forecast_seed(sv.scaled, "close_scaled", W_FIT))
    path = forecast.forecast_models(seeds, _models(sv), fixtures.FORECAST_HORIZON)
    return path.select("symbol", "step", r6("pred").alias("pred"))


def q_tune_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: before/after tuning to the external series from stored statistics, with a penalty towards the earlier slopes."""
    _ready(spark)
    own = _f1_supervised(spark, sf_dir, window=W_FIT).samples
    ext = _ext_supervised(spark, sf_dir, W_FIT).samples
    m = forecast.tune_compare(own, ext, W_FIT, fixtures.TUNE_STRENGTH)
    return m.select("stage", "n", *[r6(c).alias(c) for c in ("mae", "rmse", "r2")])


QUERIES = {
    "raw_trace": q_raw_trace,
    "publish_incremental": q_publish_incremental,
    "tick_series_index": q_tick_series_index,
    "one_day_index": q_one_day_index,
    "guarded_publish": q_guarded_publish,
    "land_until": q_land_until,
    "stream_quarantine": q_stream_quarantine,
    "stream_dedupe": q_stream_dedupe,
    "fit_per_series": q_fit_per_series,
    "forecast_per_series": q_forecast_per_series,
    "tune_compare": q_tune_compare,
    "features": q_features,
    "unify_sources": q_unify_sources,
    "dedupe_by_date": q_dedupe_by_date,
    "clean_series": q_clean_series,
    "series_index": q_series_index,
    "series_head": q_series_head,
    "series_coverage": q_series_coverage,
    "rolling_mean": q_rolling_mean,
    "log_return": q_log_return,
    "tick_rolling_mean": q_tick_rolling_mean,
    "tick_log_return": q_tick_log_return,
    "tick_sequences": q_tick_sequences,
    "tick_baselines": q_tick_baselines,
    "tick_describe": q_tick_describe,
    "future_dates": q_future_dates,
    "describe": q_describe,
    "corr_matrix": q_corr_matrix,
    "outlier_stats": q_outlier_stats,
    "histogram": q_histogram,
    "minmax_scale": q_minmax_scale,
    "minmax_scale_all": q_minmax_scale_all,
    "minmax_roundtrip": q_minmax_roundtrip,
    "make_sequences": q_make_sequences,
    "make_sequences_60": q_make_sequences_60,
    "temporal_split": q_temporal_split,
    "temporal_split_3way": q_temporal_split_3way,
    "temporal_split_85": q_temporal_split_85,
    "external_series": q_external_series,
    "forecast_seed": q_forecast_seed,
    "score_linear": q_score_linear,
    "align_predictions": q_align_predictions,
    "recursive_forecast": q_recursive_forecast,
    "forecast_timeline": q_forecast_timeline,
    "regression_metrics": q_regression_metrics,
    "leaderboard": q_leaderboard,
    "model_compare_wide": q_model_compare_wide,
    "normalize_csv": q_normalize_csv,
    "normalize_provider": q_normalize_provider,
    "quarantine": q_quarantine,
    "null_counts": q_null_counts,
    "parse_dates": q_parse_dates,
    "records_to_json": q_records_to_json,
    "stamp_provenance": q_stamp_provenance,
    "string_normalize": q_string_normalize,
    "flatten_provider": q_flatten_provider,
    "provider_slice": q_provider_slice,
    "src_csv": q_src_csv,
    "parquet_publish": q_parquet_publish,
    "export_json": q_export_json,
    "predictions_csv": q_predictions_csv,
    "supervised_store": q_supervised_store,
    "doc_roundtrip": q_doc_roundtrip,
    "publish_messages": q_publish_messages,
    "stream_land": q_stream_land,
    "raw_scan": q_raw_scan,
    "stream_topic_counts": q_stream_topic_counts,
    "reconcile_counts": q_reconcile_counts,
    "publish_pipeline": q_publish_pipeline,
    "ml_frame": q_ml_frame,
    "fit_lag_model": q_fit_lag_model,
    "refit_compare": q_refit_compare,
}

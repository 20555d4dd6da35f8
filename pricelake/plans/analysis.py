"""Unified table -> clean series -> features -> supervised samples (analysis chain)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake import fixtures
from pricelake.operators.clean import clean_series
from pricelake.operators.features import features
from pricelake.operators.supervised import apply_minmax, fit_minmax, make_sequences, series_counts, temporal_split
from pricelake.session import materialize, scratch_path
from pricelake.sources.files import read_external


@dataclass
class Supervised:
    samples: DataFrame  # (symbol, idx, date, X, y, split)
    params: DataFrame  # (symbol, min, max)
    scaled: DataFrame  # indexed series with the scaled value column


def clean_two_sources(spark: SparkSession, sf_dir: str, start: str | None = None) -> DataFrame:
    """F1 (two overlapping sources) -> one clean, indexed row per date."""
    return clean_series(fixtures.two_sources(spark, sf_dir), start=start, constant=("symbol",))


def clean_multi(spark: SparkSession, sf_dir: str, start: str | None = None) -> DataFrame:
    """F1m (one series per symbol) -> clean, indexed series."""
    return clean_series(fixtures.multi_symbol_unified(spark, sf_dir), start=start)


def feature_table(clean: DataFrame) -> DataFrame:
    return features(clean)


def supervised(
    series: DataFrame,
    value_col: str = "close",
    window: int = 30,
    train_pct: int = 80,
    fit_on: str = "train",
    val_pct_of_train: int | None = None,
    persist: bool = True,
) -> Supervised:
    """Scale ``value_col`` per symbol, cut ``window``-step samples, label splits.

    The input fans out into four branches (row counts, scaler fit, scaled
    values, split counts); with ``persist`` it is written once to the shared
    checkpoint folder first, so the upstream plan runs once, not four times.
    """
    # Only these columns are used downstream; pruning cannot reach through a
    # written table, so narrow the projection before writing it.
    series = series.select("symbol", "idx", "date", value_col)
    if persist:
        series = materialize(series, "series")
    # Rows per symbol, computed once: the scaler fit needs N, the split needs
    # the N - window samples (exact: ``value_col`` has no NULLs here).
    n_rows = series_counts(series)
    params = fit_minmax(series, value_col, fit_on=fit_on, window=window, train_pct=train_pct, counts=n_rows)
    scaled_col = f"{value_col}_scaled"
    scaled = apply_minmax(series, params, value_col, scaled_col)
    samples = make_sequences(scaled, scaled_col, window)
    n_samples = n_rows.select("symbol", (F.col("n") - F.lit(window)).alias("n"))
    samples = temporal_split(samples, train_pct, val_pct_of_train, counts=n_samples)
    return Supervised(samples=samples, params=params, scaled=scaled)


def external_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 external table, written and read as the columnar dataset that it is: pick and rename Date/Close, drop missing, index."""
    from pricelake.operators.ordering import series_index

    path = scratch_path(spark, "external")
    fixtures.external_raw(spark, sf_dir).write.parquet(path)
    d = read_external(spark, path).select(
        F.lit(fixtures.EXTERNAL_SYMBOL).alias("symbol"),
        F.col("Date").cast("date").alias("date"),
        F.col("Close").cast("double").alias("close"),
    ).dropna(how="any")
    return series_index(d, constant=("symbol",))

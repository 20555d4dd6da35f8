"""Cleaning: drop admin columns, drop missing, keep from a date on, index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.operators.ordering import partition_by_bucket, series_index
from pricelake.operators.unify import DEFAULT_PRIORITY, dedupe_by_date


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns if present (absent names are ignored)."""
    return df.drop(*[n for n in names if n in df.columns])


def from_date(df: DataFrame, start: str | None, date_col: str = "date") -> DataFrame:
    """Keep rows with ``date >= start`` (pushed down to the scan when possible)."""
    if start is None:
        return df
    return df.filter(F.col(date_col) >= F.to_date(F.lit(start)))


def clean_series(
    unified: DataFrame,
    start: str | None = None,
    priority: Sequence[str] = DEFAULT_PRIORITY,
    keys: Sequence[str] = ("symbol",),
    index: bool = True,
    bucket: Column | None = None,
    constant: Sequence[str] = (),
) -> DataFrame:
    """Unified rows -> one clean row per ``(symbol, date)`` with a dense ``idx``.

    Order as in the analysis it replaces: one row per date first, then rows
    with a NULL or NaN anywhere are dropped (so a date whose winning row is
    bad disappears), then the from-date filter, then the positional index.
    The filter only touches ``date``, a grouping key of the dedupe, so
    Catalyst moves it below the aggregate towards the scan.

    Rows are shuffled once, by ``(symbol, month)``: the dedupe (a
    ``row_number`` window keyed by ``(symbol, month, date)``), the bucket
    counts and the row numbers all reuse that partitioning, and the row
    numbers reuse the dedupe's sort. Duplicates of a date come from different
    sources, which rarely share a map partition, so a map-side combine
    before this shuffle would save little. ``constant`` names keys that the
    caller has fixed to one literal (see ``partition_by_bucket``).
    """
    d = partition_by_bucket(from_date(unified, start), keys, "date", bucket, constant)
    d = dedupe_by_date(d, keys=(*keys, "_bkt", "date"), priority=priority, method="window")
    d = drop_columns(d, "ingested_at", "source")
    d = d.dropna(how="any")
    return series_index(d, keys=keys, order_col="date") if index else d.drop("_bkt")


def series_head(indexed: DataFrame, n: int = 5, idx_col: str = "idx") -> DataFrame:
    """First ``n`` rows of every series (``head()`` per symbol), by position."""
    return indexed.filter(F.col(idx_col) < n)

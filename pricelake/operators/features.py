"""Feature columns: volatility, calendar, guarded rolling mean, logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.functions.dates import weekday_mon0
from pricelake.functions.numeric import ln_or_null, log1p_or_null
from pricelake.operators.ordering import DEFAULT_BLOCK_ROWS, with_lookback


def add_calendar(df: DataFrame, date_col: str = "date") -> DataFrame:
    return (
        df.withColumn("year", F.year(date_col))
        .withColumn("month", F.month(date_col))
        .withColumn("dayofweek", weekday_mon0(date_col))
    )


def rolling_mean(
    df: DataFrame,
    value_col: str = "close",
    window: int = 20,
    out_col: str | None = None,
    keys: Sequence[str] = ("symbol",),
    idx_col: str = "idx",
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """Mean of the last ``window`` rows; NULL until ``window`` values exist.

    The count guard matters: a plain Spark frame would average the partial
    window at the start of each series.
    """
    out_col = out_col or f"ma_{window}"

    def build(d, w):
        frame = w.rowsBetween(-(window - 1), 0)
        x = F.col(value_col)
        return d.withColumn(out_col, F.when(F.count(x).over(frame) == window, F.avg(x).over(frame)))

    return with_lookback(df, build, k=window - 1, keys=keys, idx_col=idx_col, block_rows=block_rows)


def log_return(
    df: DataFrame,
    value_col: str = "close",
    out_col: str = "log_return",
    keys: Sequence[str] = ("symbol",),
    idx_col: str = "idx",
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """ln(x / previous x); NULL for the first row and for non-positive ratios."""

    def build(d, w):
        ratio = F.try_divide(F.col(value_col), F.lag(value_col, 1).over(w))
        return d.withColumn(out_col, ln_or_null(ratio))

    return with_lookback(df, build, k=1, keys=keys, idx_col=idx_col, block_rows=block_rows)


def features(
    clean: DataFrame,
    ma_window: int = 20,
    keys: Sequence[str] = ("symbol",),
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """Clean series -> feature table.

    The rolling mean runs on the series as filtered by the caller (it restarts
    at the from-date), and rows whose mean is not yet defined are dropped,
    before the two log columns are added (their NULLs do not drop rows).
    ``clean`` must be the output of ``clean_series`` (indexed, no NULL/NaN).
    """
    d = clean.withColumn("volatility", F.col("high") - F.col("low"))
    d = add_calendar(d)
    d = rolling_mean(d, "close", ma_window, f"ma_{ma_window}", keys=keys, block_rows=block_rows)
    d = d.dropna(how="any")
    # The clean input has no missing values, so exactly the first ma_window-1
    # rows of each series went: re-base the position to start at 0 again.
    d = d.withColumn("idx", F.col("idx") - F.lit(ma_window - 1))
    return d.withColumn("log_close", ln_or_null("close")).withColumn("log_volume", log1p_or_null("volume"))

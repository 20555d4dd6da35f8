"""Scaling, supervised sequences and temporal splits.

A sample ``i`` of a series is ``X = values[i .. i+w-1]`` and ``y = values[i+w]``,
dated by ``y``; a series of N rows gives N - w samples. Samples keep their
``(symbol, idx, date)`` key throughout, so nothing is ever aligned by row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.numeric import inverse_minmax, minmax
from pricelake.operators.ordering import DEFAULT_BLOCK_ROWS, with_lookback


def series_counts(df: DataFrame, keys: Sequence[str] = ("symbol",), n_col: str = "n") -> DataFrame:
    """Rows per series: a map-side combined count, one output row per symbol."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n_col))


def train_cut(n_samples: Column, train_pct: int) -> Column:
    """Number of training samples: floor(n * pct / 100) in integer arithmetic."""
    # n * pct is an exact integer, so the quotient is never a hair below a whole number.
    return F.floor((n_samples * F.lit(int(train_pct))) / F.lit(100)).cast("long")


def fit_minmax(
    df: DataFrame,
    value_col: str = "close",
    keys: Sequence[str] = ("symbol",),
    fit_on: str = "all",
    window: int = 30,
    train_pct: int = 80,
    idx_col: str = "idx",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Fit per-series min/max.

    ``fit_on='all'`` fits on every row (what the original analysis did, which
    leaks test values into the scaler); ``fit_on='train'`` fits only on the rows
    that training samples use: positions ``< n_train + window``.
    """
    rows = df
    if fit_on == "train":
        n = counts.withColumnRenamed("n", "_N") if counts is not None else series_counts(df, keys, "_N")
        cut = train_cut(F.col("_N") - F.lit(window), train_pct) + F.lit(window)
        rows = df.join(n, list(keys)).filter(F.col(idx_col) < cut)
    elif fit_on != "all":
        raise ValueError(f"fit_on must be 'all' or 'train', not {fit_on!r}")
    return rows.groupBy(*keys).agg(F.min(value_col).alias("min"), F.max(value_col).alias("max"))


def apply_minmax(
    df: DataFrame,
    params: DataFrame,
    value_col: str = "close",
    out_col: str | None = None,
    keys: Sequence[str] = ("symbol",),
    inverse: bool = False,
) -> DataFrame:
    """Scale (or unscale) with fitted params. The params table has one row per
    symbol; the join lets Spark broadcast it when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffle otherwise."""
    out_col = out_col or (f"{value_col}_scaled" if not inverse else f"{value_col}_usd")
    f = inverse_minmax if inverse else minmax
    return (
        df.join(params.select(*keys, F.col("min").alias("_lo"), F.col("max").alias("_hi")), list(keys))
        .withColumn(out_col, f(value_col, "_lo", "_hi"))
        .drop("_lo", "_hi")
    )


def make_sequences(
    indexed: DataFrame,
    value_col: str = "close",
    window: int = 30,
    keys: Sequence[str] = ("symbol",),
    idx_col: str = "idx",
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """``(symbol, idx, date, X ARRAY<DOUBLE>, y)``: one sample per row that has
    ``window`` earlier rows; sample ``idx`` = row position - window.

    ``collect_list`` skips NULLs, so a NULL inside a window drops that sample:
    pass a value column without NULLs.
    """

    def build(d, w):
        frame = w.rowsBetween(-window, -1)
        # The count alone decides which samples exist, so a caller that only wants labels prunes the arrays.
        return d.withColumn("X", F.collect_list(value_col).over(frame)).withColumn("_seen", F.count(value_col).over(frame))

    seq = with_lookback(indexed, build, k=window, keys=keys, idx_col=idx_col, block_rows=block_rows)
    return seq.filter(F.col("_seen") == window).select(
        *keys, (F.col(idx_col) - F.lit(window)).alias("idx"), "date", "X", F.col(value_col).alias("y")
    )


def temporal_split(
    samples: DataFrame,
    train_pct: int = 80,
    val_pct_of_train: int | None = None,
    keys: Sequence[str] = ("symbol",),
    idx_col: str = "idx",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Label samples ``train`` / ``test`` by position: the first
    floor(n * pct / 100) of each series train. With ``val_pct_of_train``, the
    last part of train becomes ``val`` (train if idx < floor(n_train*(100-v)/100)).

    ``counts`` ``(keys, n)`` may give the samples per series when the caller
    knows them (N - window for a series without NULLs), sparing a second
    evaluation of the sample plan just to count it."""
    n = counts.withColumnRenamed("n", "_n") if counts is not None else series_counts(samples, keys, "_n")
    n_train = train_cut(F.col("_n"), train_pct)
    idx = F.col(idx_col)
    label = F.when(idx < n_train, F.lit("train")).otherwise(F.lit("test"))
    if val_pct_of_train is not None:
        fit_cut = train_cut(n_train, 100 - int(val_pct_of_train))
        label = F.when(idx < fit_cut, F.lit("train")).when(idx < n_train, F.lit("val")).otherwise(F.lit("test"))
    return samples.join(n, list(keys)).withColumn("split", label).drop("_n")


def forecast_seed(
    indexed: DataFrame,
    value_col: str,
    window: int = 30,
    keys: Sequence[str] = ("symbol",),
    idx_col: str = "idx",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Last ``window`` points of each series, long: ``(symbol, pos, date, value)``
    with pos 0 = oldest. Found by position (idx >= n - window), so no task ever
    sorts a whole series."""
    n = counts if counts is not None else series_counts(indexed, keys, "_n")
    if counts is not None:
        n = n.withColumnRenamed("n", "_n")
    first = F.col("_n") - F.lit(window)
    return (
        indexed.join(n, list(keys))
        .filter(F.col(idx_col) >= first)
        .select(*keys, (F.col(idx_col) - first).alias("pos"), "date", F.col(value_col).alias("value"))
    )


def seed_arrays(seed_long: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Long seed -> one row per symbol: ``seed`` ordered oldest first, plus the
    last date. Each group holds exactly ``window`` rows."""
    return seed_long.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda s: s["value"]).alias("seed"),
        F.max("date").alias("last_date"),
    )

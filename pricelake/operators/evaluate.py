"""Scoring and comparing forecasts.

Predictions live in one long table ``(model, symbol, date, real, pred)``, so
every comparison is one aggregate grouped by model (and symbol), never a
union of per-model results. A naive "tomorrow = today" baseline is always
available next to any model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.functions.numeric import is_missing
from pricelake.operators.ordering import DEFAULT_BLOCK_ROWS, with_lookback
from pricelake.operators.reshape import listed


def baseline_predictions(
    series: DataFrame,
    value_col: str = "close",
    keys: Sequence[str] = ("symbol",),
    idx_col: str = "idx",
    mean_windows: Sequence[int] = (5, 20),
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """Long predictions of the naive model (previous value) and of trailing
    means of the previous ``n`` values, on an indexed series. Rows without a
    prediction (start of a series) are not emitted."""
    k = max([1, *mean_windows])

    def build(d, w):
        x = F.col(value_col)
        models = [F.struct(F.lit("naive").alias("model"), F.lag(x, 1).over(w).alias("pred"))]
        for n in mean_windows:
            frame = w.rowsBetween(-n, -1)
            models.append(
                F.struct(F.lit(f"ma{n}").alias("model"), F.when(F.count(x).over(frame) == n, F.avg(x).over(frame)).alias("pred"))
            )
        return d.withColumn("_models", F.array(*models))

    out = with_lookback(series, build, k=k, keys=keys, idx_col=idx_col, block_rows=block_rows)
    return (
        out.select(*keys, "date", F.col(value_col).alias("real"), F.explode("_models").alias("_m"))
        .select(F.col("_m.model").alias("model"), *keys, "date", "real", F.col("_m.pred").alias("pred"))
        .filter(F.col("pred").isNotNull())
    )


def regression_metrics(predictions: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """MAE, RMSE and R^2 per group in one aggregate.

    R^2 = 1 - SSE / SST with SST = var_pop(real) * n; NULL when ``real`` is
    constant (SST = 0) instead of a division error. Only complete pairs count
    (neither side missing or NaN).
    """
    predictions = predictions.filter(~is_missing("pred", T.DoubleType()) & ~is_missing("real", T.DoubleType()))
    e = F.col("pred") - F.col("real")
    sst = F.var_pop("real") * F.count(F.lit(1))
    return predictions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.when(sst > 0, F.lit(1.0) - F.sum(e * e) / sst).alias("r2"),
    )


def leaderboard(predictions: DataFrame, by: Sequence[str] = ("model",), digits: int | None = 4) -> DataFrame:
    """Metrics per model ranked by MAE (1 = best), then rounded. With further
    keys in ``by`` (a symbol) models are ranked within each; the metric table
    has one row per model there, so a rank's partition is small."""
    m = regression_metrics(predictions, by)
    within = Window.partitionBy(*[k for k in by if k != "model"]).orderBy(F.col("mae").asc_nulls_last())
    m = m.withColumn("rank", F.rank().over(within))
    if digits is None:
        return m
    return m.select(*by, "n", *[F.round(c, digits).alias(c) for c in ("mae", "rmse", "r2")], "rank")


def compare_wide(predictions: DataFrame, models: Sequence[str], keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Models side by side on the date axis: one row per ``(symbol, date)``,
    one column per model. A conditional aggregate over a known model list
    (a pivot with explicit values: no extra job to find the models); a model
    that the list lacks is an error. The long table serves any number of models."""
    predictions = listed(predictions, "model", models)
    aggs = [F.max("real").alias("real")]
    aggs += [F.max(F.when(F.col("model") == m, F.col("pred"))).alias(m) for m in models]
    return predictions.groupBy(*keys, "date").agg(*aggs)


def align_by_position(
    samples: DataFrame, predictions: DataFrame, keys: Sequence[str] = ("symbol",), idx_col: str = "idx"
) -> DataFrame:
    """Attach positional predictions ``(symbol, idx, pred)`` to dated samples
    ``(symbol, idx, date, y)`` with an equi-join, never by row order."""
    return samples.join(predictions, [*keys, idx_col], "inner")

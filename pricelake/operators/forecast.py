"""Scoring and multi-step forecasts as Spark jobs.

Neural training is not rebuilt; forecasting models here are linear in the
lag window: with given coefficients (exact, SQL-checkable), fitted over all
series with ``pyspark.ml``, or fitted per series from sufficient statistics,
which one aggregate gathers, which can be stored and added up, and from which
a model is solved or tuned without reading its data again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.operators.evaluate import regression_metrics
from pricelake.operators.supervised import apply_minmax
from pricelake.session import materialize


def dot(x: Column, coef: Sequence[float]) -> Column:
    """sum_i x[i] * coef[i], written out term by term: plain arithmetic that code generation takes whole."""
    total = F.lit(0.0)
    for i, c in enumerate(coef):
        total = total + F.get(x, F.lit(i)) * F.lit(float(c))
    return total


def score_linear(samples: DataFrame, coef: Sequence[float], x_col: str = "X", out_col: str = "pred") -> DataFrame:
    """Batch scoring with given lag coefficients (oldest lag first)."""
    return samples.withColumn(out_col, dot(F.col(x_col), coef))


def impulse_response(coef: Sequence[float], horizon: int) -> np.ndarray:
    """The ``horizon x window`` matrix M with forecast = M @ seed.

    A lag-linear model fed with its own predictions is linear in the seed: row
    h holds what each seed point contributes to step h + 1. It is built once
    from the coefficients, by the recursion on unit seeds."""
    window = np.eye(len(coef))
    rows = []
    for _ in range(int(horizon)):
        rows.append(np.asarray(coef, float) @ window)
        window = np.vstack([window[1:], rows[-1]])
    return np.array(rows).reshape(int(horizon), len(coef))


def recursive_forecast(
    seeds: DataFrame,
    coef: Sequence[float],
    horizon: int = 365,
    keys: Sequence[str] = ("symbol",),
    seed_col: str = "seed",
) -> DataFrame:
    """Autoregressive forecast: predict, push the prediction into the window,
    repeat ``horizon`` times -- as plain arithmetic per (seed, step), with the
    rows of ``impulse_response`` instead of a loop over the steps.

    Returns ``(symbol, step, pred)`` with step = 1..horizon (scaled units).
    Seeds of another length than the coefficients have no forecast.
    """
    w = len(coef)
    # One constant, read once: w * horizon numbers, whatever the number of series.
    matrix = F.from_json(F.lit(json.dumps(impulse_response(coef, horizon).tolist())), "array<array<double>>")
    kept = [*keys, *[c for c in seeds.columns if c not in (*keys, seed_col)]]
    place, row, seed = (f"_{c}_{uuid.uuid4().hex[:8]}" for c in ("place", "row", "seed"))
    steps = seeds.filter(F.size(seed_col) == w).select(*kept, F.col(seed_col).alias(seed), F.posexplode(matrix).alias(place, row))
    total = F.lit(0.0)
    for i in range(w):
        total = total + F.get(row, F.lit(i)) * F.get(seed, F.lit(i))
    return steps.select(*kept, total.alias("pred"), (F.col(place) + 1).cast("int").alias("step"))


def future_date(last: Column, step: Column, calendar: str = "daily") -> Column:
    """Date ``step`` periods after ``last``: calendar days, or weekdays (Mon-Fri)."""
    if calendar == "daily":
        return F.date_add(last, step)
    if calendar == "weekday":
        wd = F.weekday(last)
        base = F.date_sub(last, F.greatest(wd - F.lit(4), F.lit(0)))
        wdb = F.least(wd, F.lit(4))
        return F.date_add(base, step + F.lit(2) * F.floor((wdb + step) / F.lit(5)).cast("int"))
    raise ValueError(f"calendar must be 'daily' or 'weekday', not {calendar!r}")


def future_dates(last_dates: DataFrame, horizon: int = 365, date_col: str = "last_date", calendar: str = "daily") -> DataFrame:
    """``(symbol, step, date)`` for the ``horizon`` periods after each last date."""
    return last_dates.select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(int(horizon)))).alias("step")
    ).withColumn("date", future_date(F.col(date_col), F.col("step"), calendar))


def last_dates(df: DataFrame, keys: Sequence[str] = ("symbol",), date_col: str = "date") -> DataFrame:
    return df.groupBy(*keys).agg(F.max(date_col).alias("last_date"))


def forecast_in_units(
    forecast: DataFrame, params: DataFrame, keys: Sequence[str] = ("symbol",), calendar: str = "daily"
) -> DataFrame:
    """Attach future dates and original units to a scaled forecast."""
    d = forecast.withColumn("date", future_date(F.col("last_date"), F.col("step"), calendar))
    return apply_minmax(d, params, "pred", "pred_usd", keys=keys, inverse=True)


def timeline(real: DataFrame, predicted: DataFrame, future: DataFrame) -> DataFrame:
    """Real, predicted and future values on one axis: ``(kind, symbol, date, value)``."""
    return (
        real.select(F.lit("real").alias("kind"), "symbol", "date", "value")
        .unionByName(predicted.select(F.lit("pred").alias("kind"), "symbol", "date", "value"))
        .unionByName(future.select(F.lit("future").alias("kind"), "symbol", "date", "value"))
    )


def ml_frame(samples: DataFrame, x_col: str = "X", y_col: str = "y") -> DataFrame:
    """Sample arrays -> ``features`` ML vector + ``label`` (JVM-side conversion)."""
    from pyspark.ml.functions import array_to_vector

    return samples.withColumn("features", array_to_vector(F.col(x_col))).withColumn("label", F.col(y_col))


def fit_lag_model(
    train: DataFrame,
    weight_col: str | None = None,
    reg_param: float = 0.0,
    kind: str = "linear",
    per_symbol: bool = False,
):
    """Fit one global regressor on lag windows with ``pyspark.ml``.

    ``kind='linear'``: normal equations; only the small Gram matrix is
    tree-aggregated, never the rows. ``kind='gbt'``: gradient-boosted trees.
    ``per_symbol`` gives every series its own level: features and label are
    centred on the symbol's means (one aggregate, one join), which fits the
    same coefficients as a term per symbol would, for any number of symbols
    (see ``CentredModel``). Returns a fitted model that reads the ``features``
    / ``label`` columns of ``ml_frame``.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import GBTRegressor, LinearRegression

    if per_symbol:
        means = materialize(symbol_means(train), "symbol-means")
        inner = fit_lag_model(centred(train, means), weight_col, reg_param, kind)
        return CentredModel(inner, means)
    if kind == "linear":
        est = LinearRegression(featuresCol="features", labelCol="label", regParam=reg_param, solver="normal")
    elif kind == "gbt":
        est = GBTRegressor(featuresCol="features", labelCol="label", seed=42)
    else:
        raise ValueError(f"kind must be 'linear' or 'gbt', not {kind!r}")
    if weight_col:
        est = est.setWeightCol(weight_col)
    return Pipeline(stages=[est]).fit(train)


def symbol_means(frame: DataFrame, key: str = "symbol") -> DataFrame:
    """(key, _mx, _my): the means of features and label per symbol, and over all rows under a NULL key (for symbols not seen)."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer

    means = [vector_to_array(Summarizer.mean(F.col("features"))).alias("_mx"), F.avg("label").alias("_my")]
    return frame.groupBy(key).agg(*means).unionByName(frame.agg(*means).withColumn(key, F.lit(None).cast("string")))


def centred(frame: DataFrame, means: DataFrame, key: str = "symbol") -> DataFrame:
    """``frame`` with features and label less the symbol's means; ``_my`` is kept."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    whole = means.where(F.col(key).isNull()).select(F.col("_mx").alias("_ax"), F.col("_my").alias("_ay")).withColumn("_one", F.lit(1))
    own = means.where(F.col(key).isNotNull())
    d = frame.join(own, key, "left").withColumn("_one", F.lit(1)).join(F.broadcast(whole), "_one").drop("_one")  # one row
    d = d.withColumn("_mx", F.coalesce("_mx", "_ax")).withColumn("_my", F.coalesce("_my", "_ay")).drop("_ax", "_ay")
    x = F.zip_with(vector_to_array("features"), F.col("_mx"), lambda a, b: a - b)
    return d.withColumn("features", array_to_vector(x)).withColumn("label", F.col("label") - F.col("_my")).drop("_mx")


class CentredModel:
    """A model of centred series; ``transform`` adds the symbol's mean back to label and prediction."""

    def __init__(self, model, means: DataFrame):
        self.model, self.means = model, means

    def transform(self, frame: DataFrame) -> DataFrame:
        d = self.model.transform(centred(frame, self.means))
        return d.withColumn("prediction", F.col("prediction") + F.col("_my")).withColumn("label", F.col("label") + F.col("_my")).drop("_my")


def score_model(model, samples: DataFrame, model_name: str, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Long prediction rows ``(model, symbol, date, real, pred)`` for ML-scored samples."""
    return model.transform(samples).select(
        F.lit(model_name).alias("model"), *keys, "date", F.col("label").alias("real"), F.col("prediction").alias("pred")
    )


def lag_statistics(samples: DataFrame, window: int, keys: Sequence[str] = ("symbol",), x_col: str = "X", y_col: str = "y") -> DataFrame:
    """``(keys, n, mean, scatter)``: what a least-squares fit needs of each series' samples.

    ``mean`` holds the means of the ``window`` lags and of y, ``scatter`` the
    upper triangle of their centred cross products. One aggregate whose parts
    are combined before the shuffle: (window + 1)(window + 2) / 2 numbers per
    series leave a task, never the samples."""
    names = [f"_v{i}" for i in range(window + 1)]
    d = samples.filter((F.size(x_col) == window) & F.col(y_col).isNotNull())
    d = d.select(*keys, *[F.get(x_col, F.lit(i)).alias(names[i]) for i in range(window)], F.col(y_col).alias(names[window]))
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    means = "array(" + ", ".join(f"avg({v})" for v in names) + ")"
    scatter = "array(" + ", ".join(f"covar_pop({a}, {b}) * count(1)" for a, b in pairs) + ")"
    return d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.expr(means).alias("mean"), F.expr(scatter).alias("scatter"))


def _square(scatter: pd.Series, size: int) -> np.ndarray:
    """The full matrices of upper triangles, stacked."""
    out = np.zeros((len(scatter), size, size))
    if len(scatter):
        i, j = np.triu_indices(size)
        out[:, i, j] = out[:, j, i] = np.stack(scatter.to_numpy())
    return out


_STATISTICS = "n double, mean array<double>, scatter array<double>"


def _schema(df: DataFrame, keys: Sequence[str], rest: str) -> str:
    return ", ".join([*(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys), rest])


def merge_statistics(first: DataFrame, second: DataFrame, window: int, weight: float = 1.0, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """The statistics of both tables' samples together, those of ``second`` weighted; a series may be in one of them only."""
    size = window + 1
    second = second.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("n").alias("n2"), F.col("mean").alias("mean2"), F.col("scatter").alias("scatter2"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    both = first.join(second, same, "full_outer").select(*[F.coalesce(k, f"_{k}").alias(k) for k in keys], "n", "mean", "scatter", "n2", "mean2", "scatter2")
    upper = np.triu_indices(size)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        zero, none = np.zeros(size), np.zeros(len(upper[0]))
        filled = lambda c, other: [other if x is None else x for x in c]
        for d in parts:
            n1, n2 = d["n"].fillna(0).to_numpy(float), d["n2"].fillna(0).to_numpy(float) * weight
            m1, m2 = np.array(filled(d["mean"], zero)).reshape(len(d), size), np.array(filled(d["mean2"], zero)).reshape(len(d), size)
            s1, s2 = _square(pd.Series(filled(d["scatter"], none)), size), _square(pd.Series(filled(d["scatter2"], none)), size)
            apart, n = m2 - m1, n1 + n2
            share = np.divide(n2, n, out=np.zeros_like(n), where=n > 0)
            mean = m1 + apart * share[:, None]
            scatter = s1 + weight * s2 + (n1 * share)[:, None, None] * apart[:, :, None] * apart[:, None, :]
            yield d[[*keys]].assign(n=n, mean=list(mean), scatter=list(scatter[:, upper[0], upper[1]]))

    return both.mapInPandas(run, _schema(first, keys, _STATISTICS))


_MODEL = "n double, coef array<double>, intercept double"


def solve_models(statistics: DataFrame, window: int, keys: Sequence[str] = ("symbol",), prior: DataFrame | None = None, strength: float = 0.0) -> DataFrame:
    """One linear model per series, ``(keys, n, coef, intercept)``: the least squares of its statistics.

    With ``prior``, a table ``(keys, coef)`` of earlier slopes, ``strength *
    |coef - prior|^2`` is added to the squared errors, so a model moves from its
    earlier slopes as far as the new data ask for; a series without a prior is
    pulled towards zero. Slopes that the data leave open are the smallest ones
    (a constant series has slope 0 and its mean). Series are solved in batches,
    each by one small system."""
    d = statistics.select(*keys, F.col("n").cast("double").alias("n"), "mean", "scatter")
    if prior is not None:
        old = prior.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("coef").alias("prior"))
        d = d.join(old, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left").drop(*[f"_{k}" for k in keys])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            whole = _square(part["scatter"], window + 1)
            mean = np.array(part["mean"].tolist()).reshape(len(part), window + 1)
            xx, xy = whole[:, :window, :window], whole[:, :window, window]
            if strength:
                xx = xx + strength * np.eye(window)
                if "prior" in part:
                    xy = xy + strength * np.array([np.zeros(window) if p is None else p for p in part["prior"]]).reshape(len(part), window)
            coef = (np.linalg.pinv(xx, hermitian=True) @ xy[:, :, None])[:, :, 0]
            yield part[[*keys, "n"]].assign(coef=list(coef), intercept=mean[:, window] - (coef * mean[:, :window]).sum(axis=1))

    return d.mapInPandas(run, _schema(statistics, keys, _MODEL))


def score_models(samples: DataFrame, models: DataFrame, window: int, keys: Sequence[str] = ("symbol",), x_col: str = "X", out_col: str = "pred") -> DataFrame:
    """Each sample scored by its series' model; a series without one has no rows."""
    small = models.select(*keys, F.col("coef").alias("_coef"), F.col("intercept").alias("_c"))
    total = F.col("_c")
    for i in range(window):
        total = total + F.get(x_col, F.lit(i)) * F.get("_coef", F.lit(i))
    return samples.join(small, list(keys)).withColumn(out_col, total).drop("_coef", "_c")


def forecast_models(seeds: DataFrame, models: DataFrame, horizon: int = 365, keys: Sequence[str] = ("symbol",), seed_col: str = "seed") -> DataFrame:
    """The recursive forecast of every series by its own model: ``(keys, step, pred)``.

    Steps follow each other, series do not: a batch of series takes a step by
    one matrix operation. Seeds of another length than the slopes have none."""
    d = seeds.join(models.select(*keys, "coef", "intercept"), list(keys)).filter(F.size(seed_col) == F.size("coef")).select(*keys, F.col(seed_col).alias("seed"), "coef", "intercept")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for _, same in part.groupby(part["coef"].map(len)):
                window, coef, level = np.array(same["seed"].tolist(), float), np.array(same["coef"].tolist(), float), same["intercept"].to_numpy(float)
                out = np.zeros((len(same), horizon))
                for h in range(horizon):
                    out[:, h] = (window * coef).sum(axis=1) + level
                    window = np.concatenate([window[:, 1:], out[:, h : h + 1]], axis=1)
                yield same[[*keys]].assign(path=list(out))

    paths = d.mapInPandas(run, _schema(seeds, keys, "path array<double>"))
    return paths.select(*keys, F.posexplode("path").alias("_p", "pred")).select(*keys, (F.col("_p") + 1).cast("int").alias("step"), "pred")


def tune_compare(own: DataFrame, external: DataFrame, window: int, strength: float, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Before and after tuning a model to an external series (M8).

    ``before`` is solved from the statistics of the own training samples, which
    are read for them once; ``after`` starts from its slopes and takes in the
    statistics of the external training samples, with a penalty on moving away.
    Both are scored on the external test samples. ``own`` is one series."""
    train = lambda d: d.filter(F.col("split") == "train")
    before = materialize(solve_models(lag_statistics(train(own), window, keys), window, keys), "model-before")
    one = before.select("coef", "intercept").withColumn("_one", F.lit(1))
    start = external.select(*keys).distinct().withColumn("_one", F.lit(1)).join(F.broadcast(one), "_one").drop("_one")  # one row: the own series' model
    after = solve_models(lag_statistics(train(external), window, keys), window, keys, prior=start, strength=strength)
    test = external.filter(F.col("split") == "test")
    stages = [score_models(test, m, window, keys).select(F.lit(name).alias("stage"), F.col("y").alias("real"), "pred") for name, m in (("before", start), ("after", after))]
    return regression_metrics(stages[0].unionByName(stages[1]), by=("stage",))


def refit_compare(own: DataFrame, external: DataFrame, external_weight: float = 0.1) -> DataFrame:
    """Before/after comparison of adding an external series at lower influence.

    ``before``: fit on own training samples; ``after``: fit on own plus
    external training samples, the external rows weighted ``external_weight``.
    Both are scored on the external test samples (the fine-tuning target).
    """
    own_tr = ml_frame(own.filter(F.col("split") == "train")).withColumn("w", F.lit(1.0))
    ext = ml_frame(external)
    ext_tr = ext.filter(F.col("split") == "train").withColumn("w", F.lit(float(external_weight)))
    ext_te = ext.filter(F.col("split") == "test")
    before = fit_lag_model(own_tr, "w")
    after = fit_lag_model(own_tr.unionByName(ext_tr), "w")
    preds = score_model(before, ext_te, "before").unionByName(score_model(after, ext_te, "after"))
    return regression_metrics(preds.withColumnRenamed("model", "stage"), by=("stage",))

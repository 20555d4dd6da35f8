"""Buckets from the data, impulse-response forecasts, one model per series, tuning."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricelake.operators import forecast, ordering
from pricelake.session import materialize

# ---------------------------------------------------------------- P9: buckets from the data


def bucketed(spark, rows, schema, order_col, size=1000, **kw):
    d = ordering.data_buckets(spark.createDataFrame(rows, schema).repartition(7), order_col=order_col, rows=size, **kw)
    sizes = {tuple(r)[:2]: r["count"] for r in d.groupBy("symbol", "_bkt").count().collect()}
    s = ordering.series_index(d, order_col=order_col)
    w = Window.partitionBy("symbol").orderBy(order_col)
    wrong = s.where(F.col(order_col).isNotNull()).withColumn("want", F.row_number().over(w) - 1).where("idx <> want").count()
    return sizes, s, wrong


def test_rows_of_one_second_are_cut_into_bounded_buckets(spark):
    start = dt.datetime(2024, 5, 1, 12, 0, 0)
    rnd = random.Random(2)
    offsets = rnd.sample(range(1_000_000), 60_000)
    rows = [("hot", start + dt.timedelta(microseconds=o)) for o in offsets] + [("small", start + dt.timedelta(days=400 * i)) for i in range(20)]
    sizes, s, wrong = bucketed(spark, rows, "symbol string, ts timestamp", "ts")
    assert wrong == 0 and s.count() == 60_020
    hot = [n for (symbol, _), n in sizes.items() if symbol == "hot"]
    assert max(hot) <= 1250 and len(hot) >= 55
    assert [n for (symbol, _), n in sizes.items() if symbol == "small"] == [20]


def test_skewed_values_and_a_bounded_number_of_buckets(spark):
    rnd = random.Random(4)
    rows = [("a", rnd.lognormvariate(0, 5)) for _ in range(30_000)] + [("a", 1e300)]
    sizes, _, wrong = bucketed(spark, rows, "symbol string, t double", "t", size=100, most=64)
    assert wrong == 0 and len(sizes) <= 64 and max(sizes.values()) <= 1.25 * 30_001 / 64


def test_dates_of_one_month_ties_nulls_and_other_columns(spark):
    rows = [("a", dt.date(2024, 1, 1 + i % 31), i) for i in range(31)] + [("b", None, 1), ("b", dt.date(2020, 1, 1), 2), (None, dt.date(2020, 1, 1), 3)]
    d = ordering.data_buckets(spark.createDataFrame(rows, "symbol string, date date, _all int"), rows=10)
    assert d.columns == ["symbol", "date", "_all", "_bkt"] and d.count() == 34
    got = ordering.series_index(d).collect()
    assert sorted(r.idx for r in got if r.symbol == "a") == list(range(31)) and [r.idx for r in got if r.symbol == "b"] == [0]
    tied = ordering.data_buckets(spark.createDataFrame([("a", 5)] * 500, "symbol string, t int"), order_col="t", rows=10)
    assert tied.select("_bkt").distinct().count() == 1
    with pytest.raises(TypeError, match="bucket column"):
        ordering.data_buckets(spark.createDataFrame([("a", "x")], "symbol string, date string"))


def static_plan(spark, df):
    """The physical plan without AQE and without joins that are broadcast for their size alone."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_rows_of_few_series_are_not_dealt_by_series(spark):
    rows = spark.range(20_000).select(F.lit("a").alias("symbol"), (F.col("id") * 7919 % 100_003).alias("t"))
    d = ordering.data_buckets(materialize(rows, "few-series"), order_col="t", rows=100)
    plan = static_plan(spark, d)  # dealt by series, all rows of one series would look for their bucket in one task
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    b = d.groupBy("_bkt").agg(F.count("*").alias("n"), F.min("t").alias("a"), F.max("t").alias("z")).orderBy("_bkt").collect()
    assert sum(r.n for r in b) == 20_000 and max(r.n for r in b) <= 125 and len(b) >= 160
    assert all(x.z < y.a for x, y in zip(b, b[1:]))


@pytest.mark.parametrize("most", [2, 64, 65, 5000])
def test_buckets_at_the_bounds_of_the_search(spark, most):
    rows = [("a", i * i) for i in range(3000)] + [("b", 5)] * 40 + [(None, 3), (None, 4), ("c", None)]
    d = ordering.data_buckets(spark.createDataFrame(rows, "symbol string, t int"), order_col="t", rows=1, most=most).collect()
    assert sorted((r.symbol or "", r.t or 0) for r in d) == sorted((s or "", t or 0) for s, t in rows)
    a = [r["_bkt"] for r in sorted((r for r in d if r.symbol == "a"), key=lambda r: r.t)]
    assert a == sorted(a) and 0 <= a[0] and a[-1] < most and len(set(a)) >= 0.8 * min(most, 3000)
    assert max(a.count(b) for b in set(a)) <= 1.25 * max(1, 3000 / most) + 1
    assert [r["_bkt"] for r in d if r.symbol == "c"] == [None] and len({r["_bkt"] for r in d if r.symbol == "b"}) == 1


def test_rows_are_sorted_once_for_their_positions(spark):
    d = spark.range(1000).select(F.lit("a").alias("symbol"), F.col("id").alias("t"), F.floor(F.col("id") / 50).cast("int").alias("_bkt"))
    s = ordering.series_index(materialize(d, "bucketed").repartition("symbol", "_bkt"), order_col="t")
    of_rows = [x for x in static_plan(spark, s).splitlines() if "Sort [" in x and "Window" not in x]
    assert len(of_rows) == 3  # rows by (series, bucket, t); counts for their sum; offsets for the join
    assert all(r.t == r.idx for r in s.collect()) and s.count() == 1000


# ---------------------------------------------------------------- M4: impulse response


def recursion(seed, coef, horizon, level=0.0):
    window, out = list(seed), []
    for _ in range(horizon):
        out.append(float(np.dot(window, coef)) + level)
        window = window[1:] + out[-1:]
    return out


@pytest.mark.parametrize("w", [1, 2, 7])
def test_forecast_equals_the_recursion(spark, w):
    rnd = random.Random(w)
    coef = [rnd.uniform(-0.5, 0.5) for _ in range(w)]
    seeds = [(f"s{i}", [rnd.uniform(-10, 10) for _ in range(w)], dt.date(2024, 1, 1), 9) for i in range(5)] + [("short", [1.0] * (w - 1), None, 9), ("none", None, None, 9)]
    df = spark.createDataFrame(seeds, "symbol string, seed array<double>, last_date date, _m int")
    got = forecast.recursive_forecast(df, coef, 40).collect()
    assert {r.symbol for r in got} == {f"s{i}" for i in range(5)} and len(got) == 200
    for symbol, seed, _, _ in seeds[:5]:
        path = [r.pred for r in sorted((r for r in got if r.symbol == symbol), key=lambda r: r.step)]
        assert np.allclose(path, recursion(seed, coef, 40), rtol=1e-9, atol=1e-12)


# ---------------------------------------------------------------- M2: one model per series


def samples_of(rows):
    return [(s, [float(x) for x in xs], float(y)) for s, xs, y in rows]


def test_five_thousand_series_each_find_their_own_rule(spark):
    n = 5000
    d = spark.range(n * 12).select((F.col("id") % n).alias("k"), F.floor(F.col("id") / n).alias("i"))
    x = [F.sin(F.col("k") * (j + 1) + F.col("i") * (j + 2)) for j in range(2)]
    d = d.select(F.concat(F.lit("s"), F.col("k")).alias("symbol"), F.array(*x).alias("X"), "k")
    d = d.withColumn("y", F.get("X", F.lit(0)) * F.col("k") / 1000 - F.get("X", F.lit(1)) * 2 + F.col("k"))
    models = forecast.solve_models(forecast.lag_statistics(d, 2), 2)
    got = models.withColumn("k", F.substring("symbol", 2, 9).cast("int")).select(
        F.max(F.abs(F.get("coef", F.lit(0)) - F.col("k") / 1000)), F.max(F.abs(F.get("coef", F.lit(1)) + 2)), F.max(F.abs(F.col("intercept") - F.col("k"))), F.count("*")
    )
    a, b, c, rows = got.first()
    assert rows == n and max(a, b, c) < 1e-6


def test_fit_equals_least_squares_and_open_slopes_are_the_smallest(spark):
    rnd = random.Random(9)
    rows = [("fit", [rnd.random() * 100 for _ in range(4)], rnd.random()) for _ in range(50)]
    rows += [("constant", [3.0] * 4, 3.0)] * 5 + [("one", [1.0, 2.0, 3.0, 4.0], 7.0)] + [("fit", [1.0], 5.0), ("fit", None, 5.0), ("fit", [1.0] * 4, None)]
    df = spark.createDataFrame(rows, "symbol string, X array<double>, y double").repartition(4)
    got = {r.symbol: r for r in forecast.solve_models(forecast.lag_statistics(df, 4), 4).collect()}
    a = np.array([[*x, 1.0] for s, x, _ in rows[:50]])
    want = np.linalg.lstsq(a, np.array([y for _, _, y in rows[:50]]), rcond=None)[0]
    assert np.allclose([*got["fit"].coef, got["fit"].intercept], want) and got["fit"].n == 50
    assert got["constant"].coef == [0.0] * 4 and got["constant"].intercept == 3.0
    assert got["one"].coef == [0.0] * 4 and got["one"].intercept == 7.0


def test_merged_statistics_equal_those_of_all_samples(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("abc"), [rnd.gauss(1e4, 1), rnd.gauss(0, 5)], rnd.random()) for _ in range(200)]
    schema = "symbol string, X array<double>, y double"
    first, second = rows[:90], [r for r in rows[90:] if r[0] != "c"] + [("new", [1.0, 2.0], 3.0)]
    stats = lambda r: forecast.lag_statistics(spark.createDataFrame(r, schema), 2)
    merged = {r.symbol: r for r in forecast.merge_statistics(stats(first), stats(second), 2).collect()}
    for r in stats(first + second).collect():
        m = merged.pop(r.symbol)
        assert m.n == r.n and np.allclose(m.mean, r["mean"]) and np.allclose(m.scatter, r.scatter, rtol=1e-9, atol=1e-9)
    assert not merged
    halved = {r.symbol: r for r in forecast.merge_statistics(stats(first), stats(first), 2, weight=0.5).collect()}
    whole = {r.symbol: r for r in stats(first).collect()}
    assert all(np.isclose(halved[s].n, 1.5 * whole[s].n) and np.allclose(halved[s].scatter, 1.5 * np.array(whole[s].scatter)) for s in whole)


def test_forecast_of_each_series_by_its_own_model(spark):
    models = spark.createDataFrame([("a", [0.5, 0.4], 1.0), ("b", [0.0, 1.0], 0.0), ("c", [1.0], 2.0)], "symbol string, coef array<double>, intercept double")
    seeds = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 4.0]), ("c", [5.0]), ("d", [1.0, 1.0]), ("a", [0.0])], "symbol string, seed array<double>")
    got = forecast.forecast_models(seeds, models, 6).collect()
    want = {"a": recursion([1.0, 2.0], [0.5, 0.4], 6, 1.0), "b": [4.0] * 6, "c": [7.0, 9.0, 11.0, 13.0, 15.0, 17.0]}
    assert len(got) == 18
    for s, path in want.items():
        assert np.allclose([r.pred for r in sorted((r for r in got if r.symbol == s), key=lambda r: r.step)], path)


# ---------------------------------------------------------------- M8: tuning


def test_tuning_moves_from_the_prior_to_the_new_fit(spark):
    rnd = random.Random(6)
    rows = [("s", [x0 := rnd.random(), x1 := rnd.random()], 2 * x0 - x1 + 5) for _ in range(100)]
    stats = forecast.lag_statistics(spark.createDataFrame(rows, "symbol string, X array<double>, y double"), 2)
    prior = spark.createDataFrame([("s", [10.0, 10.0])], "symbol string, coef array<double>")
    slopes = [forecast.solve_models(stats, 2, prior=prior, strength=k).first().coef for k in (0.0, 1.0, 100.0, 1e9)]
    assert np.allclose(slopes[0], [2, -1]) and np.allclose(slopes[3], [10, 10], atol=1e-4)
    away = [np.hypot(a - 2, b + 1) for a, b in slopes]
    assert away == sorted(away)
    free = forecast.solve_models(stats, 2, prior=prior.where("symbol = 'x'"), strength=1.0).first().coef
    assert np.allclose(free, np.linalg.solve(np.cov(np.array([r[1] for r in rows]).T, ddof=0) * 100 + np.eye(2), np.cov(np.array([[*r[1], r[2]] for r in rows]).T, ddof=0)[:2, 2] * 100))


def test_tuning_reads_the_own_samples_once(spark):
    """The own samples are scanned for their statistics only, not again for the tuned model or the scores."""
    import datetime

    seen = spark.sparkContext.accumulator(0)

    def counted(parts):
        for p in parts:
            seen.add(p.num_rows)
            yield p

    rnd = random.Random(8)
    make = lambda s, n: [(s, i, datetime.date(2020, 1, 1), [rnd.random(), rnd.random()], rnd.random(), "train" if i < 0.8 * n else "test") for i in range(n)]
    schema = "symbol string, idx bigint, date date, X array<double>, y double, split string"
    own = spark.createDataFrame(make("own", 50), schema).mapInArrow(counted, schema)
    rows = forecast.tune_compare(own, spark.createDataFrame(make("ext", 30), schema), 2, 5.0).collect()
    assert {r.stage: r.n for r in rows} == {"before": 6, "after": 6}
    assert seen.value == 50

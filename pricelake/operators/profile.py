"""Profiling: summary statistics, missing counts, correlations, box plots,
histograms (A1-A7, A9).

Sums and extremes come from one aggregate over the wide rows; only what needs
the values one by one (quantiles, bins) unpivots them to ``(symbol, column,
value)``. Missing values (NULL or NaN) are left out of every statistic, as
pandas does.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.functions.numeric import is_missing, order_image
from pricelake.operators.normalize import sql_str
from pricelake.session import materialize

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def long_values(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("symbol",)
) -> DataFrame:
    """``(keys, column, value DOUBLE)`` without missing values."""
    d = df.select(*keys, *[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    return d.unpivot(list(keys), [f"`{c}`" for c in columns], "column", "value").filter(~is_missing("value", T.DoubleType()))


def narrow(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The columns that a profile reads, written once: it reads them in several passes."""
    return materialize(df.select(*keys, *[F.col(f"`{c}`").cast("double").alias(c) for c in columns]), "profile-input")


def _locate(counts: DataFrame, part: Sequence[str]) -> DataFrame:
    """Of (part, _d, _c) the digits that hold a target rank of ``_t``, with the ranks they hold as ``_t`` and the rows before them as ``_start``."""
    before = Window.partitionBy(*part).orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    d = counts.withColumn("_start", F.col("_from") + F.coalesce(F.sum("_c").over(before), F.lit(0)))
    hit = lambda t: (t["k"] >= F.col("_start")) & (t["k"] < F.col("_start") + F.col("_c"))
    return d.withColumn("_t", F.filter("_t", hit)).filter(F.size("_t") > 0)


def exact_quantiles(
    v: DataFrame,
    group: Sequence[str],
    probs: Sequence[tuple[str, float]],
    value: str = "value",
    digit: int = 16,
    rows: int | None = None,
) -> DataFrame:
    """Exact quantiles (linear interpolation between the order statistics at
    floor and ceil of p*(n-1), as pandas and SQL ``quantile_cont``) by radix
    selection, whatever the values' spread.

    Values are read as their ``order_image``. A round counts the rows of each
    group by the image's next ``digit`` bits (combined before the shuffle),
    adds the counts up, and keeps the prefixes that hold a target rank; the
    next round counts only rows with a kept prefix. A rank is found as soon as
    its prefix holds one distinct value or the rank is the prefix's first or
    last, so spread-out values take one or two rounds, and no input takes more
    than ``64 / digit``.

    A task holds at most ``2 ** digit`` counts of one group and prefix. No
    table of the distinct values is made and no rows are sorted. ``v`` is read
    once per round: write it first if it is costly. A caller who knows that no
    group has more than ``rows`` rows says so: if that is no more than the counts
    of a digit, all bits are one digit. Returns ``(group, <name>...)``.
    """
    g = list(group)
    if rows is not None and rows <= 1 << digit:
        digit = 64
    d = v.filter(~is_missing(value, T.DoubleType())).select(*g, F.col(value).cast("double").alias("_v")).withColumn("_i", order_image("_v"))
    n1 = (F.col("_n") - F.lit(1)).cast("double")
    targets = F.array(
        *[
            F.struct(F.lit(name).alias("q"), F.lit(side).alias("side"), fn(F.lit(float(p)) * n1).cast("long").alias("k"))
            for name, p in probs
            for side, fn in (("lo", F.floor), ("hi", F.ceil))
        ]
    )
    stats = [F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    first, last = F.col("_k") == F.col("_start"), F.col("_k") == F.col("_start") + F.col("_c") - 1
    found = F.when((F.col("_lo") == F.col("_hi")) | first, F.col("_lo")).when(last, F.col("_hi"))
    rounds, kept, shift = [], None, 64 - digit
    while True:
        low = F.shiftright("_i", max(shift, 0)).alias("_d")
        if kept is None:
            part = g
            counts = d.groupBy(*g, low).agg(*stats).withColumn("_n", F.sum("_c").over(Window.partitionBy(*g)))
            counts = counts.withColumn("_t", targets).withColumn("_from", F.lit(0).cast("long"))
        else:
            part = [*g, "_p"]
            inside = d.withColumn("_p", F.shiftright("_i", shift + digit)).join(kept.select(*part), part, "left_semi")
            counts = inside.groupBy(*part, low).agg(*stats).join(kept, part)
        located = _locate(counts, part).select(*g, "_n", "_d", "_start", "_c", "_lo", "_hi", F.explode("_t").alias("_t"))
        located = located.select("*", F.col("_t.q").alias("_q"), F.col("_t.side").alias("_side"), F.col("_t.k").alias("_k"))
        picked = materialize(located.select(*g, "_n", "_d", "_start", "_t", "_q", "_side", found.alias("_x")), "quantile-round")
        rounds.append(picked.filter("_x is not null").select(*g, "_n", "_q", "_side", "_x"))
        open_ = picked.filter("_x is null")
        if shift <= 0 or open_.isEmpty():
            break
        kept = open_.groupBy(*g, F.col("_d").alias("_p"), "_n", F.col("_start").alias("_from")).agg(F.collect_list("_t").alias("_t"))
        shift -= digit
    picked = rounds[0]
    for more in rounds[1:]:
        picked = picked.unionByName(more)
    sides = picked.groupBy(*g, "_n").agg(
        *[
            F.max(F.when((F.col("_q") == name) & (F.col("_side") == side), F.col("_x"))).alias(f"{name}_{side}")
            for name, _ in probs
            for side in ("lo", "hi")
        ]
    )
    frac = {name: F.lit(float(p)) * n1 - F.floor(F.lit(float(p)) * n1) for name, p in probs}
    between = lambda n: F.when(F.col(f"{n}_lo") == F.col(f"{n}_hi"), F.col(f"{n}_lo")).otherwise(F.col(f"{n}_lo") + (F.col(f"{n}_hi") - F.col(f"{n}_lo")) * frac[n])
    return sides.select(*g, *[between(n).alias(n) for n, _ in probs])


def quantiles(v: DataFrame, group: Sequence[str], probs: Sequence[tuple[str, float]], method: str = "exact", accuracy: int = 10000, rows: int | None = None) -> DataFrame:
    """``(group, <name>...)`` quantiles of ``value``: ``exact`` is the
    distributed ``exact_quantiles``, for every size; ``approx`` is Spark's
    ``percentile_approx`` in one pass. The caller chooses."""
    if method == "approx":
        return v.groupBy(*group).agg(*[F.percentile_approx("value", F.lit(p), F.lit(accuracy)).alias(n) for n, p in probs])
    if method != "exact":
        raise ValueError(f"method must be 'exact' or 'approx', not {method!r}")
    return exact_quantiles(v, group, probs, rows=rows)


def wide_stats(df: DataFrame, columns: Sequence[str], keys: Sequence[str], stats: dict) -> DataFrame:
    """``(keys, column, <stat>...)`` from one aggregate over the wide rows; only
    its small result is turned into one row per column. stats: name -> function
    of a Column."""
    number = lambda c: F.when(~is_missing(F.col(f"`{c}`"), T.DoubleType()), F.col(f"`{c}`").cast("double"))
    d = df.select(*keys, *[number(c).alias(f"_{i}") for i, c in enumerate(columns)])
    one = d.groupBy(*keys).agg(*[f(F.col(f"_{i}")).alias(f"_{i}_{n}") for i in range(len(columns)) for n, f in stats.items()])
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"_{i}_{n}").alias(n) for n in stats]) for i, c in enumerate(columns)]
    return one.select(*keys, F.inline(F.array(*rows)))


def describe(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    keys: Sequence[str] = ("symbol",),
    method: str = "exact",
) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 % (linear interpolation), max.

    Moments come from one algebraic aggregate; quantiles from ``quantiles``
    (exact and distributed by default, ``method='approx'`` for one pass).
    """
    columns = list(columns) if columns is not None else numeric_columns(df, keys)
    df = narrow(df, columns, keys)
    g = [*keys, "column"]
    probs = (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    moments = wide_stats(df, columns, keys, {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max})
    q = quantiles(long_values(df, columns, keys), g, probs, method, rows=df.count())
    return moments.filter("count > 0").join(q, g).select(*g, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column: type, non-missing count and missing count (NULL or
    NaN), plus the total row count -- one pass over the data."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        aggs.append(F.count_if(is_missing(F.col(f"`{f.name}`"), f.dataType)).alias(f"_m{i}"))
    one = df.agg(*aggs)
    rows = ", ".join(
        f"named_struct('column', {sql_str(f.name)}, 'dtype', '{f.dataType.simpleString()}', "
        f"'non_null', _rows - _m{i}, 'missing', _m{i}, 'rows', _rows)"
        for i, f in enumerate(fields)
    )
    return one.selectExpr(f"inline(array({rows}))")


def corr_matrix(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("symbol",), date_col: str | None = "date") -> DataFrame:
    """Pearson correlation of every pair, long ``(keys, col_a, col_b, r)``.

    The date takes part as a number (days since epoch; a linear rescale does
    not change r). All pairs come from one aggregate per series. Pairs drop
    rows where either side is missing, as pandas does.
    """
    d = df
    cols = list(columns)
    if date_col is not None:
        d = d.withColumn(date_col, F.unix_date(F.col(date_col)).cast("double"))
        cols = [date_col, *cols]
    d = d.select(*keys, *[F.when(~is_missing(F.col(f"`{c}`"), T.DoubleType()), F.col(f"`{c}`").cast("double")).alias(c) for c in cols])
    pairs = [(a, a) for a in cols] + list(combinations(cols, 2))
    agg = d.groupBy(*keys).agg(*[F.corr(f"`{a}`", f"`{b}`").alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        cells.append(f"named_struct('col_a', {sql_str(a)}, 'col_b', {sql_str(b)}, 'r', _{i})")
        if a != b:
            cells.append(f"named_struct('col_a', {sql_str(b)}, 'col_b', {sql_str(a)}, 'r', _{i})")
    # One SQL expression for the whole matrix (one call, not hundreds of Column objects).
    return agg.selectExpr(*[f"`{k}`" for k in keys], f"inline(array({', '.join(cells)}))")


def outlier_stats(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = ("symbol",),
    whisker: float = 1.5,
    method: str = "exact",
) -> DataFrame:
    """Box-plot numbers per series and column: quartiles, IQR fences, the most
    extreme values inside the fences (whisker ends) and the outlier count.
    Rows are counted, never removed.

    Quartiles per group (a table of #series x #columns rows that Spark
    broadcasts if small enough), then one aggregate against the fences.
    """
    df = narrow(df, columns, keys)
    v = long_values(df, columns, keys)
    g = [*keys, "column"]
    q = quantiles(v, g, (("q1", 0.25), ("q3", 0.75)), method, rows=df.count())
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    q = q.withColumn("lo_fence", F.col("q1") - F.lit(whisker) * F.col("iqr")).withColumn(
        "hi_fence", F.col("q3") + F.lit(whisker) * F.col("iqr")
    )
    x = F.col("value")
    inside = (x >= F.col("lo_fence")) & (x <= F.col("hi_fence"))
    stats = v.join(q, g).groupBy(*g, "q1", "q3", "iqr", "lo_fence", "hi_fence").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(inside, x)).alias("whisker_lo"),
        F.max(F.when(inside, x)).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"),
    )
    return stats


def histogram(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("symbol",), bins: int = 50) -> DataFrame:
    """Equal-width histogram per series and column, all ``bins`` bins (empty
    ones with count 0); the last bin is closed so the maximum falls in it.
    A constant column puts every value in bin 1. Infinite values have no bin
    and are left out, as missing ones are.

    min/max per group (one wide aggregate, written once) -> bin number per
    row -> grouped count; the bin grid is generated from the small per-group
    table, not a cross join. The input is read once, its columns are written.
    """
    df = narrow(df, columns, keys)
    v = long_values(df, columns, keys).filter(F.abs("value") < float("inf"))
    g = [*keys, "column"]
    finite = lambda f: lambda c: f(F.when(F.abs(c) < float("inf"), c))
    rng = wide_stats(df, columns, keys, {"lo": finite(F.min), "hi": finite(F.max)}).filter("lo is not null")
    rng = materialize(rng, "histogram-ranges")
    x, lo, hi = F.col("value"), F.col("lo"), F.col("hi")
    b = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.floor((x - lo) * F.lit(float(bins)) / (hi - lo)) + F.lit(1), F.lit(bins))
    ).cast("int")
    counts = v.join(rng, g).groupBy(*g, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select(*g, "lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    width = (hi - lo) / F.lit(float(bins))
    return (
        grid.join(counts, [*g, "bin"], "left")
        .select(
            *g,
            "bin",
            (lo + (F.col("bin") - 1) * width).alias("bin_lo"),
            (lo + F.col("bin") * width).alias("bin_hi"),
            F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"),
        )
    )

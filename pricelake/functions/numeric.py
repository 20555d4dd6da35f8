"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_missing(col: Column | str, dtype: T.DataType | None = None) -> Column:
    """NULL, or NaN for floating columns (what pandas calls missing)."""
    c = _c(col)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def ln_or_null(col: Column | str) -> Column:
    """Natural log; NULL for x <= 0 (numpy would give -inf / NaN)."""
    c = _c(col)
    return F.when(c > 0, F.ln(c))


def log1p_or_null(col: Column | str) -> Column:
    c = _c(col)
    return F.when(c > -1, F.log1p(c))


def minmax(col: Column | str, lo: Column | str, hi: Column | str) -> Column:
    """(x - min) / (max - min); a constant series maps to 0.0."""
    x, lo, hi = _c(col), _c(lo), _c(hi)
    rng = hi - lo
    return F.when(rng == 0, F.lit(0.0)).otherwise((x - lo) / rng)


def inverse_minmax(col: Column | str, lo: Column | str, hi: Column | str) -> Column:
    x, lo, hi = _c(col), _c(lo), _c(hi)
    return x * (hi - lo) + lo


def order_image(col: Column | str) -> Column:
    """A BIGINT that is ordered as the DOUBLE is: its bits without the sign, negated below zero.

    Exponent and fraction come from exact steps only (scaling by powers of
    two), so different numbers have different images. -0.0 and 0.0 share one,
    infinities are the extremes; NULL for NULL and NaN."""
    x = _c(col)
    a = F.when(F.abs(x) < float("inf"), F.abs(x))
    near = F.greatest(F.least(F.floor(F.log2(a)), F.lit(1023)), F.lit(-1022))  # one off at most
    scaled = a / F.pow(F.lit(2.0), near)
    e = near + F.when(scaled >= 2, 1).when((scaled < 1) & (near > -1022), -1).otherwise(0)
    fraction = (a / F.pow(F.lit(2.0), e) * F.lit(2.0**52)).cast("bigint")
    size = (e + 1022) * F.lit(2**52) + fraction
    positive = F.when(a == 0, F.lit(0).cast("bigint")).when(F.abs(x) == float("inf"), F.lit(2047 << 52)).otherwise(size)
    return F.when(x.isNotNull() & ~F.isnan(x), F.when(x < 0, -positive).otherwise(positive))

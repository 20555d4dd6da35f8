"""Radix-select quantiles and the order-preserving image they rest on."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from pricelake.functions.numeric import order_image
from pricelake.operators import profile

EDGE = [0.0, -0.0, 5e-324, 2.2250738585072009e-308, 2.2250738585072014e-308, 1.7976931348623157e308, 1.0, 2.0, 3.0, 4.0, 0.1, 100.0, 100.00000002, math.inf, math.pi, 2.0**52, 2.0**53 + 2, 1 - 2**-53, 1 + 2**-52]


def bits(x):
    """The image by its definition."""
    n = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -n if x < 0 else n


def test_image_is_the_bit_pattern(spark):
    rnd = random.Random(1)
    values = EDGE + [-x for x in EDGE] + [rnd.random() * 2.0 ** rnd.randint(-1070, 1020) for _ in range(3000)] + [2.0**e for e in range(-1074, 1024)]
    df = spark.createDataFrame([(x,) for x in values], "x double").select("x", order_image("x").alias("i"))
    assert all(r.i == bits(r.x) for r in df.collect())
    assert [r.i for r in spark.createDataFrame([(None,), (math.nan,)], "x double").select(order_image("x").alias("i")).collect()] == [None, None]


PROBS = (("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p0", 0.0), ("p100", 1.0))


@pytest.mark.parametrize(("digit", "rows_known"), [(7, None), (16, None), (16, 60_000)])
def test_equals_percentile_at_any_spread(spark, digit, rows_known):
    rnd = random.Random(3)
    rows = [("dense", 100 + rnd.random() * 2e-7) for _ in range(20_000)] + [("dense", 100.04)]
    rows += [("signs", rnd.choice([-1, 1]) * rnd.lognormvariate(0, 40)) for _ in range(5000)] + [("ties", float(rnd.randint(0, 3))) for _ in range(999)]
    rows += [("one", 5.0), ("two", -1.0), ("two", 1.0), ("nulls", None), ("nulls", math.nan), ("zeros", -0.0), ("zeros", 0.0), ("tiny", 5e-324), ("tiny", 1e-323)]
    v = spark.createDataFrame(rows, "symbol string, value double").repartition(5)
    got = {r.symbol: r.asDict() for r in profile.exact_quantiles(v, ["symbol"], PROBS, digit=digit, rows=rows_known).collect()}
    want = v.where(~F.isnan("value")).groupBy("symbol").agg(*[F.percentile("value", F.lit(p)).alias(n) for n, p in PROBS]).where("p50 is not null").collect()
    assert sorted(got) == sorted(r.symbol for r in want)
    for r in want:
        for n, _ in PROBS:
            assert math.isclose(got[r.symbol][n], r[n], rel_tol=1e-12, abs_tol=0) or got[r.symbol][n] == r[n], (r.symbol, n, got[r.symbol][n], r[n])


def test_infinite_values_take_part(spark):
    v = spark.createDataFrame([("s", x) for x in (-math.inf, 1.0, 2.0, 3.0, math.inf)], "symbol string, value double")
    r = profile.exact_quantiles(v, ["symbol"], PROBS).first()
    assert (r.p0, r.p25, r.p50, r.p75, r.p100) == (-math.inf, 1.0, 2.0, 3.0, math.inf)


def test_a_narrow_cluster_is_split_by_later_digits(spark):
    """200,000 values within 2e-7 of 100 and one apart: no prefix of a round has more than 2**16 digits below it."""
    v = spark.range(200_000).select(F.lit("s").alias("symbol"), (F.lit(100.0) + F.col("id") * F.lit(1e-12)).alias("value"))
    v = v.union(spark.createDataFrame([("s", 100.04)], "symbol string, value double"))
    image = v.select(order_image("value").alias("i"))
    for shift in (48, 32, 16):
        widest = image.groupBy(F.shiftright("i", shift).alias("p")).agg(F.count_distinct(F.shiftright("i", shift - 16)).alias("n")).agg(F.max("n")).first()[0]
        assert widest <= 2**16
    r = profile.exact_quantiles(v, ["symbol"], PROBS).first()
    assert math.isclose(r.p50, 100.0 + 1e-12 * 100_000, rel_tol=1e-15) and r.p100 == 100.04

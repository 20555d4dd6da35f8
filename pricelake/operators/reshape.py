"""Long <-> wide provider layouts (S3): ``(symbol, date, field...)`` <->
one ``Field_TICKER`` column per field and ticker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.operators.normalize import PROVIDER_FIELD_NAMES, sql_str
from pricelake.schemas import PRICE_FIELDS


def flat_name(field: str, ticker: str) -> str:
    return f"{PROVIDER_FIELD_NAMES[field]}_{ticker}"


def listed(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """``df`` whose ``col`` must be NULL or one of ``values``: another value
    stops the query instead of vanishing from a wide table."""
    ok = F.col(col).isNull() | F.col(col).isin(list(values))
    return df.withColumn(col, F.when(ok, F.col(col)).otherwise(F.raise_error(F.concat(F.lit(f"{col} not listed: "), F.col(col).cast("string")))))


def values_of(df: DataFrame, col: str, limit: int = 1000) -> list:
    """The distinct values of ``col``, sorted, for a wide table. More than
    ``limit`` are an error: columns that grow with the data belong in the long form."""
    got = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(got) > limit:
        raise ValueError(f"{col} has over {limit} values; use the long form")
    return sorted(got)


def flatten(long: DataFrame, tickers: Sequence[str], fields: Sequence[str] = PRICE_FIELDS, date_col: str = "date") -> DataFrame:
    """One row per date, one ``Field_TICKER`` column per field and ticker
    (a pivot with known values: a single aggregate, no discovery job). A
    symbol that ``tickers`` lacks is an error; see ``values_of``. The long
    form ``(symbol, date, field...)`` serves any number of symbols."""
    long = listed(long, "symbol", tickers)
    aggs = [
        F.expr(f"max(CASE WHEN symbol = {sql_str(t)} THEN {f} END) AS `{flat_name(f, t)}`") for t in tickers for f in fields
    ]
    return long.groupBy(F.col(date_col).alias("Date")).agg(*aggs)


def unflatten(wide: DataFrame, tickers: Sequence[str], fields: Sequence[str] = PRICE_FIELDS) -> DataFrame:
    """Back to ``(symbol, date, fields...)``; dates where a ticker has no
    values at all are dropped."""
    rows = F.array(
        *[
            F.struct(F.lit(t).alias("symbol"), *[F.col(f"`{flat_name(f, t)}`").alias(f) for f in fields])
            for t in tickers
        ]
    )
    out = wide.select(F.col("Date").alias("date"), F.inline(rows))
    any_value = F.lit(False)
    for f in fields:
        any_value = any_value | F.col(f).isNotNull()
    return out.filter(any_value)

"""Canonical projection, vertical union and deterministic one-row-per-date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.functions.dates import parse_date
from pricelake.operators.normalize import sql_str
from pricelake.schemas import PRICE_FIELDS, UNIFIED_COLUMNS

# Fixed value: default source priority for "first wins" (provider rows first).
DEFAULT_PRIORITY = ("yfinance", "csv")


def canonical(df: DataFrame, symbol: str | None = None) -> DataFrame:
    """Project any source frame onto the unified columns (drops ``id``, ``ticker``, ...).

    Prices are widened to DOUBLE (a FLOAT column of a SQL table becomes the
    exact double of its 32-bit value); a text ``date`` is parsed with every
    known layout; ``symbol`` fills a missing symbol column.
    """
    dtypes = dict(df.dtypes)

    def project(c: str):
        if c == "symbol" and c not in dtypes:
            return F.lit(symbol).cast("string").alias(c)
        if c in PRICE_FIELDS:  # a text that is no number is missing, and the row goes when the series is cleaned
            return F.col(c).try_cast("double").alias(c)
        if c == "date":
            return (F.col(c) if dtypes[c] == "date" else parse_date(F.col(c).cast("string"))).alias(c)
        return F.col(c).cast("string").alias(c)

    return df.select(*[project(c) for c in UNIFIED_COLUMNS])


# ISO-8601 with offset; with the session time zone in UTC it ends in +00:00.
ISO_UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def stamp_provenance(df: DataFrame, source: str, ticker: str | None = None, ingested_at: str | None = None) -> DataFrame:
    """Add ``source``, optionally ``ticker``, and ``ingested_at``.

    ``ingested_at`` is one value per load: the given text, or the query's
    current time (``current_timestamp`` is fixed per query, not per row) as
    ISO-8601 text in the session time zone (UTC). Passing it explicitly makes
    a re-run reproducible.
    """
    ts = F.lit(ingested_at) if ingested_at is not None else F.date_format(F.current_timestamp(), ISO_UTC_FORMAT)
    out = df.withColumn("source", F.lit(source))
    if ticker is not None:
        out = out.withColumn("ticker", F.lit(ticker))
    return out.withColumn("ingested_at", ts)


def unify_sources(*frames: DataFrame) -> DataFrame:
    """Vertical union by name of canonical frames; duplicates are kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def dedupe_by_date(
    df: DataFrame,
    keys: Sequence[str] = ("symbol", "date"),
    priority: Sequence[str] = DEFAULT_PRIORITY,
    source_col: str = "source",
    ingested_col: str = "ingested_at",
    method: str = "aggregate",
) -> DataFrame:
    """Keep one row per ``keys`` under a total order.

    Order: source priority (a row without source comes last), then earliest
    ``ingested_at``, then a hash of the row so that even full ties resolve the same way on every run.

    ``method='aggregate'`` (default): a ``min_by`` aggregate, which combines
    map-side before its shuffle. ``method='window'``: ``row_number() == 1``
    over ``keys``, for input already partitioned by a prefix of ``keys``
    (no shuffle of its own, one sort that later windows on the same prefix
    reuse). Both keep the same row.
    """
    payload = [c for c in df.columns if c not in keys]
    q = lambda c: f"`{c}`"
    place = f"array_position(array({', '.join(sql_str(p) for p in priority)}), {q(source_col)})"
    ts = f"try_to_timestamp({q(ingested_col)})"
    # The one order of both methods: listed sources, then others, then rows without a source.
    order = [
        f"CASE WHEN {q(source_col)} IS NULL THEN {len(priority) + 2} WHEN {place} = 0 THEN {len(priority) + 1} ELSE {place} END",
        f"{ts} IS NULL",
        ts,
        q(ingested_col),
        f"xxhash64({', '.join(q(c) for c in payload)})",
    ]
    if method == "window":
        rn = F.expr(f"row_number() OVER (PARTITION BY {', '.join(q(k) for k in keys)} ORDER BY {', '.join(order)})")
        return df.withColumn("_rn", rn).filter(F.col("_rn") == 1).drop("_rn")
    if method != "aggregate":
        raise ValueError(f"method must be 'aggregate' or 'window', not {method!r}")
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*[F.col(c) for c in payload]), F.expr(f"struct({', '.join(order)})")).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload])
    )

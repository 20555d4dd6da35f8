"""Raw JSON messages -> typed price rows, with a reject reason instead of a crash
(P1-P3, P6, X8, X9, X13).

Each message is parsed once into ``MAP<STRING,STRING>`` so a missing key and
an explicit ``null`` stay distinguishable and any number text is kept for a
``try_cast``. Nothing raises on bad input: a row either normalises or carries
one ``reject_reason`` and its raw text for the quarantine table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.dates import parse_date
from pricelake.schemas import PRICE_FIELDS

# Message keys of the two source layouts.
PACKED_KEY = "date;open;high;low;close;volume"
PROVIDER_FIELD_NAMES = {"open": "Open", "high": "High", "low": "Low", "close": "Close", "volume": "Volume"}
PROVIDER_DATE_KEY = "Date"

# Reject reasons, first match wins.
MALFORMED = "malformed_json"
UNKNOWN = "unknown_format"
BAD_ARITY = "bad_arity"
NULL_VALUE = "null_value"
BAD_NUMBER = "bad_number"
BAD_DATE = "bad_date"

OUTPUT = ("topic", "symbol", "date", *PRICE_FIELDS, "source", "ingested_at", "reject_reason", "raw")


def parse_map(value: Column) -> Column:
    return F.from_json(value, "map<string,string>")


# The layouts are written as Spark SQL expression text: one expression per
# output column, parsed on the JVM in one call instead of hundreds of small
# Column objects built one by one from Python.


def sql_str(text: str) -> str:
    """A Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _get(key_sql: str) -> str:
    return f"try_element_at(_m, {key_sql})"


# What Python's float() reads, without the type suffixes (1.5d, 2f) that a cast would take.
NUMBER = r"(?i)^[+-]?([0-9]+\\.?[0-9]*([eE][+-]?[0-9]+)?|\\.[0-9]+([eE][+-]?[0-9]+)?|nan|inf|infinity)$"


def _num(text_sql: str) -> str:
    """Number text -> DOUBLE or NULL. A bare NaN token comes out of the map
    quoted, so quotes are trimmed; 'NaN' / 'Infinity' parse as in Python."""
    bare = f"btrim(trim({text_sql}), '\"')"
    return f"CASE WHEN {bare} RLIKE '{NUMBER}' THEN try_cast({bare} AS DOUBLE) END"


# A layout names, per price field f, the text of its number (``_t_f``). The texts are read as numbers once, in a
# projection of their own (``_n_f``); reason and values refer to both.


def _csv_fields(symbol: str) -> dict[str, str]:
    """CSV-producer layouts: (a) one packed key split on ';' into exactly 6
    parts, (b) regular keys where a missing key means 0.0 but an explicit null
    or a non-number rejects the row, (c) anything else is unknown.
    Reads ``_m`` (the parsed map) and ``_parts`` (the split packed text)."""
    hp = f"map_contains_key(_m, {sql_str(PACKED_KEY)})"
    packed_bad = " OR ".join(f"_n_{f} IS NULL" for f in PRICE_FIELDS)
    present = {f: f"map_contains_key(_m, {sql_str(f)})" for f in PRICE_FIELDS}
    null_value = " OR ".join(f"({present[f]} AND _t_{f} IS NULL)" for f in PRICE_FIELDS)
    bad_number = " OR ".join(f"(_t_{f} IS NOT NULL AND _n_{f} IS NULL)" for f in PRICE_FIELDS)
    reason = (
        f"CASE WHEN _m IS NULL THEN {sql_str(MALFORMED)} "
        f"WHEN {hp} AND size(_parts) <> 6 THEN {sql_str(BAD_ARITY)} "
        f"WHEN {hp} AND ({packed_bad}) THEN {sql_str(BAD_NUMBER)} "
        f"WHEN {hp} THEN CAST(NULL AS STRING) "
        f"WHEN NOT map_contains_key(_m, 'date') THEN {sql_str(UNKNOWN)} "
        f"WHEN {null_value} THEN {sql_str(NULL_VALUE)} "
        f"WHEN {bad_number} THEN {sql_str(BAD_NUMBER)} END"
    )
    return {
        **{f"_t_{f}": f"CASE WHEN {hp} THEN get(_parts, {i + 1}) ELSE {_get(sql_str(f))} END" for i, f in enumerate(PRICE_FIELDS)},
        "_reason": reason,
        "symbol": sql_str(symbol),
        "_date_text": f"CASE WHEN {hp} THEN get(_parts, 0) ELSE {_get(sql_str('date'))} END",
        **{f: f"CASE WHEN {hp} OR {present[f]} THEN _n_{f} ELSE 0.0D END" for f in PRICE_FIELDS},
        "source": _get("'source'"),
        "ingested_at": _get("'ingested_at'"),
    }


def _provider_fields(default_ticker: str | None) -> dict[str, str]:
    """Provider layout with ticker-suffixed keys (``Open_<ticker>``): missing,
    null, empty or zero values become 0.0, NaN is kept, a non-number rejects
    the row."""
    default = sql_str(default_ticker) if default_ticker is not None else "CAST(NULL AS STRING)"
    # A message without a ticker still names it in its keys (Open_<ticker>).
    prefix = PROVIDER_FIELD_NAMES["open"] + "_"
    in_keys = f"substring(get(filter(map_keys(_m), k -> startswith(k, {sql_str(prefix)})), 0), {len(prefix) + 1})"
    ticker = f"coalesce({_get(sql_str('ticker'))}, {in_keys}, {default})"
    empty = {f: f"(_t_{f} IS NULL OR btrim(_t_{f}, '\"') = '')" for f in PRICE_FIELDS}
    bad = " OR ".join(f"(NOT {empty[f]} AND _n_{f} IS NULL)" for f in PRICE_FIELDS)
    return {
        **{f"_t_{f}": _get(f"concat({sql_str(PROVIDER_FIELD_NAMES[f] + '_')}, {ticker})") for f in PRICE_FIELDS},
        "_reason": f"CASE WHEN _m IS NULL THEN {sql_str(MALFORMED)} WHEN {ticker} IS NULL THEN {sql_str(UNKNOWN)} WHEN {bad} THEN {sql_str(BAD_NUMBER)} END",
        "symbol": ticker,
        "_date_text": _get(sql_str(PROVIDER_DATE_KEY)),
        **{f: f"CASE WHEN {empty[f]} THEN 0.0D ELSE _n_{f} END" for f in PRICE_FIELDS},
        "source": _get("'source'"),
        "ingested_at": _get("'ingested_at'"),
    }


def _finish(messages: DataFrame, fields: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse once, evaluate the layout, parse the date, add the date reject,
    NULL every value of a rejected row. ``keep`` names message columns to carry along."""
    parsed = messages.select("topic", "value", *keep, parse_map(F.col("value")).alias("_m"))
    # A key that comes twice: the last value counts, as json.loads reads it.
    last = "transform(array_distinct(map_keys(_m)), k -> element_at(filter(map_entries(_m), e -> e.key = k), -1).value)"
    once = f"CASE WHEN size(array_distinct(map_keys(_m))) < size(_m) THEN map_from_arrays(array_distinct(map_keys(_m)), {last}) ELSE _m END"
    parsed = parsed.selectExpr("topic", "value", *keep, f"{once} AS _m").selectExpr("*", f"split({_get(sql_str(PACKED_KEY))}, ';', -1) AS _parts")
    texts = {n: sql for n, sql in fields.items() if n.startswith("_t_")}
    parsed = parsed.selectExpr("*", *[f"{sql} AS {name}" for name, sql in texts.items()])
    parsed = parsed.selectExpr("*", *[f"{_num(f'_t_{f}')} AS _n_{f}" for f in PRICE_FIELDS])
    d = parsed.selectExpr("topic", "value", *keep, *[f"{sql} AS {name}" for name, sql in fields.items() if name not in texts])
    d = d.withColumn("date", parse_date(F.col("_date_text")))
    d = d.selectExpr(
        "*", f"CASE WHEN _reason IS NULL AND date IS NULL THEN {sql_str(BAD_DATE)} ELSE _reason END AS reject_reason"
    )
    kept = ("symbol", "date", *PRICE_FIELDS, "source", "ingested_at")
    return d.selectExpr(
        "topic", *[f"CASE WHEN reject_reason IS NULL THEN {c} END AS {c}" for c in kept], "reject_reason", "value AS raw", *keep
    )


def normalize_csv(messages: DataFrame, symbol: str) -> DataFrame:
    """CSV-producer messages (see ``_csv_fields``) -> normalised rows."""
    return _finish(messages, _csv_fields(symbol))


def normalize_provider(messages: DataFrame, default_ticker: str | None = None) -> DataFrame:
    """Provider messages (see ``_provider_fields``) -> normalised rows."""
    return _finish(messages, _provider_fields(default_ticker))


def normalize_messages(messages: DataFrame, csv_topics: list[str], provider_topics: list[str], symbol: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Both layouts in one pass: each message is parsed once and routed by
    topic inside the projection (no second scan of the source, which a
    broker source could not prune by topic). Messages of other topics are
    left out."""
    csv, prov = _csv_fields(symbol), _provider_fields(symbol)
    in_csv = "topic IN (" + ", ".join(sql_str(t) for t in csv_topics) + ")"
    fields = {n: f"CASE WHEN {in_csv} THEN {csv[n]} ELSE {prov[n]} END" for n in csv}
    routed = messages.filter(F.col("topic").isin([*csv_topics, *provider_topics]))
    return _finish(routed, fields, keep)


def good_rows(normalized: DataFrame) -> DataFrame:
    """Rows that normalised, without the bookkeeping columns."""
    return normalized.filter(F.col("reject_reason").isNull()).drop("reject_reason", "raw")


def quarantined(normalized: DataFrame) -> DataFrame:
    """Rejected rows with their raw text and reason."""
    return normalized.filter(F.col("reject_reason").isNotNull()).select("topic", "reject_reason", "raw")


def reject_counts(normalized: DataFrame) -> DataFrame:
    """Rows per topic and outcome ('ok' or the reject reason)."""
    return normalized.groupBy("topic", F.coalesce(F.col("reject_reason"), F.lit("ok")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n")
    )

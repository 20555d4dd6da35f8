"""DuckDB SQL oracles, one per registered query, over the driver's tables.

Written independently of the Spark plans: plain SQL windows and aggregates
over whole tables (``row_number`` over a whole series is fine for an oracle).
"""

from __future__ import annotations

# Fixed values shared with pricelake.fixtures (FIXTURES.md part B).
INGESTED = "'2024-01-01T00:00:00+00:00'"
FROM_DATE = "DATE '1997-01-01'"

F1 = f"""f1 AS (
  SELECT 'ALL' AS symbol, CAST(o_orderdate AS DATE) AS date,
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
         CAST(count(*) AS DOUBLE) AS volume,
         CASE WHEN o_orderkey % 2 = 0 THEN 'csv' ELSE 'yfinance' END AS source,
         {INGESTED} AS ingested_at
  FROM orders GROUP BY 2, 8)"""

F1M = """f1m AS (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
         CAST(count(*) AS DOUBLE) AS volume
  FROM orders GROUP BY 1, 2)"""

F3 = """ext AS (
  SELECT 'EXT' AS symbol, CAST(d AS DATE) AS date, close FROM (
    SELECT l_shipdate AS d,
           arg_max(l_extendedprice, (l_orderkey, l_linenumber, l_extendedprice)) AS close
    FROM lineitem GROUP BY 1)
  WHERE d IS NOT NULL AND close IS NOT NULL AND NOT isnan(close)),
exti AS (SELECT *, CAST(row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS BIGINT) AS idx FROM ext)"""

NOT_MISSING = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in ("open", "high", "low", "close", "volume"))


def clean_from(src: str, name: str = "clean", start: str | None = None) -> str:
    """dedupe (priority yfinance, csv) -> drop missing -> from-date, if any -> idx."""
    return f"""{name}_d AS (
  SELECT * FROM {src}
  QUALIFY row_number() OVER (PARTITION BY symbol, date
          ORDER BY CASE source WHEN 'yfinance' THEN 1 WHEN 'csv' THEN 2 ELSE 3 END, ingested_at) = 1),
{name} AS (
  SELECT symbol, date, open, high, low, close, volume,
         CAST(row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS BIGINT) AS idx
  FROM {name}_d WHERE date IS NOT NULL AND {NOT_MISSING}{f" AND date >= {start}" if start else ""})"""


F1MU = f"""f1mu AS (SELECT *, 'yfinance' AS source, {INGESTED} AS ingested_at FROM f1m)"""

FEATURES = """feat0 AS (
  SELECT *, high - low AS volatility, CAST(year(date) AS INTEGER) AS year,
         CAST(month(date) AS INTEGER) AS month, CAST(isodow(date) - 1 AS INTEGER) AS dayofweek,
         CASE WHEN count(close) OVER w = 20 THEN avg(close) OVER w END AS ma_20
  FROM clean WINDOW w AS (PARTITION BY symbol ORDER BY idx ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
feat AS (
  SELECT symbol, idx - 19 AS idx, date, open, high, low, close, volume, volatility, year, month, dayofweek,
         ma_20, CASE WHEN close > 0 THEN ln(close) END AS log_close,
         CASE WHEN volume > -1 THEN ln(1 + volume) END AS log_volume
  FROM feat0 WHERE ma_20 IS NOT NULL)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE: dict[str, str] = {}

ORACLE["features"] = with_(F1, clean_from("f1", start=FROM_DATE), FEATURES) + """
SELECT symbol, idx, date, open, high, low, close, volume, volatility, year, month, dayofweek,
       round(ma_20, 6) AS ma_20, round(log_close, 6) AS log_close, round(log_volume, 6) AS log_volume
FROM feat"""

ORACLE["unify_sources"] = with_(F1) + """
SELECT symbol, date, CAST(CAST(open AS FLOAT) AS DOUBLE) AS open, CAST(CAST(high AS FLOAT) AS DOUBLE) AS high,
       CAST(CAST(low AS FLOAT) AS DOUBLE) AS low, CAST(CAST(close AS FLOAT) AS DOUBLE) AS close,
       CAST(CAST(volume AS FLOAT) AS DOUBLE) AS volume, source, ingested_at
FROM f1 WHERE source = 'csv'
UNION ALL
SELECT symbol, date, open, high, low, close, volume, source, ingested_at FROM f1 WHERE source = 'yfinance'"""

ORACLE["dedupe_by_date"] = with_(F1) + """
SELECT * FROM f1
QUALIFY row_number() OVER (PARTITION BY symbol, date
        ORDER BY CASE source WHEN 'yfinance' THEN 1 WHEN 'csv' THEN 2 ELSE 3 END, ingested_at) = 1"""

ORACLE["clean_series"] = with_(F1, clean_from("f1", start=FROM_DATE)) + "SELECT * FROM clean"

ORACLE["series_index"] = with_(F1M) + """
SELECT symbol, date, CAST(row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS BIGINT) AS idx FROM f1m"""

ORACLE["series_head"] = with_(F1M, F1MU, clean_from("f1mu")) + "SELECT * FROM clean WHERE idx < 5"

ORACLE["series_coverage"] = with_(F3) + """
SELECT symbol, min(date) AS first_date, max(date) AS last_date, count(*) AS n_rows FROM ext GROUP BY symbol"""

ORACLE["rolling_mean"] = with_(F1M) + """
SELECT symbol, date, close,
       round(CASE WHEN count(close) OVER w = 20 THEN avg(close) OVER w END, 6) AS ma_20
FROM f1m WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""

ORACLE["log_return"] = with_(F1M) + """
SELECT symbol, date, close,
       round(CASE WHEN close / lag(close) OVER w > 0 THEN ln(close / lag(close) OVER w) END, 6) AS log_return
FROM f1m WINDOW w AS (PARTITION BY symbol ORDER BY date)"""

ORACLE["future_dates"] = with_(F1M) + """
SELECT symbol, CAST(s AS INTEGER) AS step, CAST(last_date + CAST(s AS INTEGER) AS DATE) AS date
FROM (SELECT symbol, max(date) AS last_date, unnest(range(1, 366)) AS s FROM f1m GROUP BY symbol)"""

# ---------------------------------------------------------------- profile

LONG_MULTI = """lv AS (
  UNPIVOT (SELECT symbol, open, high, low, close, volume FROM clean)
  ON open, high, low, close, volume INTO NAME "column" VALUE value)"""

ORACLE["describe"] = with_(F1M, F1MU, clean_from("f1mu"), LONG_MULTI) + """
SELECT symbol, "column", count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS p25,
       round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75,
       round(max(value), 6) AS max
FROM lv GROUP BY symbol, "column\""""

_CORR_COLS = ["date", "open", "high", "low", "close", "volume"]


def _corr_sql() -> str:
    parts = []
    for a in _CORR_COLS:
        for b in _CORR_COLS:
            parts.append(
                f"SELECT symbol, '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM cd GROUP BY symbol"
            )
    return "\nUNION ALL\n".join(parts)


ORACLE["corr_matrix"] = with_(
    F1,
    clean_from("f1"),
    """cd AS (SELECT symbol, CAST(date - DATE '1970-01-01' AS DOUBLE) AS date, open, high, low, close, volume FROM clean)""",
) + _corr_sql()

ORACLE["outlier_stats"] = with_(
    F1M,
    F1MU,
    clean_from("f1mu"),
    LONG_MULTI,
    """q AS (SELECT symbol, "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
       FROM lv GROUP BY ALL),
fz AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5::DOUBLE * (q3 - q1) AS lo_fence, q3 + 1.5::DOUBLE * (q3 - q1) AS hi_fence FROM q)""",
) + """
SELECT lv.symbol, lv."column", count(*) AS n,
       count(*) FILTER (WHERE NOT (value >= lo_fence AND value <= hi_fence)) AS n_outliers,
       round(any_value(q1), 6) AS q1, round(any_value(q3), 6) AS q3, round(any_value(iqr), 6) AS iqr,
       round(any_value(lo_fence), 6) AS lo_fence, round(any_value(hi_fence), 6) AS hi_fence,
       round(min(value) FILTER (WHERE value >= lo_fence AND value <= hi_fence), 6) AS whisker_lo,
       round(max(value) FILTER (WHERE value >= lo_fence AND value <= hi_fence), 6) AS whisker_hi
FROM lv JOIN fz USING (symbol, "column") GROUP BY lv.symbol, lv."column\""""

ORACLE["histogram"] = with_(
    F1M,
    F1MU,
    clean_from("f1mu"),
    LONG_MULTI,
    """rng AS (SELECT symbol, "column", min(value) AS lo, max(value) AS hi FROM lv GROUP BY ALL),
bn AS (SELECT lv.symbol, lv."column",
              CAST(CASE WHEN hi = lo THEN 1
                        ELSE least(floor((value - lo) * CAST(50 AS DOUBLE) / (hi - lo)) + 1, 50) END AS INTEGER) AS bin
       FROM lv JOIN rng USING (symbol, "column")),
cnt AS (SELECT symbol, "column", bin, count(*) AS c FROM bn GROUP BY ALL),
grid AS (SELECT symbol, "column", lo, hi, CAST(unnest(range(1, 51)) AS INTEGER) AS bin FROM rng)""",
) + """
SELECT g.symbol, g."column", g.bin,
       round(lo + (g.bin - 1) * ((hi - lo) / CAST(50 AS DOUBLE)), 6) AS bin_lo,
       round(lo + g.bin * ((hi - lo) / CAST(50 AS DOUBLE)), 6) AS bin_hi,
       coalesce(c, 0) AS count
FROM grid g LEFT JOIN cnt USING (symbol, "column", bin)"""

# ---------------------------------------------------------------- supervised

WEIGHTS = [2.0 * i / (30 * 31) for i in range(1, 31)]


def supervised_ctes(src: str, value: str, window: int, pct: int, p: str, val_pct: int | None = None, fit_all: bool = False) -> str:
    """Scale ``value`` with min/max of the training rows, cut ``window``-step
    samples (x_00 oldest), label the split by position."""
    lags = ",\n         ".join(f"lag(xs, {window - j}) OVER w AS x_{j:02d}" for j in range(window))
    label = f"CASE WHEN s.idx < ns * {pct} // 100 THEN 'train' ELSE 'test' END"
    if val_pct is not None:
        label = (
            f"CASE WHEN s.idx < (ns * {pct} // 100) * {100 - val_pct} // 100 THEN 'train' "
            f"WHEN s.idx < ns * {pct} // 100 THEN 'val' ELSE 'test' END"
        )
    return f"""{p}_n AS (SELECT symbol, count(*) AS n_rows FROM {src} GROUP BY symbol),
{p}_p AS (SELECT t.symbol, min({value}) AS mn, max({value}) AS mx FROM {src} t JOIN {p}_n USING (symbol)
          {"" if fit_all else f"WHERE t.idx < (n_rows - {window}) * {pct} // 100 + {window}"} GROUP BY t.symbol),
{p}_s AS (SELECT t.*, mn, mx, CASE WHEN mx = mn THEN 0.0 ELSE ({value} - mn) / (mx - mn) END AS xs
          FROM {src} t JOIN {p}_p USING (symbol)),
{p}_q AS (SELECT symbol, idx - {window} AS idx, date, xs AS y,
         {lags}
          FROM {p}_s WINDOW w AS (PARTITION BY symbol ORDER BY idx)),
{p}_qn AS (SELECT symbol, count(*) AS ns FROM {p}_q WHERE idx >= 0 GROUP BY symbol),
{p}_samples AS (SELECT s.*, {label} AS split FROM {p}_q s JOIN {p}_qn USING (symbol) WHERE s.idx >= 0)"""


def x_cols(window: int) -> str:
    return ", ".join(f"round(x_{j:02d}, 6) AS x_{j:02d}" for j in range(window))


SV = supervised_ctes("feat", "close", 30, 80, "sv")
BASE = (F1, clean_from("f1"), FEATURES)

ORACLE["minmax_scale"] = with_(*BASE, SV) + """
SELECT symbol, idx, date, close, mn AS min, mx AS max, round(xs, 6) AS close_scaled FROM sv_s"""

ORACLE["minmax_roundtrip"] = with_(*BASE, SV) + """
SELECT symbol, idx, date, close, round(xs, 6) AS close_scaled, round(xs * (mx - mn) + mn, 6) AS restored FROM sv_s"""

ORACLE["make_sequences"] = with_(*BASE, SV) + f"""
SELECT symbol, idx, date, round(y, 6) AS y, split, {x_cols(30)} FROM sv_samples"""

ORACLE["temporal_split"] = with_(*BASE, SV) + "SELECT symbol, idx, date, split FROM sv_samples"

ORACLE["temporal_split_3way"] = with_(*BASE, supervised_ctes("feat", "close", 30, 80, "sv", val_pct=10)) + """
SELECT symbol, idx, date, split FROM sv_samples"""

ORACLE["make_sequences_60"] = with_(
    *BASE,
    """lr0 AS (SELECT symbol, date, CASE WHEN close / lag(close) OVER w > 0 THEN ln(close / lag(close) OVER w) END AS log_return
        FROM feat WINDOW w AS (PARTITION BY symbol ORDER BY idx)),
lr AS (SELECT symbol, date, log_return, CAST(row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS BIGINT) AS idx
       FROM lr0 WHERE log_return IS NOT NULL)""",
    supervised_ctes("lr", "log_return", 60, 80, "sv"),
) + f"""
SELECT symbol, idx, date, round(y, 6) AS y, split, {x_cols(60)} FROM sv_samples"""

ORACLE["temporal_split_85"] = with_(F3, supervised_ctes("exti", "close", 30, 85, "sv")) + """
SELECT symbol, idx, date, split FROM sv_samples"""

ORACLE["external_series"] = with_(F3) + "SELECT symbol, idx, date, close FROM exti"

ORACLE["forecast_seed"] = with_(*BASE, SV) + """
SELECT s.symbol, s.idx - (n_rows - 30) AS pos, s.date, round(s.xs, 6) AS value
FROM sv_s s JOIN sv_n USING (symbol) WHERE s.idx >= n_rows - 30"""

DOT_X = " + ".join(f"x_{j:02d} * {WEIGHTS[j]!r}" for j in range(30))
DOT_WIN = " + ".join(f"win[{j + 1}] * {WEIGHTS[j]!r}" for j in range(30))

ORACLE["score_linear"] = with_(*BASE, SV) + f"""
SELECT symbol, idx, date, round(y, 6) AS y, round({DOT_X}, 6) AS pred FROM sv_samples WHERE split = 'test'"""

ALIGNED = f"""al AS (
  SELECT s.symbol, s.date, s.y * (p.mx - p.mn) + p.mn AS real, ({DOT_X}) * (p.mx - p.mn) + p.mn AS pred
  FROM sv_samples s JOIN sv_p p USING (symbol) WHERE split = 'test')"""

ORACLE["align_predictions"] = with_(*BASE, SV, ALIGNED) + """
SELECT symbol, date, round(real, 6) AS real, round(pred, 6) AS pred FROM al"""

FUTURE = f"""seeds AS (
  SELECT s.symbol, list(s.xs ORDER BY s.idx) AS win, max(s.date) AS last_date, any_value(s.mn) AS mn, any_value(s.mx) AS mx
  FROM sv_s s JOIN sv_n USING (symbol) WHERE s.idx >= n_rows - 30 GROUP BY s.symbol),
rec AS (
  SELECT symbol, last_date, mn, mx, 0 AS step, win, CAST(NULL AS DOUBLE) AS pred FROM seeds
  UNION ALL
  SELECT symbol, last_date, mn, mx, step + 1, list_append(win[2:30], {DOT_WIN}), {DOT_WIN}
  FROM rec WHERE step < 365),
fut AS (SELECT symbol, CAST(step AS INTEGER) AS step, CAST(last_date + CAST(step AS INTEGER) AS DATE) AS date,
               pred, pred * (mx - mn) + mn AS pred_usd FROM rec WHERE step > 0)"""

ORACLE["recursive_forecast"] = "WITH RECURSIVE " + with_(*BASE, SV, FUTURE)[5:] + """
SELECT symbol, step, date, round(pred, 6) AS pred, round(pred_usd, 6) AS pred_usd FROM fut"""

ORACLE["forecast_timeline"] = "WITH RECURSIVE " + with_(*BASE, SV, ALIGNED, FUTURE)[5:] + """
SELECT 'real' AS kind, symbol, date, round(close, 6) AS value FROM feat
UNION ALL SELECT 'pred', symbol, date, round(pred, 6) FROM al
UNION ALL SELECT 'future', symbol, date, round(pred_usd, 6) FROM fut"""

# ---------------------------------------------------------------- evaluation

F4 = """f4 AS (
  SELECT * FROM (
    SELECT 'naive' AS model, symbol, date, close AS real, lag(close) OVER w AS pred
    FROM f1m WINDOW w AS (PARTITION BY symbol ORDER BY date)
    UNION ALL
    SELECT 'ma5', symbol, date, close, CASE WHEN count(close) OVER w = 5 THEN avg(close) OVER w END
    FROM f1m WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
    UNION ALL
    SELECT 'ma20', symbol, date, close, CASE WHEN count(close) OVER w = 20 THEN avg(close) OVER w END
    FROM f1m WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))
  WHERE pred IS NOT NULL)"""

METRICS = """count(*) AS n, avg(abs(pred - real)) AS mae, sqrt(avg((pred - real) * (pred - real))) AS rmse,
       CASE WHEN var_pop(real) * count(*) > 0
            THEN 1 - sum((pred - real) * (pred - real)) / (var_pop(real) * count(*)) END AS r2"""

ORACLE["regression_metrics"] = with_(F1M, F4) + f"""
SELECT model, symbol, n, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2
FROM (SELECT model, symbol, {METRICS} FROM f4 GROUP BY model, symbol)"""

ORACLE["leaderboard"] = with_(F1M, F4) + f"""
SELECT model, n, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(r2, 4) AS r2, CAST(rank() OVER (ORDER BY mae) AS INTEGER) AS rank
FROM (SELECT model, {METRICS} FROM f4 GROUP BY model)"""

ORACLE["model_compare_wide"] = with_(F1M, F4) + """
SELECT symbol, date, max(real) AS real, max(CASE WHEN model = 'naive' THEN pred END) AS naive,
       round(max(CASE WHEN model = 'ma5' THEN pred END), 6) AS ma5,
       round(max(CASE WHEN model = 'ma20' THEN pred END), 6) AS ma20
FROM f4 GROUP BY symbol, date"""

# ---------------------------------------------------------------- messages, normalisation

NORM = """msg AS (
  SELECT f1.*, dayofyear(date) % 23 AS f, dayofmonth(date) % 5 = 0 AS packed,
         CASE WHEN source = 'csv' THEN 'prices_csv' ELSE 'prices_provider' END AS topic
  FROM f1),
nr AS (
  SELECT *, CASE
      WHEN f = 1 THEN 'malformed_json'
      WHEN source = 'csv' AND f = 2 THEN 'unknown_format'
      WHEN source = 'csv' AND packed AND f IN (3, 6) THEN 'bad_arity'
      WHEN source = 'csv' AND packed AND f IN (4, 5) THEN 'bad_number'
      WHEN source = 'csv' AND f = 4 THEN 'bad_number'
      WHEN source = 'csv' AND f = 5 THEN 'null_value'
      WHEN source <> 'csv' AND f = 2 THEN 'bad_date'
      WHEN source <> 'csv' AND f = 4 THEN 'bad_number' END AS reject_reason
  FROM msg),
norm AS (
  SELECT topic,
         CASE WHEN reject_reason IS NULL THEN symbol END AS symbol,
         CASE WHEN reject_reason IS NULL THEN date END AS date,
         CASE WHEN reject_reason IS NULL THEN open END AS open,
         CASE WHEN reject_reason IS NULL THEN CASE WHEN source <> 'csv' AND f = 5 THEN 0.0::DOUBLE ELSE high END END AS high,
         CASE WHEN reject_reason IS NULL THEN CASE WHEN f = 6 THEN 0.0::DOUBLE ELSE low END END AS low,
         CASE WHEN reject_reason IS NULL THEN close END AS close,
         CASE WHEN reject_reason IS NULL THEN CASE WHEN f = 7 THEN 'NaN'::DOUBLE ELSE volume END END AS volume,
         CASE WHEN reject_reason IS NULL THEN source END AS source,
         CASE WHEN reject_reason IS NULL THEN ingested_at END AS ingested_at,
         reject_reason
  FROM nr)"""

ORACLE["normalize_csv"] = with_(F1, NORM) + "SELECT * FROM norm WHERE topic = 'prices_csv'"
ORACLE["normalize_provider"] = with_(F1, NORM) + "SELECT * FROM norm WHERE topic = 'prices_provider'"
ORACLE["quarantine"] = with_(F1, NORM) + """
SELECT topic, coalesce(reject_reason, 'ok') AS outcome, count(*) AS n FROM norm GROUP BY ALL"""

_NORM_TYPES = [
    ("topic", "string"), ("symbol", "string"), ("date", "date"), ("open", "double"), ("high", "double"),
    ("low", "double"), ("close", "double"), ("volume", "double"), ("source", "string"),
    ("ingested_at", "string"), ("reject_reason", "string"),
]


def _null_counts_sql() -> str:
    parts = []
    for c, t in _NORM_TYPES:
        miss = f"{c} IS NULL OR isnan({c})" if t == "double" else f"{c} IS NULL"
        parts.append(
            f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(*) - count(*) FILTER (WHERE {miss}) AS non_null, "
            f"count(*) FILTER (WHERE {miss}) AS missing, count(*) AS rows FROM norm"
        )
    return "\nUNION ALL\n".join(parts)


ORACLE["null_counts"] = with_(F1, NORM) + _null_counts_sql()

ORACLE["publish_messages"] = with_(F1, NORM) + "SELECT * FROM norm"
ORACLE["stream_land"] = with_(F1, NORM) + "SELECT * FROM norm"
ORACLE["raw_scan"] = with_(F1, NORM) + "SELECT topic, count(*) AS n FROM msg GROUP BY topic"
ORACLE["stream_topic_counts"] = ORACLE["raw_scan"]
ORACLE["reconcile_counts"] = with_(F1, NORM) + """
SELECT topic, n AS landed, e AS expected,
       CASE WHEN n = e THEN 'ok' WHEN n < e THEN 'short' ELSE 'over' END AS status
FROM (SELECT topic, count(*) AS n, count(*) + CASE WHEN topic = 'prices_provider' THEN 10 ELSE 0 END AS e
      FROM msg GROUP BY topic)"""

ORACLE["parse_dates"] = with_(F1M) + """
SELECT symbol,
       CASE dayofyear(date) % 3 WHEN 0 THEN strftime(date, '%Y.%m.%d %H:%M')
                                WHEN 1 THEN strftime(date, '%Y-%m-%d %H:%M:%S')
                                ELSE strftime(date, '%Y/%m/%d') END AS date_text,
       CASE WHEN dayofyear(date) % 3 < 2 THEN date END AS date
FROM f1m"""

ORACLE["records_to_json"] = with_(F1) + """
SELECT source AS key, symbol, strftime(date, '%Y-%m-%d %H:%M:%S') AS date, open, high, low, close, volume,
       source, ingested_at FROM f1"""

ORACLE["stamp_provenance"] = with_(F1M) + f"""
SELECT *, 'yfinance' AS source, symbol AS ticker, {INGESTED} AS ingested_at FROM f1m"""

ORACLE["string_normalize"] = with_(F1M) + """
SELECT symbol, replace(lower(trim(symbol)), ' ', '_') AS label, 'Close_' || symbol AS close_key, count(*) AS n_rows
FROM f1m GROUP BY symbol"""

_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_FIELDS = [("open", "Open"), ("high", "High"), ("low", "Low"), ("close", "Close"), ("volume", "Volume")]

ORACLE["flatten_provider"] = with_(F1M) + "SELECT date AS \"Date\", " + ", ".join(
    f"max(CASE WHEN symbol = '{t}' THEN {f} END) AS \"{n}_{t}\"" for t in _PRIORITIES for f, n in _FIELDS
) + " FROM f1m GROUP BY date"

ORACLE["provider_slice"] = with_(F1M) + f"SELECT * FROM f1m WHERE symbol = '1-URGENT' AND date >= {FROM_DATE}"

# ---------------------------------------------------------------- sources and sinks

ORACLE["src_csv"] = with_(F1) + """
SELECT date, open, high, low, close, volume, CAST(NULL AS VARCHAR) AS _corrupt_record FROM f1"""

ORACLE["parquet_publish"] = with_(F1M, F1MU) + "SELECT * FROM f1mu"

ORACLE["export_json"] = with_(F1, clean_from("f1")) + "SELECT * FROM clean"

ORACLE["predictions_csv"] = with_(F1M, F4) + "SELECT model, symbol, date, real, round(pred, 6) AS pred FROM f4"

ORACLE["supervised_store"] = with_(*BASE, SV) + """
SELECT s.symbol, s.idx, s.date, round(s.y, 6) AS y, s.split, p.mn AS min, p.mx AS max
FROM sv_samples s JOIN sv_p p USING (symbol)"""

ORACLE["doc_roundtrip"] = with_(F1) + """
SELECT symbol, date, open, high, low, close, volume, source, 'GC=F' AS ticker, ingested_at FROM f1"""

# ---------------------------------------------------------------- ticks

F6 = """f6 AS (
  SELECT l_returnflag AS symbol, CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS close,
         CAST(CAST(l_shipdate AS DATE) - DATE '1970-01-01' AS BIGINT) * 10000000000000 + l_orderkey * 10 + l_linenumber AS t
  FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1, 2, 4),
f6i AS (SELECT *, CAST(row_number() OVER (PARTITION BY symbol ORDER BY t) - 1 AS BIGINT) AS idx FROM f6)"""

ORACLE["tick_rolling_mean"] = with_(F6) + """
SELECT symbol, t, idx, close, round(CASE WHEN count(close) OVER w = 20 THEN avg(close) OVER w END, 6) AS ma_20
FROM f6i WINDOW w AS (PARTITION BY symbol ORDER BY t ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""

ORACLE["tick_log_return"] = with_(F6) + """
SELECT symbol, t, round(CASE WHEN close / lag(close) OVER w > 0 THEN ln(close / lag(close) OVER w) END, 6) AS log_return
FROM f6i WINDOW w AS (PARTITION BY symbol ORDER BY t)"""

ORACLE["tick_sequences"] = with_(F6) + """
SELECT symbol, idx - 5 AS idx, date, close AS y, x_00, x_01, x_02, x_03, x_04
FROM (SELECT *, """ + ", ".join(f"lag(close, {5 - j}) OVER w AS x_{j:02d}" for j in range(5)) + """
      FROM f6i WINDOW w AS (PARTITION BY symbol ORDER BY t)) WHERE idx >= 5"""

ORACLE["tick_baselines"] = with_(F6.replace("f6i AS", "f1m AS"), F4.replace("ORDER BY date", "ORDER BY t")) + f"""
SELECT model, symbol, n, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2
FROM (SELECT model, symbol, {METRICS} FROM f4 GROUP BY model, symbol)"""

ORACLE["tick_describe"] = with_(F6) + """
SELECT symbol, 'close' AS "column", count(close) AS count, round(avg(close), 6) AS mean, round(stddev_samp(close), 6) AS std,
       round(min(close), 6) AS min, round(quantile_cont(close, 0.25), 6) AS p25, round(quantile_cont(close, 0.5), 6) AS p50,
       round(quantile_cont(close, 0.75), 6) AS p75, round(max(close), 6) AS max
FROM f6 GROUP BY symbol"""

ORACLE["minmax_scale_all"] = with_(*BASE, supervised_ctes("feat", "close", 30, 80, "sv", fit_all=True)) + """
SELECT symbol, idx, date, close, mn AS min, mx AS max, round(xs, 6) AS close_scaled FROM sv_s"""

# ---------------------------------------------------------------- end to end

ORACLE["publish_pipeline"] = with_(F1, NORM, "good AS (SELECT * FROM norm WHERE reject_reason IS NULL)", clean_from("good")) + """
SELECT 'clean' AS kind, symbol, date, open, high, low, close, volume, idx, CAST(NULL AS VARCHAR) AS topic, CAST(NULL AS VARCHAR) AS reject_reason
FROM clean
UNION ALL
SELECT 'quarantine', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, topic, reject_reason FROM norm WHERE reject_reason IS NOT NULL"""

# ---------------------------------------------------------------- fitted models: normal equations of two lags

ORACLE["ml_frame"] = with_(*BASE, SV) + f"""
SELECT symbol, idx, date, split, round(y, 6) AS y, {x_cols(30)} FROM sv_samples"""

SV2 = supervised_ctes("feat", "close", 2, 80, "sv")
EX2 = supervised_ctes("exti", "close", 2, 85, "ex")


def fitted(src: str, name: str) -> str:
    """Weighted least squares of y on x_00, x_01 and a constant over ``src`` (with weights w): one row (b0, b1, c)."""
    m = ", ".join(f"sum(w * {v}) / sum(w) AS m_{v}" for v in ("x_00", "x_01", "y"))
    s = ", ".join(
        f"sum(w * ({a} - m_{a}) * ({b} - m_{b})) AS s_{i}"
        for i, (a, b) in enumerate((("x_00", "x_00"), ("x_00", "x_01"), ("x_01", "x_01"), ("x_00", "y"), ("x_01", "y")))
    )
    return f"""{name}_m AS (SELECT {m} FROM {src}),
{name}_s AS (SELECT {s}, any_value(m_x_00) AS m0, any_value(m_x_01) AS m1, any_value(m_y) AS my FROM {src}, {name}_m),
{name}_b AS (SELECT (s_2 * s_3 - s_1 * s_4) / (s_0 * s_2 - s_1 * s_1) AS b0, (s_0 * s_4 - s_1 * s_3) / (s_0 * s_2 - s_1 * s_1) AS b1, m0, m1, my FROM {name}_s),
{name} AS (SELECT b0, b1, my - b0 * m0 - b1 * m1 AS c FROM {name}_b)"""


ORACLE["fit_lag_model"] = with_(
    *BASE,
    SV2,
    "tr AS (SELECT *, 1.0::DOUBLE AS w FROM sv_samples WHERE split = 'train')",
    fitted("tr", "fit"),
    """f4 AS (
  SELECT 'linear_fit' AS model, symbol, date, y AS real, b0 * x_00 + b1 * x_01 + c AS pred FROM sv_samples, fit WHERE split = 'test'
  UNION ALL
  SELECT 'linear_given', symbol, date, y, x_00 * (1.0::DOUBLE / 3) + x_01 * (2.0::DOUBLE / 3) FROM sv_samples WHERE split = 'test'
  UNION ALL
  SELECT 'naive', symbol, date, y, x_01 FROM sv_samples WHERE split = 'test')""",
) + f"""
SELECT model, n, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(r2, 4) AS r2, CAST(rank() OVER (ORDER BY mae) AS INTEGER) AS rank
FROM (SELECT model, {METRICS} FROM f4 GROUP BY model)"""

ORACLE["refit_compare"] = with_(
    *BASE,
    F3,
    SV2,
    EX2,
    "tr AS (SELECT x_00, x_01, y, 1.0::DOUBLE AS w FROM sv_samples WHERE split = 'train')",
    "ta AS (SELECT * FROM tr UNION ALL SELECT x_00, x_01, y, 0.1::DOUBLE FROM ex_samples WHERE split = 'train')",
    fitted("tr", "before"),
    fitted("ta", "after"),
    """f4 AS (
  SELECT 'before' AS stage, y AS real, b0 * x_00 + b1 * x_01 + c AS pred FROM ex_samples, before WHERE split = 'test'
  UNION ALL
  SELECT 'after', y, b0 * x_00 + b1 * x_01 + c FROM ex_samples, after WHERE split = 'test')""",
) + f"""
SELECT stage, n, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2
FROM (SELECT stage, {METRICS} FROM f4 GROUP BY stage)"""

# ---------------------------------------------------------------- positions from data-made buckets

ORACLE["tick_series_index"] = with_(F6) + "SELECT symbol, t, idx FROM f6i"

ORACLE["one_day_index"] = """
WITH f9 AS (
  SELECT l_linestatus AS symbol, 865123200000000 + l_orderkey * 10 + l_linenumber AS micros, max(l_extendedprice) AS close
  FROM lineitem GROUP BY ALL)
SELECT symbol, CAST(micros AS BIGINT) AS micros, close, CAST(row_number() OVER (PARTITION BY symbol ORDER BY micros) - 1 AS BIGINT) AS idx FROM f9"""

# ---------------------------------------------------------------- streams

ORACLE["land_until"] = ORACLE["reconcile_counts"]
ORACLE["stream_dedupe"] = ORACLE["stream_land"]

ORACLE["guarded_publish"] = with_(F1M) + """
SELECT '1-URGENT' AS topic, true AS published, count(*) AS n_messages FROM f1m WHERE symbol = '1-URGENT'
UNION ALL SELECT 'ABSENT', false, 0"""


def _members(*pairs: tuple[str, str]) -> str:
    return "concat_ws(',', " + ", ".join(f"""'"' || {k} || '":' || {v}""" for k, v in pairs) + ")"


def _quoted(v: str) -> str:
    return f"""'"' || {v} || '"'"""


_CSV_DATE = "strftime(date, '%Y.%m.%d %H:%M')"
_NUMBERS = {c: f"CAST({c} AS VARCHAR)" for c in ("open", "high", "low", "close", "volume")}
_FAULTY = {
    "open": _NUMBERS["open"],
    "high": f"CASE WHEN f = 5 THEN 'null' ELSE {_NUMBERS['high']} END",
    "low": f"CASE WHEN f <> 6 THEN {_NUMBERS['low']} END",
    "close": f"""CASE WHEN f = 4 THEN '"n/a"' ELSE {_NUMBERS['close']} END""",
    "volume": f"CASE WHEN f = 7 THEN 'NaN' ELSE {_NUMBERS['volume']} END",
}
_PACKED = f"""concat_ws(';', {_CSV_DATE}, {_NUMBERS["open"]}, CASE WHEN f = 5 THEN '' ELSE {_NUMBERS["high"]} END,
      CASE WHEN f <> 6 THEN {_NUMBERS["low"]} END, CASE WHEN f = 4 THEN 'n/a' ELSE {_NUMBERS["close"]} END,
      CASE WHEN f = 3 THEN NULL WHEN f = 7 THEN 'NaN' ELSE {_NUMBERS["volume"]} END)"""
_CSV_TAIL = (("'source'", _quoted("'csv'")), ("'ingested_at'", _quoted("ingested_at")))
RAW = f"""raw AS (
  SELECT *, CASE WHEN f = 1 THEN substring(body, 1, CAST(length(body) // 2 AS BIGINT)) ELSE body END AS raw FROM (
    SELECT *, '{{' || CASE
      WHEN source = 'csv' AND packed THEN {_members(("CASE WHEN f = 2 THEN 'date,open,high,low,close,volume' ELSE 'date;open;high;low;close;volume' END", _quoted(_PACKED)), *_CSV_TAIL)}
      WHEN source = 'csv' THEN {_members(("CASE WHEN f = 2 THEN 'fecha' ELSE 'date' END", _quoted(_CSV_DATE)), *((f"'{c}'", v) for c, v in _FAULTY.items()), *_CSV_TAIL)}
      ELSE {_members(("CASE WHEN f = 2 THEN 'Fecha' ELSE 'Date' END", _quoted("strftime(date, '%Y-%m-%d %H:%M:%S')")), *((f"'{c.capitalize()}_' || symbol", v) for c, v in _FAULTY.items()), ("'source'", _quoted("'yfinance'")), ("'ticker'", _quoted("symbol")), ("'ingested_at'", _quoted("ingested_at")))}
      END || '}}' AS body FROM nr))"""

ORACLE["stream_quarantine"] = with_(F1, NORM, RAW) + """
SELECT 'good' AS kind, topic, symbol, date, open, high, low, close, volume,
       CAST(NULL AS VARCHAR) AS reject_reason, CAST(NULL AS VARCHAR) AS raw, CAST(NULL AS BOOLEAN) AS origin_known
FROM norm WHERE reject_reason IS NULL
UNION ALL
SELECT 'quarantine', topic, NULL, NULL, NULL, NULL, NULL, NULL, NULL, reject_reason, raw, true FROM raw WHERE reject_reason IS NOT NULL"""

ORACLE["raw_trace"] = with_(F1, NORM, RAW) + """
SELECT CAST(CASE WHEN topic = 'prices_csv' THEN 1 ELSE 2 END AS BIGINT) AS run, topic, reject_reason, raw, true AS origin_known
FROM raw WHERE reject_reason IS NOT NULL"""

ORACLE["publish_incremental"] = with_(F1M) + """
SELECT symbol, date, CAST(row_number() OVER w - 1 AS BIGINT) AS idx, close,
       round(CASE WHEN count(close) OVER m = 20 THEN avg(close) OVER m END, 6) AS ma_20,
       round(CASE WHEN close / lag(close) OVER w > 0 THEN ln(close / lag(close) OVER w) END, 6) AS log_return
FROM f1m WINDOW w AS (PARTITION BY symbol ORDER BY date), m AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""

# ---------------------------------------------------------------- one model per series, and tuning

MULTI2 = (F1M, F1MU, clean_from("f1mu"), supervised_ctes("clean", "close", 2, 80, "sv"))


def fitted_by_symbol(src: str, name: str) -> str:
    """``fitted`` for each symbol of ``src`` (unweighted): rows (symbol, n, b0, b1, c)."""
    pairs = (("x_00", "x_00"), ("x_00", "x_01"), ("x_01", "x_01"), ("x_00", "y"), ("x_01", "y"))
    s = ", ".join(f"count(*) * covar_pop({a}, {b}) AS s_{i}" for i, (a, b) in enumerate(pairs))
    return f"""{name}_s AS (SELECT symbol, count(*) AS n, {s}, avg(x_00) AS m0, avg(x_01) AS m1, avg(y) AS my FROM {src} GROUP BY symbol),
{name}_b AS (SELECT *, (s_2 * s_3 - s_1 * s_4) / (s_0 * s_2 - s_1 * s_1) AS b0, (s_0 * s_4 - s_1 * s_3) / (s_0 * s_2 - s_1 * s_1) AS b1 FROM {name}_s),
{name} AS (SELECT symbol, n, b0, b1, my - b0 * m0 - b1 * m1 AS c FROM {name}_b)"""


MODELS = ("tr AS (SELECT * FROM sv_samples WHERE split = 'train')", fitted_by_symbol("tr", "fit"))

ORACLE["fit_per_series"] = with_(
    *MULTI2,
    *MODELS,
    "f4 AS (SELECT symbol, y AS real, b0 * x_00 + b1 * x_01 + c AS pred FROM sv_samples JOIN fit USING (symbol) WHERE split = 'test')",
    f"m AS (SELECT symbol, {METRICS} FROM f4 GROUP BY symbol)",
) + """
SELECT symbol, fit.n, round(b0, 6) AS b0, round(b1, 6) AS b1, round(c, 6) AS intercept, m.n AS n_test,
       round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2
FROM fit JOIN m USING (symbol)"""

ORACLE["forecast_per_series"] = "WITH RECURSIVE " + with_(
    *MULTI2,
    *MODELS,
    """last AS (SELECT s.symbol, max(CASE WHEN s.idx = n_rows - 2 THEN xs END) AS x0, max(CASE WHEN s.idx = n_rows - 1 THEN xs END) AS x1
      FROM sv_s s JOIN sv_n USING (symbol) GROUP BY s.symbol),
rec AS (
  SELECT symbol, 0 AS step, x0, x1, b0, b1, c FROM last JOIN fit USING (symbol)
  UNION ALL
  SELECT symbol, step + 1, x1, b0 * x0 + b1 * x1 + c, b0, b1, c FROM rec WHERE step < 365)""",
)[5:] + """
SELECT symbol, CAST(step AS INTEGER) AS step, round(x1, 6) AS pred FROM rec WHERE step > 0"""

ORACLE["tune_compare"] = with_(
    *BASE,
    F3,
    SV2,
    EX2,
    "tr AS (SELECT * FROM sv_samples WHERE split = 'train')",
    fitted_by_symbol("tr", "before"),
    "te AS (SELECT * FROM ex_samples WHERE split = 'train')",
    fitted_by_symbol("te", "exm"),
    """tuned_b AS (
  SELECT e.m0, e.m1, e.my, e.s_0 + 5 AS a, e.s_1 AS b, e.s_2 + 5 AS d, e.s_3 + 5 * p.b0 AS u, e.s_4 + 5 * p.b1 AS v FROM exm_s e, before p),
tuned_c AS (SELECT *, (d * u - b * v) / (a * d - b * b) AS b0, (a * v - b * u) / (a * d - b * b) AS b1 FROM tuned_b),
after AS (SELECT b0, b1, my - b0 * m0 - b1 * m1 AS c FROM tuned_c),
f4 AS (
  SELECT 'before' AS stage, y AS real, b0 * x_00 + b1 * x_01 + c AS pred FROM ex_samples, before WHERE split = 'test'
  UNION ALL
  SELECT 'after', y, b0 * x_00 + b1 * x_01 + c FROM ex_samples, after WHERE split = 'test')""",
) + f"""
SELECT stage, n, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2
FROM (SELECT stage, {METRICS} FROM f4 GROUP BY stage)"""

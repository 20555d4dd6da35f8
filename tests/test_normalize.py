"""Message normalisation and quarantine edge cases."""

import math

from pricelake.operators import normalize as N


def run(spark, texts, fn):
    df = spark.createDataFrame([("t", "k", t) for t in texts], "topic string, key string, value string")
    return fn(df).collect()


def test_csv_cases(spark):
    texts = [
        '{"date;open;high;low;close;volume":"2004.06.11 00:00;1;2;0.5;1.5;100","source":"csv","ingested_at":"x"}',
        '{"date;open;high;low;close;volume":"2004.06.11 00:00;1;2;0.5;1.5","source":"csv"}',
        '{"date;open;high;low;close;volume":"2004.06.11 00:00;1;;0.5;1.5;7","source":"csv"}',
        '{"date":"2004.06.11 00:00","open":1,"high":2,"close":1.5,"volume":NaN,"source":"csv"}',
        '{"date":"2004.06.11 00:00","open":1,"high":null,"low":1,"close":1.5,"volume":1}',
        '{"date":"2004.06.11 00:00","open":1,"high":2,"low":1,"close":"n/a","volume":1}',
        '{"fecha":"2004.06.11 00:00","open":1}',
        '{"date":"2004.06.11',
        '{"date":"junk","open":1,"high":1,"low":1,"close":1,"volume":1}',
    ]
    rows = run(spark, texts, lambda d: N.normalize_csv(d, "GC"))
    reasons = [r.reject_reason for r in rows]
    assert reasons == [None, "bad_arity", "bad_number", None, "null_value", "bad_number", "unknown_format", "malformed_json", "bad_date"]
    assert rows[0].volume == 100.0 and rows[0].symbol == "GC"
    assert rows[3].low == 0.0 and math.isnan(rows[3].volume)
    assert rows[1].open is None and rows[1].raw == texts[1]


def test_provider_cases(spark):
    texts = [
        '{"Date":"2004-01-02 00:00:00","Open_GC=F":1.0,"High_GC=F":null,"Close_GC=F":3,"Volume_GC=F":NaN,"ticker":"GC=F"}',
        '{"Date":"2004-01-02 00:00:00","Open_GC=F":"n/a","ticker":"GC=F"}',
        '{"Open_GC=F":1,"ticker":"GC=F"}',
    ]
    rows = run(spark, texts, lambda d: N.normalize_provider(d))
    assert [r.reject_reason for r in rows] == [None, "bad_number", "bad_date"]
    r = rows[0]
    assert (r.open, r.high, r.low, r.close) == (1.0, 0.0, 0.0, 3.0) and math.isnan(r.volume) and r.symbol == "GC=F"


def test_reject_counts(spark):
    texts = ['{"date":"2004.06.11 00:00","open":1,"high":1,"low":1,"close":1,"volume":1}', "{bad"]
    df = spark.createDataFrame([("t", "k", t) for t in texts], "topic string, key string, value string")
    got = {(r.topic, r.outcome): r.n for r in N.reject_counts(N.normalize_csv(df, "S")).collect()}
    assert got == {("t", "ok"): 1, ("t", "malformed_json"): 1}


def test_any_text_gets_exactly_one_outcome(spark):
    """Property: whatever the text, normalisation never raises and every
    message is either a good row (all values typed) or carries one reason."""
    import json

    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    scalar = st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=False), st.integers(-10**6, 10**6), st.text(max_size=6))
    keys = st.sampled_from(["date", "open", "high", "low", "close", "volume", "source", "fecha", N.PACKED_KEY, "Date", "Open_X", "ticker"])
    obj = st.dictionaries(keys, scalar, max_size=8)
    text = st.one_of(obj.map(lambda d: json.dumps(d)), st.text(max_size=30))

    seen = []  # at least 60 drawn lists; all texts go through one Spark job

    @settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(text, min_size=8, max_size=30))
    def draw(texts):
        seen.extend(texts)

    draw()
    assert len(set(seen)) > 100
    df = spark.createDataFrame([(i % 2 and "p" or "c", "k", t) for i, t in enumerate(seen)], "topic string, key string, value string")
    rows = N.normalize_messages(df, ["c"], ["p"], "S").collect()
    assert len(rows) == len(seen)
    for r in rows:
        if r.reject_reason is None:
            assert r.date is not None and all(r[f] is not None for f in ("open", "high", "low", "close", "volume"))
        else:
            assert r.reject_reason in {N.MALFORMED, N.UNKNOWN, N.BAD_ARITY, N.NULL_VALUE, N.BAD_NUMBER, N.BAD_DATE}
            assert r.date is None and r.raw is not None


def test_provider_without_ticker_reads_it_from_its_keys(spark):
    texts = ['{"Date":"2011-02-03 00:00:00","Open_X":1,"High_X":2,"Low_X":3,"Close_X":4,"Volume_X":5}', '{"Date":"2011-02-03 00:00:00","a":1}']
    df = spark.createDataFrame([("p", "k", t) for t in texts], "topic string, key string, value string")
    a, b = N.normalize_provider(df).collect()
    assert (a.symbol, a.open, a.volume) == ("X", 1.0, 5.0) and b.reject_reason == N.UNKNOWN


def test_number_texts_and_repeated_keys(spark):
    row = '{"date":"2011.02.03 00:00","open":%s,"high":1,"low":1,"close":1,"volume":1%s}'
    texts = [row % ('"1.5d"', ""), row % ('"2f"', ""), row % ("1e2", ""), row % ("1.0", ',"open":7.5'), row % ('"-Infinity"', "")]
    df = spark.createDataFrame([("c", "k", t) for t in texts], "topic string, key string, value string")
    rows = N.normalize_csv(df, "S").collect()
    assert [r.reject_reason for r in rows] == ["bad_number", "bad_number", None, None, None]
    assert [r.open for r in rows[2:]] == [100.0, 7.5, float("-inf")]


def test_good_rows_and_quarantine_split_everything(spark):
    texts = ['{"date":"2011.02.03 00:00","open":1,"high":1,"low":1,"close":1,"volume":1}', "{bad", '{"x":1}']
    df = spark.createDataFrame([("c", "k", t) for t in texts], "topic string, key string, value string")
    n = N.normalize_csv(df, "S")
    assert [r.open for r in N.good_rows(n).collect()] == [1.0]
    assert sorted((r.reject_reason, r.raw) for r in N.quarantined(n).collect()) == [("malformed_json", "{bad"), ("unknown_format", '{"x":1}')]


def test_messages_parsed_once_in_one_pass(spark):
    """Both layouts come out of one projection with a single JSON parse per message."""
    df = spark.createDataFrame([("c", "k", "{}"), ("p", "k", "{}")], "topic string, key string, value string")
    plan = N.normalize_messages(df, ["c"], ["p"], "S")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") + plan.count("jsontostructs") == 1

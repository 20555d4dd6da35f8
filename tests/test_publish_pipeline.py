"""The end-to-end publish query on messages that the fixtures do not hold."""

import os

import pytest

from pricelake.plans import queries as Q

SF = os.environ.get("PRICELAKE_TEST_SF", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.exists(f"{SF}/orders.parquet"), reason="driver tables absent")
def test_rejected_messages_without_text_stay_in_the_quarantine(spark, monkeypatch):
    whole = Q.messages.read_raw_zone

    def with_blank(*args, **kw):
        df = whole(*args, **kw)
        one = df.limit(1)
        return df.unionByName(one.selectExpr("topic", "key", "'' value", "file_path")).unionByName(one.selectExpr("topic", "key", "cast(null as string) value", "file_path"))

    count = lambda: Q.q_publish_pipeline(spark, SF).where("kind = 'quarantine'").count()
    before = count()
    monkeypatch.setattr(Q.messages, "read_raw_zone", with_blank)
    assert count() == before + 2

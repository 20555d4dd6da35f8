"""Raw messages -> normalised, quarantined, unified table (ingest + unify flow)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pricelake.operators.normalize import good_rows, normalize_messages
from pricelake.operators.unify import canonical

# The two topics the producers publish to.
TOPIC_CSV = "prices_csv"
TOPIC_PROVIDER = "prices_provider"


def normalized(messages: DataFrame, symbol: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Both layouts normalised into one table with ``reject_reason``, ``raw`` and the message columns of ``keep``."""
    return normalize_messages(messages, [TOPIC_CSV], [TOPIC_PROVIDER], symbol, keep)


def unified(normalized_rows: DataFrame) -> DataFrame:
    """The good ones of normalised rows, in the unified layout."""
    return canonical(good_rows(normalized_rows))

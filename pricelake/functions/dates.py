"""Date parsing and calendar fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two textual date layouts the sources use.
CSV_DATE_FORMAT = "yyyy.MM.dd HH:mm"
PROVIDER_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMATS = (CSV_DATE_FORMAT, PROVIDER_DATE_FORMAT, "yyyy-MM-dd")


def parse_date(col: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Text -> DATE trying each layout in turn; unparseable text gives NULL.

    Every layout is tried explicitly, so rows of both sources survive (the
    mixed-format case where inferring one layout would null the other).
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]).cast("date")


def format_csv_date(col: Column | str) -> Column:
    return F.date_format(col, CSV_DATE_FORMAT)


def format_provider_date(col: Column | str) -> Column:
    return F.date_format(col, PROVIDER_DATE_FORMAT)


def weekday_mon0(col: Column | str) -> Column:
    """Day of week with Monday = 0 (``F.dayofweek`` would be Sunday = 1)."""
    return F.weekday(col)

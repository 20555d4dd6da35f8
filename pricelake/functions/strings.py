"""String helpers for labels and headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_label(col: Column | str) -> Column:
    """strip, lower, blank -> '_' (header normalisation, as a column expression)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.replace(F.lower(F.trim(c)), F.lit(" "), F.lit("_"))


def normalize_header(name: str) -> str:
    """Same rule for a column name (driver-side metadata, no job)."""
    return name.strip().lower().replace(" ", "_")


def flatten_label(field: Column | str, ticker: Column | str) -> Column:
    """Two-level column label (field, ticker) -> 'field_ticker'."""
    f = F.col(field) if isinstance(field, str) else field
    t = F.col(ticker) if isinstance(ticker, str) else ticker
    return F.concat_ws("_", f, t)

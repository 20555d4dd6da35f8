"""Schemas of the tables pricelake reads and writes."""

from pyspark.sql import types as T

PRICE_FIELDS = ("open", "high", "low", "close", "volume")

# Unified table; `symbol` is our ninth column so every operator can key on it.
UNIFIED_COLUMNS = ("symbol", "date", "open", "high", "low", "close", "volume", "source", "ingested_at")

UNIFIED = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("date", T.DateType()),
        *[T.StructField(f, T.DoubleType()) for f in PRICE_FIELDS],
        T.StructField("source", T.StringType()),
        T.StructField("ingested_at", T.StringType()),
    ]
)

# Semicolon CSV with a header, prices as numbers, date as text.
CSV_FILE = T.StructType(
    [
        T.StructField("Date", T.StringType()),
        T.StructField("Open", T.DoubleType()),
        T.StructField("High", T.DoubleType()),
        T.StructField("Low", T.DoubleType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("Volume", T.DoubleType()),
    ]
)

# D3: a message as it comes off a topic (the Kafka source's columns we use).
MESSAGE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

# Long prediction table.
PREDICTIONS = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("real", T.DoubleType()),
        T.StructField("pred", T.DoubleType()),
    ]
)

# Fitted min-max parameters, one row per symbol.
SCALER = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("min", T.DoubleType()),
        T.StructField("max", T.DoubleType()),
    ]
)

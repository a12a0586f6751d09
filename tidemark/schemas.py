"""Declared record schemas (FIXTURES.md §1-§4). Nothing is inferred."""

from pyspark.sql.types import (
    ArrayType, DoubleType, LongType, StringType, StructField, StructType, TimestampType,
)

PRICE_SCHEMA = StructType([
    StructField("symbol", StringType()),
    StructField("price", DoubleType()),
    StructField("volume", DoubleType()),
    StructField("price_change_percent", DoubleType()),
    StructField("high_24h", DoubleType()),
    StructField("low_24h", DoubleType()),
    StructField("timestamp", LongType()),
    StructField("human_time", StringType()),
])

SENTIMENT_SCHEMA = StructType([
    StructField("type", StringType()),
    StructField("value", LongType()),
    StructField("classification", StringType()),
    StructField("timestamp", LongType()),
])

# Exchange ticker: every numeric field travels as a string.
TICKER_WIRE_SCHEMA = StructType([
    StructField("s", StringType()),
    StructField("c", StringType()),
    StructField("v", StringType()),
    StructField("P", StringType()),
    StructField("h", StringType()),
    StructField("l", StringType()),
    StructField("E", LongType()),
])

FEAR_GREED_WIRE_SCHEMA = StructType([
    StructField("value", StringType()),
    StructField("value_classification", StringType()),
    StructField("timestamp", StringType()),
    StructField("time_until_update", StringType()),
])

# Market snapshot: numbers read as strings and cast, so a quoted number or a
# bad value becomes null instead of failing the record.
MARKET_WIRE_FIELDS = [
    "current_price", "market_cap", "total_volume", "high_24h", "low_24h", "price_change_24h",
    "price_change_percentage_24h", "price_change_percentage_1h_in_currency",
    "price_change_percentage_7d_in_currency", "market_cap_change_24h",
    "market_cap_change_percentage_24h", "circulating_supply", "total_supply", "ath",
    "ath_change_percentage",
]
MARKET_WIRE_SCHEMA = StructType(
    [StructField("id", StringType()), StructField("symbol", StringType()),
     StructField("name", StringType()), StructField("market_cap_rank", StringType())]
    + [StructField(f, StringType()) for f in MARKET_WIRE_FIELDS])

ARTICLE_SCHEMA = StructType([
    StructField("type", StringType()),
    StructField("id", StringType()),
    StructField("source", StringType()),
    StructField("title", StringType()),
    StructField("summary", StringType()),
    StructField("link", StringType()),
    StructField("author", StringType()),
    StructField("created_utc", DoubleType()),
    StructField("timestamp", LongType()),
    StructField("human_time", StringType()),
    StructField("tags", ArrayType(StringType())),
])

QUALITY_METRIC_SCHEMA = StructType([
    StructField("check_time", TimestampType()),
    StructField("table_name", StringType()),
    StructField("metric_name", StringType()),
    StructField("metric_value", DoubleType()),
    StructField("threshold", DoubleType()),
    StructField("status", StringType()),
])

VOLUME_SPIKES_SCHEMA = "spike_time timestamp, symbol string, volume double, volume_baseline double, spike_multiplier double, price_at_spike double"
PRICE_MOVES_SCHEMA = "window_start timestamp, window_end timestamp, symbol string, price_change_pct double, avg_price double, volatility double"

__all__ = [
    "PRICE_SCHEMA", "SENTIMENT_SCHEMA", "TICKER_WIRE_SCHEMA", "FEAR_GREED_WIRE_SCHEMA",
    "MARKET_WIRE_SCHEMA", "MARKET_WIRE_FIELDS", "ARTICLE_SCHEMA", "QUALITY_METRIC_SCHEMA",
]

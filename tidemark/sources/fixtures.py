"""Input views over the driver's tables (FIXTURES.md §5).

The reference reads market messages from Kafka; here they are derived from
the ``events`` / ``documents`` / ``part`` tables so that every query's work
grows with those tables. All fixtures are plain DataFrame plans (no collect,
no Python), so Catalyst prunes and pushes filters through them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import SENTIMENT_ZONES
from ..functions.timecols import epoch_ms_to_iso, ts_to_epoch_ms
from ..plans.chunked import bucket_width, range_frame

# Fixed mapping of event types to symbols and the fixture's fixed rules
# (FIXTURES.md §5).
EVENT_SYMBOLS = {
    "click": "BTCUSDT",
    "view": "ETHUSDT",
    "purchase": "BNBUSDT",
    "signup": "SOLUSDT",
    "error": "XRPUSDT",
}
KAFKA_PARTITIONS = 3
MALFORMED_EVERY = 97      # every 97th event id is cut in half on the wire
ROLLING_24H_SECONDS = 24 * 3600
AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def symbol_of(event_type) -> F.Column:
    expr = None
    for k, v in EVENT_SYMBOLS.items():
        expr = F.when(event_type == k, v) if expr is None else expr.when(event_type == k, v)
    return expr


def base_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price ticks without the rolling 24 h fields (cheap projection)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        symbol_of(F.col("event_type")).alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        F.col("ts").alias("event_time"),
        F.col("event_id").alias("kafka_offset"),
        (F.col("user_id") % KAFKA_PARTITIONS).cast("int").alias("kafka_partition"),
        ts_to_epoch_ms(F.col("ts")).alias("timestamp"),
    )


def with_rolling_24h(df: DataFrame, time_col: str = "event_time",
                     lookback_seconds: int = ROLLING_24H_SECONDS) -> DataFrame:
    """high_24h / low_24h = max / min price of the symbol over the last 24 h
    (inclusive); price_change_percent against the first price in that span.

    Linear-time bucketed frame (``plans.chunked.range_frame``, one-hour
    buckets) instead of a sliding RANGE window, whose cost grows with the
    number of ticks per 24 h.
    """
    bucket = math.gcd(lookback_seconds, bucket_width(df))  # a whole number of buckets, following the session's width
    r = range_frame(df, ["symbol"], time_col, "kafka_offset", "price", lookback_seconds, bucket)
    return r.select(*df.columns, F.col("_rf.max").alias("high_24h"), F.col("_rf.min").alias("low_24h"),
                    (F.try_divide(F.col("price") - F.col("_rf.first"),
                                  F.nullif(F.col("_rf.first"), F.lit(0.0))) * 100).alias("price_change_percent"))


def ticks(spark: SparkSession, sf_dir: str, rolling: bool = True) -> DataFrame:
    """The decoded price stream (bronze columns minus ingest audit)."""
    t = base_ticks(spark, sf_dir)
    if rolling:
        t = with_rolling_24h(t)
    else:
        t = t.withColumns({c: F.lit(None).cast("double")
                           for c in ("high_24h", "low_24h", "price_change_percent")})
    return t.withColumn("human_time", epoch_ms_to_iso(F.col("timestamp")))


def _malformed(event_id) -> F.Column:
    return (event_id % MALFORMED_EVERY) == 0


def _maybe_cut(text: F.Column, bad: F.Column) -> F.Column:
    return F.when(bad, F.substring(text, 1, (F.length(text) / 2).cast("int"))).otherwise(text)


def kafka_price_records(spark: SparkSession, sf_dir: str, cut: bool = False) -> DataFrame:
    """What the price topic holds: key = symbol, value = the 8-field JSON; with
    ``cut`` every 97th message is broken (for queries about bad input)."""
    t = ticks(spark, sf_dir)
    value = F.to_json(F.struct("symbol", "price", "volume", "price_change_percent",
                               "high_24h", "low_24h", "timestamp", "human_time"))
    return t.select(
        F.col("symbol").cast("binary").alias("key"),
        (_maybe_cut(value, _malformed(F.col("kafka_offset"))) if cut else value).cast("binary").alias("value"),
        F.lit("crypto-prices").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.timestamp_millis("timestamp").alias("timestamp"),  # Kafka times are in ms
        F.lit(0).alias("timestampType"),
    )


def raw_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange ticker messages: keys s,c,v,P,h,l,E with numeric strings."""
    t = ticks(spark, sf_dir)
    js = F.to_json(F.struct(
        F.col("symbol").alias("s"),
        F.col("price").cast("string").alias("c"),
        F.col("volume").cast("string").alias("v"),
        F.col("price_change_percent").cast("string").alias("P"),
        F.col("high_24h").cast("string").alias("h"),
        F.col("low_24h").cast("string").alias("l"),
        F.col("timestamp").alias("E")))
    return t.select(F.col("kafka_offset").alias("msg_id"),
                    js.alias("raw_json"))


def sentiment_class(value) -> F.Column:
    expr = None
    for i, (lo, hi, name) in enumerate(SENTIMENT_ZONES):
        last = i == len(SENTIMENT_ZONES) - 1
        cond = (value >= lo) & ((value <= hi) if last else (value < hi))
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr


def sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fear & greed readings, one per hour: the index is the floor of the mean
    ``props.k`` (0..99) over all events of the hour, published at the hour's
    end. Columns: type, value, classification, timestamp (ms),
    index_timestamp (s), event_time, msg_id (hours since the epoch)."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    g = ev.groupBy(F.window("ts", "1 hour").alias("w")).agg(F.floor(F.avg(k)).cast("long").alias("value"))
    end = F.col("w.end")
    return g.select(
        F.lit("fear_greed_index").alias("type"),
        "value",
        sentiment_class(F.col("value")).alias("classification"),
        ts_to_epoch_ms(end).alias("timestamp"),
        F.floor(ts_to_epoch_ms(end) / 1000).cast("long").alias("index_timestamp"),
        end.alias("event_time"),
        F.floor(ts_to_epoch_ms(end) / 3600000).cast("long").alias("msg_id"),
    )


def sentiment_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sentiment(spark, sf_dir)
    js = F.to_json(F.struct("type", "value", "classification", "timestamp"))
    return s.select("msg_id", _maybe_cut(js, _malformed(F.col("msg_id"))).alias("raw_json"))


def fear_greed_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw index API answers as a poller sees them: numbers as strings, the
    index time is the start of the day (the index is published daily), and
    ``time_until_update`` counts to the next full hour ('' on the hour)."""
    s = sentiment(spark, sf_dir)
    day_s = F.floor(F.col("index_timestamp") / 86400) * 86400
    tuu = 3600 - (F.col("index_timestamp") % 3600)
    return s.select(
        F.col("msg_id").alias("poll_id"),
        F.col("event_time").alias("poll_time"),
        F.col("value").cast("string").alias("value"),
        F.col("classification").alias("value_classification"),
        day_s.cast("string").alias("timestamp"),
        F.when(tuu == 3600, F.lit("")).otherwise(tuu.cast("string")).alias("time_until_update"),
    )


def rss_entries(spark: SparkSession, sf_dir: str, documents: DataFrame | None = None, carry: tuple[Column, ...] = ()) -> DataFrame:
    """Parsed feed entries from ``documents``: the link is the text itself, so
    exact copies of a text are the same article. (``documents``: given rows of it; ``carry``: further columns of theirs.)"""
    d = table(spark, sf_dir, "documents") if documents is None else documents
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    pub = base + F.make_dt_interval(mins=F.col("doc_id").cast("int"))
    return d.select(
        F.col("source").alias("feed"),
        F.substring_index("text", "\n", 1).alias("title"),   # the first line is the headline
        F.col("text").alias("summary"),
        F.col("text").alias("link"),
        F.when(F.col("lang") == "en", F.col("source")).alias("author"),
        F.when(F.col("lang").isin("en", "fr"), pub).alias("published"),
        F.when(F.col("lang") != "de", pub + F.expr("INTERVAL 30 SECONDS")).alias("updated"),
        F.array(F.struct(F.col("lang").alias("term")),
                F.struct(F.col("source").alias("term"))).alias("tags"),
        F.col("doc_id").alias("entry_id"),
        *carry,
    )


def newsapi_articles(spark: SparkSession, sf_dir: str, documents: DataFrame | None = None, carry: tuple[Column, ...] = ()) -> DataFrame:
    """Search-API articles: the documents again, so they overlap the feed
    entries. (The API's own language parameter is not applied here.)"""
    d = table(spark, sf_dir, "documents") if documents is None else documents
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    pub = base + F.make_dt_interval(mins=F.col("doc_id").cast("int"))
    return d.select(
        F.when(F.col("n_chars") % 2 == 0, F.struct(F.col("source").alias("name"))).alias("source"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("description"),
        F.col("text").alias("url"),
        F.col("source").alias("author"),
        F.when(F.col("n_chars") % 3 == 0, F.lit("not a time"))
         .otherwise(F.date_format(pub, "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("publishedAt"),
        F.col("doc_id").alias("entry_id"),
        *carry,
    )


def market_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market snapshot JSON from ``part``; optional keys absent for odd sizes."""
    p = table(spark, sf_dir, "part")
    odd = (F.col("p_size") % 2) == 1
    opt = lambda c: F.when(~odd, c)  # noqa: E731 — absent key when null (to_json drops nulls)
    js = F.to_json(F.struct(
        F.concat(F.lit("coin-"), F.col("p_partkey").cast("string")).alias("id"),
        F.lower(F.regexp_replace("p_brand", "[^A-Za-z0-9]", "")).alias("symbol"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("current_price"),
        (F.col("p_retailprice") * F.col("p_size") * 1000).alias("market_cap"),
        F.col("p_partkey").alias("market_cap_rank"),
        (F.col("p_size") * 1000.0).alias("total_volume"),
        opt(F.col("p_retailprice") * 1.05).alias("high_24h"),
        opt(F.col("p_retailprice") * 0.95).alias("low_24h"),
        opt(F.col("p_retailprice") * 0.01).alias("price_change_24h"),
        opt(F.lit(1.0)).alias("price_change_percentage_24h"),
        opt(F.col("p_size") / 10.0).alias("price_change_percentage_1h_in_currency"),
        opt(F.col("p_size") / 5.0).alias("price_change_percentage_7d_in_currency"),
        opt(F.col("p_retailprice") * 10).alias("market_cap_change_24h"),
        opt(F.lit(0.5)).alias("market_cap_change_percentage_24h"),
        opt(F.col("p_size") * 100.0).alias("circulating_supply"),
        opt(F.col("p_size") * 200.0).alias("total_supply"),
        opt(F.col("p_retailprice") * 2).alias("ath"),
        opt(F.lit(-50.0)).alias("ath_change_percentage"),
    ))
    return p.select(F.col("p_partkey").alias("msg_id"), js.alias("raw_json"))


def trending_payloads(spark: SparkSession, sf_dir: str, size: int) -> DataFrame:
    """Trending-coins answers: per brand, its first ``size`` parts (by part key)
    as coins (``coins: array<struct<item: struct<name>>>``). The list is bounded
    by what is asked for before it is collected (a per-brand top-k, limited map side)."""
    p = table(spark, sf_dir, "part")
    w = Window.partitionBy("p_brand").orderBy("p_partkey")
    p = p.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= size)
    return (p.groupBy("p_brand")
             .agg(F.sort_array(F.collect_list(F.struct(F.col("p_partkey"), F.col("p_name"))))
                  .alias("_parts"))
             .select(F.col("p_brand").alias("poll_key"),
                     F.transform("_parts", lambda x: F.struct(F.struct(x["p_name"].alias("name"))
                                                              .alias("item"))).alias("coins")))


# Per-symbol validation bounds used on the test data (FIXTURES.md §5): small
# enough that both outcomes occur for prices 0.01 .. 490.
TEST_BOUNDS = [
    ("BTCUSDT", 1.0, 200.0, 0.0, 90.0),
    ("ETHUSDT", 1.0, 200.0, 0.0, 90.0),
    ("BNBUSDT", 1.0, 200.0, 0.0, 90.0),
]


def validation_bounds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        TEST_BOUNDS, "symbol string, min_price double, max_price double, min_volume double, max_volume double")


def as_of_lit() -> F.Column:
    return F.lit(AS_OF).cast("timestamp_ntz")



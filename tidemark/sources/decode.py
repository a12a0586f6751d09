"""Wire decoding and record normalising.

All parsing is ``from_json`` with a declared schema (PERMISSIVE: a broken
record becomes nulls plus its raw text in ``_corrupt_record``), numbers that
travel as strings are ``try_cast``, so one bad message never stops a job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.columns import col_
from ..functions.timecols import epoch_ms_to_iso, epoch_ms_to_ts, epoch_s_to_ts, ts_to_iso
from ..schemas import (
    FEAR_GREED_WIRE_SCHEMA, MARKET_WIRE_FIELDS, MARKET_WIRE_SCHEMA, PRICE_SCHEMA,
    SENTIMENT_SCHEMA, TICKER_WIRE_SCHEMA,
)

CORRUPT = "_corrupt_record"
PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def kafka_envelope(raw: DataFrame) -> DataFrame:
    """Kafka record -> (symbol_key, raw_json, kafka_timestamp, partition, offset)."""
    return raw.selectExpr("CAST(key AS STRING) AS symbol_key", "CAST(value AS STRING) AS raw_json",
                          "timestamp AS kafka_timestamp", "partition", "offset")


def with_corrupt(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField(CORRUPT, StringType())])


def decode_json(df: DataFrame, col: str, schema: StructType, keep_corrupt: bool = False) -> Column:
    s = with_corrupt(schema) if keep_corrupt else schema
    return F.from_json(F.col(col), s, PERMISSIVE if keep_corrupt else {"mode": "PERMISSIVE"})


def decode_price_json(envelope: DataFrame) -> DataFrame:
    """Envelope -> the 8 price fields flattened, plus Kafka metadata."""
    return (envelope.withColumn("data", F.from_json("raw_json", PRICE_SCHEMA))
                    .select("symbol_key", "data.*", "kafka_timestamp",
                            F.col("partition").alias("kafka_partition"),
                            F.col("offset").alias("kafka_offset")))


def decode_sentiment_json(df: DataFrame, col: str = "raw_json") -> DataFrame:
    keep = [c for c in df.columns if c != col]
    return df.withColumn("data", F.from_json(col, SENTIMENT_SCHEMA)).select(*keep, "data.*")


def bronze_records(envelope: DataFrame, audit: bool = True) -> DataFrame:
    """Bronze layer rows: decode + ingest time + event time (exact ms)."""
    out = decode_price_json(envelope)
    if audit:
        out = out.withColumn("ingested_at", F.current_timestamp())
    return out.withColumn("event_time", epoch_ms_to_ts("timestamp"))


def route_malformed(df: DataFrame, col: str, schema: StructType) -> DataFrame:
    """One pass: the declared fields where the JSON parsed (``route`` good), the
    raw text where it did not (``route`` quarantine). Nothing is dropped."""
    parsed = df.withColumn("_d", F.from_json(F.col(col), with_corrupt(schema), PERMISSIVE))
    bad = F.col(f"_d.{CORRUPT}").isNotNull() | F.col(col).isNull()
    keep = [c for c in df.columns if c != col]
    return parsed.select(*keep, F.when(bad, "quarantine").otherwise("good").alias("route"),
                         F.when(bad, F.col(col)).alias("raw_text"),
                         *[F.col(f"_d.{f.name}").alias(f.name) for f in schema.fields])


def split_malformed(df: DataFrame, col: str, schema: StructType):
    """(good, quarantine) as two tables; ``route_malformed`` gives both in one pass."""
    routed = route_malformed(df, col, schema)
    names = [f.name for f in schema.fields]
    return (routed.filter("route = 'good'").drop("route", "raw_text"),
            routed.filter("route = 'quarantine'").drop("route", *names))


def normalize_ticker(raw: DataFrame, col: str = "raw_json") -> DataFrame:
    """Exchange ticker {s,c,v,P,h,l,E} (numeric strings) -> the 8-field price
    record. Bad numbers become null (``try_cast``), as does a broken record."""
    keep = [c for c in raw.columns if c != col]
    d = F.from_json(F.col(col), TICKER_WIRE_SCHEMA)
    num = lambda k: F.col(f"_t.{k}").try_cast("double")
    return (raw.withColumn("_t", d)
               .select(*keep,
                       F.col("_t.s").alias("symbol"), num("c").alias("price"), num("v").alias("volume"),
                       num("P").alias("price_change_percent"), num("h").alias("high_24h"),
                       num("l").alias("low_24h"), F.col("_t.E").alias("timestamp"),
                       epoch_ms_to_iso(F.col("_t.E")).alias("human_time")))


def normalize_market_data(raw: DataFrame, as_of, col: str = "raw_json") -> DataFrame:
    """Market snapshot -> 22 fields; optional fields absent -> null.
    ``as_of`` (the poll time) gives ``timestamp`` / ``human_time``."""
    keep = [c for c in raw.columns if c != col]
    now = F.lit(as_of).cast("timestamp")
    m = "_m"
    num = lambda k: F.col(f"{m}.{k}").try_cast("double")
    renames = {"price_change_percentage_1h_in_currency": "price_change_percentage_1h",
               "price_change_percentage_7d_in_currency": "price_change_percentage_7d"}
    return (raw.withColumn(m, F.from_json(col, MARKET_WIRE_SCHEMA))
               .select(*keep,
                       F.lit("market_data").alias("type"),
                       F.col(f"{m}.id").alias("coin_id"),
                       F.upper(F.col(f"{m}.symbol")).alias("symbol"),
                       F.col(f"{m}.name").alias("name"),
                       *[num(f).alias(renames.get(f, f)) for f in MARKET_WIRE_FIELDS[:3]],
                       F.col(f"{m}.market_cap_rank").try_cast("long").alias("market_cap_rank"),
                       *[num(f).alias(renames.get(f, f)) for f in MARKET_WIRE_FIELDS[3:]],
                       F.unix_millis(now).alias("timestamp"),
                       ts_to_iso(now).alias("human_time")))


def trending_top(payload: DataFrame, n: int = 5, col: str = "coins") -> DataFrame:
    """Names of the first ``n`` trending coins: ``transform(slice(...))``."""
    keep = [c for c in payload.columns if c != col]
    return payload.select(*keep, F.transform(F.slice(col, 1, n), lambda c: c["item"]["name"])
                          .alias("trending"))


def normalize_sentiment(raw: DataFrame, as_of) -> DataFrame:
    """Index API answer -> sentiment record. ``next_update`` only when
    ``time_until_update`` is present and non-empty."""
    now_s = F.unix_seconds(F.lit(as_of).cast("timestamp"))
    tuu = F.when(F.length(F.col("time_until_update")) > 0,
                 F.col("time_until_update").try_cast("long"))
    ts = F.col("timestamp").try_cast("long")
    keep = [c for c in raw.columns if c not in FEAR_GREED_WIRE_SCHEMA.fieldNames()]
    return raw.select(
        *keep,
        F.lit("fear_greed_index").alias("type"),
        F.col("value").try_cast("int").alias("value"),
        F.col("value_classification").alias("classification"),
        ts.alias("index_timestamp"),
        ts_to_iso(epoch_s_to_ts(ts)).alias("index_human_time"),
        tuu.alias("time_until_update"),
        (now_s + tuu).alias("next_update"),
        (now_s * 1000).alias("timestamp"),
        ts_to_iso(F.lit(as_of).cast("timestamp")).alias("human_time"))


def article_id(link) -> Column:
    """md5 hex of the link (of '' when there is none)."""
    return F.md5(F.coalesce(col_(link), F.lit("")))


def normalize_rss(entries: DataFrame, as_of, carry: tuple[str, ...] = ()) -> DataFrame:
    """Feed entry -> 11-field article. Time = published, else updated, else
    the poll time; author defaults to 'Unknown'; tags = their terms."""
    now = F.lit(as_of).cast("timestamp_ntz")
    t = F.coalesce(F.col("published"), F.col("updated"), now)
    return entries.select(
        F.lit("news_article").alias("type"),
        article_id("link").alias("id"),
        F.col("feed").alias("source"),
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        F.coalesce(F.col("summary"), F.lit("")).alias("summary"),
        F.coalesce(F.col("link"), F.lit("")).alias("link"),
        F.coalesce(F.col("author"), F.lit("Unknown")).alias("author"),
        (F.unix_micros(t.cast("timestamp")) / 1e6).alias("created_utc"),
        F.unix_millis(now.cast("timestamp")).alias("timestamp"),
        ts_to_iso(t).alias("human_time"),
        F.coalesce(F.transform("tags", lambda x: x["term"]), F.array().cast("array<string>")).alias("tags"),
        "entry_id", *carry)


def normalize_newsapi(articles: DataFrame, as_of, carry: tuple[str, ...] = ()) -> DataFrame:
    """Search-API article -> the same 11 fields. ``publishedAt`` is parsed
    with a fixed pattern; unparsable or missing -> the poll time."""
    now = F.lit(as_of).cast("timestamp_ntz")
    parsed = F.try_to_timestamp(F.col("publishedAt"), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")).cast("timestamp_ntz")
    t = F.coalesce(parsed, now)
    return articles.select(
        F.lit("news_article").alias("type"),
        article_id("url").alias("id"),
        F.coalesce(F.col("source.name"), F.lit("NewsAPI")).alias("source"),
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        F.coalesce(F.col("description"), F.lit("")).alias("summary"),
        F.coalesce(F.col("url"), F.lit("")).alias("link"),
        F.coalesce(F.col("author"), F.lit("Unknown")).alias("author"),
        (F.unix_micros(t.cast("timestamp")) / 1e6).alias("created_utc"),
        F.unix_millis(now.cast("timestamp")).alias("timestamp"),
        ts_to_iso(t).alias("human_time"),
        F.array().cast("array<string>").alias("tags"),
        "entry_id", *carry)


def news_union(*streams: DataFrame) -> DataFrame:
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s)
    return out


def dedup_seen_ids(articles: DataFrame, order: list[str] | None = None) -> DataFrame:
    """First article per id wins. With an order (e.g. poll time, source rank)
    the earliest row is kept deterministically; the aggregation is keyed by
    id, so a hot id is one key among many, never one task's whole input."""
    if not order:
        return articles.dropDuplicates(["id"])
    cols = articles.columns
    o = F.struct(*[F.col(c) for c in order])
    return (articles.groupBy("id").agg(F.min_by(F.struct(*cols), o).alias("_a"))
                    .select("_a.*"))


def emit_on_change(polls: DataFrame, time_col: str = "poll_time", key_cols=("timestamp", "value"),
                   tie_col: str = "poll_id") -> DataFrame:
    """Keep a poll only when (index time, value) differs from the previous
    poll's (null-safe); the first poll is always kept. The previous poll comes
    from a chunked lag (``plans.chunked.lag_by_key``), so a single global
    series is still spread over time buckets."""
    from ..plans.chunked import lag_by_key
    p = polls.withColumns({"_series": F.lit(0), "_seen": F.lit(True)})
    lagged = lag_by_key(p, ["_series"], time_col, [F.col(time_col), F.col(tie_col)],
                        [*key_cols, "_seen"], prefix="_prev_")
    changed = None
    for k in key_cols:
        c = ~F.col(k).eqNullSafe(F.col(f"_prev_{k}"))
        changed = c if changed is None else changed | c
    first = F.col("_prev__seen").isNull()  # a previous poll of nulls is a previous poll
    return lagged.filter(first | changed).drop("_series", "_seen", "_prev__seen", *[f"_prev_{k}" for k in key_cols])

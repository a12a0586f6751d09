"""Registered normaliser, news and de-duplication queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import sentiment_label, sentiment_zone
from ..functions.timecols import epoch_ms_to_iso
from ..operators.quality import bounds_lookup
from ..registry import register
from ..sources.decode import (
    article_id, decode_sentiment_json, dedup_seen_ids, emit_on_change, news_union,
    normalize_market_data, normalize_newsapi, normalize_rss, normalize_sentiment,
    normalize_ticker, route_malformed, trending_top,
)
from ..schemas import PRICE_SCHEMA
from ..sources.fixtures import (
    AS_OF, fear_greed_polls, kafka_price_records, market_snapshots, newsapi_articles,
    raw_tickers, rss_entries, sentiment, sentiment_messages, validation_bounds, ticks,
    trending_payloads,
)
from .layers import bronze
from .sqlviews import (
    AS_OF_TS, BRONZE, BRONZE_CUT, NEWSAPI, POLLS, RSS, SENTIMENT, TEST_BOUNDS_SQL, TICKS, article_cols,
    iso_ms, iso_ts,
)

TICKER_DOUBLES = ["price", "volume", "price_change_percent", "high_24h", "low_24h"]


@register("normalize_ticker", doubles=TICKER_DOUBLES, sql=f"""
WITH {BRONZE}
SELECT kafka_offset AS msg_id, symbol, price, volume, price_change_percent, high_24h, low_24h,
       "timestamp", human_time
FROM bronze""")
def q_normalize_ticker(spark, sf_dir):
    return normalize_ticker(raw_tickers(spark, sf_dir))


@register("epoch_ms_to_iso", sql=f"""
WITH {TICKS} SELECT kafka_offset, {iso_ms('"timestamp"')} AS human_time FROM ticks""")
def q_epoch_ms_to_iso(spark, sf_dir):
    t = ticks(spark, sf_dir, rolling=False)
    return t.select("kafka_offset", epoch_ms_to_iso("timestamp").alias("human_time"))


@register("skip_malformed", sql=f"""
WITH {BRONZE_CUT}
SELECT kafka_offset AS "offset", CASE WHEN symbol IS NULL THEN 'quarantine' ELSE 'good' END AS route,
       symbol, price, "timestamp", symbol IS NULL AS has_raw_text
FROM bronze""")
def q_skip_malformed(spark, sf_dir):
    rec = kafka_price_records(spark, sf_dir, cut=True).select("offset", F.col("value").cast("string").alias("raw_json"))
    return route_malformed(rec, "raw_json", PRICE_SCHEMA).select(
        "offset", "route", "symbol", "price", "timestamp", F.col("raw_text").isNotNull().alias("has_raw_text"))


@register("decode_sentiment_json", sql=f"""
WITH {SENTIMENT}
SELECT msg_id,
       CASE WHEN msg_id % 97 = 0 THEN NULL ELSE type END AS type,
       CASE WHEN msg_id % 97 = 0 THEN NULL ELSE value END AS value,
       CASE WHEN msg_id % 97 = 0 THEN NULL ELSE classification END AS classification,
       CASE WHEN msg_id % 97 = 0 THEN NULL ELSE "timestamp" END AS "timestamp"
FROM sentiment""")
def q_decode_sentiment_json(spark, sf_dir):
    return decode_sentiment_json(sentiment_messages(spark, sf_dir))


@register("sentiment_label", sql=f"""
WITH {SENTIMENT}
SELECT msg_id, CASE classification WHEN 'Extreme Fear' THEN '[EXTREME FEAR]' WHEN 'Fear' THEN '[FEAR]'
       WHEN 'Neutral' THEN '[NEUTRAL]' WHEN 'Greed' THEN '[GREED]'
       WHEN 'Extreme Greed' THEN '[EXTREME GREED]' ELSE '[UNKNOWN]' END AS label
FROM sentiment""")
def q_sentiment_label(spark, sf_dir):
    return sentiment(spark, sf_dir).select("msg_id", sentiment_label().alias("label"))


@register("sentiment_zone", sql=f"""
WITH {SENTIMENT}
SELECT CASE WHEN value >= 0 AND value < 30 THEN 'Extreme Fear' WHEN value >= 30 AND value < 45 THEN 'Fear'
            WHEN value >= 45 AND value < 55 THEN 'Neutral' WHEN value >= 55 AND value < 70 THEN 'Greed'
            WHEN value >= 70 AND value <= 100 THEN 'Extreme Greed' END AS zone,
       count(*) AS n
FROM sentiment GROUP BY 1""")
def q_sentiment_zone(spark, sf_dir):
    return (sentiment(spark, sf_dir).select(sentiment_zone("value").alias("zone"))
            .groupBy("zone").agg(F.count(F.lit(1)).alias("n")))


@register("normalize_sentiment", sql=f"""
WITH {POLLS}
SELECT poll_id, poll_time, 'fear_greed_index' AS type, CAST(value AS INTEGER) AS value,
       value_classification AS classification, CAST("timestamp" AS BIGINT) AS index_timestamp,
       {iso_ts('make_timestamp(CAST("timestamp" AS BIGINT) * 1000000)')} AS index_human_time,
       TRY_CAST(nullif(time_until_update, '') AS BIGINT) AS time_until_update,
       epoch({AS_OF_TS})::BIGINT + TRY_CAST(nullif(time_until_update, '') AS BIGINT) AS next_update,
       epoch({AS_OF_TS})::BIGINT * 1000 AS "timestamp",
       '2024-01-31T00:00:00' AS human_time
FROM polls""")
def q_normalize_sentiment(spark, sf_dir):
    return normalize_sentiment(fear_greed_polls(spark, sf_dir), AS_OF)


@register("emit_on_change", sql=f"""
WITH {POLLS},
l AS (
    SELECT *, lag("timestamp") OVER (ORDER BY poll_time, poll_id) AS pt,
           lag(value) OVER (ORDER BY poll_time, poll_id) AS pv,
           row_number() OVER (ORDER BY poll_time, poll_id) AS rn
    FROM polls
)
SELECT poll_id, poll_time, value, value_classification, "timestamp", time_until_update
FROM l WHERE rn = 1 OR pt IS DISTINCT FROM "timestamp" OR pv IS DISTINCT FROM value""")
def q_emit_on_change(spark, sf_dir):
    return emit_on_change(fear_greed_polls(spark, sf_dir))


MARKET_DOUBLES = ["current_price", "market_cap", "total_volume", "high_24h", "low_24h",
                  "price_change_24h", "price_change_percentage_24h", "price_change_percentage_1h",
                  "price_change_percentage_7d", "market_cap_change_24h",
                  "market_cap_change_percentage_24h", "circulating_supply", "total_supply", "ath",
                  "ath_change_percentage"]


def _opt(expr: str) -> str:
    return f"CASE WHEN p_size % 2 = 0 THEN {expr} END"


@register("normalize_market_data", doubles=MARKET_DOUBLES, sql=f"""
SELECT p_partkey AS msg_id, 'market_data' AS type, 'coin-' || CAST(p_partkey AS VARCHAR) AS coin_id,
       upper(lower(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g'))) AS symbol, p_name AS name,
       p_retailprice AS current_price, p_retailprice * p_size * 1000 AS market_cap,
       p_size * 1000.0::DOUBLE AS total_volume, p_partkey AS market_cap_rank,
       {_opt('p_retailprice * 1.05::DOUBLE')} AS high_24h,
       {_opt('p_retailprice * 0.95::DOUBLE')} AS low_24h,
       {_opt('p_retailprice * 0.01::DOUBLE')} AS price_change_24h,
       {_opt('1.0::DOUBLE')} AS price_change_percentage_24h,
       {_opt('p_size / 10.0::DOUBLE')} AS price_change_percentage_1h,
       {_opt('p_size / 5.0::DOUBLE')} AS price_change_percentage_7d,
       {_opt('p_retailprice * 10')} AS market_cap_change_24h,
       {_opt('0.5::DOUBLE')} AS market_cap_change_percentage_24h,
       {_opt('p_size * 100.0::DOUBLE')} AS circulating_supply,
       {_opt('p_size * 200.0::DOUBLE')} AS total_supply,
       {_opt('p_retailprice * 2')} AS ath,
       {_opt('-50.0::DOUBLE')} AS ath_change_percentage,
       epoch_ms({AS_OF_TS}) AS "timestamp", '2024-01-31T00:00:00' AS human_time
FROM part""")
def q_normalize_market_data(spark, sf_dir):
    return normalize_market_data(market_snapshots(spark, sf_dir), AS_OF)


@register("trending_top5", sql="""
SELECT poll_key, string_agg(p_name, '|' ORDER BY p_partkey) AS trending
FROM (SELECT p_brand AS poll_key, p_name, p_partkey,
             row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part)
WHERE rn <= 5 GROUP BY 1""")
def q_trending_top5(spark, sf_dir):
    t = trending_top(trending_payloads(spark, sf_dir, 5), 5)
    return t.select("poll_key", F.concat_ws("|", "trending").alias("trending"))


def _articles_out(df):
    return df.select("type", "id", "source", "title", "summary", "link", "author", "created_utc", "timestamp",
                     "human_time", F.concat_ws(",", "tags").alias("tags_text"), "entry_id")


ART_SQL_COLS = 'type, id, source, title, summary, link, author, created_utc, "timestamp", human_time, tags_text, entry_id'


@register("normalize_rss", doubles=["created_utc"], sql=f"""
WITH {RSS}, a AS ({article_cols('rss')}) SELECT {ART_SQL_COLS} FROM a""")
def q_normalize_rss(spark, sf_dir):
    return _articles_out(normalize_rss(rss_entries(spark, sf_dir), AS_OF))


@register("normalize_newsapi", doubles=["created_utc"], sql=f"""
WITH {NEWSAPI}, a AS ({article_cols('newsapi')}) SELECT {ART_SQL_COLS} FROM a""")
def q_normalize_newsapi(spark, sf_dir):
    return _articles_out(normalize_newsapi(newsapi_articles(spark, sf_dir), AS_OF))


@register("article_id", sql="SELECT doc_id, md5(coalesce(text, '')) AS id FROM documents")
def q_article_id(spark, sf_dir):
    from ..sources.fixtures import table
    return table(spark, sf_dir, "documents").select("doc_id", article_id("text").alias("id"))


def _all_articles(spark, sf_dir):
    n = normalize_newsapi(newsapi_articles(spark, sf_dir), AS_OF).withColumn("source_rank", F.lit(0))
    r = normalize_rss(rss_entries(spark, sf_dir), AS_OF).withColumn("source_rank", F.lit(1))
    return news_union(n, r)


@register("news_union", sql=f"""
WITH {RSS}, {NEWSAPI},
u AS ({article_cols('newsapi')} UNION ALL {article_cols('rss')})
SELECT source, count(*) AS n, count(DISTINCT id) AS ids FROM u GROUP BY 1""")
def q_news_union(spark, sf_dir):
    return (_all_articles(spark, sf_dir).groupBy("source")
            .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids")))


@register("dedup_seen_ids", doubles=["created_utc"], sql=f"""
WITH {RSS}, {NEWSAPI},
u AS ({article_cols('newsapi')} UNION ALL {article_cols('rss')}),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY source_rank, entry_id) AS rn FROM u)
SELECT {ART_SQL_COLS} FROM r WHERE rn = 1""")
def q_dedup_seen_ids(spark, sf_dir):
    d = dedup_seen_ids(_all_articles(spark, sf_dir), order=["source_rank", "entry_id"])
    return _articles_out(d)


@register("bounds_lookup", sql=f"""
WITH {BRONZE}, {TEST_BOUNDS_SQL}
SELECT b.kafka_offset, b.symbol, bd.min_price, bd.max_price, bd.min_volume, bd.max_volume
FROM bronze b LEFT JOIN bounds bd ON b.symbol = bd.symbol""")
def q_bounds_lookup(spark, sf_dir):
    j = bounds_lookup(bronze(spark, sf_dir), validation_bounds(spark))
    return j.select("kafka_offset", "symbol", "min_price", "max_price", "min_volume", "max_volume")

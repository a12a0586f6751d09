import datetime as dt
import hashlib
import os

from pyspark.sql import functions as F

from tidemark.operators.maintenance import compact_table, register_layer_views, remove_hidden, scan_path
from tidemark.session import scratch_path
from tidemark.sources.decode import (
    article_id, normalize_market_data, normalize_newsapi, normalize_rss, normalize_sentiment,
    trending_top,
)
from tidemark.streaming.sources import sink_console, to_kafka_records

AS_OF = "2024-01-31 00:00:00"


def test_normalize_sentiment(spark):
    raw = spark.createDataFrame([("25", "Extreme Fear", "1706659200", "3600"), ("60", "Greed", "1706659200", ""),
                                 ("x", "Greed", "1706659200", None)],
                                "value string, value_classification string, timestamp string, time_until_update string")
    out = normalize_sentiment(raw, AS_OF).collect()
    as_of_s = 1706659200
    assert out[0].value == 25 and out[0].next_update == as_of_s + 3600 and out[0].index_human_time == "2024-01-31T00:00:00"
    assert out[1].next_update is None and out[1].time_until_update is None
    assert out[2].value is None
    assert out[0].timestamp == as_of_s * 1000


def test_normalize_articles(spark):
    t = dt.datetime(2024, 1, 2, 3, 4, 5)
    rss = spark.createDataFrame([
        ("Feed", "T", "S", "http://a", None, None, t, [("x",), ("y",)], 1),
        ("Feed", None, None, None, "me", None, None, None, 2)],
        "feed string, title string, summary string, link string, author string, published timestamp_ntz, "
        "updated timestamp_ntz, tags array<struct<term:string>>, entry_id long")
    out = normalize_rss(rss, AS_OF).orderBy("entry_id").collect()
    assert out[0].author == "Unknown" and out[0].human_time == "2024-01-02T03:04:05" and out[0].tags == ["x", "y"]
    assert out[0].id == hashlib.md5(b"http://a").hexdigest()
    assert out[1].id == hashlib.md5(b"").hexdigest() and out[1].human_time == "2024-01-31T00:00:00"
    assert out[1].title == "" and out[1].tags == []
    api = spark.createDataFrame([(None, "T", "D", "u", None, "2024-01-02T03:04:05Z", 1),
                                 (("Src",), "T", "D", "u", "a", "garbage", 2)],
                                "source struct<name:string>, title string, description string, url string, "
                                "author string, publishedAt string, entry_id long")
    out = normalize_newsapi(api, AS_OF).orderBy("entry_id").collect()
    assert out[0].source == "NewsAPI" and out[0].human_time == "2024-01-02T03:04:05"
    assert out[1].source == "Src" and out[1].human_time == "2024-01-31T00:00:00"
    assert out[0].tags == [] and out[0].author == "Unknown"


def test_market_and_trending(spark):
    raw = spark.createDataFrame([(1, '{"id":"bitcoin","symbol":"btc","name":"Bitcoin","current_price":43000.5,'
                                     '"market_cap":8.4e11,"market_cap_rank":1,"total_volume":2.1e10}')],
                                "msg_id long, raw_json string")
    r = normalize_market_data(raw, AS_OF).first()
    assert r.symbol == "BTC" and r.current_price == 43000.5 and r.market_cap_rank == 1
    assert r.high_24h is None and r.ath is None and r.type == "market_data"
    coins = spark.createDataFrame([("k", [((f"c{i}",),) for i in range(8)])],
                                  "poll_key string, coins array<struct<item:struct<name:string>>>")
    assert trending_top(coins, 5).first().trending == ["c0", "c1", "c2", "c3", "c4"]
    assert spark.createDataFrame([(None,)], "l string").select(article_id("l").alias("i")).first().i == \
        hashlib.md5(b"").hexdigest()


def test_compact_and_views(spark):
    src = scratch_path(spark, "t-small")
    df = spark.range(0, 500).select((F.col("id") % 3).cast("string").alias("symbol"), "id")
    df.repartition(20).write.partitionBy("symbol").parquet(src)
    out = compact_table(spark, src)
    assert out.count() == 500 and out.select("_metadata.file_path").distinct().count() == 3
    assert remove_hidden(spark, src) == 60
    names = register_layer_views(spark, {"v_small": src, "v_missing": src + "-nope"})
    assert names == ["v_small"] and spark.table("v_small").count() == 500
    assert scan_path(spark, src).count() == 500


def test_console_sink_and_kafka_records(spark):
    src = scratch_path(spark, "t-console")
    spark.range(3).write.parquet(src)
    q = sink_console(spark.readStream.schema("id long").parquet(src), scratch_path(spark, "t-console-ck"))
    q.awaitTermination()
    rec = to_kafka_records(spark.createDataFrame([("A", 1.0)], "symbol string, price double"), "symbol").first()
    assert rec.key == "A" and rec.value == '{"symbol":"A","price":1.0}'

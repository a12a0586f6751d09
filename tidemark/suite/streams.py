"""Registered streaming queries: file streams replaying data derived from
the driver's tables through the streaming operators (``availableNow``),
each run under a fresh folder of the shared checkpoint directory.

Windowed append output holds back windows the watermark has not passed, so
the oracles keep closed windows only.
"""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..operators.insights import correlation_state, market_sentiment, price_movements, volume_spikes
from ..registry import register
from ..session import hadoop_path, scratch_path
from ..schemas import PRICE_SCHEMA
from ..sources.fixtures import kafka_price_records, market_snapshots, newsapi_articles, rss_entries, sentiment, table, AS_OF
from ..sources.decode import decode_price_json, kafka_envelope, normalize_market_data, route_malformed
from ..streaming.batches import BatchTable
from ..streaming.last_rows import Counts
from ..streaming.medallion import bronze_stream, run_medallion
from ..streaming.seen import SeenIds
from ..streaming.sources import (
    KAFKA_RECORD_SCHEMA, console_rows, read_stream, release, replay_as_files, stage_replay,
)
from ..streaming.stateful import Fanout, SentimentJoin, TailCarry, read_batches, run_tail_carry
from .insights import TEST_MINUTES
from .market import gold_sql
from .reports import INSIGHT_COLUMNS, SENTIMENT_ROWS, insight_rows, insight_rows_sql
from .sqlviews import BRONZE, BRONZE_CUT, SENTIMENT, candles_cte, moves_v2_sql, signals_v2_sql, spikes_sql

PARTS = 4


def _price_topic(spark, sf_dir, cut=False):
    """The price topic replayed as time-ordered JSON record files (``cut``: with broken messages)."""
    path, staged = scratch_path(spark, "topic-prices"), scratch_path(spark, "records")
    rec = kafka_price_records(spark, sf_dir, cut=cut).select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp", "timestampType")
    rec.write.mode("overwrite").parquet(staged)  # derive once, replay from the written copy
    replay_as_files(spark.read.parquet(staged), path, "timestamp", PARTS)
    return path


def _run(df, out, ck, **options):
    """An append-only file sink run over what is there; returns when it is done."""
    w = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).options(**options)
    w.trigger(availableNow=True).start().awaitTermination()


def _stream(spark, path, per_trigger=None, max_bytes=None):
    return read_stream(spark, "json", path=path, schema=KAFKA_RECORD_SCHEMA, max_per_trigger=per_trigger, max_bytes=max_bytes)


def _medallion(spark, sf_dir, layers):
    root = scratch_path(spark, "medallion")
    return run_medallion(spark, _stream(spark, _price_topic(spark, sf_dir)), root, layers=layers)


VALID_BRONZE = BRONZE + """,
vb AS (SELECT * FROM bronze WHERE symbol IS NOT NULL AND event_time IS NOT NULL)"""

CLOSED_SILVER = VALID_BRONZE + ", " + candles_cte(
    "1 minute", "c_all", src="vb") + """,
wm AS (SELECT max(event_time) - INTERVAL 5 MINUTE AS w FROM vb),
silver AS (
    SELECT symbol, window_start, window_end, open, high, low, close, volume, trade_count, vwap,
           price_volatility, (close - open) / NULLIF(open, 0) * 100 AS candle_change_pct
    FROM c_all WHERE window_end <= (SELECT w FROM wm)
)"""

SILVER_DOUBLES = ["open", "high", "low", "close", "volume", "vwap", "price_volatility",
                  "candle_change_pct"]


@register("stream_tumbling_ohlc", doubles=SILVER_DOUBLES, sql=f"WITH {CLOSED_SILVER} SELECT * FROM silver")
def q_stream_tumbling_ohlc(spark, sf_dir):
    p = _medallion(spark, sf_dir, ("bronze", "silver"))
    return spark.read.parquet(p.table("silver")).drop("processed_at")


@register("watermark_silver", sql=f"WITH {CLOSED_SILVER} SELECT symbol, count(*) AS candles FROM silver GROUP BY 1")
def q_watermark_silver(spark, sf_dir):
    p = _medallion(spark, sf_dir, ("bronze", "silver"))
    return spark.read.parquet(p.table("silver")).groupBy("symbol").agg(F.count(F.lit(1)).alias("candles"))


def _closed_gold_sql() -> str:
    """Gold over the closed silver candles, keeping the windows the gold
    watermark (max silver window_end - 10 min) has closed."""
    g = gold_sql("1 minute", 15, 5, prefix=CLOSED_SILVER, candles="silver")
    return (f"SELECT * FROM ({g}) WHERE period_end <= "
            f"(SELECT max(window_end) - INTERVAL 10 MINUTE FROM ({_silver_only()}))")


def _silver_only() -> str:
    return f"WITH {CLOSED_SILVER} SELECT * FROM silver"


GOLD_DOUBLES = ["period_open", "period_high", "period_low", "period_close", "period_volume",
                "period_vwap", "avg_volatility", "price_change_pct", "price_range_pct"]


@register("stream_sliding_analytics", doubles=GOLD_DOUBLES, sql=_closed_gold_sql())
def q_stream_sliding_analytics(spark, sf_dir):
    p = _medallion(spark, sf_dir, ("bronze", "silver", "gold"))
    return spark.read.parquet(p.table("gold")).drop("computed_at")


@register("bronze_stream", doubles=["price", "volume", "price_change_percent", "high_24h", "low_24h"],
          sql=f"WITH {BRONZE} SELECT * FROM bronze")
def q_bronze_stream(spark, sf_dir):
    p = _medallion(spark, sf_dir, ("bronze",))
    return spark.read.parquet(p.table("bronze")).drop("ingested_at")


@register("pipeline_lifecycle", sql=f"""
WITH {CLOSED_SILVER}
SELECT 'bronze' AS layer, (SELECT count(*) FROM bronze) AS records
UNION ALL SELECT 'silver', (SELECT count(*) FROM silver)
UNION ALL SELECT 'gold', (SELECT count(*) FROM ({_closed_gold_sql()}))""")
def q_pipeline_lifecycle(spark, sf_dir):
    p = _medallion(spark, sf_dir, ("bronze", "silver", "gold"))
    parts = [spark.read.parquet(p.table(x)).agg(F.count(F.lit(1)).alias("records"))
             .select(F.lit(x).alias("layer"), "records") for x in ("bronze", "silver", "gold")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _tick_stream(spark, sf_dir):
    """Decoded ticks, one time-ordered file group per micro-batch."""
    ticks = decode_price_json(kafka_envelope(_stream(spark, _price_topic(spark, sf_dir), per_trigger=1)))
    return ticks.withColumn("event_time", F.timestamp_millis("timestamp").cast("timestamp_ntz"))


def _tail_run(spark, sf_dir, op, k, name, required=()):
    """Output of a tail-carry operator over several micro-batches, with their number as ``batch_id``."""
    out, state, ck = (scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-state"),
                      scratch_path(spark, f"{name}-ckpt"))
    run_tail_carry(_tick_stream(spark, sf_dir), TailCarry(op, k, out, state, required=required), ck).awaitTermination()
    return read_batches(spark, out)


def spikes_op(t, carry):
    return volume_spikes(t, carry=carry)


def moves_op(t, carry):
    return price_movements(t, minutes=TEST_MINUTES, carry=carry)


VALID_TICKS_SRC = VALID_BRONZE + """,
vticks AS (SELECT symbol, price, volume, event_time, kafka_offset FROM vb)"""


def _over_valid(sql: str) -> str:
    """The same oracle over the decodable bronze rows (what the stream sees)."""
    from .sqlviews import BASE_TICKS
    head, body = sql.split("WITH " + BASE_TICKS, 1)
    return head + "WITH " + VALID_TICKS_SRC + body.replace("FROM base_ticks", "FROM vticks")


@register("stateful_volume_baseline",
          doubles=["volume", "volume_baseline", "spike_multiplier", "price_at_spike"],
          sql=None)
def q_stateful_volume_baseline(spark, sf_dir):
    return _tail_run(spark, sf_dir, spikes_op, 49, "spikes").drop("batch_id")


@register("stateful_price_window", doubles=["price_change_pct", "avg_price", "volatility"], sql=None)
def q_stateful_price_window(spark, sf_dir):
    return _tail_run(spark, sf_dir, moves_op, 99, "moves", required=["price"]).drop("batch_id")


def _fix_stateful_sql():
    from ..registry import REGISTRY
    REGISTRY["stateful_volume_baseline"].sql = _over_valid(spikes_sql())
    REGISTRY["stateful_price_window"].sql = _over_valid(moves_v2_sql(TEST_MINUTES))


_fix_stateful_sql()


@register("src_kafka_tail", doubles=["price", "price_change_percent"], sql=f"""
WITH {BRONZE} SELECT symbol, price, price_change_percent, event_time FROM bronze""")
def q_src_kafka_tail(spark, sf_dir):
    topic = _price_topic(spark, sf_dir)
    s = bronze_stream(_stream(spark, topic)).select("symbol", "price", "price_change_percent", "event_time")
    out, ck = scratch_path(spark, "tail-out"), scratch_path(spark, "tail-ckpt")
    _run(s, out, ck)
    return spark.read.parquet(out)


@register("src_multi_topic", sql=f"""
WITH {BRONZE}, {SENTIMENT}
SELECT 'crypto-prices' AS topic, symbol_key AS "key", kafka_offset AS "offset" FROM bronze
UNION ALL SELECT 'crypto-fear-greed', classification, msg_id FROM sentiment""")
def q_src_multi_topic(spark, sf_dir):
    path = scratch_path(spark, "topics")
    rec = kafka_price_records(spark, sf_dir).select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp", "timestampType")
    s = sentiment(spark, sf_dir)
    srec = s.select(F.col("classification").alias("key"),
                    F.to_json(F.struct("type", "value", "classification", "timestamp")).alias("value"),
                    F.lit("crypto-fear-greed").alias("topic"), F.lit(0).alias("partition"),
                    F.col("msg_id").alias("offset"), F.col("event_time").cast("timestamp").alias("timestamp"),
                    F.lit(0).alias("timestampType"))
    rec.unionByName(srec).write.mode("overwrite").json(path)
    # one subscription, read once: the sink's folders split it by topic
    out, ck = scratch_path(spark, "topics-out"), scratch_path(spark, "topics-ckpt")
    w = _stream(spark, path).writeStream.format("parquet").partitionBy("topic").option("path", out)
    w.option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select("topic", "key", "offset")


@register("dedup_stream", sql="SELECT DISTINCT md5(coalesce(text, '')) AS id FROM documents")
def q_dedup_stream(spark, sf_dir):
    """Articles in several micro-batches; every id goes out once, however far apart its rows are.

    The topic holds what each source sent, in the order of the articles' times; the stream makes
    articles of it, so that the long texts are moved and written once an article until then."""
    from ..sources.decode import news_union, normalize_newsapi, normalize_rss
    path = scratch_path(spark, "topic-news")
    kinds = {"newsapi": (newsapi_articles, normalize_newsapi), "rss": (rss_entries, normalize_rss)}
    sent = F.struct(*table(spark, sf_dir, "documents").columns).alias("sent")
    topic = news_union(*[
        norm(made(spark, sf_dir, carry=(sent,)), AS_OF, carry=("sent",)).select(F.lit(k).alias("kind"), "created_utc", "sent.*")
        for k, (made, norm) in kinds.items()])
    replay_as_files(topic, path, "created_utc", PARTS, fmt="parquet")
    s = spark.readStream.schema(topic.schema).option("maxFilesPerTrigger", 1).parquet(path)
    arts = news_union(*[norm(made(spark, sf_dir, s.where(F.col("kind") == k)), AS_OF) for k, (made, norm) in kinds.items()])
    out, seen, ck = (scratch_path(spark, f"dedup-{x}") for x in ("out", "seen", "ckpt"))
    handler = SeenIds(spark, out, seen, "id", ["created_utc"])
    run_tail_carry(arts, handler, ck).awaitTermination()
    return read_batches(spark, out).select("id")


@register("checkpoint_recovery", sql=f"WITH {BRONZE} SELECT symbol, kafka_offset, event_time FROM bronze")
def q_checkpoint_recovery(spark, sf_dir):
    """Stop after the first half of the files, restart on the same
    checkpoint with the rest present: every row exactly once."""
    from ..streaming.sources import sink_table_append
    src = scratch_path(spark, "topic-recovery")
    rec = kafka_price_records(spark, sf_dir).select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp", "timestampType")
    out, ck = scratch_path(spark, "recovery-out"), scratch_path(spark, "recovery-ckpt")
    files = stage_replay(rec, src, "timestamp", PARTS)
    release(spark, files[:2], src)
    sink_table_append(bronze_stream(_stream(spark, src)), out, ck).awaitTermination()
    release(spark, files[2:], src)
    sink_table_append(bronze_stream(_stream(spark, src)), out, ck).awaitTermination()
    return spark.read.parquet(out).select("symbol", "kafka_offset", "event_time")


@register("src_kafka_stream", sql=f"""
WITH {BRONZE} SELECT symbol_key, kafka_partition AS "partition", kafka_offset AS "offset" FROM bronze""")
def q_src_kafka_stream(spark, sf_dir):
    s = kafka_envelope(_stream(spark, _price_topic(spark, sf_dir))).select("symbol_key", "partition", "offset")
    out, ck = scratch_path(spark, "env-out"), scratch_path(spark, "env-ckpt")
    _run(s, out, ck)
    return spark.read.parquet(out)


@register("src_table_stream", sql=f"""
WITH {BRONZE} SELECT symbol, count(*) AS n FROM bronze WHERE symbol IS NOT NULL GROUP BY 1""")
def q_src_table_stream(spark, sf_dir):
    from ..streaming.sources import read_table_stream
    p = _medallion(spark, sf_dir, ("bronze",))
    s = read_table_stream(spark, p.table("bronze")).select("symbol")
    out, ck = scratch_path(spark, "tbl-out"), scratch_path(spark, "tbl-ckpt")
    _run(s, out, ck)
    return spark.read.parquet(out).filter(F.col("symbol").isNotNull()).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"))


@register("sink_table_append", doubles=["price", "volume"], sql=f"""
WITH {BRONZE} SELECT symbol, kafka_partition, kafka_offset, event_time, price, volume FROM bronze""")
def q_sink_table_append(spark, sf_dir):
    """Reads the appended table back through its symbol partition folders."""
    p = _medallion(spark, sf_dir, ("bronze",))
    return spark.read.parquet(p.table("bronze")).select("symbol", "kafka_partition", "kafka_offset", "event_time", "price", "volume")


@register("audit_timestamp", sql=f"WITH {BRONZE} SELECT symbol, kafka_offset, TRUE AS stamped_in_this_run FROM bronze")
def q_audit_timestamp(spark, sf_dir):
    """Every row's stamp lies between the start of the stream and now."""
    began = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    p = _medallion(spark, sf_dir, ("bronze",))
    stamp = F.col("ingested_at").cast("timestamp")
    between = (stamp >= F.lit(began).cast("timestamp_ntz").cast("timestamp")) & (stamp <= F.current_timestamp())
    return spark.read.parquet(p.table("bronze")).select("symbol", "kafka_offset", F.coalesce(between, F.lit(False)).alias("stamped_in_this_run"))


@register("watermark_bronze", sql=f"WITH {BRONZE} SELECT symbol, kafka_offset, event_time FROM bronze")
def q_watermark_bronze(spark, sf_dir):
    """Bronze has a watermark but no state: nothing is dropped, however late."""
    p = _medallion(spark, sf_dir, ("bronze",))
    return spark.read.parquet(p.table("bronze")).select("symbol", "kafka_offset", "event_time")


@register("watermark_gold", sql=f"SELECT symbol, count(*) AS n FROM ({_closed_gold_sql()}) GROUP BY 1")
def q_watermark_gold(spark, sf_dir):
    p = _medallion(spark, sf_dir, ("bronze", "silver", "gold"))
    return spark.read.parquet(p.table("gold")).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


@register("sink_kafka_keyed", doubles=["price"], sql=f"""
WITH {BRONZE} SELECT symbol AS "key", symbol, price, "timestamp" FROM bronze WHERE symbol IS NOT NULL""")
def q_sink_kafka_keyed(spark, sf_dir):
    """Records as they would be published (key + JSON value), decoded back."""
    from ..schemas import PRICE_SCHEMA
    from ..streaming.sources import to_kafka_records
    from .layers import bronze
    b = bronze(spark, sf_dir).filter(F.col("symbol").isNotNull()).select(
        *[f.name for f in PRICE_SCHEMA.fields])
    r = to_kafka_records(b, "symbol").withColumn("v", F.from_json("value", PRICE_SCHEMA))
    return r.select("key", "v.symbol", "v.price", "v.timestamp")


def _logged(spark, sf_dir, name, per_trigger=None, then=None):
    """Bronze symbols through a sink that records each batch; the table of its records. Without
    ``per_trigger`` the input is admitted by bytes: what the largest file has."""
    from ..streaming.monitor import batch_table, logged_stream
    topic = _price_topic(spark, sf_dir)
    largest = None
    if not per_trigger:
        fs, folder = hadoop_path(spark, topic)
        largest = max((f.getLen() for f in fs.listStatus(folder)), default=1)
    s = bronze_stream(_stream(spark, topic, per_trigger, largest)).select("symbol", "price", "event_time")
    out, log, ck = (scratch_path(spark, f"{name}-{x}") for x in ("out", "log", "ckpt"))
    logged_stream(s, out, log, ck, then).awaitTermination()
    return batch_table(spark, log)


def _published(df, key):
    """(key, JSON value) as they would be published, the value as an object again."""
    from ..streaming.sources import to_kafka_records
    return to_kafka_records(df, key)


@register("sink_kafka_keyed_sentiment", sql=f"""
WITH {SENTIMENT} SELECT classification AS "key", value, "timestamp" FROM sentiment""")
def q_sink_kafka_keyed_sentiment(spark, sf_dir):
    r = _published(sentiment(spark, sf_dir).select("type", "value", "classification", "timestamp"), "classification")
    v = F.from_json("value", "value long, timestamp long")
    return r.select("key", v["value"].alias("value"), v["timestamp"].alias("timestamp"))


@register("sink_kafka_keyed_market", sql="""
SELECT upper(lower(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g'))) AS "key", 'coin-' || CAST(p_partkey AS VARCHAR) AS coin_id,
       p_name AS name FROM part""")
def q_sink_kafka_keyed_market(spark, sf_dir):
    r = _published(normalize_market_data(market_snapshots(spark, sf_dir), AS_OF), "symbol")
    v = F.from_json("value", "coin_id string, name string")
    return r.select("key", v["coin_id"].alias("coin_id"), v["name"].alias("name"))


@register("sink_kafka_keyed_news", sql="""
SELECT source AS "key", md5(coalesce(text, '')) AS id, coalesce(text, '') AS summary FROM documents""")
def q_sink_kafka_keyed_news(spark, sf_dir):
    from ..sources.decode import normalize_rss
    r = _published(normalize_rss(rss_entries(spark, sf_dir), AS_OF), "source")
    v = F.from_json("value", "id string, summary string")
    return r.select("key", v["id"].alias("id"), v["summary"].alias("summary"))


@register("quarantine_stream", sql=f"""
WITH {BRONZE_CUT}
SELECT kafka_offset AS "offset", CASE WHEN symbol IS NULL THEN 'quarantine' ELSE 'good' END AS route, symbol,
       symbol IS NULL AS has_raw_text FROM bronze""")
def q_quarantine_stream(spark, sf_dir):
    """Broken messages of the stream go to the quarantine folder of the sink with their text, the others to good."""
    s = _stream(spark, _price_topic(spark, sf_dir, cut=True), per_trigger=1).select("offset", F.col("value").alias("raw_json"))
    out, ck = scratch_path(spark, "routes-out"), scratch_path(spark, "routes-ckpt")
    w = route_malformed(s, "raw_json", PRICE_SCHEMA).writeStream.format("parquet").partitionBy("route").option("path", out)
    w.option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select("offset", "route", "symbol", F.col("raw_text").isNotNull().alias("has_raw_text"))


@register("rate_limit_input", sql=f"WITH {BRONZE} SELECT count(*) AS rows_in, TRUE AS several_batches FROM bronze")
def q_rate_limit_input(spark, sf_dir):
    log = _logged(spark, sf_dir, "rate-limit").filter(F.col("num_input_rows") > 0)
    return log.agg(F.sum("num_input_rows").alias("rows_in"), (F.count(F.lit(1)) >= PARTS).alias("several_batches"))


@register("progress_stats", sql=f"WITH {BRONZE} SELECT count(*) AS rows_in FROM bronze")
def q_progress_stats(spark, sf_dir):
    return _logged(spark, sf_dir, "progress", 2).agg(F.sum("num_input_rows").alias("rows_in"))


@register("stateful_sentiment_join", doubles=["btc_price_change", "eth_price_change"], sql=None)
def q_stateful_sentiment_join(spark, sf_dir):
    """Price stream (carried tail) appends per-tick window states; the
    sentiment stream then as-of joins each micro-batch to them."""
    return read_batches(spark, _correlate(spark, sf_dir, [], [])).drop("batch_id")


def _correlate(spark, sf_dir, price_handlers, sentiment_handlers, stamp=False):
    """Runs the price stream (states and ``price_handlers``), then the
    sentiment stream (the join and ``sentiment_handlers``); the join's output folder."""
    states, tails, days, out = (scratch_path(spark, f"sj-{x}") for x in ("states", "tail", "days", "out"))
    op = lambda t, carry: correlation_state(t, TEST_MINUTES, carry=carry)
    carry = TailCarry(op, 9, states, tails, summary_path=days, required=["price"], by_day=True)
    run_tail_carry(_tick_stream(spark, sf_dir), Fanout(carry, *price_handlers), scratch_path(spark, "sj-ckpt")).awaitTermination()
    topic = scratch_path(spark, "topic-sentiment")
    readings = sentiment(spark, sf_dir)
    replay_as_files(readings, topic, "event_time", PARTS, fmt="parquet")
    s = spark.readStream.schema(readings.schema).option("maxFilesPerTrigger", 1).parquet(topic)
    join = Fanout(SentimentJoin(states, days, out, stamp=stamp), *sentiment_handlers)
    (s.writeStream.foreachBatch(join).option("checkpointLocation", scratch_path(spark, "sj-sckpt"))
      .trigger(availableNow=True).start().awaitTermination())
    return out


def _fix_sentiment_sql():
    from ..registry import REGISTRY
    sql = signals_v2_sql(TEST_MINUTES)
    # state over the decodable ticks only, as the stream sees them
    sql = sql.replace("FROM base_ticks WHERE symbol IN", "FROM vticks WHERE symbol IN", 1)
    from .sqlviews import BASE_TICKS
    head, body = sql.split(BASE_TICKS, 1)
    REGISTRY["stateful_sentiment_join"].sql = head + VALID_TICKS_SRC + body


_fix_sentiment_sql()


@register("emit_on_change_stream", sql=None)
def q_emit_on_change_stream(spark, sf_dir):
    """Index polls as a stream: a poll is forwarded only when (index time,
    value) differs from the previous poll, the previous one carried across
    micro-batches as a one-row tail."""
    from ..sources.decode import emit_on_change
    from ..sources.fixtures import fear_greed_polls
    polls = fear_greed_polls(spark, sf_dir).withColumn("_series", F.lit(0))
    src = scratch_path(spark, "topic-polls")
    replay_as_files(polls, src, "poll_time", PARTS, fmt="parquet")
    s = spark.readStream.schema(polls.schema).option("recursiveFileLookup", "true") \
        .option("maxFilesPerTrigger", 1).parquet(src)
    out, st, ck = (scratch_path(spark, "eoc-out"), scratch_path(spark, "eoc-state"),
                   scratch_path(spark, "eoc-ckpt"))
    handler = TailCarry(lambda t, carry: emit_on_change(t), 1, out, st, columns=polls.columns,
                        key="_series", order=("poll_time", "poll_id"))
    run_tail_carry(s, handler, ck).awaitTermination()
    return read_batches(spark, out).drop("batch_id")


def _fix_emit_sql():
    from ..registry import REGISTRY
    from . import wire  # noqa: F401  (registers the batch twin)
    REGISTRY["emit_on_change_stream"].sql = REGISTRY["emit_on_change"].sql


_fix_emit_sql()


@register("sink_console", sql=f"WITH {BRONZE} SELECT count(*) AS rows_in FROM bronze")
def q_sink_console(spark, sf_dir):
    """Decoded rows to the console (untruncated, the first rows of each batch);
    the answer is the number of rows the sink was given."""
    return _logged(spark, sf_dir, "console", 1, then=console_rows(5)).agg(F.sum("num_input_rows").alias("rows_in"))


STREAMED_ROWS = insight_rows_sql({
    "price_movements": _over_valid(moves_v2_sql(TEST_MINUTES)), "volume_spikes": _over_valid(spikes_sql()),
    "market_sentiment": SENTIMENT_ROWS, "sentiment_price_correlation": signals_v2_sql(TEST_MINUTES)}, True)


@register("sink_insight_tables", doubles=["value"], sql=STREAMED_ROWS)
def q_sink_insight_tables(spark, sf_dir):
    """All four insight tables as the streams append them, batch by batch, each row stamped."""
    paths = {name: scratch_path(spark, f"insight-{name}") for name in INSIGHT_COLUMNS}
    stamped = lambda op: lambda t, carry: op(t, carry).withColumn("created_at", F.current_timestamp())
    moves = TailCarry(stamped(moves_op), 99, paths["price_movements"], scratch_path(spark, "mv-tail"), required=["price"])
    spikes = TailCarry(stamped(spikes_op), 49, paths["volume_spikes"], scratch_path(spark, "sp-tail"))

    def readings(batch, batch_id):
        rows = market_sentiment(batch).withColumn("created_at", F.current_timestamp())
        BatchTable(spark, paths["market_sentiment"]).write(rows, batch_id)

    paths["sentiment_price_correlation"] = _correlate(spark, sf_dir, [moves, spikes], [readings], stamp=True)
    return insight_rows({name: read_batches(spark, p) for name, p in paths.items()})


@register("insight_counts_stream", sql=f"""
WITH {BRONZE}, rows_of AS (
  SELECT 'messages' AS kind, CASE WHEN symbol IS NULL THEN 'quarantine' ELSE symbol END AS key FROM bronze)
SELECT kind, key, count(*) AS n FROM rows_of GROUP BY 1, 2
UNION ALL SELECT 'price_movements', symbol, count(*) FROM ({_over_valid(moves_v2_sql(TEST_MINUTES))}) GROUP BY 1, 2
UNION ALL SELECT 'volume_spikes', symbol, count(*) FROM ({_over_valid(spikes_sql())}) GROUP BY 1, 2""")
def q_insight_counts_stream(spark, sf_dir):
    """Messages, movements and spikes per symbol, added up batch by batch while the price stream runs; the
    answer reads only the counts."""
    tables = {name: Counts(spark, scratch_path(spark, f"counts-{name}"), ["key"]) for name in ("messages", "price_movements", "volume_spikes")}
    op = {"price_movements": (moves_op, 99, ["price"]), "volume_spikes": (spikes_op, 49, [])}
    handlers = [lambda batch, n: tables["messages"](batch.select(F.coalesce("symbol", F.lit("quarantine")).alias("key")), n)]
    for name, (f, rows, required) in op.items():
        tail = TailCarry(f, rows, scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-tail"), required=required)
        handlers += [tail, lambda batch, n, name=name, tail=tail: tables[name](
            BatchTable(batch.sparkSession, tail.out).read().where(F.col("batch_id") == n).select(F.col("symbol").alias("key")), n)]
    run_tail_carry(_tick_stream(spark, sf_dir), Fanout(*handlers), scratch_path(spark, "counts-ckpt")).awaitTermination()
    out = None
    for name, t in tables.items():
        one = t.totals().select(F.lit(name).alias("kind"), "key", "n")
        out = one if out is None else out.unionByName(one)
    return out

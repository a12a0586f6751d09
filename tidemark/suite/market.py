"""Registered candle / analytics queries (silver and gold layers)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.candles import candle_states, candles_of, market_analytics, merge_candles, ohlc_candles, ohlc_resample
from ..registry import register
from ..session import written
from ..sources.fixtures import base_ticks, ticks
from .sqlviews import BASE_TICKS, CANDLE_COLS, TICKS, candles_cte

CANDLE_DOUBLES = ["open", "high", "low", "close", "volume", "vwap", "price_volatility",
                  "candle_change_pct"]


def silver(spark, sf_dir, interval="1 minute"):
    return ohlc_candles(base_ticks(spark, sf_dir), interval)


@register("ohlc_1min", headline=True, doubles=CANDLE_DOUBLES, sql=f"""
WITH {BASE_TICKS}, {candles_cte('1 minute')}
SELECT {CANDLE_COLS} FROM candles""")
def q_ohlc_1min(spark, sf_dir):
    return silver(spark, sf_dir, "1 minute")


@register("ohlc_1hour", doubles=CANDLE_DOUBLES, sql=f"""
WITH {BASE_TICKS}, {candles_cte('1 hour')}
SELECT {CANDLE_COLS} FROM candles""")
def q_ohlc_1hour(spark, sf_dir):
    return silver(spark, sf_dir, "1 hour")


for _name, _interval in (("ohlc_5min", "5 minutes"), ("ohlc_15min", "15 minutes")):
    register(_name, doubles=CANDLE_DOUBLES, sql=f"""
WITH {BASE_TICKS}, {candles_cte(_interval)}
SELECT {CANDLE_COLS} FROM candles""")(lambda spark, sf_dir, i=_interval: silver(spark, sf_dir, i))


@register("vwap", doubles=["vwap", "total_volume"], sql=f"""
WITH {BASE_TICKS}
SELECT symbol, time_bucket(INTERVAL '1 day', event_time) AS day,
       sum(price * volume) / NULLIF(sum(volume), 0) AS vwap, sum(volume) AS total_volume
FROM base_ticks GROUP BY 1, 2""")
def q_vwap(spark, sf_dir):
    c = ohlc_candles(base_ticks(spark, sf_dir), "1 day")
    return c.select("symbol", F.col("window_start").alias("day"), "vwap",
                    F.col("volume").alias("total_volume"))


@register("price_volatility", doubles=["price_volatility"], sql=f"""
WITH {BASE_TICKS}
SELECT symbol, time_bucket(INTERVAL '1 hour', event_time) AS window_start,
       stddev_samp(price) AS price_volatility, count(*) AS trade_count
FROM base_ticks GROUP BY 1, 2""")
def q_price_volatility(spark, sf_dir):
    return silver(spark, sf_dir, "1 hour").select("symbol", "window_start", "price_volatility",
                                                  "trade_count")


@register("candle_change_pct", doubles=["candle_change_pct"], sql=f"""
WITH {BASE_TICKS}, {candles_cte('1 minute')}
SELECT symbol, window_start, (close - open) / NULLIF(open, 0) * 100 AS candle_change_pct
FROM candles""")
def q_candle_change_pct(spark, sf_dir):
    return silver(spark, sf_dir).select("symbol", "window_start", "candle_change_pct")


RESAMPLE_DOUBLES = ["open", "high", "low", "close", "volume", "vwap"]


def _resample_sql(interval: str, label: str) -> str:
    return f"""
WITH {BASE_TICKS}, {candles_cte('1 minute', 'm1')}
SELECT symbol,
       time_bucket(INTERVAL '{interval}', window_start) AS window_start,
       time_bucket(INTERVAL '{interval}', window_start) + INTERVAL '{interval}' AS window_end,
       arg_min(open, window_start) AS open, max(high) AS high, min(low) AS low,
       arg_max(close, window_start) AS close, sum(volume) AS volume,
       CAST(sum(trade_count) AS BIGINT) AS trade_count,
       sum(vwap * volume) / NULLIF(sum(volume), 0) AS vwap,
       count(*) AS candle_count, '{label}' AS "interval"
FROM m1 GROUP BY 1, 2"""


@register("ohlc_resample", doubles=RESAMPLE_DOUBLES, sql=_resample_sql("1 hour", "1 hour"))
def q_ohlc_resample(spark, sf_dir):
    return ohlc_resample(silver(spark, sf_dir), "1 hour")


@register("ohlc_resample_1d", doubles=RESAMPLE_DOUBLES, sql=_resample_sql("1 day", "1 day"))
def q_ohlc_resample_1d(spark, sf_dir):
    return ohlc_resample(silver(spark, sf_dir), "1 day")


ROLLUP = {"5 minutes": "1 minute", "15 minutes": "5 minutes", "1 hour": "15 minutes", "1 day": "1 hour"}


@register("ohlc_rollup", doubles=CANDLE_DOUBLES, sql=f"WITH {BASE_TICKS}, " + ", ".join(
    candles_cte(i, f"c{k}") for k, i in enumerate(ROLLUP)) + " " + " UNION ALL ".join(
    f"SELECT '{i}' AS \"interval\", {CANDLE_COLS} FROM c{k}" for k, i in enumerate(ROLLUP)))
def q_ohlc_rollup(spark, sf_dir):
    """1m -> 5m -> 15m -> 1h -> 1d by mergeable states: each as if built from the ticks, volatility included."""
    states = written(candle_states(base_ticks(spark, sf_dir), "1 minute"), "candle-states")
    out = None
    for interval in ROLLUP:
        states = merge_candles(states, interval)
        one = candles_of(states).select(F.lit(interval).alias("interval"), "*")
        out = one if out is None else out.unionByName(one)
    return out


GOLD_DOUBLES = ["period_open", "period_high", "period_low", "period_close", "period_volume",
                "period_vwap", "avg_volatility", "price_change_pct", "price_range_pct"]


def gold_sql(candle_interval: str, window_min: int, slide_min: int, prefix: str | None = None,
             candles: str = "candles") -> str:
    """Sliding windows on window_end: each candle goes to the windows
    [s, s+window) with s a multiple of the slide and s <= end < s+window.
    ``prefix`` replaces the CTEs that define the ``candles`` relation."""
    head = prefix or f"{BASE_TICKS}, {candles_cte(candle_interval)}"
    return f"""
WITH {head},
assigned AS (
    SELECT c.*, time_bucket(INTERVAL '{slide_min} minutes', window_end)
                - INTERVAL (k * {slide_min}) MINUTE AS period_start
    FROM {candles} c, range(0, {window_min // slide_min}) AS r(k)
),
g AS (
    SELECT symbol, period_start, period_start + INTERVAL '{window_min} minutes' AS period_end,
           arg_min(open, window_start) AS period_open, max(high) AS period_high,
           min(low) AS period_low, arg_max(close, window_start) AS period_close,
           sum(volume) AS period_volume, avg(vwap) AS period_vwap,
           avg(price_volatility) AS avg_volatility,
           CAST(sum(trade_count) AS BIGINT) AS total_trades
    FROM assigned GROUP BY 1, 2
)
SELECT *, (period_close - period_open) / NULLIF(period_open, 0) * 100 AS price_change_pct,
       (period_high - period_low) / NULLIF(period_low, 0) * 100 AS price_range_pct,
       CASE WHEN (period_close - period_open) / NULLIF(period_open, 0) * 100 > 2.0 THEN 'STRONG_BULLISH'
            WHEN (period_close - period_open) / NULLIF(period_open, 0) * 100 > 0.5 THEN 'BULLISH'
            WHEN (period_close - period_open) / NULLIF(period_open, 0) * 100 < -2.0 THEN 'STRONG_BEARISH'
            WHEN (period_close - period_open) / NULLIF(period_open, 0) * 100 < -0.5 THEN 'BEARISH'
            ELSE 'NEUTRAL' END AS signal,
       CASE WHEN period_volume > 1000000 THEN 'HIGH_VOLUME' ELSE 'NORMAL_VOLUME' END AS volume_signal
FROM g"""


@register("market_analytics_15m", headline=True, doubles=GOLD_DOUBLES,
          sql=gold_sql("1 minute", 15, 5))
def q_market_analytics_15m(spark, sf_dir):
    return market_analytics(silver(spark, sf_dir), "15 minutes", "5 minutes")


@register("market_analytics_12h", doubles=GOLD_DOUBLES, sql=gold_sql("1 hour", 720, 240))
def q_market_analytics_12h(spark, sf_dir):
    return market_analytics(silver(spark, sf_dir, "1 hour"), "12 hours", "4 hours")


@register("period_change_range_pct", doubles=["price_change_pct", "price_range_pct"],
          sql=f"SELECT symbol, period_start, price_change_pct, price_range_pct FROM ({gold_sql('1 hour', 720, 240)})")
def q_period_change_range(spark, sf_dir):
    return q_market_analytics_12h(spark, sf_dir).select(
        "symbol", "period_start", "price_change_pct", "price_range_pct")


@register("trend_signal", sql=f"""
SELECT signal, count(*) AS n FROM ({gold_sql('1 minute', 15, 5)}) GROUP BY 1""")
def q_trend_signal(spark, sf_dir):
    return q_market_analytics_15m(spark, sf_dir).groupBy("signal").agg(F.count(F.lit(1)).alias("n"))


@register("volume_signal", sql=f"""
SELECT volume_signal, count(*) AS n, CAST(sum(total_trades) AS BIGINT) AS trades
FROM ({gold_sql('1 hour', 720, 240)}) GROUP BY 1""")
def q_volume_signal(spark, sf_dir):
    return (q_market_analytics_12h(spark, sf_dir).groupBy("volume_signal")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("total_trades").alias("trades")))


@register("ticks_rolling_24h", doubles=["high_24h", "low_24h", "price_change_percent"], sql=f"""
WITH {TICKS}
SELECT symbol, event_time, kafka_offset, high_24h, low_24h, price_change_percent FROM ticks""")
def q_ticks_rolling(spark, sf_dir):
    return ticks(spark, sf_dir).select("symbol", "event_time", "kafka_offset", "high_24h",
                                       "low_24h", "price_change_percent")

"""Registered staging and mart queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import (
    body_size, candle_type, flag_anomaly, flag_ohlc_integrity, lower_wick, position_in_range,
    safe_ratio, surrogate_key, upper_wick,
)
from ..operators.candles import ohlc_candles
from ..operators.warehouse import (
    agg_hourly_stats, dim_symbols, fact_trades, filter_not_flagged, stg_crypto_prices,
    stg_ohlc_candles,
)
from ..registry import register
from ..sources.fixtures import base_ticks, ticks
from .sqlviews import DIM, FACT, HOURLY, STG_PRICES, stg_candles_cte


def stg_prices(spark, sf_dir):
    return stg_crypto_prices(ticks(spark, sf_dir))


def stg_candles(spark, sf_dir, interval="1 minute"):
    return stg_ohlc_candles(ohlc_candles(base_ticks(spark, sf_dir), interval))


STG_DOUBLES = ["price", "volume", "price_change_percent", "high_24h", "low_24h"]


@register("stg_crypto_prices", doubles=STG_DOUBLES, sql=f"WITH {STG_PRICES} SELECT * FROM stg")
def q_stg_crypto_prices(spark, sf_dir):
    return stg_prices(spark, sf_dir)


@register("stg_not_null_filter", sql=f"""
WITH {STG_PRICES} SELECT symbol, count(*) AS n FROM stg GROUP BY 1""")
def q_stg_not_null(spark, sf_dir):
    return stg_prices(spark, sf_dir).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


@register("flag_anomaly", sql=f"""
WITH {STG_PRICES}
SELECT symbol, is_anomaly, count(*) AS n FROM stg GROUP BY 1, 2""")
def q_flag_anomaly(spark, sf_dir):
    t = ticks(spark, sf_dir)
    return (t.select("symbol", flag_anomaly().alias("is_anomaly"))
             .groupBy("symbol", "is_anomaly").agg(F.count(F.lit(1)).alias("n")))


@register("trunc_hour_day", sql=f"""
WITH {STG_PRICES}
SELECT event_hour, event_date, count(*) AS n FROM stg GROUP BY 1, 2""")
def q_trunc_hour_day(spark, sf_dir):
    return stg_prices(spark, sf_dir).groupBy("event_hour", "event_date").agg(
        F.count(F.lit(1)).alias("n"))


STGC_DOUBLES = ["open", "high", "low", "close", "volume", "vwap", "price_volatility",
                "candle_change_pct", "body_size", "upper_wick", "lower_wick"]


@register("stg_ohlc_candles", doubles=STGC_DOUBLES,
          sql=f"WITH {stg_candles_cte()} SELECT * FROM stg_c")
def q_stg_ohlc_candles(spark, sf_dir):
    return stg_candles(spark, sf_dir)


@register("flag_ohlc_integrity", sql=f"""
WITH {stg_candles_cte('1 hour')}
SELECT has_integrity_issue, count(*) AS n FROM stg_c GROUP BY 1""")
def q_flag_ohlc_integrity(spark, sf_dir):
    c = ohlc_candles(base_ticks(spark, sf_dir), "1 hour")
    return (c.select(flag_ohlc_integrity().alias("has_integrity_issue"))
             .groupBy("has_integrity_issue").agg(F.count(F.lit(1)).alias("n")))


@register("candle_type", sql=f"""
WITH {stg_candles_cte('1 hour')}
SELECT symbol, candle_type, count(*) AS n FROM stg_c GROUP BY 1, 2""")
def q_candle_type(spark, sf_dir):
    c = ohlc_candles(base_ticks(spark, sf_dir), "1 hour")
    return (c.select("symbol", candle_type().alias("candle_type"))
             .groupBy("symbol", "candle_type").agg(F.count(F.lit(1)).alias("n")))


@register("candle_body_wicks", doubles=["body_size", "upper_wick", "lower_wick"], sql=f"""
WITH {stg_candles_cte('1 hour')}
SELECT symbol, window_start, body_size, upper_wick, lower_wick FROM stg_c""")
def q_candle_body_wicks(spark, sf_dir):
    c = ohlc_candles(base_ticks(spark, sf_dir), "1 hour")
    return c.select("symbol", "window_start", body_size().alias("body_size"),
                    upper_wick().alias("upper_wick"), lower_wick().alias("lower_wick"))


@register("filter_not_flagged", sql=f"""
WITH {STG_PRICES} SELECT symbol, count(*) AS n FROM stg WHERE NOT is_anomaly GROUP BY 1""")
def q_filter_not_flagged(spark, sf_dir):
    return (filter_not_flagged(stg_prices(spark, sf_dir), "is_anomaly")
            .groupBy("symbol").agg(F.count(F.lit(1)).alias("n")))


FACT_DOUBLES = ["price", "prev_price", "price_change", "price_change_pct", "volume",
                "prev_volume", "volume_change", "high_24h", "low_24h", "change_24h_pct",
                "position_in_range_pct"]


@register("fact_trades", headline=True, doubles=FACT_DOUBLES, sql=f"WITH {FACT} SELECT * FROM fact")
def q_fact_trades(spark, sf_dir):
    return fact_trades(stg_prices(spark, sf_dir))


@register("lag_price_volume", doubles=["price", "prev_price", "volume", "prev_volume"], sql=f"""
WITH {FACT} SELECT symbol, event_time, kafka_offset, price, prev_price, volume, prev_volume
FROM fact""")
def q_lag_price_volume(spark, sf_dir):
    return fact_trades(stg_prices(spark, sf_dir)).select(
        "symbol", "event_time", "kafka_offset", "price", "prev_price", "volume", "prev_volume")


@register("price_volume_delta", doubles=["price_change", "price_change_pct", "volume_change"],
          sql=f"""WITH {FACT} SELECT trade_id, price_change, price_change_pct, volume_change FROM fact""")
def q_price_volume_delta(spark, sf_dir):
    return fact_trades(stg_prices(spark, sf_dir)).select(
        "trade_id", "price_change", "price_change_pct", "volume_change")


@register("position_in_range", doubles=["position_in_range_pct"], sql=f"""
WITH {STG_PRICES}
SELECT symbol, kafka_offset,
       CASE WHEN high_24h > low_24h THEN (price - low_24h) / (high_24h - low_24h) * 100
            ELSE 50.0 END AS position_in_range_pct
FROM stg""")
def q_position_in_range(spark, sf_dir):
    return stg_prices(spark, sf_dir).select("symbol", "kafka_offset",
                                            position_in_range().alias("position_in_range_pct"))


@register("surrogate_key", sql=f"""
WITH {STG_PRICES}
SELECT kafka_offset,
       md5(concat_ws('-', coalesce(CAST(symbol AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
                          coalesce(CAST(event_time AS VARCHAR), '_dbt_utils_surrogate_key_null_')))
         AS trade_id
FROM stg""")
def q_surrogate_key(spark, sf_dir):
    return stg_prices(spark, sf_dir).select("kafka_offset",
                                            surrogate_key("symbol", "event_time").alias("trade_id"))


@register("dim_symbols", sql=f"WITH {DIM} SELECT * FROM dim")
def q_dim_symbols(spark, sf_dir):
    return dim_symbols(stg_prices(spark, sf_dir))


@register("distinct_symbols", sql=f"WITH {STG_PRICES} SELECT DISTINCT symbol FROM stg")
def q_distinct_symbols(spark, sf_dir):
    return stg_prices(spark, sf_dir).select("symbol").distinct()


for _name, _col in (("split_symbol", "base_currency, quote_currency"),
                    ("currency_name", "currency_name"), ("market_tier", "market_tier")):
    def _mk(cols):
        def fn(spark, sf_dir):
            return dim_symbols(stg_prices(spark, sf_dir)).select(
                "symbol", *[c.strip() for c in cols.split(",")])
        return fn
    register(_name, sql=f"WITH {DIM} SELECT symbol, {_col} FROM dim")(_mk(_col))


HOURLY_DOUBLES = ["hour_open", "hour_high", "hour_low", "hour_close", "hour_change_pct",
                  "total_volume", "avg_vwap", "avg_volatility", "bullish_ratio"]


@register("agg_hourly_stats", headline=True, doubles=HOURLY_DOUBLES,
          sql=f"WITH {HOURLY} SELECT * FROM hourly_stats")
def q_agg_hourly_stats(spark, sf_dir):
    return agg_hourly_stats(stg_candles(spark, sf_dir))


@register("conditional_counts", sql=f"""
WITH {HOURLY} SELECT symbol, hour_start, bullish_candles, bearish_candles, doji_candles
FROM hourly_stats""")
def q_conditional_counts(spark, sf_dir):
    return agg_hourly_stats(stg_candles(spark, sf_dir)).select(
        "symbol", "hour_start", "bullish_candles", "bearish_candles", "doji_candles")


@register("hour_sentiment", sql=f"""
WITH {HOURLY} SELECT hour_sentiment, count(*) AS n FROM hourly_stats GROUP BY 1""")
def q_hour_sentiment(spark, sf_dir):
    return agg_hourly_stats(stg_candles(spark, sf_dir)).groupBy("hour_sentiment").agg(
        F.count(F.lit(1)).alias("n"))


@register("first_value_hour", doubles=["hour_open"], sql=f"""
WITH {HOURLY} SELECT symbol, hour_start, hour_open FROM hourly_stats""")
def q_first_value_hour(spark, sf_dir):
    return agg_hourly_stats(stg_candles(spark, sf_dir)).select("symbol", "hour_start", "hour_open")


@register("last_value_hour", doubles=["hour_close"], sql=f"""
WITH {HOURLY} SELECT symbol, hour_start, hour_close FROM hourly_stats""")
def q_last_value_hour(spark, sf_dir):
    return agg_hourly_stats(stg_candles(spark, sf_dir)).select("symbol", "hour_start", "hour_close")


@register("safe_ratio", doubles=["bullish_ratio", "hour_change_pct"], sql=f"""
WITH {HOURLY} SELECT symbol, hour_start, bullish_ratio, hour_change_pct FROM hourly_stats""")
def q_safe_ratio(spark, sf_dir):
    h = agg_hourly_stats(stg_candles(spark, sf_dir))
    return h.select("symbol", "hour_start",
                    safe_ratio(F.col("bullish_candles").cast("double"), F.col("candle_count"))
                    .alias("bullish_ratio"), "hour_change_pct")


@register("distinct_rows", sql=f"""
WITH {HOURLY} SELECT DISTINCT symbol, event_date, hour_sentiment FROM hourly_stats""")
def q_distinct_rows(spark, sf_dir):
    return agg_hourly_stats(stg_candles(spark, sf_dir)).select(
        "symbol", "event_date", "hour_sentiment").distinct()

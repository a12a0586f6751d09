"""Registered insight queries: spikes, movements, sentiment correlation.

Test-data parameters (FIXTURES.md §5): the data holds about one tick per
symbol per 15 minutes, so besides the reference defaults the movement and
correlation windows are also run at 120 minutes, and the simple spike rule at
a volume threshold of 90 (volumes are 0..99).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import direction_label, significant_move
from ..operators.insights import (
    asof_sentiment_prices, market_sentiment, pair_change, price_movements,
    price_movements_simple, sentiment_signals, sentiment_signals_simple, volume_spikes,
    volume_spikes_simple,
)
from ..registry import register
from ..sources.fixtures import base_ticks, sentiment, ticks
from .sqlviews import (
    BASE_TICKS, SENTIMENT, TICKS, asof_sql, moves_v1_sql, moves_v2_sql, signals_v1_sql, signals_v2_sql,
    spikes_sql,
)

TEST_MINUTES = 120
TEST_SPIKE_VOLUME = 90

SPIKE_DOUBLES = ["volume", "volume_baseline", "spike_multiplier", "price_at_spike"]
MOVE_DOUBLES = ["price_change_pct", "avg_price", "volatility"]


@register("volume_spikes_v2", headline=True, doubles=SPIKE_DOUBLES, sql=spikes_sql())
def q_volume_spikes_v2(spark, sf_dir):
    return volume_spikes(base_ticks(spark, sf_dir))


@register("volume_spikes_v1", doubles=["volume", "price_at_spike"], sql=f"""
WITH {BASE_TICKS}
SELECT event_time AS spike_time, symbol, volume, price AS price_at_spike
FROM base_ticks WHERE volume > {TEST_SPIKE_VOLUME}""")
def q_volume_spikes_v1(spark, sf_dir):
    return volume_spikes_simple(base_ticks(spark, sf_dir), TEST_SPIKE_VOLUME)


@register("price_movements_v2", headline=True, doubles=MOVE_DOUBLES, sql=moves_v2_sql())
def q_price_movements_v2(spark, sf_dir):
    return price_movements(base_ticks(spark, sf_dir))


@register("price_movements_v2_120m", doubles=MOVE_DOUBLES, sql=moves_v2_sql(TEST_MINUTES))
def q_price_movements_v2_120(spark, sf_dir):
    return price_movements(base_ticks(spark, sf_dir), minutes=TEST_MINUTES)


@register("price_movements_v1", doubles=["price_change_pct", "avg_price"],
          sql=moves_v1_sql(TEST_MINUTES))
def q_price_movements_v1(spark, sf_dir):
    return price_movements_simple(base_ticks(spark, sf_dir), minutes=TEST_MINUTES)


@register("significant_moves", doubles=MOVE_DOUBLES, sql=f"""
SELECT * FROM ({moves_v2_sql(TEST_MINUTES)}) WHERE abs(price_change_pct) > 0.5""")
def q_significant_moves(spark, sf_dir):
    m = price_movements(base_ticks(spark, sf_dir), minutes=TEST_MINUTES)
    return m.filter(significant_move())


@register("direction_label", sql=f"""
SELECT symbol, CASE WHEN price_change_pct > 0 THEN 'UP' ELSE 'DOWN' END AS direction,
       count(*) AS n
FROM ({moves_v2_sql()}) GROUP BY 1, 2""")
def q_direction_label(spark, sf_dir):
    m = price_movements(base_ticks(spark, sf_dir))
    return (m.select("symbol", direction_label("price_change_pct", flat=False).alias("direction"))
             .groupBy("symbol", "direction").agg(F.count(F.lit(1)).alias("n")))


@register("sink_sentiment", sql=f"""
WITH {SENTIMENT}
SELECT epoch_ms("timestamp") AS recorded_time, CAST(value AS INTEGER) AS fear_greed_index,
       classification AS fear_greed_class
FROM sentiment""")
def q_sink_sentiment(spark, sf_dir):
    return market_sentiment(sentiment(spark, sf_dir))


@register("asof_sentiment_prices", doubles=["change"], sql=f"""
WITH {asof_sql(TEST_MINUTES)}
SELECT * FROM asofj""")
def q_asof(spark, sf_dir):
    return asof_sentiment_prices(sentiment(spark, sf_dir), base_ticks(spark, sf_dir), TEST_MINUTES)


@register("pair_change", doubles=["btc_price_change", "eth_price_change"], sql=f"""
WITH {asof_sql(TEST_MINUTES)}
SELECT * FROM pairs""")
def q_pair_change(spark, sf_dir):
    return pair_change(asof_sentiment_prices(sentiment(spark, sf_dir), base_ticks(spark, sf_dir),
                                             TEST_MINUTES))


@register("sentiment_signal_v2", headline=True, doubles=["btc_price_change", "eth_price_change"],
          sql=signals_v2_sql(TEST_MINUTES))
def q_signal_v2(spark, sf_dir):
    return sentiment_signals(sentiment(spark, sf_dir), base_ticks(spark, sf_dir), TEST_MINUTES)


@register("sentiment_signal_v1", doubles=["btc_price_change", "eth_price_change"],
          sql=signals_v1_sql(TEST_MINUTES))
def q_signal_v1(spark, sf_dir):
    return sentiment_signals_simple(sentiment(spark, sf_dir), base_ticks(spark, sf_dir),
                                    TEST_MINUTES)


# The same with the reference's default windows.

@register("price_movements_v1_default", doubles=["price_change_pct", "avg_price"], sql=moves_v1_sql())
def q_price_movements_v1_default(spark, sf_dir):
    return price_movements_simple(base_ticks(spark, sf_dir))


@register("asof_sentiment_prices_default", doubles=["change"], sql=f"WITH {asof_sql()} SELECT * FROM asofj")
def q_asof_default(spark, sf_dir):
    return asof_sentiment_prices(sentiment(spark, sf_dir), base_ticks(spark, sf_dir))


@register("sentiment_signal_v2_default", doubles=["btc_price_change", "eth_price_change"], sql=signals_v2_sql())
def q_signal_v2_default(spark, sf_dir):
    return sentiment_signals(sentiment(spark, sf_dir), base_ticks(spark, sf_dir))


@register("sentiment_signal_v1_default", doubles=["btc_price_change", "eth_price_change"], sql=signals_v1_sql())
def q_signal_v1_default(spark, sf_dir):
    return sentiment_signals_simple(sentiment(spark, sf_dir), base_ticks(spark, sf_dir))


@register("ticker_direction", sql=f"""
WITH {TICKS}
SELECT kafka_offset, CASE WHEN price_change_percent > 0 THEN 'UP' WHEN price_change_percent < 0 THEN 'DOWN' ELSE 'FLAT' END
       AS direction FROM ticks""")
def q_ticker_direction(spark, sf_dir):
    return ticks(spark, sf_dir).select("kafka_offset", direction_label("price_change_percent").alias("direction"))

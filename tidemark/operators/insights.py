"""Market insights: volume spikes, price movements and the
sentiment-price correlation, as batch DataFrame jobs.

The reference keeps per-symbol deques in one process. Here every per-tick
window is a Spark window over (symbol, chunk) with an exact halo
(``plans.chunked``), and the sentiment lookup is a distributed as-of join
(``plans.asof``). Tick order within a symbol is (event_time, kafka_offset).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import pct_change
from ..plans.asof import asof_latest
from ..plans.chunked import (
    PART, SEQ, bucket_width, drop_halo, range_frame, row_halo, row_sequence,
)
from ..plans.frames import frame_chunk_rows, two_bound_frame

# Fixed thresholds of the reference's processors.
SPIKE_WINDOW = 50
SPIKE_MIN_HISTORY = 10
SPIKE_MULTIPLIER = 1.5
SIMPLE_SPIKE_VOLUME = 1_000_000
MOVE_MAX_ROWS = 100
MOVE_MINUTES = 20
MOVE_MIN_POINTS = 3
MOVE_THRESHOLD = 0.1
SIMPLE_MOVE_MIN_POINTS = 10
CORR_POINTS = 10
CORR_MIN_POINTS = 5
CORR_SYMBOLS = ("BTCUSDT", "ETHUSDT")
FEAR = 30
GREED = 70
MODERATE_FEAR = 45
MODERATE_GREED = 55
DIRECTION_V2 = 0.3
CORR_WINDOW_MINUTES_V2 = 10
SIMPLE_FEAR = 25
SIMPLE_GREED = 75
CORR_WINDOW_MINUTES_V1 = 15

TICK_ORDER = ["event_time", "kafka_offset"]


def _priced(ticks: DataFrame) -> DataFrame:
    return ticks.filter(F.col("price").isNotNull())


def _ordered(df: DataFrame, halo: int, chunk_rows: int) -> DataFrame:
    seq = row_sequence(df, ["symbol"], "event_time", [F.col(c) for c in TICK_ORDER])
    return row_halo(seq, halo, chunk_rows)


def _rows_window(halo: int) -> Window:
    return Window.partitionBy("symbol", PART).orderBy(SEQ).rowsBetween(-halo, 0)


def volume_spikes_simple(ticks: DataFrame, threshold: float = SIMPLE_SPIKE_VOLUME) -> DataFrame:
    """v1: any priced tick with volume above a fixed threshold."""
    return ticks.filter((F.col("volume") > threshold) & F.col("price").isNotNull()).select(
        F.col("event_time").alias("spike_time"), "symbol", "volume",
        F.col("price").alias("price_at_spike"))


def volume_spikes(ticks: DataFrame, window: int = SPIKE_WINDOW, min_history: int = SPIKE_MIN_HISTORY,
                  multiplier: float = SPIKE_MULTIPLIER,
                  chunk_rows: int | None = None, carry: list[str] = ()) -> DataFrame:
    """v2: baseline = mean of the last <= ``window`` volumes including the
    current one, once ``min_history`` exist; emit when volume / baseline >=
    ``multiplier`` (ratio 0 for a non-positive baseline). Missing volume = 0.
    A tick without a price counts in the baseline and is never emitted."""
    t = ticks.select("symbol", "price", F.coalesce(F.col("volume"), F.lit(0.0)).alias("volume"),
                     *TICK_ORDER, *carry)
    h = _ordered(t, window - 1, chunk_rows)
    w = _rows_window(window - 1)
    s = (h.withColumn("_n", F.count(F.lit(1)).over(w))
          .withColumn("volume_baseline", F.avg("volume").over(w)))
    s = drop_halo(s).filter(F.col("_n") >= min_history)
    s = s.withColumn("spike_multiplier",
                     F.when(F.col("volume_baseline") > 0,
                            F.col("volume") / F.col("volume_baseline")).otherwise(F.lit(0.0)))
    return s.filter((F.col("spike_multiplier") >= multiplier) & F.col("price").isNotNull()).select(
        F.col("event_time").alias("spike_time"), "symbol", "volume", "volume_baseline",
        "spike_multiplier", F.col("price").alias("price_at_spike"), *carry)


def price_movements(ticks: DataFrame, max_rows: int = MOVE_MAX_ROWS, minutes: int = MOVE_MINUTES,
                    min_points: int = MOVE_MIN_POINTS, threshold: float = MOVE_THRESHOLD,
                    chunk_rows: int | None = None, carry: list[str] = ()) -> DataFrame:
    """v2: per tick, the window is the last <= ``max_rows`` ticks whose time is
    >= tick time - ``minutes`` (a tick exactly at the cutoff stays). With
    >= ``min_points`` points, emit when |first -> last change| >= threshold.
    A tick without a price is no tick: it takes no place in a window. The
    tick's offset tells moves of one symbol and time apart."""
    t = _priced(ticks).select("symbol", "price", *TICK_ORDER, *carry)
    f = _two_bound(t, max_rows, int(minutes) * 60, chunk_rows).where(F.col("_fr.n") >= min_points)
    f = f.select("*", pct_change(F.col("price"), F.col("_fr.first")).alias("price_change_pct"))
    return f.where(F.abs(F.col("price_change_pct")) >= threshold).select(
        F.col("_fr.first_time").alias("window_start"), F.col("event_time").alias("window_end"), "symbol",
        "price_change_pct", F.col("_fr.mean").alias("avg_price"),
        F.when(F.col("_fr.n") >= 2, F.sqrt(F.col("_fr.m2") / (F.col("_fr.n") - 1))).otherwise(F.lit(0.0)).alias("volatility"),
        "kafka_offset", *carry)


def _two_bound(ticks: DataFrame, max_rows: int, seconds: int, chunk_rows: int | None, strict: bool = False) -> DataFrame:
    h = _ordered(ticks, max_rows - 1, frame_chunk_rows(ticks, chunk_rows))
    return two_bound_frame(h, ["symbol"], "event_time", "price", max_rows, seconds, strict)


def price_movements_simple(ticks: DataFrame, minutes: int = MOVE_MINUTES,
                           min_points: int = SIMPLE_MOVE_MIN_POINTS) -> DataFrame:
    """v1: window = ticks newer than tick time - ``minutes`` (strict), up to
    and including this tick in (event_time, offset) order, no row cap; with
    >= ``min_points`` points emit every tick. Ticks without a price are left out.

    The frame has no row bound, so it is computed by the linear bucketed
    frame (``plans.chunked.range_frame``): streaming aggregates only, no
    per-row re-scan of the frame and no collected lists."""
    secs = int(minutes) * 60
    r = range_frame(_priced(ticks), ["symbol"], "event_time", "kafka_offset", "price", secs,
                    math.gcd(secs, bucket_width(ticks)), strict=True, peers=False)
    n = F.col("_rf.count")
    return (r.filter(n >= min_points)
             .select(F.col("_rf.first_time").alias("window_start"),
                     F.col("event_time").alias("window_end"), "symbol",
                     pct_change(F.col("price"), F.col("_rf.first")).alias("price_change_pct"),
                     (F.col("_rf.sum") / n).alias("avg_price")))


def correlation_state(ticks: DataFrame, minutes: int = MOVE_MINUTES, strict: bool = False,
                      points: int = CORR_POINTS, symbols=CORR_SYMBOLS,
                      chunk_rows: int | None = None, carry: list[str] = ()) -> DataFrame:
    """Per tick of the correlated symbols: the price window as the processor
    holds it right after that tick, reduced to what the correlation reads —
    the count of its last <= ``points`` entries and their first -> last
    change. ``strict`` selects the simple processor's eviction (time > cutoff).
    Ticks without a price are left out."""
    t = _priced(ticks).filter(F.col("symbol").isin(list(symbols))).select("symbol", "price", *TICK_ORDER, *carry)
    f = _two_bound(t, points, int(minutes) * 60, chunk_rows, strict)
    return f.select("symbol", "event_time", "kafka_offset", F.col("_fr.n").alias("n_points"),
                    pct_change(F.col("price"), F.col("_fr.first")).alias("change"), *carry)


def asof_sentiment_prices(sentiment: DataFrame, ticks: DataFrame, minutes: int = MOVE_MINUTES,
                          strict: bool = False, symbols=CORR_SYMBOLS) -> DataFrame:
    """For each sentiment reading, the BTC and ETH window state as of the
    latest tick at or before it: one row per (reading, symbol)."""
    return asof_state(sentiment, correlation_state(ticks, minutes, strict, symbols=symbols), symbols)


def asof_state(sentiment: DataFrame, state: DataFrame, symbols=CORR_SYMBOLS) -> DataFrame:
    """As-of join of readings to per-tick window states (symbol, event_time,
    kafka_offset, n_points, change)."""
    left = (sentiment.select("msg_id", "event_time", "value", "classification")
                     .withColumn("symbol", F.explode(F.array(*[F.lit(s) for s in symbols]))))
    j = asof_latest(left, state, ["symbol"], "event_time", "event_time",
                    [F.col("event_time"), F.col("kafka_offset")],
                    F.struct("n_points", "change"), out="_st", tie_col="kafka_offset")
    return j.select("msg_id", "event_time", "value", "classification", "symbol",
                    F.col("_st.n_points").alias("n_points"), F.col("_st.change").alias("change"))


def pair_change(asof: DataFrame, symbols=CORR_SYMBOLS, min_points: int = CORR_MIN_POINTS) -> DataFrame:
    """Side by side changes; a reading is kept only if every symbol has at
    least ``min_points`` points (a grouped pivot over a fixed symbol list)."""
    a, b = symbols
    g = (asof.groupBy("msg_id", "event_time", "value", "classification")
             .agg(F.max(F.when(F.col("symbol") == a, F.col("change"))).alias("btc_price_change"),
                  F.max(F.when(F.col("symbol") == b, F.col("change"))).alias("eth_price_change"),
                  F.min(F.coalesce(F.col("n_points"), F.lit(0))).alias("_minn")))
    return g.filter(F.col("_minn") >= min_points).drop("_minn")


def market_direction(btc: Column, eth: Column, threshold: float) -> Column:
    return (F.when((btc > threshold) & (eth > threshold), "BULLISH")
            .when((btc < -threshold) & (eth < -threshold), "BEARISH")
            .otherwise("MIXED"))


def signal_v2(fg: Column, direction: Column, btc: Column) -> Column:
    return (F.when((fg < FEAR) & (direction == "BEARISH"), "STRONG_BUY")
            .when((fg > GREED) & (direction == "BULLISH"), "STRONG_SELL")
            .when((fg < FEAR) & (direction == "BULLISH"), "REVERSAL_UP")
            .when((fg > GREED) & (direction == "BEARISH"), "REVERSAL_DOWN")
            .when((fg < MODERATE_FEAR) & (btc > DIRECTION_V2), "BUY_SIGNAL")
            .when((fg > MODERATE_GREED) & (btc < -DIRECTION_V2), "SELL_SIGNAL")
            .when(direction != "MIXED", "CORRELATION")
            .otherwise("NEUTRAL"))


def signal_v1(fg: Column, direction: Column) -> Column:
    return (F.when((fg < SIMPLE_FEAR) & (direction == "BEARISH"), "BUY_SIGNAL")
            .when((fg > SIMPLE_GREED) & (direction == "BULLISH"), "SELL_SIGNAL")
            .when((fg < SIMPLE_FEAR) & (direction == "BULLISH"), "REVERSAL_CONFIRMED")
            .otherwise("NEUTRAL"))


def _correlation_rows(pairs: DataFrame, window_minutes: int) -> DataFrame:
    return pairs.select(
        (F.col("event_time") - F.make_dt_interval(mins=F.lit(int(window_minutes)))).alias("window_start"),
        F.col("event_time").alias("window_end"),
        F.col("value").cast("int").alias("fear_greed_index"),
        F.col("classification").alias("fear_greed_class"),
        "btc_price_change", "eth_price_change", "market_direction", "correlation_signal")


def sentiment_signals(sentiment: DataFrame, ticks: DataFrame, minutes: int = MOVE_MINUTES) -> DataFrame:
    """Improved processor: contrarian / reversal / moderate signals; NEUTRAL
    rows are not stored."""
    return signals_from_asof(asof_sentiment_prices(sentiment, ticks, minutes))


def signals_from_asof(asof: DataFrame) -> DataFrame:
    p = pair_change(asof)
    d = market_direction(F.col("btc_price_change"), F.col("eth_price_change"), DIRECTION_V2)
    p = p.withColumn("market_direction", d).withColumn(
        "correlation_signal", signal_v2(F.col("value"), F.col("market_direction"), F.col("btc_price_change")))
    return _correlation_rows(p.filter(F.col("correlation_signal") != "NEUTRAL"), CORR_WINDOW_MINUTES_V2)


def sentiment_signals_simple(sentiment: DataFrame, ticks: DataFrame,
                             minutes: int = MOVE_MINUTES) -> DataFrame:
    """Simple processor: direction at 0, three signals, every row stored."""
    p = pair_change(asof_sentiment_prices(sentiment, ticks, minutes, strict=True))
    d = market_direction(F.col("btc_price_change"), F.col("eth_price_change"), 0.0)
    p = p.withColumn("market_direction", d).withColumn(
        "correlation_signal", signal_v1(F.col("value"), F.col("market_direction")))
    return _correlation_rows(p, CORR_WINDOW_MINUTES_V1)


def market_sentiment(sentiment: DataFrame) -> DataFrame:
    """Every reading becomes a row (recorded_time, index, class)."""
    return sentiment.select(F.timestamp_millis("timestamp").cast("timestamp_ntz").alias("recorded_time"),
                            F.col("value").cast("int").alias("fear_greed_index"),
                            F.col("classification").alias("fear_greed_class"))

"""Candles and rolling market analytics.

The same functions serve batch DataFrames and streams: a grouped
aggregation over ``window()`` is a partial + final hash aggregate keyed by
(symbol, window), so work spreads over symbol-windows, never over symbols.
Open / close are ``min_by`` / ``max_by`` on (event_time, offset): exact and
order independent, unlike ``first`` / ``last``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import pct_change, safe_ratio, trend_signal, volume_signal

SILVER_COLUMNS = ["symbol", "window_start", "window_end", "open", "high", "low", "close",
                  "volume", "trade_count", "vwap", "price_volatility", "candle_change_pct"]
GOLD_COLUMNS = ["symbol", "period_start", "period_end", "period_open", "period_high",
                "period_low", "period_close", "period_volume", "period_vwap", "avg_volatility",
                "total_trades", "price_change_pct", "price_range_pct", "signal", "volume_signal"]


def vwap(price="price", volume="volume"):
    """sum(price*volume) / sum(volume); null when the volume sums to 0."""
    return safe_ratio(F.sum(F.col(price) * F.col(volume)), F.sum(volume))


def tick_order(time_col: str = "event_time", tie_col: str = "kafka_offset"):
    """(time, offset) as one decimal: micros times 10^18 plus the offset, the same
    order as the pair for offsets of 0 to 10^18. A fixed-width key keeps the
    candles in a hash aggregate, where a struct would sort all rows."""
    micros = F.unix_micros(F.col(time_col).cast("timestamp")).cast("decimal(20,0)")
    return (micros * F.lit(10**18).cast("decimal(19,0)") + F.col(tie_col).cast("decimal(19,0)")).cast("decimal(38,0)")


def ohlc_candles(ticks: DataFrame, interval: str = "1 minute", time_col: str = "event_time",
                 tie_col: str = "kafka_offset", audit: bool = False) -> DataFrame:
    """Tumbling candles per symbol (the silver layer)."""
    order = tick_order(time_col, tie_col)
    agg = (ticks.groupBy("symbol", F.window(time_col, interval).alias("w"))
                .agg(F.min_by("price", order).alias("open"),
                     F.max("price").alias("high"),
                     F.min("price").alias("low"),
                     F.max_by("price", order).alias("close"),
                     F.sum("volume").alias("volume"),
                     F.count(F.lit(1)).alias("trade_count"),
                     vwap().alias("vwap"),
                     F.stddev_samp("price").alias("price_volatility")))
    out = agg.select(
        "symbol",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "open", "high", "low", "close", "volume", "trade_count", "vwap", "price_volatility",
        pct_change(F.col("close"), F.col("open")).alias("candle_change_pct"),
    )
    if audit:
        out = out.withColumn("processed_at", F.current_timestamp())
    return out


def ohlc_resample(candles: DataFrame, interval: str = "1 hour") -> DataFrame:
    """Re-bucket finer candles into ``interval`` (1m/5m/15m/1h/1d): first open,
    max high, min low, last close, summed volume and trades, and a
    volume-weighted VWAP rebuilt from the parts (sum(vwap*volume)/sum(volume)).
    Intervals must divide a day: windows are epoch aligned."""
    order = F.col("window_start")
    agg = (candles.groupBy("symbol", F.window("window_start", interval).alias("w"))
                  .agg(F.min_by("open", order).alias("open"),
                       F.max("high").alias("high"),
                       F.min("low").alias("low"),
                       F.max_by("close", order).alias("close"),
                       F.sum("volume").alias("volume"),
                       F.sum("trade_count").alias("trade_count"),
                       safe_ratio(F.sum(F.col("vwap") * F.col("volume")), F.sum("volume")).alias("vwap"),
                       F.count(F.lit(1)).alias("candle_count")))
    return agg.select("symbol", F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), "open", "high", "low", "close",
                      "volume", "trade_count", "vwap", "candle_count",
                      F.lit(interval).alias("interval"))


#: What a candle must carry so that candles of any longer interval follow exactly.
STATE_COLUMNS = ["symbol", "window_start", "window_end", "first_key", "open", "high", "low", "last_key", "close", "volume",
                 "price_volume", "trade_count", "n", "mean", "m2"]


def candle_states(ticks: DataFrame, interval: str = "1 minute", time_col: str = "event_time",
                  tie_col: str = "kafka_offset") -> DataFrame:
    """Mergeable candles: beside open, high, low and close the order keys of the first
    and last tick, the sums that VWAP is the ratio of, and the prices' count, mean and
    sum of squared deviations."""
    order = tick_order(time_col, tie_col)
    agg = (ticks.groupBy("symbol", F.window(time_col, interval).alias("w"))
                .agg(F.min(order).alias("first_key"), F.min_by("price", order).alias("open"), F.max("price").alias("high"),
                     F.min("price").alias("low"), F.max(order).alias("last_key"), F.max_by("price", order).alias("close"),
                     F.sum("volume").alias("volume"), F.sum(F.col("price") * F.col("volume")).alias("price_volume"),
                     F.count(F.lit(1)).alias("trade_count"), F.count("price").alias("n"), F.avg("price").alias("mean"),
                     (F.var_pop("price") * F.count("price")).alias("m2")))
    return agg.select("symbol", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *STATE_COLUMNS[3:])


def merge_candles(states: DataFrame, interval: str) -> DataFrame:
    """States of ``interval`` from finer ones (1m, 5m, 15m, 1h, 1d: each may come from any that divides it).

    Squared deviations add up around the common mean: the sum of the parts' own
    plus what each part's mean is off, which loses nothing to cancellation. That mean is a window over
    the same key as the aggregate, so the states are shuffled once."""
    w = F.window("window_start", interval)
    parts = states.withColumns({"_start": w["start"], "_end": w["end"]})
    whole = Window.partitionBy("symbol", "_start", "_end")
    mean = F.sum(F.col("n") * F.col("mean")).over(whole) / F.nullif(F.sum("n").over(whole), F.lit(0))
    parts = parts.withColumn("_mean", mean)
    off = F.col("mean") - F.col("_mean")
    return (parts.groupBy("symbol", "_start", "_end")
                 .agg(F.min("first_key").alias("first_key"), F.min_by("open", "first_key").alias("open"), F.max("high").alias("high"),
                      F.min("low").alias("low"), F.max("last_key").alias("last_key"), F.max_by("close", "last_key").alias("close"),
                      F.sum("volume").alias("volume"), F.sum("price_volume").alias("price_volume"),
                      F.sum("trade_count").alias("trade_count"), F.sum("n").alias("n"), F.max("_mean").alias("mean"),
                      F.sum(F.col("m2") + F.col("n") * off * off).alias("m2"))
                 .withColumnsRenamed({"_start": "window_start", "_end": "window_end"}).select(*STATE_COLUMNS))


def candles_of(states: DataFrame) -> DataFrame:
    """The silver candles that states stand for: what ``ohlc_candles`` makes of the ticks."""
    return states.select(
        "symbol", "window_start", "window_end", "open", "high", "low", "close", "volume", "trade_count",
        safe_ratio(F.col("price_volume"), F.col("volume")).alias("vwap"),
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("price_volatility"),
        pct_change(F.col("close"), F.col("open")).alias("candle_change_pct"))


def _whole_minutes(text: str) -> int | None:
    number, unit = text.split()
    size = {"minute": 1, "hour": 60, "day": 1440}.get(unit.rstrip("s"))
    return int(number) * size if size and number.isdigit() else None


def _panes(candles: DataFrame, time: Column) -> DataFrame:
    """Partial analytics of the candles of one tumbling window: sums and counts in place of means."""
    order = F.col("window_start")
    return (candles.groupBy("symbol", time.alias("pane"))
                   .agg(F.min(order).alias("first_start"), F.min_by("open", order).alias("open"), F.max("high").alias("high"),
                        F.min("low").alias("low"), F.max(order).alias("last_start"), F.max_by("close", order).alias("close"),
                        F.sum("volume").alias("volume"), F.sum("vwap").alias("vwaps"), F.count("vwap").alias("vwap_n"),
                        F.sum("price_volatility").alias("vols"), F.count("price_volatility").alias("vol_n"),
                        F.sum("trade_count").alias("trades")))


def _sliding(candles: DataFrame, window: str, slide: str) -> DataFrame:
    """Sliding windows put together from panes of one slide: a candle is read into one pane, and only
    panes are handed to the windows that hold them. ``window`` must be a multiple of ``slide``."""
    panes = _panes(candles, F.window("window_end", slide))
    step, n = _whole_minutes(slide), _whole_minutes(window) // _whole_minutes(slide)
    if candles.isStreaming:  # a window over the panes' own time keeps the watermark
        placed = panes.groupBy("symbol", F.window(F.window_time("pane"), window, slide).alias("w"))
    else:
        back = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        start = F.col("pane.start") - F.make_dt_interval(mins=F.col("_back") * step)
        placed = panes.withColumn("_back", back).withColumn(
            "w", F.struct(start.alias("start"), (start + F.make_dt_interval(mins=F.lit(step * n))).alias("end"))).groupBy("symbol", "w")
    return placed.agg(F.min_by("open", "first_start").alias("period_open"), F.max("high").alias("period_high"),
                      F.min("low").alias("period_low"), F.max_by("close", "last_start").alias("period_close"),
                      F.sum("volume").alias("period_volume"), (F.sum("vwaps") / F.nullif(F.sum("vwap_n"), F.lit(0))).alias("period_vwap"),
                      (F.sum("vols") / F.nullif(F.sum("vol_n"), F.lit(0))).alias("avg_volatility"), F.sum("trades").alias("total_trades"))


def market_analytics(candles: DataFrame, window: str = "15 minutes", slide: str = "5 minutes",
                     audit: bool = False) -> DataFrame:
    """Sliding analytics over candles keyed on ``window_end`` (the gold layer).

    As in the reference, a candle belongs to the sliding windows that contain
    its *end* time, and ``period_vwap`` is the unweighted mean of candle VWAPs.
    The window must be a multiple of the slide, both whole minutes, hours or days.
    """
    w, s = _whole_minutes(window), _whole_minutes(slide)
    if not w or not s or w % s:
        raise ValueError(f"{window} is not a multiple of {slide}")
    agg = _sliding(candles, window, slide)
    out = (agg.withColumn("price_change_pct", pct_change(F.col("period_close"), F.col("period_open")))
              .withColumn("price_range_pct", pct_change(F.col("period_high"), F.col("period_low")))
              .withColumn("signal", trend_signal("price_change_pct"))
              .withColumn("volume_signal", volume_signal("period_volume"))
              .select("symbol", F.col("w.start").alias("period_start"),
                      F.col("w.end").alias("period_end"), *GOLD_COLUMNS[3:]))
    if audit:
        out = out.withColumn("computed_at", F.current_timestamp())
    return out

"""Serving queries.

Top-k answers are ``orderBy(...).limit(n)``, which Spark plans as
TakeOrderedAndProject: each task keeps its own best n and only those reach
the final merge. Symbol filters are plain equality predicates, so on a table
partitioned by symbol they prune directories. "Now" is a parameter
(``as_of``) so answers are reproducible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import TRACKED_SYMBOLS, null_to_zero
from ..streaming.last_rows import newest

PRICE_COLUMNS = ["symbol", "price", "volume", "price_change_percent", "event_time"]


def _clamp(v: int, lo: int, hi: int) -> int:
    if not lo <= v <= hi:
        raise ValueError(f"parameter {v} outside [{lo}, {hi}]")
    return v


def latest_price_correlated(spark: SparkSession, bronze: DataFrame) -> DataFrame:
    """Rows whose event_time equals their symbol's maximum (all ties kept),
    written as the correlated subquery; Catalyst decorrelates it into an
    aggregate + join."""
    return spark.sql("""
        SELECT symbol, price, volume, coalesce(price_change_percent, 0.0) AS price_change_percent,
               event_time
        FROM {b} AS b1
        WHERE event_time = (SELECT max(event_time) FROM {b} AS b2 WHERE b2.symbol = b1.symbol)
        ORDER BY symbol""", b=bronze.select(*PRICE_COLUMNS))


def latest_price_semi(bronze: DataFrame) -> DataFrame:
    """Same rows as the semi join with per-symbol maxima, in one pass: the rows
    of rank 1 by time within their symbol, ties included. ``bronze`` may be the
    whole layer or the table of newest rows that a stream keeps
    (``streaming.last_rows``): the answer is the same."""
    return newest(bronze.select(*PRICE_COLUMNS), "symbol", "event_time").orderBy("symbol")


def price_history(bronze: DataFrame, symbol: str, as_of, hours: int = 24, limit: int = 100) -> DataFrame:
    _clamp(hours, 1, 168)
    _clamp(limit, 1, 1000)
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(hours))
    return (bronze.filter((F.col("symbol") == symbol.upper()) & (F.col("event_time") > cutoff))
                  .select("symbol", "price", "volume",
                          null_to_zero("price_change_percent").alias("price_change_percent"),
                          "event_time", "kafka_offset")
                  .orderBy(F.col("event_time").desc(), F.col("kafka_offset").desc())
                  .limit(limit))


def price_history_simple(bronze: DataFrame, symbol: str, limit: int = 50) -> DataFrame:
    _clamp(limit, 1, 500)
    return (bronze.filter(F.col("symbol") == symbol.upper())
                  .select(*PRICE_COLUMNS, "kafka_offset")
                  .orderBy(F.col("event_time").desc(), F.col("kafka_offset").desc())
                  .limit(limit))


def ohlc_latest(silver: DataFrame, symbol: str, limit: int = 100, max_limit: int = 500) -> DataFrame:
    _clamp(limit, 1, max_limit)
    return (silver.filter(F.col("symbol") == symbol.upper())
                  .select("symbol", "window_start", "window_end", "open", "high", "low", "close",
                          "volume", "vwap", "trade_count", "candle_change_pct")
                  .orderBy(F.col("window_start").desc())
                  .limit(limit))


def analytics_latest(gold: DataFrame, symbol: str, limit: int | None = 50) -> DataFrame:
    """Gold rows for a symbol, newest first; ``limit=None`` is the variant
    without a limit. Null volatility is served as 0."""
    out = (gold.filter(F.col("symbol") == symbol.upper())
               .select("symbol", "period_start", "period_end", "price_change_pct",
                       null_to_zero("avg_volatility").alias("volatility"), "signal",
                       "volume_signal", "total_trades")
               .orderBy(F.col("period_end").desc(), F.col("period_start").desc()))
    if limit is not None:
        out = out.limit(_clamp(limit, 1, 200))
    return out


def list_symbols(dim: DataFrame) -> DataFrame:
    return (dim.filter(F.col("is_active"))
               .select("symbol", "base_currency", "quote_currency", "currency_name", "market_tier")
               .orderBy("market_tier", "symbol"))


def list_symbols_static(spark: SparkSession) -> DataFrame:
    """The other API's fixed list."""
    return spark.createDataFrame([(s,) for s in TRACKED_SYMBOLS], "symbol string")


def quality_latest(metrics: DataFrame, limit: int = 20) -> DataFrame:
    return (metrics.select("check_time", "table_name", "metric_name", "metric_value",
                           "threshold", "status")
                   .orderBy(F.col("check_time").desc(), "table_name", "metric_name")
                   .limit(limit))


def dashboard_analytics(gold: DataFrame) -> DataFrame:
    return gold.select("symbol", "price_change_pct", "signal", "volume_signal",
                       "total_trades").orderBy("symbol")


def recent_movements(moves: DataFrame, limit: int = 20) -> DataFrame:
    """Newest moves first (insertion order = event order here, offsets break ties)."""
    return (moves.orderBy(F.col("window_end").desc(), F.col("kafka_offset").desc()).select("symbol", "price_change_pct", "avg_price", "window_end", "window_start")
                 .limit(limit))


def layer_counts(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Row count per layer as one small union of three global counts."""
    def cnt(df, name):
        return df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("layer"), "records")
    return cnt(bronze, "bronze").unionByName(cnt(silver, "silver")).unionByName(cnt(gold, "gold"))


def quality_pass_rate(metrics: DataFrame) -> DataFrame:
    """SUM(status = PASS) * 100 / COUNT(*), 0 for an empty table."""
    return metrics.agg(F.coalesce(F.avg(F.when(F.col("status") == "PASS", 100.0).otherwise(0.0)),
                                  F.lit(0.0)).alias("pass_rate"))


def recent_summary(moves: DataFrame, per_symbol: int = 100, symbols=TRACKED_SYMBOLS) -> DataFrame:
    """Per symbol over its newest ``per_symbol`` moves: avg change, min / max /
    avg of avg_price; a symbol whose avg change is null or 0 is skipped.
    The per-symbol top-k runs as a window group limit (partial top-k before
    the shuffle), so no task holds a whole symbol."""
    w = Window.partitionBy("symbol").orderBy(F.col("window_end").desc(), F.col("kafka_offset").desc())
    top = (moves.filter(F.col("symbol").isin(list(symbols)))
                .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= per_symbol))
    g = top.groupBy("symbol").agg(F.avg("price_change_pct").alias("avg_change"),
                                  F.min("avg_price").alias("min_price"),
                                  F.max("avg_price").alias("max_price"),
                                  F.avg("avg_price").alias("avg_price_overall"))
    return g.filter(F.col("avg_change").isNotNull() & (F.col("avg_change") != 0))

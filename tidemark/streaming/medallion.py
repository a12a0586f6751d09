"""Bronze -> silver -> gold as Structured Streaming queries.

The transformations are the batch ones (``operators.candles``,
``sources.decode``); streaming adds watermarks and append sinks. Windowed
aggregations keep per-(symbol, window) state and emit a window once the
watermark passes its end; rows older than the watermark are dropped there
(bronze has no state and keeps them).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.candles import market_analytics, ohlc_candles
from ..sources.decode import bronze_records, kafka_envelope
from .sources import read_table_stream, sink_table_append

BRONZE_WATERMARK = "5 minutes"
SILVER_WATERMARK = "5 minutes"
GOLD_WATERMARK = "10 minutes"


def bronze_stream(raw: DataFrame, watermark: str | None = BRONZE_WATERMARK) -> DataFrame:
    """Decoded, audited price rows. ``watermark=None`` leaves the watermark to
    a downstream layer chained in the same query (a stream may define it
    once)."""
    out = bronze_records(kafka_envelope(raw))
    return out.withWatermark("event_time", watermark) if watermark else out


def silver_stream(bronze: DataFrame, interval: str = "1 minute",
                  watermark: str = SILVER_WATERMARK) -> DataFrame:
    return ohlc_candles(bronze.withWatermark("event_time", watermark), interval, audit=True)


def gold_stream(silver: DataFrame, window: str = "15 minutes", slide: str = "5 minutes",
                watermark: str = GOLD_WATERMARK) -> DataFrame:
    return market_analytics(silver.withWatermark("window_end", watermark), window, slide, audit=True)


@dataclass
class LayerPaths:
    root: str

    def table(self, layer: str) -> str:
        return f"{self.root}/{layer}"

    def checkpoint(self, layer: str) -> str:
        return f"{self.root}/_checkpoints/{layer}"


def run_medallion(spark: SparkSession, raw: DataFrame, root: str, interval: str = "1 minute",
                  window: str = "15 minutes", slide: str = "5 minutes",
                  layers=("bronze", "silver", "gold")) -> LayerPaths:
    """Run the layers one after another with ``availableNow`` triggers; each
    later layer reads the previous layer's table as a stream. Re-running on
    the same root resumes from the checkpoints (no duplicates)."""
    p = LayerPaths(root)
    if "bronze" in layers:
        q = sink_table_append(bronze_stream(raw), p.table("bronze"), p.checkpoint("bronze"),
                              name=None)
        q.awaitTermination()
    if "silver" in layers:
        b = read_table_stream(spark, p.table("bronze"))
        q = sink_table_append(silver_stream(b, interval), p.table("silver"), p.checkpoint("silver"))
        q.awaitTermination()
    if "gold" in layers:
        s = read_table_stream(spark, p.table("silver"))
        q = sink_table_append(gold_stream(s, window, slide), p.table("gold"), p.checkpoint("gold"))
        q.awaitTermination()
    return p


def start_all(queries: list[StreamingQuery]) -> None:
    """Lifecycle for continuously triggered layers: wait for any query to end
    (or fail), then stop the rest, so a failure is never left half-running."""
    if not queries:
        return
    try:
        SparkSession.active().streams.awaitAnyTermination()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()

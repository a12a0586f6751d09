"""Shared layer builders for registered queries: bronze from the price
topic's records, silver candles, gold analytics (all derived by Spark from
the driver's tables)."""

from __future__ import annotations

from ..operators.candles import market_analytics, ohlc_candles
from ..operators.maintenance import rebalanced
from ..session import path_exists, scratch_path
from ..sources.decode import bronze_records, kafka_envelope
from ..sources.fixtures import base_ticks, kafka_price_records
from ..sources.footers import footer_table
from ..streaming.last_rows import LastRows
from ..streaming.stateful import run_tail_carry


def bronze(spark, sf_dir, audit=False, cut=False):
    return bronze_records(kafka_envelope(kafka_price_records(spark, sf_dir, cut=cut)), audit=audit)


_written: dict[tuple, str] = {}


def bronze_table(spark, sf_dir):
    """The bronze layer as serving reads it: written once per session and
    input, partitioned by symbol, so symbol and time filters prune and push."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written or not path_exists(spark, _written[key]):
        path = scratch_path(spark, "bronze-table")
        rebalanced(bronze(spark, sf_dir), ["symbol"]).write.partitionBy("symbol").parquet(path)
        _written[key] = path
    return spark.read.parquet(_written[key])


def written_layer(spark, sf_dir, name, build, by=("symbol",)):
    """Path of a table that is written once per session and input, partitioned by ``by``."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written or not path_exists(spark, _written[key]):
        path, df = scratch_path(spark, f"layer-{name}"), build(spark, sf_dir)
        (rebalanced(df, list(by)).write.partitionBy(*by) if by else df.write).parquet(path)
        _written[key] = path
    return _written[key]


def layer_footers(spark, sf_dir, name):
    """A written layer for counts and extremes: bronze, silver or gold."""
    if name == "bronze":
        bronze_table(spark, sf_dir)
        return footer_table(spark, _written[(spark.sparkContext.applicationId, sf_dir)])
    return footer_table(spark, written_layer(spark, sf_dir, name, {"silver": silver, "gold": gold}[name]))


def last_prices(spark, sf_dir):
    """The newest bronze rows per symbol, as a stream over the bronze table keeps them (several
    micro-batches; run once per session and input). What is read is only that table."""
    key = (spark.sparkContext.applicationId, sf_dir, "last")
    if key not in _written or not path_exists(spark, _written[key]):
        layer = bronze_table(spark, sf_dir)
        path = scratch_path(spark, "last-prices")
        stream = spark.readStream.schema(layer.schema).option("maxFilesPerTrigger", 4).parquet(_written[key[:2]])
        run_tail_carry(stream, LastRows(spark, path), scratch_path(spark, "last-ckpt")).awaitTermination()
        _written[key] = path
    return LastRows(spark, _written[key]).last()


def silver(spark, sf_dir, interval="1 minute"):
    return ohlc_candles(base_ticks(spark, sf_dir), interval)


def gold(spark, sf_dir, window="15 minutes", slide="5 minutes"):
    return market_analytics(silver(spark, sf_dir), window, slide)

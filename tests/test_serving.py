import datetime as dt

from tidemark.operators.serving import (
    latest_price_correlated, latest_price_semi, price_history, price_history_simple,
)

T = dt.datetime(2024, 1, 30, 12)
SCHEMA = ("symbol string, price double, volume double, price_change_percent double, "
          "event_time timestamp_ntz, kafka_offset long")


def _bronze(spark):
    return spark.createDataFrame([
        ("A", 1.0, 1.0, None, T, 1), ("A", 2.0, 1.0, 1.0, T, 2),        # two rows share the latest time
        ("A", 3.0, 1.0, 1.0, T - dt.timedelta(hours=1), 3),
        ("B", 4.0, 1.0, 1.0, T - dt.timedelta(days=3), 4)], SCHEMA)


def test_latest_price_ties(spark):
    b = _bronze(spark)
    a = sorted((r.symbol, r.price) for r in latest_price_semi(b).collect())
    c = sorted((r.symbol, r.price) for r in latest_price_correlated(spark, b).collect())
    assert a == c == [("A", 1.0), ("A", 2.0), ("B", 4.0)]
    # null change served as 0 by the correlated (API) variant
    assert {r.price_change_percent for r in latest_price_correlated(spark, b).collect()} == {0.0, 1.0}


def test_history(spark):
    b = _bronze(spark)
    assert price_history(b, "zzz", "2024-01-31 00:00:00").count() == 0          # unknown symbol
    rows = price_history(b, "a", "2024-01-31 00:00:00", hours=24, limit=1000).collect()
    assert [r.kafka_offset for r in rows] == [2, 1, 3]                        # newest first, limit > data
    assert price_history(b, "b", "2024-01-31 00:00:00", hours=24).count() == 0  # older than look-back
    assert price_history_simple(b, "b", 50).count() == 1


def test_limits_and_null_volatility(spark):
    import pytest
    from tidemark.operators.serving import analytics_latest, ohlc_latest
    gold = spark.createDataFrame(
        [("A", T, T + dt.timedelta(minutes=15), 1.0, None, "NEUTRAL", "NORMAL_VOLUME", 3)],
        "symbol string, period_start timestamp_ntz, period_end timestamp_ntz, price_change_pct double, "
        "avg_volatility double, signal string, volume_signal string, total_trades long")
    assert analytics_latest(gold, "a").first().volatility == 0.0
    assert analytics_latest(gold, "a", limit=None).count() == 1
    with pytest.raises(ValueError):
        analytics_latest(gold, "a", limit=201)
    silver = spark.createDataFrame([("A", T, T, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1, 0.0)],
                                   "symbol string, window_start timestamp_ntz, window_end timestamp_ntz, "
                                   "open double, high double, low double, close double, volume double, "
                                   "vwap double, trade_count long, candle_change_pct double")
    assert ohlc_latest(silver, "A", limit=500).count() == 1
    with pytest.raises(ValueError):
        ohlc_latest(silver, "A", limit=0)


def test_counts_and_extremes_come_from_footers(spark):
    from tidemark.operators.quality import check_completeness, check_freshness
    from tidemark.operators.serving import layer_counts
    from tidemark.session import scratch_path
    from tidemark.sources.footers import footer_table
    path = scratch_path(spark, "t-footers")
    t0 = 1704067200000
    rows = [(s, t0 + 1000 * i, float(i)) for i, s in enumerate(["BTCUSDT", "ETHUSDT", None] * 30)] + [("ETHUSDT", None, None)]
    spark.createDataFrame(rows, "symbol string, timestamp long, price double").write.partitionBy("symbol").parquet(path)
    t = footer_table(spark, path)
    for df in (layer_counts(t, t, t), check_freshness(t, "2024-01-01 00:02:00", "timestamp"),
               check_completeness(t, spark, "2024-01-01 00:30:00", time_col="timestamp")):
        plan = df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [COUNT(*)]" in plan or "PushedAggregation: [MAX(timestamp)]" in plan, plan[:2000]
    assert [r.records for r in layer_counts(t, t, t).collect()] == [91] * 3
    f = check_freshness(t, "2024-01-01 00:02:00", "timestamp").first()
    assert (str(f.latest), f.age_seconds, f.fresh) == ("2024-01-01 00:01:29", 31.0, True)
    seen = {r.symbol: str(r.last_seen) for r in check_completeness(t, spark, "2024-01-01 00:30:00", time_col="timestamp").collect()}
    assert seen == {"BTCUSDT": "2024-01-01 00:01:27", "ETHUSDT": "2024-01-01 00:01:28", "BNBUSDT": "None"}

from pyspark.sql import functions as F

from tidemark.operators.candles import market_analytics, ohlc_candles, ohlc_resample
from tests.conftest import ts

SCHEMA = "symbol string, price double, volume double, event_time timestamp_ntz, kafka_offset long"


def test_candle_edges(spark):
    rows = [
        ("A", 10.0, 1.0, ts("2024-01-01 00:00:10"), 1),   # single tick in its minute
        ("B", 5.0, 0.0, ts("2024-01-01 00:01:00"), 7),    # exactly on the window edge
        ("B", 6.0, 0.0, ts("2024-01-01 00:01:00"), 3),    # same time, lower offset -> open
        ("B", 7.0, 0.0, ts("2024-01-01 00:01:30"), 2),
    ]
    c = {(r.symbol): r for r in ohlc_candles(spark.createDataFrame(rows, SCHEMA)).collect()}
    a, b = c["A"], c["B"]
    assert a.trade_count == 1 and a.price_volatility is None and a.open == a.close == 10.0
    assert str(b.window_start) == "2024-01-01 00:01:00"
    assert b.open == 6.0 and b.close == 7.0 and b.high == 7.0 and b.low == 5.0
    assert b.vwap is None  # total volume 0
    assert b.volume == 0.0 and b.trade_count == 3


def test_candle_invariants_on_data(spark):
    from tidemark.sources.fixtures import base_ticks
    t = base_ticks(spark, "/root/testdata/sf0.001")
    c = ohlc_candles(t, "1 hour")
    bad = c.filter((F.col("low") > F.col("open")) | (F.col("open") > F.col("high")) |
                   (F.col("low") > F.col("close")) | (F.col("close") > F.col("high")) |
                   (F.col("vwap") < F.col("low") - 1e-9) | (F.col("vwap") > F.col("high") + 1e-9)).count()
    assert bad == 0
    assert c.agg(F.sum("trade_count")).first()[0] == t.count()
    # resampling to a day keeps all trades
    d = ohlc_resample(ohlc_candles(t, "1 minute"), "1 day")
    assert d.agg(F.sum("trade_count")).first()[0] == t.count()


def test_sliding_on_window_end(spark):
    rows = [("A", 1.0, 1.0, ts("2024-01-01 00:14:10"), 1)]  # 1-min candle ends 00:15:00
    g = market_analytics(ohlc_candles(spark.createDataFrame(rows, SCHEMA)), "15 minutes", "5 minutes")
    starts = sorted(str(r.period_start) for r in g.collect())
    assert starts == ["2024-01-01 00:05:00", "2024-01-01 00:10:00", "2024-01-01 00:15:00"]


def test_each_candle_in_three_windows(spark):
    from tidemark.sources.fixtures import base_ticks
    c = ohlc_candles(base_ticks(spark, "/root/testdata/sf0.001"), "1 minute")
    g = market_analytics(c, "15 minutes", "5 minutes")
    assert g.agg(F.sum("total_trades")).first()[0] == 3 * c.agg(F.sum("trade_count")).first()[0]


def test_merged_candles_equal_those_of_the_ticks(spark):
    """1m -> 5m -> 15m -> 1h -> 1d against candles built from ticks, at prices whose spread is tiny beside them; null prices
    and volumes, single ticks, ties in time."""
    import random

    from tidemark.operators.candles import candle_states, candles_of, merge_candles
    rnd = random.Random(4)
    base = ts("2024-01-01 00:00:00")
    import datetime as dt
    rows = [(rnd.choice(["A", "A", "B", None]), None if i % 41 == 7 else 60_000 + rnd.random() / 100, None if i % 29 == 3 else float(rnd.randrange(3)),
             base + dt.timedelta(seconds=rnd.choice([30 * rnd.randrange(5000), rnd.randrange(172800)])), i) for i in range(1500)]
    rows.append(("C", None, 1.0, base, 9999))
    ticks = spark.createDataFrame(rows, SCHEMA)
    states = candle_states(ticks, "1 minute")
    for interval in ("5 minutes", "15 minutes", "1 hour", "1 day"):
        states = merge_candles(states, interval)
        got = {(r.symbol, r.window_start): r for r in candles_of(states).collect()}
        want = {(r.symbol, r.window_start): r for r in ohlc_candles(ticks, interval).collect()}
        assert set(got) == set(want)
        for k, w in want.items():
            g = got[k]
            assert (g.open, g.high, g.low, g.close, g.trade_count, g.window_end) == (w.open, w.high, w.low, w.close, w.trade_count, w.window_end)
            for x, y in ((g.vwap, w.vwap), (g.volume, w.volume), (g.price_volatility, w.price_volatility), (g.candle_change_pct, w.candle_change_pct)):
                assert (x is None) == (y is None) and (x is None or abs(x - y) < 1e-9), (k, x, y)


def test_sliding_windows_are_built_from_panes(spark):
    """Same rows as Spark's own sliding window, null measures included, without a copy of each candle per window."""
    import random

    import pytest
    rnd = random.Random(9)
    import datetime as dt
    base = ts("2024-01-01 00:00:00")
    rows = [("A" if i % 3 else "B", 100 + rnd.random(), None if i % 10 == 0 else 1.0, base + dt.timedelta(seconds=rnd.randrange(20_000)), i) for i in range(200)]
    candles = ohlc_candles(spark.createDataFrame(rows, SCHEMA))
    g = market_analytics(candles, "15 minutes", "5 minutes")
    assert "Expand" not in g._jdf.queryExecution().optimizedPlan().toString()
    order = F.col("window_start")
    ref = candles.groupBy("symbol", F.window("window_end", "15 minutes", "5 minutes").alias("w")).agg(
        F.min_by("open", order).alias("o"), F.max_by("close", order).alias("c"), F.avg("vwap").alias("v"), F.avg("price_volatility").alias("p"),
        F.sum("trade_count").alias("n"))
    rnd6 = lambda x: None if x is None else round(x, 9)
    want = {(r.symbol, r.w.start, r.w.end): (r.o, r.c, rnd6(r.v), rnd6(r.p), r.n) for r in ref.collect()}
    got = {(r.symbol, r.period_start, r.period_end): (r.period_open, r.period_close, rnd6(r.period_vwap), rnd6(r.avg_volatility), r.total_trades) for r in g.collect()}
    assert got == want and len(got) > 50
    with pytest.raises(ValueError):
        market_analytics(candles, "15 minutes", "4 minutes")

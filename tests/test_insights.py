import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.insights import (
    market_direction, price_movements, price_movements_simple, sentiment_signals, signal_v1,
    signal_v2, volume_spikes, volume_spikes_simple,
)

SCHEMA = "symbol string, price double, volume double, event_time timestamp_ntz, kafka_offset long"
T0 = dt.datetime(2024, 1, 1)


def _ticks(spark, vols, symbol="A", step_s=1, prices=None):
    rows = [(symbol, (prices[i] if prices else 100.0), v, T0 + dt.timedelta(seconds=i * step_s), i)
            for i, v in enumerate(vols)]
    return spark.createDataFrame(rows, SCHEMA)


def test_spikes_history_and_multiplier(spark):
    # 9 ticks of history: nothing; the 10th has baseline over 10 values
    vols = [10.0] * 9 + [40.0]
    out = volume_spikes(_ticks(spark, vols), chunk_rows=4).collect()
    assert len(out) == 1 and out[0].volume == 40.0
    assert abs(out[0].volume_baseline - 13.0) < 1e-12
    # 9 ticks only: no baseline yet
    assert volume_spikes(_ticks(spark, vols[:9])).count() == 0


def test_spikes_zero_null_and_exact(spark):
    assert volume_spikes(_ticks(spark, [0.0] * 12)).count() == 0       # baseline 0 -> ratio 0
    vols = [None] * 9 + [1.0]                                          # null volume counts as 0
    out = volume_spikes(_ticks(spark, vols)).collect()
    assert len(out) == 1 and abs(out[0].spike_multiplier - 10.0) < 1e-12
    # multiplier exactly 1.5: baseline 2 over 10 values with current 3 -> (9x + 3)/10 = 2
    x = 17.0 / 9.0
    out = volume_spikes(_ticks(spark, [x] * 9 + [3.0])).collect()
    assert len(out) == 1 and out[0].spike_multiplier >= 1.5


def test_spikes_window_is_fifty_rows(spark):
    vols = [100.0] * 60 + [1.0] * 49 + [3.0]   # baseline = last 50 incl current = (49 + 3)/50
    out = volume_spikes(_ticks(spark, vols), chunk_rows=7).collect()
    last = [r for r in out if r.volume == 3.0]
    assert len(last) == 1 and abs(last[0].volume_baseline - 52.0 / 50.0) < 1e-12


def test_simple_spike(spark):
    assert volume_spikes_simple(_ticks(spark, [1_000_000.0, 1_000_001.0])).count() == 1


def test_moves_cutoff_and_cap(spark):
    # ticks at 0, 10, 20 minutes: at t=20 the tick at 0 is exactly 20 min old
    rows = [("A", p, 1.0, T0 + dt.timedelta(minutes=m), i) for i, (m, p) in enumerate([(0, 100.0), (10, 100.0), (20, 101.0)])]
    df = spark.createDataFrame(rows, SCHEMA)
    v2 = price_movements(df).collect()            # kept: 3 points, 1% move
    assert len(v2) == 1 and v2[0].window_start == T0 and abs(v2[0].price_change_pct - 1.0) < 1e-9
    v1 = price_movements_simple(df, min_points=2).collect()   # strict cutoff drops the 0-min tick
    last = [r for r in v1 if r.window_end == T0 + dt.timedelta(minutes=20)][0]
    assert last.window_start == T0 + dt.timedelta(minutes=10)
    # more than 100 ticks inside 20 minutes: the window is capped at 100 rows
    prices = [100.0] * 150 + [200.0]
    out = price_movements(_ticks(spark, [1.0] * 151, prices=prices), chunk_rows=37).collect()
    last = [r for r in out if r.window_end == T0 + dt.timedelta(seconds=150)][0]
    assert last.window_start == T0 + dt.timedelta(seconds=51)


def test_moves_threshold_exact(spark):
    prices = [1000.0, 1000.0, 1001.0]   # +0.1 % exactly -> emitted (>=)
    out = price_movements(_ticks(spark, [1.0] * 3, prices=prices)).collect()
    assert len(out) == 1
    prices = [1000.0, 1000.0, 1000.5]
    assert price_movements(_ticks(spark, [1.0] * 3, prices=prices)).count() == 0


def test_signal_rules(spark):
    cases = [(29, 1.0, 1.0), (30, -1.0, -1.0), (71, 1.0, 1.0), (29, -1.0, -1.0), (71, -1.0, -1.0),
             (44, 0.31, -1.0), (56, -0.31, 1.0), (50, 0.3, 0.3), (50, 0.31, 0.31), (50, 0.0, 0.0)]
    df = spark.createDataFrame(cases, "fg int, btc double, eth double")
    d = market_direction(F.col("btc"), F.col("eth"), 0.3)
    got = [r.s for r in df.select(signal_v2(F.col("fg"), d, F.col("btc")).alias("s")).collect()]
    assert got == ["REVERSAL_UP", "CORRELATION", "STRONG_SELL", "STRONG_BUY", "REVERSAL_DOWN",
                   "BUY_SIGNAL", "SELL_SIGNAL", "NEUTRAL", "CORRELATION", "NEUTRAL"]
    d0 = market_direction(F.col("btc"), F.col("eth"), 0.0)
    got = [r.s for r in df.select(signal_v1(F.col("fg"), d0).alias("s")).collect()]
    assert got[0] == "NEUTRAL" and got[3] == "NEUTRAL"
    v1 = spark.createDataFrame([(24, -1.0, -1.0), (76, 1.0, 1.0), (24, 1.0, 1.0)], "fg int, btc double, eth double")
    got = [r.s for r in v1.select(signal_v1(F.col("fg"), market_direction(F.col("btc"), F.col("eth"), 0.0))
                                  .alias("s")).collect()]
    assert got == ["BUY_SIGNAL", "SELL_SIGNAL", "REVERSAL_CONFIRMED"]


def test_sentiment_needs_five_points_and_prior_prices(spark):
    rows = []
    for sym, start in (("BTCUSDT", 100.0), ("ETHUSDT", 50.0)):
        for i in range(5):
            rows.append((sym, start * (1 + 0.01 * i), 1.0, T0 + dt.timedelta(minutes=i), len(rows)))
    ticks = spark.createDataFrame(rows, SCHEMA)
    s = spark.createDataFrame([
        ("x", 20, "Extreme Fear", T0 + dt.timedelta(minutes=3, seconds=30), 1),   # only 4 points yet
        ("x", 80, "Extreme Greed", T0 + dt.timedelta(minutes=4), 2),              # 5 points (tick at same time counts)
        ("x", 80, "Extreme Greed", T0 - dt.timedelta(minutes=1), 3),              # no price before it
    ], "type string, value long, classification string, event_time timestamp_ntz, msg_id long")
    out = sentiment_signals(s, ticks, minutes=20).collect()
    assert len(out) == 1 and out[0].fear_greed_index == 80 and out[0].correlation_signal == "STRONG_SELL"
    assert abs(out[0].btc_price_change - 4.0) < 1e-9

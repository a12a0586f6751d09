"""Missing prices, null polls and ticks at one time: what the windows do with them."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.insights import (
    correlation_state, price_movements, price_movements_simple, volume_spikes, volume_spikes_simple,
)
from tidemark.operators.quality import route_validated, validate_ohlc, validate_prices
from tidemark.operators.reports import cumcount, describe_tables, load_insights, store_insights
from tidemark.operators.serving import latest_price_semi, recent_movements
from tidemark.session import scratch_path
from tidemark.sources.decode import emit_on_change, route_malformed, split_malformed
from tidemark.sources.fixtures import trending_payloads, validation_bounds
from tidemark.schemas import PRICE_SCHEMA

T0 = dt.datetime(2024, 1, 1)
TICKS = "symbol string, price double, volume double, event_time timestamp_ntz, kafka_offset long"


def _ticks(spark, prices, volume=1.0, symbol="BTCUSDT", step=1):
    rows = [(symbol, p, volume, T0 + dt.timedelta(minutes=step * i), i) for i, p in enumerate(prices)]
    return spark.createDataFrame(rows, TICKS)


def test_null_price_takes_no_place_in_movement_windows(spark):
    prices = [100.0] * 6 + [None] + [100.0, 101.0, 100.0]
    got = {r.kafka_offset: r for r in price_movements(_ticks(spark, prices)).collect()}
    assert set(got) == {8}
    assert abs(got[8].avg_price - (8 * 100 - 100 + 101) / 8) < 1e-9 and got[8].volatility > 0
    same = price_movements(_ticks(spark, [100.0] * 5 + [None] + [100.0] * 5), threshold=0.0).collect()
    assert len(same) == 8 and {(r.avg_price, r.volatility) for r in same} == {(100.0, 0.0)}


def test_null_price_in_simple_movements_and_correlation_state(spark):
    t = _ticks(spark, [100.0] * 6 + [None] + [100.0] * 6)
    got = price_movements_simple(t, min_points=10).collect()
    assert {r.avg_price for r in got} == {100.0} and len(got) == 3
    state = {r.kafka_offset: r.n_points for r in correlation_state(t).collect()}
    assert 6 not in state and state[7] == 7 and state[12] == 10


def test_spike_without_price_counts_but_is_not_emitted(spark):
    rows = [("A", 1.0, 1.0, T0 + dt.timedelta(minutes=i), i) for i in range(12)]
    rows[11] = ("A", None, 500.0, rows[11][3], 11)
    rows.append(("A", 1.0, 500.0, T0 + dt.timedelta(minutes=12), 12))
    df = spark.createDataFrame(rows, TICKS)
    got = volume_spikes(df).collect()
    assert [r.price_at_spike for r in got] == [1.0] and abs(got[0].volume_baseline - 1011 / 13) < 1e-9
    assert volume_spikes_simple(df, 100.0).count() == 1


def test_second_null_poll_is_not_a_change(spark):
    polls = spark.createDataFrame([(1, T0, None, None), (2, T0 + dt.timedelta(hours=1), None, None),
                                   (3, T0 + dt.timedelta(hours=2), "5", "x")],
                                  "poll_id long, poll_time timestamp_ntz, value string, timestamp string")
    assert sorted(r.poll_id for r in emit_on_change(polls).collect()) == [1, 3]


def test_ties_are_ordered_by_offset(spark):
    prices = [100.0, 101.0, 102.0, 103.0, 104.0]
    rows = [("A", p, 1.0, T0 + dt.timedelta(minutes=min(i, 3)), i) for i, p in enumerate(prices)]
    moves = price_movements(spark.createDataFrame(rows, TICKS))
    assert [r.price_change_pct for r in recent_movements(moves, 2).collect()] == [4.0, 3.0]
    assert {r.kafka_offset: r.n for r in cumcount(moves, "window_end", "kafka_offset").collect()} == {2: 0, 3: 1, 4: 2}
    last = latest_price_semi(spark.createDataFrame(rows, TICKS).withColumn("price_change_percent", F.lit(0.0)))
    assert sorted(r.price for r in last.collect()) == [103.0, 104.0]


def test_routes_in_one_pass(spark):
    good = '{"symbol":"A","price":1.0,"volume":1.0,"timestamp":1}'
    df = spark.createDataFrame([(1, good), (2, good[:20]), (3, None)], "offset long, raw_json string")
    routed = {r.offset: (r.route, r.raw_text, r.price) for r in route_malformed(df, "raw_json", PRICE_SCHEMA).collect()}
    assert routed == {1: ("good", None, 1.0), 2: ("quarantine", good[:20], None), 3: ("quarantine", None, None)}
    ok, bad = split_malformed(df, "raw_json", PRICE_SCHEMA)
    assert ok.count() == 1 and bad.count() == 2 and bad.columns == ["offset", "raw_text"]
    rec = spark.createDataFrame([("BTCUSDT", 50.0, 1.0, 1, 0.0), ("X", None, 1.0, 1, 0.0)],
                                "symbol string, price double, volume double, timestamp long, price_change_percent double")
    v = route_validated(validate_prices(rec, validation_bounds(spark), "2024-01-31 00:00:00"))
    assert {r.symbol: r.route for r in v.collect()} == {"BTCUSDT": "valid", "X": "invalid"}


def test_vwap_rounding_is_no_warning(spark):
    rows = [("A", 10.0, 10.0, 10.0, 10.0, 3.0, 10.000000000000002), ("B", 10.0, 10.0, 10.0, 10.0, 3.0, 10.5)]
    c = spark.createDataFrame(rows, "symbol string, open double, high double, low double, close double, volume double, vwap double")
    got = {r.symbol: list(r.warnings) for r in validate_ohlc(c).collect()}
    assert got == {"A": [], "B": ["VWAP (10.500000) outside OHLC range [10.0, 10.0]"]}


def test_insight_tables_are_stored_and_loaded(spark):
    a = spark.createDataFrame([(T0 + dt.timedelta(hours=i), i) for i in (2, 0, 1)], "t timestamp_ntz, v int")
    root = scratch_path(spark, "t-insights")
    store_insights({"a": a}, root)
    back = load_insights(spark, root, {"a": "t"})["a"].collect()
    assert [r.v for r in back] == [0, 1, 2] and all(r.created_at for r in back)
    rows = describe_tables({"a": a, "none": a.where("false")}, {"a": "t", "none": "t"}, last=2).collect()
    assert [(r.table_name, r.nth, r.row_count) for r in sorted(rows, key=lambda r: r.nth)] == [("a", 1, 3), ("a", 2, 3)]
    assert '"v":2' in min(rows, key=lambda r: r.nth).row


def test_trending_list_is_as_long_as_asked(spark):
    got = trending_payloads(spark, "/root/testdata/sf0.01", 40).select(F.max(F.size("coins")).alias("n")).first()
    assert got.n > 15

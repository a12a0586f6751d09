import datetime as dt


from tidemark.operators.quality import (
    expectation_suite, quality_metric_rows, quality_metrics, validate_ohlc, validate_prices,
)
from tidemark.schemas import PRICE_SCHEMA
from tidemark.sources.decode import (
    dedup_seen_ids, emit_on_change, normalize_ticker, split_malformed,
)
from tidemark.sources.fixtures import validation_bounds

AS_OF = "2024-01-31 00:00:00"
AS_OF_MS = int(dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc).timestamp() * 1000)
REC = "symbol string, price double, volume double, timestamp long, price_change_percent double"


def test_validate_prices_rules(spark):
    rows = [
        ("BTCUSDT", None, 1.0, AS_OF_MS, None),             # missing price
        ("BTCUSDT", 0.0, 1.0, AS_OF_MS, None),              # price 0
        ("BTCUSDT", 10.0, -1.0, AS_OF_MS, None),            # volume -1
        ("btcusdt", 10.0, 1.0, AS_OF_MS, None),             # lower case -> upper, valid
        ("DOGEUSDT", 10.0, 1.0, AS_OF_MS, None),            # unknown symbol: flag only
        ("ETHUSDT", 10.0, 1.0, AS_OF_MS - 300_000, 50.0),   # exactly 5 min old, change exactly 50
        ("ETHUSDT", 10.0, 1.0, AS_OF_MS - 300_001, -50.5),  # stale and extreme
        ("ETHUSDT", 500.0, 95.0, AS_OF_MS, None),           # outside test bounds
    ]
    df = spark.createDataFrame(rows, REC)
    out = validate_prices(df, validation_bounds(spark), AS_OF).collect()
    assert not out[0].valid and out[0].errors == ["Schema validation failed: price missing"]
    assert not out[1].valid and "Price must be positive" in out[1].errors[0]
    assert not out[2].valid and "Volume cannot be negative" in out[2].errors[0]
    assert out[3].valid and out[3].symbol == "BTCUSDT" and out[3].warnings == []
    assert out[4].valid and out[4].unknown_symbol and out[4].warnings == []
    assert out[5].valid and out[5].warnings == []
    assert out[6].warnings == ["Stale data: 300s old", "Extreme price change: -50.5%"]
    assert out[7].warnings == ["Price 500.0 outside expected range [1.0, 200.0]",
                               "Volume 95.0 outside expected range [0.0, 90.0]"]
    m = quality_metrics(validate_prices(df, validation_bounds(spark), AS_OF)).first()
    assert m.total_records == 8 and m.invalid_records == 3 and m.valid_records == 5
    rows = quality_metric_rows(validate_prices(df, validation_bounds(spark), AS_OF), "t", AS_OF).collect()
    assert {r.metric_name for r in rows} == {"validity_rate", "warning_rate", "invalid_records"}
    assert all(r.status in ("PASS", "WARN", "FAIL") for r in rows)


def test_validate_ohlc_asymmetric(spark):
    c = spark.createDataFrame([(0.5, 2.0, 1.0, 2.5, 1.5, 1.0), (3.0, 2.0, 1.0, 0.5, 9.0, -1.0),
                               (1.5, 1.0, 2.0, 1.5, 1.5, 1.0)],
                              "open double, high double, low double, close double, vwap double, volume double")
    out = validate_ohlc(c).collect()
    assert out[0].valid and out[0].warnings == []          # open < low, close > high: not checked here
    assert not out[1].valid and out[1].errors == ["Negative volume"]
    assert len(out[1].warnings) == 3
    assert not out[2].valid and out[2].errors[0].startswith("High (1.0) < Low (2.0)")


def test_expectation_suite(spark):
    df = spark.createDataFrame([("A", 1.0), (None, None)], "symbol string, price double")
    out = {(r.expectation, r.column): (r.success, r.unexpected_count) for r in expectation_suite(df).collect()}
    assert out[("expect_column_values_to_not_be_null", "price")] == (False, 1)
    assert out[("expect_column_to_exist", "symbol")] == (True, 0)
    assert out[("expect_column_values_to_be_of_type", "price")] == (True, 0)


def test_json_edge_cases(spark):
    raw = spark.createDataFrame([
        (1, '{"s":"BTCUSDT","c":"43000.1","v":"1.5","P":"-0.5","h":"44000","l":"42000","E":1704067200000}'),
        (2, '{"s":"BTCUSDT","c":"abc","v":"","E":1704067200000}'),   # not numeric / empty / missing keys
        (3, '{"s":"BTCUSDT","c":"43'),                                # truncated
    ], "msg_id long, raw_json string")
    out = {r.msg_id: r for r in normalize_ticker(raw).collect()}
    assert out[1].price == 43000.1 and out[1].human_time == "2024-01-01T00:00:00"
    assert out[2].price is None and out[2].volume is None and out[2].high_24h is None
    assert out[3].symbol is None and out[3].price is None
    # a quoted number does not fit the typed price record: it is quarantined
    # with its raw text, like truncated or missing messages
    rec = spark.createDataFrame([(1, '{"symbol":"A","price":1.5}'), (2, '{"symbol":'), (3, None),
                                 (4, '{"symbol":"A","price":"1.0"}')], "offset long, raw_json string")
    good, bad = split_malformed(rec, "raw_json", PRICE_SCHEMA)
    assert sorted(r.offset for r in bad.collect()) == [2, 3, 4]
    assert good.first().price == 1.5 and good.first().volume is None


def test_dedup_first_wins_and_emit_on_change(spark):
    a = spark.createDataFrame([("x", 1, 5), ("x", 0, 9), ("y", 1, 1)], "id string, source_rank int, entry_id long")
    out = {r.id: (r.source_rank, r.entry_id) for r in dedup_seen_ids(a, ["source_rank", "entry_id"]).collect()}
    assert out == {"x": (0, 9), "y": (1, 1)}
    t = dt.datetime(2024, 1, 1)
    polls = spark.createDataFrame([
        (1, t, "10", "100"), (2, t + dt.timedelta(hours=1), "10", "100"),   # same: dropped
        (3, t + dt.timedelta(hours=2), "11", "100"), (4, t + dt.timedelta(hours=3), "11", "200"),
        (5, t + dt.timedelta(hours=4), "11", "200")],
        "poll_id long, poll_time timestamp_ntz, value string, timestamp string")
    kept = [r.poll_id for r in emit_on_change(polls).orderBy("poll_id").collect()]
    assert kept == [1, 3, 4]


def test_freshness_and_completeness(spark):
    from tidemark.operators.quality import check_completeness, check_freshness
    t = dt.datetime(2024, 1, 31)
    df = spark.createDataFrame([("BTCUSDT", t - dt.timedelta(minutes=5)), ("ETHUSDT", t - dt.timedelta(hours=2))],
                               "symbol string, event_time timestamp_ntz")
    f = check_freshness(df, AS_OF).first()
    assert f.age_seconds == 300.0 and f.fresh                       # exactly 5 minutes is still fresh
    c = {r.symbol: r.has_recent_data for r in check_completeness(df, spark, AS_OF).collect()}
    assert c == {"BTCUSDT": True, "ETHUSDT": False, "BNBUSDT": False}


def test_validate_record_alias(spark):
    from tidemark.operators.quality import validate_record
    df = spark.createDataFrame([("BTCUSDT", 10.0, 1.0, AS_OF_MS, None)], REC)
    assert validate_record(df, validation_bounds(spark), AS_OF).first().valid

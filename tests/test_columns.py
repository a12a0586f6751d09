from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions.timecols import epoch_ms_to_iso


def test_split_symbol_and_names(spark):
    df = spark.createDataFrame([(s,) for s in ["ETHBTC", "BTCUSDT", "XUSD", "USDTUSDT", "FOO"]], "symbol string")
    base, quote = C.split_symbol("symbol")
    rows = {r.symbol: r for r in df.select("symbol", base.alias("b"), quote.alias("q"),
                                           C.currency_name().alias("n"), C.market_tier().alias("t")).collect()}
    assert (rows["ETHBTC"].b, rows["ETHBTC"].q) == ("ETH", "BTC")
    assert (rows["BTCUSDT"].b, rows["BTCUSDT"].q) == ("BTC", "USDT")
    assert (rows["XUSD"].b, rows["XUSD"].q) == ("X", "USD")
    # REPLACE removes every occurrence, not just the suffix
    assert (rows["USDTUSDT"].b, rows["USDTUSDT"].q) == ("", "USDT")
    assert (rows["FOO"].b, rows["FOO"].q) == ("FOO", "UNKNOWN")
    assert rows["BTCUSDT"].n == "Bitcoin" and rows["FOO"].n == "Unknown"
    assert rows["BTCUSDT"].t == "TIER_1" and rows["FOO"].t == "TIER_3"


def test_trend_and_volume_signal(spark):
    vals = [2.5, 2.0, 0.6, 0.5, 0.0, -0.5, -0.6, -2.0, -2.1, None]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    got = [r.s for r in df.select(C.trend_signal("p").alias("s")).collect()]
    assert got == ["STRONG_BULLISH", "BULLISH", "BULLISH", "NEUTRAL", "NEUTRAL", "NEUTRAL",
                   "BEARISH", "BEARISH", "STRONG_BEARISH", "NEUTRAL"]
    v = spark.createDataFrame([(1_000_000.0,), (1_000_000.5,)], "v double")
    assert [r.s for r in v.select(C.volume_signal("v").alias("s")).collect()] == ["NORMAL_VOLUME", "HIGH_VOLUME"]


def test_sentiment_zone_and_label(spark):
    df = spark.createDataFrame([(v,) for v in [0, 29, 30, 44, 45, 54, 55, 69, 70, 100]], "v int")
    got = [r.z for r in df.select(C.sentiment_zone("v").alias("z")).collect()]
    assert got == ["Extreme Fear", "Extreme Fear", "Fear", "Fear", "Neutral", "Neutral", "Greed",
                   "Greed", "Extreme Greed", "Extreme Greed"]
    lab = spark.createDataFrame([("Fear",), ("Whatever",), (None,)], "c string")
    assert [r.l for r in lab.select(C.sentiment_label("c").alias("l")).collect()] == [
        "[FEAR]", "[UNKNOWN]", "[UNKNOWN]"]


def test_flags(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, 50.0), (1.0, 1.0, 50.01), (0.0, 1.0, None), (1.0, -1.0, None), (1.0, 1.0, None)],
        "price double, volume double, price_change_percent double")
    assert [r.a for r in df.select(C.flag_anomaly().alias("a")).collect()] == [False, True, True, True, False]
    c = spark.createDataFrame([(0.5, 2.0, 1.0, 1.5), (1.5, 2.0, 1.0, 1.5), (None, 2.0, 1.0, None)],
                              "open double, high double, low double, close double")
    out = c.select(C.flag_ohlc_integrity().alias("i"), C.candle_type().alias("t")).collect()
    assert [r.i for r in out] == [True, False, False]
    assert [r.t for r in out] == ["BULLISH", "DOJI", "DOJI"]


def test_position_surrogate_iso(spark):
    df = spark.createDataFrame([(5.0, 10.0, 0.0), (5.0, 1.0, 1.0)], "price double, high_24h double, low_24h double")
    assert [r.p for r in df.select(C.position_in_range().alias("p")).collect()] == [50.0, 50.0]
    k = spark.createDataFrame([("A", None)], "a string, b string").select(C.surrogate_key("a", "b").alias("k"))
    import hashlib
    assert k.first().k == hashlib.md5(b"A-_dbt_utils_surrogate_key_null_").hexdigest()
    iso = spark.createDataFrame([(1704067200000,), (1704067200123,)], "ms long").select(
        epoch_ms_to_iso("ms").alias("s")).collect()
    assert [r.s for r in iso] == ["2024-01-01T00:00:00", "2024-01-01T00:00:00.123000"]


def test_safe_ratio_no_ansi_error(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0)], "x double, y double")
    assert [r.r for r in df.select(C.safe_ratio("x", "y").alias("r")).collect()] == [None, 0.5]
    assert df.select(F.lit(1)).count() == 2

"""The chunked plans against brute force, with tiny buckets and chunks so
that halos and carries cross many boundaries."""

import random
import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.plans.asof import asof_latest
from tidemark.plans.chunked import (
    PART, SEQ, drop_halo, lag_by_key, range_frame, row_halo, row_sequence,
)

SCHEMA = "symbol string, event_time timestamp_ntz, kafka_offset long, price double"


def _data(spark, n=400, seed=7, ties=True):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        sec = rnd.randint(0, 6 * 3600)
        if ties and i % 17 == 0 and rows:
            t = rows[-1][1]
        else:
            t = base + dt.timedelta(seconds=sec, microseconds=rnd.randint(0, 999999))
        rows.append((rnd.choice(["A", "B", "C"]), t, i, float(rnd.randint(1, 1000)) / 10))
    return rows, spark.createDataFrame(rows, SCHEMA)


import pytest  # noqa: E402


@pytest.mark.parametrize("reuse", [False, True])
def test_row_sequence_and_halo(spark, reuse):
    rows, df = _data(spark)
    seq = row_sequence(df, ["symbol"], "event_time", [F.col("event_time"), F.col("kafka_offset")],
                       bucket_seconds=600, reuse_input=reuse)
    naive = df.withColumn("rn", F.row_number().over(
        Window.partitionBy("symbol").orderBy("event_time", "kafka_offset")))
    j = seq.join(naive, ["symbol", "kafka_offset"])
    assert j.filter(F.col(SEQ) != F.col("rn")).count() == 0
    h = row_halo(seq, 4, chunk_rows=13)
    w = Window.partitionBy("symbol", PART).orderBy(SEQ).rowsBetween(-4, 0)
    got = drop_halo(h.withColumn("s5", F.sum("price").over(w)))
    ref = df.withColumn("s5", F.sum("price").over(
        Window.partitionBy("symbol").orderBy("event_time", "kafka_offset").rowsBetween(-4, 0)))
    a = {r.kafka_offset: round(r.s5, 6) for r in got.collect()}
    b = {r.kafka_offset: round(r.s5, 6) for r in ref.collect()}
    assert a == b


@pytest.mark.parametrize("reuse", [False, True])
def test_lag_by_key(spark, reuse):
    rows, df = _data(spark)
    got = lag_by_key(df, ["symbol"], "event_time", [F.col("event_time"), F.col("kafka_offset")],
                     ["price"], bucket_seconds=300, reuse_input=reuse)
    ref = df.withColumn("p", F.lag("price").over(Window.partitionBy("symbol").orderBy("event_time", "kafka_offset")))
    a = {r.kafka_offset: r.prev_price for r in got.collect()}
    b = {r.kafka_offset: r.p for r in ref.collect()}
    assert a == b


def _brute_range(rows, lookback, strict, peers):
    out = {}
    for s, t, k, p in rows:
        lo = t - dt.timedelta(seconds=lookback)
        win = [(tt, kk, pp) for ss, tt, kk, pp in rows if ss == s
               and (tt > lo if strict else tt >= lo)
               and ((tt <= t) if peers else ((tt, kk) <= (t, k)))]
        first = min(win)
        out[k] = (max(x[2] for x in win), min(x[2] for x in win), first[2], len(win),
                  round(sum(x[2] for x in win), 6))
    return out


def test_range_frame_vs_brute_force(spark):
    rows, df = _data(spark, n=300)
    for lookback, bucket, strict, peers in [(3600, 600, False, True), (1200, 1200, True, False),
                                             (1800, 300, False, False)]:
        got = range_frame(df, ["symbol"], "event_time", "kafka_offset", "price", lookback, bucket,
                          strict=strict, peers=peers).collect()
        a = {r.kafka_offset: (r._rf.max, r._rf.min, r._rf.first, r._rf["count"], round(r._rf.sum, 6))
             for r in got}
        assert a == _brute_range(rows, lookback, strict, peers), (lookback, bucket, strict, peers)


def test_asof_latest_vs_brute_force(spark):
    rows, df = _data(spark, n=300, ties=False)
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    left = [(i, rnd.choice(["A", "B", "C"]), base + dt.timedelta(seconds=rnd.randint(-600, 7 * 3600)))
            for i in range(80)]
    L = spark.createDataFrame(left, "id long, symbol string, t timestamp_ntz")
    got = asof_latest(L, df, ["symbol"], "t", "event_time", [F.col("event_time"), F.col("kafka_offset")],
                      F.struct("price"), out="m", bucket_seconds=900).collect()
    a = {r.id: (r.m.price if r.m is not None else None) for r in got}
    b = {}
    for i, s, t in left:
        cands = [(tt, kk, pp) for ss, tt, kk, pp in rows if ss == s and tt <= t]
        b[i] = max(cands)[2] if cands else None
    assert a == b


def test_chunk_knobs_do_not_change_results(spark):
    from tidemark.operators.insights import volume_spikes
    from tidemark.sources.fixtures import base_ticks
    t = base_ticks(spark, "/root/testdata/sf0.001")
    ref = sorted(tuple(r) for r in volume_spikes(t).collect())
    spark.conf.set("spark.tidemark.chunkRows", "37")
    spark.conf.set("spark.tidemark.bucketSeconds", "600")
    try:
        got = sorted(tuple(r) for r in volume_spikes(t).collect())
    finally:
        spark.conf.unset("spark.tidemark.chunkRows")
        spark.conf.unset("spark.tidemark.bucketSeconds")
    assert got == ref and len(ref) > 0


def test_sequence_groups_follow_the_rows(spark):
    """Nine of ten rows in one hour of one symbol: no group sorts that hour whole."""
    import datetime as dt

    from pyspark.sql import functions as F

    from tidemark.plans.chunked import SEQ, density_chunks, row_sequence
    t0 = dt.datetime(2024, 1, 1)
    burst = [("A", t0 + dt.timedelta(seconds=i * 3600 / 1800), i) for i in range(1800)]
    rest = [("AB"[i % 2], t0 + dt.timedelta(hours=2 + i), 5000 + i) for i in range(200)]
    df = spark.createDataFrame(burst + rest, "k string, t timestamp_ntz, i long")
    groups = density_chunks(df, ["k"], "t", rows=100).groupBy("k", "_chunk").count().collect()
    assert max(r["count"] for r in groups) <= 100 + 30 and len(groups) > 15  # a slice of a minute holds 30
    order = [F.col("t"), F.col("i")]
    try:
        spark.conf.set("spark.tidemark.sortRows", "100")
        a = {(r.k, r.i): r[SEQ] for r in row_sequence(df, ["k"], "t", order).collect()}
    finally:
        spark.conf.unset("spark.tidemark.sortRows")
    for k in "AB":
        want = [i for x, t, i in sorted(burst + rest, key=lambda r: (r[1], r[2])) if x == k]
        assert [a[k, i] for i in want] == list(range(1, len(want) + 1))


def test_candle_order_is_a_hash_aggregate(spark):
    import datetime as dt

    from tidemark.operators.candles import ohlc_candles
    t0 = dt.datetime(2024, 1, 1)
    rows = [("A", float(p), 1.0, t0 + dt.timedelta(seconds=s), o) for p, s, o in [(1, 0, 7), (2, 0, 3), (3, 5, 1), (4, 5, 10**17)]]
    df = spark.createDataFrame(rows, "symbol string, price double, volume double, event_time timestamp_ntz, kafka_offset long")
    c = ohlc_candles(df)
    assert "SortAggregate" not in c._jdf.queryExecution().executedPlan().toString()
    r = c.first()
    assert (r.open, r.close) == (2.0, 4.0)


@pytest.mark.parametrize("max_rows,seconds,strict,chunk", [(5, 900, False, 13), (5, 900, True, 13), (100, 1200, False, 7), (3, 60, True, 50), (1, 600, False, 2)])
def test_two_bound_frame_vs_brute_force(spark, max_rows, seconds, strict, chunk):
    from tidemark.plans.frames import two_bound_frame
    rows, df = _data(spark, n=300)
    base = dt.datetime(2024, 1, 1)
    extra = [("D", base + dt.timedelta(seconds=60 * (k // 3)), 1000 + k, float(k % 5)) for k in range(60)]  # ties, rows at the cutoff
    rows = rows + extra
    df = df.unionByName(spark.createDataFrame(extra, SCHEMA))
    seq = row_sequence(df, ["symbol"], "event_time", [F.col("event_time"), F.col("kafka_offset")], bucket_seconds=600)
    got = two_bound_frame(row_halo(seq, max_rows - 1, chunk), ["symbol"], "event_time", "price", max_rows, seconds, strict).collect()
    assert len(got) == len(rows)
    for r in got:
        past = sorted(x[1:] for x in rows if x[0] == r.symbol and (x[1], x[2]) <= (r.event_time, r.kafka_offset))[-max_rows:]
        low = r.event_time - dt.timedelta(seconds=seconds)
        win = [x for x in past if (x[0] > low if strict else x[0] >= low)]
        mean = sum(x[2] for x in win) / len(win)
        assert (r._fr.n, r._fr.first_time, r._fr.first) == (len(win), win[0][0], win[0][2])
        assert r._fr.mean == pytest.approx(mean) and r._fr.m2 == pytest.approx(sum((x[2] - mean) ** 2 for x in win), abs=1e-7)


def test_price_movements_hold_no_lists(spark):
    from tidemark.operators.insights import asof_sentiment_prices, price_movements
    from tidemark.sources.fixtures import base_ticks
    t = base_ticks(spark, "/root/testdata/sf0.001")
    assert "collect_list" not in price_movements(t)._jdf.queryExecution().optimizedPlan().toString()
    s = spark.createDataFrame([], "msg_id string, event_time timestamp_ntz, value int, classification string")
    assert "collect_list" not in asof_sentiment_prices(s, t)._jdf.queryExecution().optimizedPlan().toString()


def _burst(spark, n=240):
    """A third of all rows in one minute of one symbol, most of those at a single instant; null keys, ties and times."""
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    rows = [(rnd.choice(["A", "B", None]), base + dt.timedelta(seconds=rnd.randint(0, 3 * 3600)), i, rnd.randint(1, 500) / 10) for i in range(n)]
    minute = base + dt.timedelta(seconds=5400)
    rows += [("A", minute + dt.timedelta(milliseconds=rnd.choice([0, 0, 0, 7, 31000])), 1000 + i, rnd.randint(1, 500) / 10) for i in range(n // 2)]
    rows += [("A", minute - dt.timedelta(seconds=3600), 3000 + i, rnd.randint(1, 500) / 10) for i in range(30)]
    return rows, spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def few_rows(spark):
    spark.conf.set("spark.tidemark.sortRows", "10")
    yield 10
    spark.conf.unset("spark.tidemark.sortRows")


def test_slices_spread_a_burst(spark, few_rows):
    """Rows per (key, slice): a minute and even an instant that holds a third of all rows is many slices' work, in order."""
    from tidemark.plans.slices import SLICE, slices_of, with_slice
    rows, df = _burst(spark)
    s = slices_of(df, ["symbol"], "event_time", "kafka_offset", spread_untied=False)
    got = with_slice(df, s, "event_time", "kafka_offset", free_first=True)
    assert s.cut and got.count() == len(rows)
    sizes = [r["count"] for r in got.groupBy("symbol", SLICE).count().collect()]
    assert max(sizes) <= 3 * few_rows and len(sizes) > len(rows) / 30
    at = {}
    for r in got.collect():
        at.setdefault(r.symbol, []).append((r.event_time, r.kafka_offset, r[SLICE]))
    for line in at.values():
        numbers = [x[2] for x in sorted(line)]
        assert numbers == sorted(numbers)


def test_burst_lag(spark, few_rows):
    rows, df = _burst(spark)
    order = [F.col("event_time"), F.col("kafka_offset")]
    got = lag_by_key(df, ["symbol"], "event_time", order, ["price"], tie_col="kafka_offset")
    ref = df.withColumn("p", F.lag("price").over(Window.partitionBy("symbol").orderBy(*order)))
    assert {r.kafka_offset: r.prev_price for r in got.collect()} == {r.kafka_offset: r.p for r in ref.collect()}
    nulls = df.withColumn("kafka_offset", F.when(F.col("kafka_offset") != 1003, F.col("kafka_offset")))  # sorts first at its instant
    got = lag_by_key(nulls, ["symbol"], "event_time", order, ["price"], tie_col="kafka_offset")
    ref = nulls.withColumn("p", F.lag("price").over(Window.partitionBy("symbol").orderBy(*order)))
    assert {r.kafka_offset: r.prev_price for r in got.collect()} == {r.kafka_offset: r.p for r in ref.collect()}


@pytest.mark.parametrize("lookback,bucket,strict,peers", [(3600, 600, False, True), (3600, 3600, True, False), (1800, 300, False, False), (7200, 3600, False, True)])
def test_burst_range_frame(spark, few_rows, lookback, bucket, strict, peers):
    rows, df = _burst(spark)
    got = range_frame(df, ["symbol"], "event_time", "kafka_offset", "price", lookback, bucket, strict=strict, peers=peers)
    assert "_slice" in got._jdf.queryExecution().optimizedPlan().toString()
    a = {r.kafka_offset: (r._rf.max, r._rf.min, r._rf.first, r._rf["count"], round(r._rf.sum, 6)) for r in got.collect()}
    assert a == _brute_range(rows, lookback, strict, peers)


def test_burst_asof(spark, few_rows):
    rows, df = _burst(spark)
    base = dt.datetime(2024, 1, 1)
    rnd = random.Random(5)
    left = [(i, rnd.choice(["A", "B", "Z", None]), base + dt.timedelta(seconds=rnd.choice([5400, 5399, 5401, rnd.randint(-600, 4 * 3600)]))) for i in range(150)]
    L = spark.createDataFrame(left, "id long, symbol string, t timestamp_ntz")
    got = asof_latest(L, df, ["symbol"], "t", "event_time", [F.col("event_time"), F.col("kafka_offset")], F.struct("kafka_offset"),
                      out="m", tie_col="kafka_offset")
    a = {r.id: (r.m.kafka_offset if r.m is not None else None) for r in got.collect()}
    for i, s, t in left:
        assert a[i] == max(((tt, kk) for ss, tt, kk, _ in rows if ss == s and tt <= t), default=(None, None))[1]


def test_one_slice_per_key_is_the_plain_window(spark):
    rows, df = _data(spark)
    order = [F.col("event_time"), F.col("kafka_offset")]
    lagged = lag_by_key(df, ["symbol"], "event_time", order, ["price"], tie_col="kafka_offset")
    assert lagged._jdf.queryExecution().optimizedPlan().toString().count("Window") == 1 and "Join" not in str(lagged._jdf.queryExecution().optimizedPlan())
    ref = df.withColumn("p", F.lag("price").over(Window.partitionBy("symbol").orderBy(*order)))
    assert {r.kafka_offset: r.prev_price for r in lagged.collect()} == {r.kafka_offset: r.p for r in ref.collect()}

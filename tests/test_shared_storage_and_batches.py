"""Shared storage, layer discovery, compaction, and streams over many micro-batches."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators.insights import correlation_state, price_movements
from tidemark.operators.maintenance import compact_table, register_layer_views
from tidemark.session import drop_scratch, path_exists, scratch_path
from tidemark.streaming.medallion import start_all
from tidemark.streaming.monitor import batch_table, collect_progress, logged_stream
from tidemark.streaming.sources import replay_as_files, sink_console
from tidemark.streaming.stateful import (
    Fanout, SentimentJoin, TailCarry, carried_tail, read_batches, run_tail_carry,
)

T0 = dt.datetime(2024, 1, 1)
TICKS = "symbol string, price double, volume double, event_time timestamp_ntz, kafka_offset long"


class _NoFolder:
    """A session on a cluster without the shared folder."""

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():  # noqa: N802
            return None

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return default


def test_unset_folder_on_a_cluster_is_an_error():
    with pytest.raises(RuntimeError):
        session.shared_dir(_NoFolder)
    assert session.is_local("local[4]") and not session.is_local("local-cluster[3,2,1000]") and not session.is_local("yarn")


def test_layer_on_the_default_file_system_is_found(spark, monkeypatch):
    path = scratch_path(spark, "t-layer")
    spark.range(3).write.parquet(path)
    monkeypatch.setattr(os.path, "exists", lambda p: False)  # only Spark's own file system counts
    assert register_layer_views(spark, {"v_layer": path, "v_none": path + "-no"}) == ["v_layer"]


def test_scratch_is_dropped(spark, monkeypatch):
    monkeypatch.setattr(session, "_scratch", [])
    path = scratch_path(spark, "t-scratch")
    spark.range(3).write.parquet(path)
    assert path_exists(spark, path) and drop_scratch(spark) == 1 and not path_exists(spark, path)


def test_compaction_compares_rows(spark, monkeypatch):
    src = scratch_path(spark, "t-rows")
    spark.range(100).selectExpr("cast(id % 2 as string) AS symbol", "id").repartition(9).write.partitionBy("symbol").parquet(src)
    from tidemark.operators import maintenance
    seen = iter([(100, 1), (100, 2)])  # same count, other rows
    monkeypatch.setattr(maintenance, "_fingerprint", lambda df, cols: next(seen))
    with pytest.raises(RuntimeError):
        compact_table(spark, src)
    assert maintenance.read_table(spark, src).count() == 100


def _visible_files(df):
    return {r[0]: r[1] for r in df.select("_metadata.file_path", "_metadata.file_size").distinct().collect()}


def test_compaction_switches_readers_at_once_and_leaves_large_files(spark, monkeypatch):
    from tidemark.operators import maintenance
    src = scratch_path(spark, "t-switch")
    rows = spark.range(3000).selectExpr("CASE WHEN id % 7 = 0 THEN NULL ELSE concat('a b/', id % 2) END AS symbol", "id", "uuid() AS filler").persist()
    rows.where("id < 2000").repartition(1).write.partitionBy("symbol").parquet(src)  # large files
    large = set(_visible_files(maintenance.read_table(spark, src)))
    rows.where("id >= 2000").repartition(12).write.mode("append").partitionBy("symbol").parquet(src)
    want = sorted(map(tuple, rows.collect()), key=str)
    small = 1 + max(s for f, s in _visible_files(maintenance.read_table(spark, src)).items() if f not in large)
    seen, point = [], maintenance._point

    def watch(*a):  # a reader before and after every change of the pointer
        seen.append(sorted(map(tuple, maintenance.read_table(spark, src).select("symbol", "id", "filler").collect()), key=str))
        point(*a)
        seen.append(sorted(map(tuple, maintenance.read_table(spark, src).select("symbol", "id", "filler").collect()), key=str))
    monkeypatch.setattr(maintenance, "_point", watch)
    out = compact_table(spark, src, small=small)
    assert len(seen) == 4 and all(s == want for s in seen)
    files = _visible_files(out)
    assert large <= set(files) and len(files) == len(large) + 3
    # rows appended later are seen at once; a second run packs what is small by then
    monkeypatch.setattr(maintenance, "_point", point)
    rows.where("id < 30").repartition(3).write.mode("append").partitionBy("symbol").parquet(src)
    assert maintenance.read_table(spark, src).count() == 3030
    out = compact_table(spark, src, small=small)
    assert out.count() == 3030 and large <= set(_visible_files(out))
    assert maintenance.remove_hidden(spark, src) > 36 and maintenance.read_table(spark, src).count() == 3030
    assert spark.read.parquet(src).count() == 3030  # nothing is hidden any more
    assert _visible_files(compact_table(spark, src, small=1)) == _visible_files(out)  # nothing small: nothing done
    rows.unpersist()


def test_bins_fill_the_target(spark):
    from tidemark.operators.maintenance import small_file_bins
    files = spark.createDataFrame([("a", f"p{i}", 40) for i in range(6)] + [("b", "q", 40), (None, "r0", 1), (None, "r1", 1)],
                                  "symbol string, path string, size long")
    got = {}
    for r in small_file_bins(files, "symbol", 100).collect():
        got.setdefault((r.path[0], r.bin), set()).add(r.path)
    assert sorted(map(sorted, got.values())) == [["p0", "p1", "p2"], ["p3", "p4"], ["r0", "r1"]]


def test_last_rows_follow_the_stream(spark):
    from tidemark.operators.serving import latest_price_semi
    from tidemark.streaming.last_rows import LastRows
    schema = TICKS + ", price_change_percent double"
    t = lambda m: T0 + dt.timedelta(minutes=m)
    batches = [[("A", 1.0, 1.0, t(1), 1, 0.1), ("B", 2.0, 1.0, t(1), 2, None)], [("A", 3.0, 1.0, t(5), 3, 0.1), (None, 3.0, 1.0, t(9), 3, 0.1)],
               [("A", 4.0, 1.0, t(5), 4, 0.1)],  # a tie across batches
               [("B", 9.0, 1.0, t(0), 5, 0.1)],  # late: changes nothing
               [("C", 1.0, None, t(2), 6, 0.1), ("A", 1.0, 1.0, None, 7, 0.1)], []] + [[("D", float(k), 1.0, t(k), 10 + k, 0.0)] for k in range(9)]
    table = LastRows(spark, scratch_path(spark, "t-last"), fan=3)
    every = spark.createDataFrame([r for b in batches for r in b], schema)
    for n, b in enumerate(batches):
        table(spark.createDataFrame(b, schema), n)
        if n == 2:
            table(spark.createDataFrame(b, schema), n)  # a retry
    key = lambda df: sorted(map(tuple, latest_price_semi(df).collect()), key=str)
    assert key(table.last()) == key(every) and len(key(every)) == 5
    assert table.read().count() < 12  # merges keep the newest rows only


def test_every_batch_is_counted(spark):
    """More batches than a query's own progress memory holds (made short here)."""
    src = scratch_path(spark, "t-many")
    spark.range(0, 12, 1, 12).write.parquet(src)
    out, log, ck = (scratch_path(spark, f"t-many-{x}") for x in ("out", "log", "ck"))
    s = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(src)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    try:
        q = logged_stream(s, out, log, ck)
        q.awaitTermination()
        assert len(q.recentProgress) <= 5
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    got = batch_table(spark, log).agg(F.sum("num_input_rows").alias("n"), F.count(F.lit(1)).alias("b")).first()
    assert (got.n, got.b) == (12, 12)


def test_listener_and_console_rows(spark, capsys):
    src = scratch_path(spark, "t-rows")
    spark.range(100).coalesce(1).write.parquet(src)
    seen = collect_progress(spark)
    try:
        sink_console(spark.readStream.schema("id long").parquet(src), scratch_path(spark, "t-rows-ck"), rows=3).awaitTermination()
        for _ in range(50):
            if seen.rows:
                break
            time.sleep(0.1)
        assert sum(r[2] for r in seen.rows) == 100
    finally:
        spark.streams.removeListener(seen)
    shown = [x for x in capsys.readouterr().out.splitlines() if x.startswith("|")]
    assert len(shown) == 4  # the header and three rows


def test_replay_keeps_time_order_and_null_times(spark):
    rows = [(T0 + dt.timedelta(minutes=(i * 37) % 200), i) for i in range(200)] + [(None, 999)]
    src = scratch_path(spark, "t-replay")
    replay_as_files(spark.createDataFrame(rows, "t timestamp_ntz, i int"), src, "t", 5, fmt="parquet")
    files = sorted((os.path.join(src, f) for f in os.listdir(src) if f.startswith("part-")), key=os.path.getmtime)
    spans = [spark.read.parquet(f).agg(F.min("t"), F.max("t")).first() for f in files]
    spans = [s for s in spans if s[0] is not None]
    assert len(files) >= 4 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert spark.read.parquet(src).count() == 201


def test_missing_tail_is_an_error(spark):
    root = scratch_path(spark, "t-no-tail")
    assert carried_tail(spark, root, 0) is None
    with pytest.raises(RuntimeError):
        carried_tail(spark, root, 3)


def _stream(spark, parts=5, n=100):
    rows = [("BTCUSDT" if i % 2 else "ETHUSDT", None if i % 13 == 5 else 100.0 + (i * 7) % 11, 1.0, T0 + dt.timedelta(minutes=i), i)
            for i in range(n)]
    df = spark.createDataFrame(rows, TICKS)
    src = scratch_path(spark, "t-ticks")
    replay_as_files(df, src, "event_time", parts, fmt="parquet")
    return df, spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(src)


def test_moves_over_many_batches_equal_the_batch_answer(spark):
    df, s = _stream(spark)
    out, st, ck = (scratch_path(spark, f"t-mv-{x}") for x in ("out", "st", "ck"))
    h = TailCarry(lambda t, carry: price_movements(t, carry=carry), 99, out, st, required=["price"])
    run_tail_carry(s, h, ck).awaitTermination()
    got = read_batches(spark, out)
    assert got.select("batch_id").distinct().count() >= 4
    key = lambda r: (r.symbol, r.kafka_offset, round(r.avg_price, 9), round(r.volatility, 9))
    want = sorted(map(key, price_movements(df).collect()))
    assert sorted(map(key, got.collect())) == want and len(want) > 20


def test_sentiment_join_prunes_days_and_survives_null_times(spark):
    df, s = _stream(spark)
    states, tails, days, out = (scratch_path(spark, f"t-sj-{x}") for x in ("states", "tails", "days", "out"))
    h = TailCarry(lambda t, carry: correlation_state(t, carry=carry), 9, states, tails, summary_path=days,
                  required=["price"], by_day=True)
    run_tail_carry(s, Fanout(h), scratch_path(spark, "t-sj-ck")).awaitTermination()
    os.makedirs(f"{states}/_part=b77")  # an unfinished folder
    schema = "msg_id long, event_time timestamp_ntz, value long, classification string"
    join = SentimentJoin(states, days, out)
    join(spark.createDataFrame([(1, T0 + dt.timedelta(minutes=90), 10, "x")], schema), 0)
    join(spark.createDataFrame([(2, None, 10, "x")], schema), 1)
    assert "day=2024-01-01" in os.listdir(f"{states}/_part=b0")
    assert path_exists(spark, f"{out}/_part=b1/_SUCCESS") and read_batches(spark, out).where("batch_id = 1").count() == 0
    assert len(os.listdir(tails)) == 2  # older tails are gone


def test_queries_run_together_and_stop_together(spark):
    src = scratch_path(spark, "t-together")
    spark.range(5).write.parquet(src)
    stream = spark.readStream.schema("id long").parquet(src)
    spark.streams.resetTerminated()

    def start(name, **trigger):
        return (stream.writeStream.format("parquet").option("path", scratch_path(spark, name))
                .option("checkpointLocation", scratch_path(spark, f"{name}-ck")).trigger(**trigger).start())
    lasting = start("t-lasting", processingTime="1 second")
    once = start("t-once", availableNow=True)
    start_all([lasting, once])
    assert not lasting.isActive and not once.isActive
    spark.streams.resetTerminated()

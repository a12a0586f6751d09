import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tidemark.operators.insights import volume_spikes
from tidemark.session import scratch_path
from tidemark.streaming.medallion import bronze_stream, silver_stream
from tidemark.streaming.sources import KAFKA_RECORD_SCHEMA, read_stream, sink_table_append
from tidemark.streaming.stateful import TailCarry, run_tail_carry

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def _record(i, symbol, minute, price=1.0, volume=1.0):
    ms = int((T0 + dt.timedelta(minutes=minute)).timestamp() * 1000)
    value = json.dumps({"symbol": symbol, "price": price, "volume": volume, "timestamp": ms})
    return {"key": symbol, "value": value, "topic": "crypto-prices", "partition": 0, "offset": i,
            "timestamp": "2024-01-01T00:00:00.000Z", "timestampType": 0}


def _write(folder, name, recs):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n")


def _run(spark, df, out, ck):
    sink_table_append(df, out, ck).awaitTermination()
    return spark.read.parquet(out)


def test_late_row_dropped_by_silver_kept_by_bronze(spark):
    src = scratch_path(spark, "t-late")
    _write(src, "a.json", [_record(0, "A", 0), _record(1, "A", 30)])
    b_out, b_ck = scratch_path(spark, "b"), scratch_path(spark, "bck")
    s_out, s_ck = scratch_path(spark, "s"), scratch_path(spark, "sck")
    stream = lambda: read_stream(spark, "json", path=src, schema=KAFKA_RECORD_SCHEMA)
    _run(spark, bronze_stream(stream()), b_out, b_ck)
    _run(spark, silver_stream(bronze_stream(stream(), watermark=None)), s_out, s_ck)
    # a row 20 minutes behind the watermark (30 - 5 min) arrives later
    _write(src, "b.json", [_record(2, "A", 10), _record(3, "A", 60)])
    bronze = _run(spark, bronze_stream(stream()), b_out, b_ck)
    silver = _run(spark, silver_stream(bronze_stream(stream(), watermark=None)), s_out, s_ck)
    assert bronze.count() == 4                                   # nothing dropped, nothing repeated
    starts = sorted(str(r.window_start) for r in silver.collect())
    assert "2024-01-01 00:10:00" not in starts                   # late row dropped by the windowed agg
    assert starts == ["2024-01-01 00:00:00", "2024-01-01 00:30:00"]


def test_restart_no_duplicates(spark):
    src = scratch_path(spark, "t-restart")
    _write(src, "a.json", [_record(i, "A", i) for i in range(5)])
    out, ck = scratch_path(spark, "r"), scratch_path(spark, "rck")
    stream = lambda: read_stream(spark, "json", path=src, schema=KAFKA_RECORD_SCHEMA)
    _run(spark, bronze_stream(stream()), out, ck)
    _run(spark, bronze_stream(stream()), out, ck)               # restart with no new data
    _write(src, "b.json", [_record(i, "A", i) for i in range(5, 8)])
    res = _run(spark, bronze_stream(stream()), out, ck)
    assert res.count() == 8 and res.select("kafka_offset").distinct().count() == 8


def test_duplicate_article_in_later_batch(spark):
    src = scratch_path(spark, "t-dedup")
    os.makedirs(src)
    schema = "id string, t timestamp"
    spark.createDataFrame([("a", T0), ("b", T0)], schema).write.mode("append").parquet(src)
    out, ck = scratch_path(spark, "d"), scratch_path(spark, "dck")

    def run():
        s = (spark.readStream.schema(schema).parquet(src)
                  .withWatermark("t", "1 day").dropDuplicatesWithinWatermark(["id"]))
        s.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck) \
            .trigger(availableNow=True).start().awaitTermination()
    run()
    spark.createDataFrame([("a", T0 + dt.timedelta(hours=1)), ("c", T0)], schema).write.mode("append").parquet(src)
    run()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_tail_carry_equals_batch(spark):
    rows = [("A" if i % 3 else "B", float(i % 7 + 1), float((i * 37) % 11),
             T0.replace(tzinfo=None) + dt.timedelta(seconds=i), i) for i in range(120)]
    schema = "symbol string, price double, volume double, event_time timestamp_ntz, kafka_offset long"
    src = scratch_path(spark, "t-tail")
    os.makedirs(src)
    df = spark.createDataFrame(rows, schema)
    for k in range(4):  # four files in event-time order, one per trigger
        df.filter((F.col("kafka_offset") >= k * 30) & (F.col("kafka_offset") < (k + 1) * 30)) \
          .coalesce(1).write.mode("append").parquet(src)
        import time
        time.sleep(0.05)
    out, st, ck = scratch_path(spark, "o"), scratch_path(spark, "st"), scratch_path(spark, "ck")
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    run_tail_carry(s, TailCarry(lambda t, carry: volume_spikes(t, carry=carry), 49, out, st), ck).awaitTermination()
    streamed = sorted((r.symbol, r.spike_time, round(r.volume_baseline, 9))
                      for r in spark.read.parquet(out).collect())
    batch = sorted((r.symbol, r.spike_time, round(r.volume_baseline, 9)) for r in volume_spikes(df).collect())
    assert streamed == batch and len(batch) > 0
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 4

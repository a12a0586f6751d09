"""Stream sources and sinks.

Kafka is the production source (``format="kafka"``; its connector jar must
be on the classpath — it is not in this container, so that path is untested
here). The same functions read file streams of Kafka-shaped JSON records,
which is what tests and registered queries use.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import hadoop_path

# Topic names of the reference's configuration (fixed values).
TOPIC_PRICES = "crypto-prices"
TOPIC_MARKET = "crypto-market-data"
TOPIC_FEAR_GREED = "crypto-fear-greed"
TOPIC_NEWS = "crypto-news"

KAFKA_RECORD_SCHEMA = ("key string, value string, topic string, partition int, offset long, "
                       "timestamp timestamp, timestampType int")


def read_stream(spark: SparkSession, fmt: str = "kafka", *, topic: str | None = None,
                path: str | None = None, schema=KAFKA_RECORD_SCHEMA,
                bootstrap_servers: str | None = None, starting_offsets: str = "latest",
                max_per_trigger: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Subscribe to a topic (or a comma-separated list), starting at
    ``starting_offsets``, tolerating lost offsets; or read a file stream
    with a declared schema. The input is rate-limited — the structured
    streaming form of back-pressure — by ``max_per_trigger`` records or files
    (``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``), or for files by ``max_bytes``
    (``maxBytesPerTrigger``: as many whole files as fit, one at least), which bounds a batch's work
    however the input is cut into files."""
    if max_per_trigger and max_bytes:
        raise ValueError("limit the input by files or by bytes, not by both")
    if fmt == "kafka":
        r = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", bootstrap_servers or "localhost:9092")
                  .option("subscribe", topic)
                  .option("startingOffsets", starting_offsets)
                  .option("failOnDataLoss", "false"))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_per_trigger))
        return r.load()
    r = spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", "true")
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_per_trigger))
    if max_bytes:
        r = r.option("maxBytesPerTrigger", str(max_bytes))
    return r.load(path)


def read_table_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """A layer table read as a stream for the next layer. Parquet file
    streams need the schema; it is taken from the table itself when absent."""
    if schema is None:
        schema = spark.read.format(fmt).load(path).schema
    return spark.readStream.format(fmt).schema(schema).option("basePath", path).load(path)


def split_topics(df: DataFrame, topics: list[str]) -> dict[str, DataFrame]:
    """One subscription to several topics, split on the ``topic`` column."""
    return {t: df.filter(F.col("topic") == t) for t in topics}


def sink_table_append(df: DataFrame, path: str, checkpoint: str, partition_by=("symbol",),
                      fmt: str = "parquet", available_now: bool = True,
                      processing_time: str | None = None, name: str | None = None) -> StreamingQuery:
    """Append to a table partitioned by symbol, with its own checkpoint."""
    w = (df.writeStream.format(fmt).outputMode("append")
           .option("checkpointLocation", checkpoint).option("path", path))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


def console_rows(rows: int):
    """Handler that prints the first ``rows`` rows of a micro-batch."""
    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"Batch: {batch_id}")
        batch.show(rows, truncate=False)
    return show


def sink_console(df: DataFrame, checkpoint: str | None = None, available_now: bool = True,
                 rows: int = 20) -> StreamingQuery:
    """Debug sink: the first ``rows`` rows of each micro-batch to the console,
    untruncated. Only those reach the driver (Spark's own console sink
    collects the whole batch first)."""
    w = df.writeStream.foreachBatch(console_rows(rows))
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def to_kafka_records(df: DataFrame, key_col: str) -> DataFrame:
    """(key, value) pairs: the key column and the whole row as JSON."""
    return df.select(F.col(key_col).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def write_kafka(df: DataFrame, topic: str, bootstrap_servers: str, key_col: str,
                compression: str = "snappy", linger_ms: int = 10) -> None:
    """Publish rows keyed by ``key_col`` (batch). Needs the Kafka connector."""
    (to_kafka_records(df, key_col).write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("kafka.compression.type", compression)
        .option("kafka.linger.ms", str(linger_ms))
        .option("topic", topic).save())


#: Rows of one replayed file at most, about.
REPLAY_ROWS = 1_000_000


def stage_replay(df: DataFrame, path: str, time_col: str, parts: int = 4, fmt: str = "json") -> list[str]:
    """Write ``df`` once, range-partitioned into files in time order (null times first), outside the
    watched folder: ``parts`` files, or as many more as hold ``REPLAY_ROWS`` rows each. Returns the files
    in order (a listing; the rows stay on the executors)."""
    staged = f"{path}-staged"
    parts = max(parts, -(-df.count() // REPLAY_ROWS))
    w = df.repartitionByRange(parts, F.col(time_col).asc_nulls_first()).write.mode("overwrite").format(fmt)
    (w.option("compression", "zstd") if fmt == "parquet" else w).save(staged)
    fs, p = hadoop_path(df.sparkSession, staged)
    return sorted(str(st.getPath()) for st in fs.listStatus(p) if st.getPath().getName().startswith("part-"))


def release(spark: SparkSession, files: list[str], path: str) -> None:
    """Move staged files into the watched folder, the first with the oldest
    modification time: a file stream takes them in that order."""
    fs, folder = hadoop_path(spark, path)
    fs.mkdirs(folder)
    now = int(time.time() * 1000)
    for i, f in enumerate(files):
        target = folder.suffix("/" + f.rsplit("/", 1)[1])
        fs.rename(hadoop_path(spark, f)[1], target)
        fs.setTimes(target, now - 1000 * (len(files) - i), -1)


def replay_as_files(df: DataFrame, path: str, time_col: str, parts: int = 4, fmt: str = "json") -> None:
    """A stand-in for a topic being consumed: ``df`` as time-ordered files for
    a file stream that takes one per trigger."""
    release(df.sparkSession, stage_replay(df, path, time_col, parts, fmt), path)

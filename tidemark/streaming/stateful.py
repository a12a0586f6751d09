"""Keyed stateful stream operators.

The reference keeps, per symbol, a bounded deque (last 50 volumes, last 100
ticks) and processes messages one by one. A per-key state handler would make
every symbol's micro-batch rows one task's work. Instead each micro-batch is
handled in ``foreachBatch`` as a batch job: the carried *tail* of the
previous batches (the last ``k`` ticks per symbol — exactly what the next
frame can reach) is unioned with the new rows, the chunked batch operator
runs over that union in parallel, and only the new rows' results are kept.
The new tail is a per-symbol top-k (a window group limit, partial before the
shuffle). Outputs are committed per batch through a manifest
(``streaming.batches``) and tails are written under the batch id with overwrite,
so a retried batch replaces its own files: exactly-once into the sink.

Order across batches is arrival order; within a symbol it must agree with
event time (the producer keys by symbol, so a Kafka partition keeps each
symbol's order).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.insights import CORR_SYMBOLS, asof_state, signals_from_asof
from ..session import path_exists, remove, written
from .batches import BATCH, BatchTable

GEN = "_gen"
TICK_COLUMNS = ["symbol", "price", "volume", "event_time", "kafka_offset"]


def carried_tail(spark: SparkSession, root: str, before: int) -> str | None:
    """Path of the tail that batch ``before - 1`` left; None for batch 0, which has no past. Batches
    are handled in order and each one writes its tail, so a missing one is an
    error: going on would silently restart the baselines."""
    if before <= 0:
        return None
    path = f"{root}/{before - 1}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        raise RuntimeError(f"no carried tail before batch {before} under {root}")
    return path


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    """All committed batches of an output, with their ``batch_id``."""
    return BatchTable(spark, root).read()


class TailCarry:
    """``foreachBatch`` handler running ``op(ticks, carry=[...])`` over the
    carried tail plus the new rows.

    Rows without a key, a time or one of the ``required`` columns are left out
    before the tail is taken: they never take up places of a frame. With
    ``by_day`` the output's folders are partitioned by the order column's day,
    for readers that need recent rows only.
    """

    def __init__(self, op: Callable[..., DataFrame], tail_rows: int, out_path: str, state_path: str,
                 columns: list[str] = TICK_COLUMNS, key: str = "symbol",
                 order: tuple[str, str] = ("event_time", "kafka_offset"),
                 summary_path: str | None = None, required: list[str] = (), by_day: bool = False):
        self.op, self.k, self.out, self.state = op, tail_rows, out_path, state_path
        self.columns, self.key, self.order = list(columns), key, order
        self.summary, self.by_day = summary_path, by_day
        self.required = [key, order[0], *required]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cur = (batch.select(*self.columns)
                    .dropna(subset=self.required)
                    .withColumn(GEN, F.lit(1)))
        prev = carried_tail(spark, self.state, batch_id)
        u = cur if prev is None else spark.read.parquet(prev).withColumn(GEN, F.lit(0)).unionByName(cur)
        u = u.persist()
        try:
            out = self.op(u, carry=[GEN]).filter(F.col(GEN) == 1).drop(GEN)
            if self.summary:
                out = written(out, "batch")  # read twice: for the table and for its summary
            days = out.withColumn("day", F.to_date(self.order[0])) if self.by_day else out
            BatchTable(spark, self.out, by=("day",) if self.by_day else ()).write(days, batch_id)
            if self.summary:
                # newest output row per (key, day): lets readers skip old history
                t = self.order[0]
                last = (out.groupBy(self.key, F.to_date(t).alias("_day"))
                               .agg(F.max_by(F.struct(*out.columns), F.struct(*[F.col(c) for c in self.order]))
                                    .alias("_r"))
                               .select("_r.*"))
                BatchTable(spark, self.summary).write(last, batch_id)
            w = Window.partitionBy(self.key).orderBy(*[F.col(c).desc() for c in self.order])
            tail = (u.withColumn("_rn", F.row_number().over(w))
                     .filter(F.col("_rn") <= self.k).drop("_rn", GEN))
            tail.write.mode("overwrite").parquet(f"{self.state}/{batch_id}")
            remove(spark, f"{self.state}/{batch_id - 2}")  # a retry of this batch needs the one before it
        finally:
            u.unpersist()


class Fanout:
    """One pass over a stream for several ``foreachBatch`` handlers, run one
    after another; each replaces its own folders when a batch is retried."""

    def __init__(self, *handlers):
        self.handlers = handlers

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for h in self.handlers:
                h(batch, batch_id)
        finally:
            batch.unpersist()


def run_tail_carry(stream: DataFrame, handler: Callable, checkpoint: str, available_now: bool = True):
    w = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


class SentimentJoin:
    """``foreachBatch`` handler for the sentiment stream. The price stream's
    handler appends, per tick, the window state the correlation reads
    (``correlation_state``), partitioned by day, and a per-(symbol, day)
    summary of its newest state. Each sentiment micro-batch is as-of joined
    (``plans.asof``) to the state rows from the day before its first reading
    on (older day folders are pruned), plus the day summaries before that: one
    row per symbol and day. Both tables are read through their manifests: what is committed
    when the batch begins, by a constant number of calls. A batch
    without any time writes an empty result."""

    def __init__(self, state_table: str, summary_table: str, out_path: str, symbols=CORR_SYMBOLS,
                 time_col: str = "event_time", stamp: bool = False):
        self.state, self.summary, self.out = state_table, summary_table, out_path
        self.symbols, self.t, self.stamp = symbols, time_col, stamp

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        first = batch.agg(F.min(self.t).alias("lo")).first().lo  # one scalar
        day = F.date_sub(F.to_date(F.lit(first).cast("timestamp_ntz")), 1)
        recent = read_batches(spark, self.state).filter(F.col("day") >= day).drop(BATCH, "day")
        older = read_batches(spark, self.summary).drop(BATCH).filter(F.col(self.t) < day.cast("timestamp_ntz"))
        out = signals_from_asof(asof_state(batch, recent.unionByName(older), self.symbols))
        if self.stamp:
            out = out.withColumn("created_at", F.current_timestamp())
        BatchTable(spark, self.out).write(out, batch_id)

"""Stream progress.

Rows per batch are recorded in a table by the sink itself (``BatchLog``); rates
come from Spark's progress events (``StreamingQueryProgress``) through a
listener attached before the queries start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from .batches import BATCH, BatchTable


class ProgressCollector(StreamingQueryListener):
    """Keeps the progress events of all queries of a session (driver side;
    one small record per micro-batch)."""

    def __init__(self):
        self.rows: list[tuple] = []

    def onQueryStarted(self, event):  # noqa: N802 - Spark's listener API
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        self.rows.append((p.name, p.batchId, p.numInputRows, float(p.inputRowsPerSecond or 0.0),
                          float(p.processedRowsPerSecond or 0.0)))

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass


def collect_progress(spark: SparkSession) -> ProgressCollector:
    """Attach a collector; do it before the queries start, so none of their
    batches is missed (a query itself only remembers its last records)."""
    c = ProgressCollector()
    spark.streams.addListener(c)
    return c


class BatchLog:
    """``foreachBatch`` handler that writes each micro-batch and records its
    number and row count in a table. The count is observed in the write
    itself (``DataFrame.observe``): nothing is read again for it. A retried batch
    replaces its own folders."""

    def __init__(self, out_path: str, log_path: str, then=None):
        self.out, self.log, self.then = out_path, log_path, then

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = Observation(f"batch-{batch_id}")
        out = BatchTable(spark, self.out)
        out.write(batch.observe(seen, F.count(F.lit(1)).alias("num_input_rows")), batch_id)
        rows = int(seen.get["num_input_rows"])
        if self.then:
            self.then(out.read().where(F.col(BATCH) == batch_id).drop(BATCH), batch_id)
        BatchTable(spark, self.log).write(spark.createDataFrame([(rows,)], "num_input_rows long"), batch_id)


def logged_stream(df: DataFrame, out_path: str, log_path: str, checkpoint: str, then=None) -> StreamingQuery:
    return (df.writeStream.foreachBatch(BatchLog(out_path, log_path, then))
              .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def batch_table(spark: SparkSession, log_path: str) -> DataFrame:
    """(num_input_rows, batch_id) of every batch recorded."""
    return BatchTable(spark, log_path).read()

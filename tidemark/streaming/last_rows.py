"""Small answers kept up to date by a stream: the newest row of every key, rows per group.

Serving asks for the newest price of each symbol many times a second; ranking
the whole bronze layer for each answer reads everything ever ingested. Every micro-batch
appends its own newest rows (one per key, ties included) to a batch table, and
merges keep only the newest of what they merge: the table holds a few
rows per key however long the stream has run, and an answer reads nothing else. A
retried batch replaces its rows; a late batch changes nothing that is newer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .batches import BATCH, BatchTable


def newest(rows: DataFrame, key: str, time_col: str) -> DataFrame:
    """Each key's rows at its greatest time, ties included; rows without key or time are left out.
    Every task keeps only its candidates before the shuffle (a window group limit)."""
    w = Window.partitionBy(key).orderBy(F.col(time_col).desc())
    known = rows.where(F.col(key).isNotNull() & F.col(time_col).isNotNull())
    return known.withColumn("_rank", F.rank().over(w)).where("_rank = 1").drop("_rank")


class LastRows(BatchTable):
    """``foreachBatch`` handler and table of the newest rows by ``key``."""

    def __init__(self, spark: SparkSession, root: str, key: str = "symbol", time_col: str = "event_time", **more):
        super().__init__(spark, root, **more)
        self.key, self.time = key, time_col

    def fold(self, rows: DataFrame) -> DataFrame:
        return newest(rows, self.key, self.time)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.write(self.fold(batch), batch_id)

    def last(self) -> DataFrame:
        """The newest rows of all committed batches."""
        return self.fold(self.read().drop(BATCH))


class Counts(BatchTable):
    """Rows per group of a growing table, kept per batch: a batch appends its own counts, merges add them up,
    and an answer sums what is there instead of reading the counted rows again."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], **more):
        super().__init__(spark, root, **more)
        self.keys = list(keys)

    def fold(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(F.sum("n").alias("n"), F.max(BATCH).alias(BATCH))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.write(batch.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n")), batch_id)

    def totals(self) -> DataFrame:
        """(keys, n) over all committed batches."""
        return self.read().groupBy(*self.keys).agg(F.sum("n").alias("n"))

"""First-wins de-duplication of a stream against every id it has ever had.

The reference holds an unbounded set of seen ids in one process. Here the set is
a table: ids by hash prefix (folders), sorted, with Parquet Bloom filters. A
micro-batch reads only the prefixes its own ids have; a small batch also
hands its ids to the scan, so that row groups whose Bloom filter or range excludes
them aren't read. What the anti-join leaves is new: it goes out and into
the table under the batch's number. There is no horizon: an id that comes again after any gap
is dropped, and a row that comes late but first is kept. A retried batch reads only what was
committed before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import BatchTable

PREFIX = "prefix"
#: Hash prefixes, and ids of a batch that are handed to the scan at most.
PREFIXES, HANDED = 64, 500
#: Sizes of a Bloom filter, each half the one before, of which Parquet keeps the smallest that does: 1 MB to 512 bytes.
BLOOM_SIZES = 12
#: How many values of an IN list Spark hands to Parquet.
IN_CONF = "spark.sql.parquet.pushdown.inFilterThreshold"


def first_rows(batch: DataFrame, id_col: str, order: list[str]) -> DataFrame:
    """One row of each id: the first in ``order`` (ties: the smallest row). The rows stay where
    the grouping by id has put them, so that a join by id moves none of them again."""
    rest = [c for c in [*order, *[c for c in batch.columns if c not in order]] if c != id_col]
    if not rest:
        return batch.distinct()
    first = batch.groupBy(id_col).agg(F.min(F.struct(*rest)).alias("_r"))
    return first.select(*[F.col(c) if c == id_col else F.col("_r").getField(c).alias(c) for c in batch.columns])


class SeenIds:
    """``foreachBatch`` handler: rows with a new id are appended to ``out``, their ids to ``seen``.
    A null id is an id like any other.

    Whole rows are shuffled once, by id; everything else about a batch is learnt from its ids alone.
    """

    def __init__(self, spark: SparkSession, out: str, seen: str, id_col: str = "id", order: list[str] = (), prefixes: int = PREFIXES):
        self.id, self.order, self.prefixes = id_col, list(order), prefixes
        self.out = BatchTable(spark, out)
        bloom = {f"parquet.bloom.filter.enabled#{id_col}": "true", "parquet.bloom.filter.adaptive.enabled": "true",
                 f"parquet.bloom.filter.candidates.number#{id_col}": str(BLOOM_SIZES)}
        self.seen = BatchTable(spark, seen, by=(PREFIX,), options=bloom, sort=(id_col,))

    def known(self, batch_id: int, ids: DataFrame) -> DataFrame | None:
        """The committed ids that may be among ``ids`` (id, prefix); None before the first commit."""
        if self.seen.latest(batch_id) is None:
            return None
        few = [r[0] for r in ids.select(self.id).where(F.col(self.id).isNotNull()).limit(HANDED + 1).collect()]
        touched = [r[0] for r in ids.select(PREFIX).distinct().collect()]  # at most ``prefixes`` numbers
        seen = self.seen.read(batch_id).where(F.col(PREFIX).isin(touched) if touched else F.lit(False))
        if len(few) <= HANDED:
            seen = seen.where(F.col(self.id).isin(few) | F.col(self.id).isNull() if few else F.col(self.id).isNull())
        return seen.select(self.id, PREFIX)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        for session in (batch.sparkSession, self.seen.spark):  # a stream's batches have a session of their own
            session.conf.set(IN_CONF, str(HANDED))
        prefix = F.pmod(F.xxhash64(self.id), F.lit(self.prefixes)).cast("int")
        rows = first_rows(batch, self.id, self.order)
        ids = batch.select(self.id).distinct().withColumn(PREFIX, prefix).persist()
        try:
            seen = self.known(batch_id, ids)
            if seen is not None:
                null = F.col(self.id).isNull()
                if not ids.where(null).isEmpty() and not seen.where(null).isEmpty():
                    rows = rows.where(~null)  # a null meets nothing in the join
                old = seen.select(F.col(self.id).alias("_id"))
                rows = rows.join(old, F.col(self.id) == F.col("_id"), "left_anti")
            self.out.write(rows, batch_id)
            # one task a prefix, however many wrote the rows: few files
            new = self.out.batch(batch_id).select(self.id).withColumn(PREFIX, prefix)
            self.seen.write(new.hint("rebalance", PREFIX), batch_id)
        finally:
            ids.unpersist()

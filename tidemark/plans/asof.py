"""As-of lookup: for each left row, the latest right row of the same key at or
before the left row's time — without a per-key or global sort.

Both sides are unioned and cut into (key, slice) partitions that follow the density of both
(``plans.slices``); a forward fill (``last(..., ignorenulls)``) runs inside each slice. Left rows that see
no right row in their own slice take the carry-in: the last right row of the
nearest earlier non-empty slice, found on a table with one row per
(key, slice) and joined back. The result is exact; the data itself is shuffled once.
Where every key has one slice there is nothing to carry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import chunk_index
from .slices import SLICE, slices_of, with_slice


def asof_latest(left: DataFrame, right: DataFrame, keys: list[str], left_time: str,
                right_time: str, right_order: list[Column], value: Column,
                out: str = "asof", bucket_seconds: int | None = None, tie_col: str | None = None) -> DataFrame:
    """Add struct column ``out`` = ``value`` of the latest right row with
    ``right_time <= left_time`` (ties on time: the largest ``right_order``).
    ``right_order`` must start with the right time column; ``tie_col`` is the right column
    after it, by which a single crowded instant may be cut. ``bucket_seconds`` forces clock buckets."""
    b = SLICE
    lcols = left.columns
    L = (left.withColumn("_t", F.col(left_time))
             .withColumn("_side", F.lit(1))
             .withColumn("_val", F.lit(None).cast(right.select(value.alias("v")).schema[0].dataType))
             .withColumn("_ord", F.lit(None).cast(right.select(F.struct(*right_order).alias("o")).schema[0].dataType)))
    R = (right.select(*keys, F.col(right_time).alias("_t"), value.alias("_val"),
                      F.struct(*right_order).alias("_ord"),
                      (F.coalesce(F.col(tie_col), F.lit(-1)) if tie_col else F.lit(None)).cast("long").alias("_tie"))
              .withColumn("_side", F.lit(0)))
    # Right rows sort before left rows at equal time: a tick at exactly the
    # left time is "already seen".
    u = L.unionByName(R, allowMissingColumns=True)
    if bucket_seconds:
        cut, u = True, u.withColumn(b, chunk_index(F.col("_t"), bucket_seconds))
    else:
        line = left.select(*keys, F.col(left_time).alias("_t"), F.lit(None).cast("long").alias("_tie")).unionByName(
            R.select(*keys, "_t", "_tie"))
        slices = slices_of(line, keys, "_t", "_tie", split_instants=tie_col is not None)
        cut, u = slices.cut, with_slice(u, slices, "_t", "_tie")
    u = u.drop("_tie")
    w = (Window.partitionBy(*keys, b).orderBy("_t", "_side", "_ord")
               .rowsBetween(Window.unboundedPreceding, 0))
    uw = (u.withColumn("_in", F.last("_val", ignorenulls=True).over(w))
           .withColumn("_seen", F.max(1 - F.col("_side")).over(w)))
    filled = uw.filter(F.col("_side") == 1)
    if not cut:
        return filled.select(*lcols, F.col("_in").alias(out))
    # Carry-in: last right value per (key, bucket), shifted to the next
    # non-empty bucket of the union of both sides' buckets. It is read off
    # the same windowed rows with all their columns, so the shuffle of the
    # union is shared (ReusedExchange) and neither side is computed twice.
    whole = F.struct(*[F.col(c) for c in uw.columns])
    last_r = (uw.filter(F.col("_side") == 0).groupBy(*keys, b)
                .agg(F.max_by(whole, F.col("_ord")).alias("_w"))
                .select(*keys, b, F.col("_w._val").alias("_lastv")))
    lb = (uw.filter(F.col("_side") == 1).groupBy(*keys, b)
            .agg(F.max(whole).alias("_w")).select(*keys, b)
            .withColumn("_lastv", F.lit(None).cast(last_r.schema["_lastv"].dataType))
            .withColumn("_isl", F.lit(1)))
    grid = last_r.withColumn("_isl", F.lit(0)).unionByName(lb)
    # Left rows sort before right rows of their own bucket, so the frame
    # (which stops one row short) sees only strictly earlier buckets.
    cw = (Window.partitionBy(*keys).orderBy(b, F.col("_isl").desc())
                .rowsBetween(Window.unboundedPreceding, -1))
    carry = (grid.withColumn("_carry", F.last("_lastv", ignorenulls=True).over(cw))
                 .filter(F.col("_isl") == 1).select(*keys, b, "_carry"))
    o = carry.select(*[F.col(k).alias(f"_o_{k}") for k in [*keys, b]], "_carry")
    cond = [filled[k].eqNullSafe(o[f"_o_{k}"]) for k in [*keys, b]]
    j = filled.join(o, on=cond, how="left")
    res = F.when(F.col("_seen") == 1, F.col("_in")).otherwise(F.col("_carry"))
    return j.select(*lcols, res.alias(out))

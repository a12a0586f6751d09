"""Frames bounded by rows and by time at once, without a list per row.

The reference keeps, per symbol, the last N ticks and drops those older than M
minutes. Neither a ROWS nor a RANGE frame is that window, and collecting the
last N ticks to filter them costs N entries per tick. Here every row carries
running sums (centred on its chunk's first value), and a second copy of it
that stands where it leaves the window (its time + M minutes). Read in time order, the
last copy passed tells a row which rows are gone by time; the running sums N rows
back tell which are gone by number. The later of the two is the row before the frame, and
the frame's sums are differences. Memory and work per row don't depend on N.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunked import IS_HALO, PART, SEQ, chunk_size

#: Rows of a chunk at most: the differences of running sums lose about so many
#: times the rounding of one value.
SUM_CHUNK_ROWS = 1000


def frame_chunk_rows(df: DataFrame, given: int | None = None) -> int:
    return int(given) if given else min(chunk_size(df), SUM_CHUNK_ROWS)


def two_bound_frame(h: DataFrame, keys: list[str], time_col: str, value_col: str, max_rows: int, seconds: int,
                    strict: bool = False, out: str = "_fr") -> DataFrame:
    """Add struct ``out`` = (n, first_time, first, mean, m2) over the last
    ``max_rows`` rows that are at most ``seconds`` older than the row
    (younger than that when ``strict``), itself included; m2 is the sum of squared
    deviations from the mean. The frame is never empty.

    ``h`` comes from ``row_halo`` with a halo of ``max_rows - 1`` rows; the
    halo rows are left out of the result. ``value_col`` must not be null.
    """
    if seconds <= 0 or max_rows < 1:
        raise ValueError("the frame needs a positive look-back and at least one row")
    cols = [c for c in h.columns if c not in (PART, IS_HALO)]
    part = [*keys, PART]
    by_row = Window.partitionBy(*part).orderBy(SEQ)
    run = by_row.rowsBetween(Window.unboundedPreceding, 0)
    t, v = F.col(time_col), F.col(value_col)
    r = h.select("*", F.first(F.struct(F.col(SEQ).alias("seq"), t.alias("time"), v.alias("value"))).over(run).alias("_base"),
                 F.lead(F.struct(t.alias("time"), v.alias("value"))).over(by_row).alias("_next"))
    d = v - F.col("_base.value")
    r = r.select("*", F.sum(d).over(run).alias("_p1"), F.sum(d * d).over(run).alias("_p2"))
    # what a frame that starts right after this row needs to know
    r = r.select("*", F.struct(F.col(SEQ).alias("seq"), "_p1", "_p2", F.col("_next.time").alias("time"),
                               F.col("_next.value").alias("value")).alias("_gone")).drop("_next")
    r = r.select("*", F.lag("_gone", max_rows).over(by_row).alias("_by_rows"))
    leaves = t + F.make_dt_interval(secs=F.lit(int(seconds)))
    here = F.struct(t.alias("at"), F.lit(1).alias("role"))
    gone = F.struct(leaves.alias("at"), F.lit(0 if strict else 2).alias("role"))  # a row at the cutoff itself
    both = r.select("*", F.explode(F.array(here, gone)).alias("_ev"))
    in_time = Window.partitionBy(*part).orderBy("_ev.at", "_ev.role", SEQ).rowsBetween(Window.unboundedPreceding, 0)
    both = both.select("*", F.last(F.when(F.col("_ev.role") != 1, F.col("_gone")), ignorenulls=True).over(in_time).alias("_by_time"))
    rows = both.where((F.col("_ev.role") == 1) & ~F.col(IS_HALO))
    later = F.when(F.coalesce(F.col("_by_time.seq") > F.col("_by_rows.seq"), F.col("_by_time").isNotNull()),
                   F.col("_by_time")).otherwise(F.col("_by_rows"))
    start, gone_by = F.col("_start"), F.col("_by_time.seq") > F.col("_by_rows.seq")
    rows = rows.select(*cols, "_p1", "_p2", "_base",  # one of the two is null at a chunk's begin: then the other
                       F.when(gone_by, F.col("_by_time")).otherwise(F.coalesce("_by_rows", "_by_time")).alias("_start"))
    n = F.col(SEQ) - F.coalesce(start["seq"], F.col("_base.seq") - 1)
    s1 = F.col("_p1") - F.coalesce(start["_p1"], F.lit(0.0))
    s2 = F.col("_p2") - F.coalesce(start["_p2"], F.lit(0.0))
    first = F.when(start.isNull(), F.struct("_base.time", "_base.value")).otherwise(F.struct(start["time"].alias("time"), start["value"].alias("value")))
    rows = rows.select(*cols, "_base", n.alias("_n"), s1.alias("_s1"), s2.alias("_s2"), first.alias("_first"))
    mean = F.col("_s1") / F.col("_n")
    return rows.select(*cols, F.struct(
        F.col("_n").alias("n"), F.col("_first.time").alias("first_time"), F.col("_first.value").alias("first"),
        (F.col("_base.value") + mean).alias("mean"),
        F.greatest(F.col("_s2") - F.col("_s1") * mean, F.lit(0.0)).alias("m2")).alias(out))

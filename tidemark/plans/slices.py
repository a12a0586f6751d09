"""Slices of a key's time line that follow the density of its rows.

A clock-cut bucket (a symbol's hour) is as large as the burst in it. Slices are
cut by counted rows instead: fine clock slices are counted with partial
aggregation, runs of thin ones are joined, and a fine slice that holds more rows than
a task should sort is cut at its instants, an instant that does at its tie
column (the offset). The numbers ascend with (time, tie), so a LAG, a RANGE frame or an
as-of look-up runs per (key, slice) and takes what reaches over a cut from
a table of one row per slice.

Counting is one narrow pass. Where no key (or no bucket of a key) holds
more rows than one slice should, that is all there is to it: ``cut`` is False and the plans
need no slices. Otherwise the table of slices is written to the shared folder; it is bounded by
the time span in fine slices, plus the instants of the dense ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import chunk_index
from ..session import written

#: Rows that a slice holds (plus those of its last fine slice), and how many fine slices a bucket is counted in.
SORT_CONF = "spark.tidemark.sortRows"
DEFAULT_SORT_ROWS = 1_000_000
FINE_SLICES = 60
#: Fine slices are of so many seconds at most.
FINE_SECONDS = 60

SLICE = "_slice"


def sort_rows(df: DataFrame, given: int | None = None) -> int:
    return int(given or df.sparkSession.conf.get(SORT_CONF, str(DEFAULT_SORT_ROWS)))


@dataclass
class Slices:
    """``cut``: some key (or bucket of one) has several slices; ``table`` has them then."""
    keys: list[str]
    fine: int
    within: int | None
    cut: bool
    table: DataFrame | None = None


def slices_of(df: DataFrame, keys: list[str], time_col: str, tie_col: str | None = None, within: int | None = None,
              rows: int | None = None, split_instants: bool = True, spread_untied: bool = True) -> Slices:
    """Slices of ``df`` (only the named columns are read). ``within``: seconds of a
    clock bucket that no slice crosses, and in which the numbers start anew.
    Rows whose tie is null stand after (or before) the others of their instant, in no order
    among themselves, so they are spread over slices of their own unless ``spread_untied`` is off. ``df`` may hold more rows than the rows that are sliced later."""
    rows = sort_rows(df, rows)
    fine = max(1, min(FINE_SECONDS, (within or FINE_SECONDS * FINE_SLICES) // FINE_SLICES))
    while within and within % fine:
        fine -= 1
    t = F.col(time_col)
    tie = F.col(tie_col).cast("long") if tie_col else F.lit(None).cast("long")
    own = df.select(*keys, t.alias("_t"), tie.alias("_tie"), chunk_index(t, fine).alias("_fine"))
    group = [*keys, *([F.floor(F.col("_fine") * fine / within).alias("_in")] if within else [])]
    counts = own.groupBy(*keys, "_fine").agg(F.count(F.lit(1)).alias("_n"))
    most = counts.groupBy(*group).agg(F.sum("_n").alias("_n")).agg(F.max("_n")).first()[0] or 0
    if most <= rows:
        return Slices(keys, fine, within, False)
    counts = written(counts, "slice-counts")
    dense = counts.where(F.col("_n") > rows)
    thin = counts.where(F.coalesce(F.col("_n") <= rows, F.lit(True))).select(
        *keys, "_fine", F.lit(None).cast(df.schema[time_col].dataType).alias("_at"), "_n",
        *[F.lit(None).cast("long").alias(c) for c in ("_lo", "_hi")], F.lit(1).alias("_pieces"), F.lit(1).alias("_free"))
    d = dense.select(*[F.col(k).alias(f"_d_{k}") for k in [*keys, "_fine"]])
    same = [own[k].eqNullSafe(d[f"_d_{k}"]) for k in [*keys, "_fine"]]
    tied = F.count("_tie")
    instants = (own.join(d, same, "left_semi").groupBy(*keys, "_fine", F.col("_t").alias("_at"))
                .agg(F.count(F.lit(1)).alias("_n"), F.min("_tie").alias("_lo"), F.max("_tie").alias("_hi"),
                     F.greatest(F.ceil(tied / rows), F.lit(1)).cast("int").alias("_pieces"),
                     F.greatest(F.ceil((F.count(F.lit(1)) - tied) / rows), F.lit(1)).cast("int").alias("_free")))
    if not split_instants:
        instants = instants.withColumns({"_pieces": F.lit(1), "_free": F.lit(1)})
    if not spread_untied:
        instants = instants.withColumn("_free", F.lit(1))
    both = thin.unionByName(instants)
    line = Window.partitionBy(*group).orderBy("_fine", "_at").rowsBetween(Window.unboundedPreceding, -1)
    first = F.floor(F.coalesce(F.sum("_n").over(line), F.lit(0)) / rows).cast("long")
    table = both.select("*", first.alias("_first")).drop("_n")
    return Slices(keys, fine, within, True, written(table, "slices"))


def with_slice(df: DataFrame, s: Slices, time_col: str, tie_col: str | None = None, free_first: bool = False) -> DataFrame:
    """Add ``_slice``, the number of the row's slice in its key (and bucket); 0 where nothing is cut.

    Rows without a tie are dealt by a hash over the slices after (``free_first``: before) the others of
    their instant. A row at a time that wasn't counted is an error."""
    if not s.cut:
        return df.withColumn(SLICE, F.lit(0).cast("long"))
    tie = F.col(tie_col).cast("long") if tie_col else F.lit(None).cast("long")
    rows = df.withColumns({"_fine": chunk_index(F.col(time_col), s.fine), "_t_": F.col(time_col), "_tie_": tie})
    names = [*s.keys, "_fine"]
    dense = s.table.where("_at IS NOT NULL").select(*[F.col(k).alias(f"_e_{k}") for k in names]).distinct()
    rows = rows.join(dense, [rows[k].eqNullSafe(dense[f"_e_{k}"]) for k in names], "left")
    rows = rows.withColumn("_at_", F.when(F.col("_e__fine").isNotNull(), F.col("_t_"))).drop(*dense.columns)
    o = s.table.select(*[F.col(k).alias(f"_o_{k}") for k in names], "_at", "_lo", "_hi", "_pieces", "_free", "_first")
    same = [rows[k].eqNullSafe(o[f"_o_{k}"]) for k in names] + [rows["_at_"].eqNullSafe(o["_at"])]
    j = rows.join(o, same, "left")
    place = F.floor((F.col("_tie_") - F.col("_lo")) * F.col("_pieces") / (F.col("_hi") - F.col("_lo") + 1))
    place = F.least(F.greatest(place, F.lit(0)), F.col("_pieces") - 1)
    spread = F.pmod(F.xxhash64(*df.columns), F.col("_free"))
    before_ties, before_free = (F.col("_free") - 1, F.lit(0)) if free_first else (F.lit(0), F.col("_pieces") - 1)
    piece = F.when(F.col("_tie_").isNull(), before_free + spread).otherwise(before_ties + place)
    number = F.coalesce(F.col("_first") + F.when(F.col("_pieces") + F.col("_free") > 2, piece).otherwise(F.lit(0)),
                        F.raise_error(F.lit("a row at a time that the slices were not counted with")).cast("long"))
    return j.select(*df.columns, number.cast("long").alias(SLICE))

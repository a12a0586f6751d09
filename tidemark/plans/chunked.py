"""Per-key ordered windows without one task per key.

The reference keeps one in-memory series per symbol. The direct Spark
translation, ``Window.partitionBy("symbol")``, sends every row of a symbol to
one task: with a handful of symbols and a hot one holding a third of all rows,
that is a single task reading a third of the data. These plans split each
key's series into chunks and copy a small *halo* (the rows an earlier chunk
contributes to a frame) into the next chunk, so the window runs per
``(key, chunk)`` and the result is exactly the un-chunked one.

* ``range_frame``: RANGE frames of a fixed look-back in linear time (see
  there).
* ``row_sequence`` + ``row_halo``: for ROWS frames. A distributed, gap-free
  sequence number per key (local rank inside a time bucket plus the running
  count of earlier buckets) decides chunk membership; the last ``halo`` rows
  of a chunk are copied into the next one.

The only tables that see a whole key are the per-(key, bucket) count tables,
whose size is bounded by the time span / bucket width, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import chunk_index
from .slices import FINE_SLICES, SLICE, Slices, slices_of, sort_rows, with_slice

# Defaults: a one-hour bucket of one symbol is the unit of sorting work; a
# row chunk holds 10,000 rows, so even a thin series spreads over many tasks
# while a 99-row halo adds about 1 % of copies.
DEFAULT_BUCKET_SECONDS = 3600
DEFAULT_CHUNK_ROWS = 10_000

# Session settings overriding the defaults, e.g. a finer bucket where one
# symbol-hour holds more rows than a task should sort.
BUCKET_CONF = "spark.tidemark.bucketSeconds"
CHUNK_CONF = "spark.tidemark.chunkRows"

PART = "_part"       # chunk a (possibly copied) row is evaluated in
IS_HALO = "_halo"    # true for copies that only feed frames
SEQ = "_seq"         # 1-based per-key sequence number


def bucket_width(df: DataFrame, given: int | None = None) -> int:
    if given:
        return int(given)
    return int(df.sparkSession.conf.get(BUCKET_CONF, str(DEFAULT_BUCKET_SECONDS)))


def chunk_size(df: DataFrame, given: int | None = None) -> int:
    if given:
        return int(given)
    return int(df.sparkSession.conf.get(CHUNK_CONF, str(DEFAULT_CHUNK_ROWS)))


def row_sequence(df: DataFrame, keys: list[str], time_col: str, order: list[Column],
                 bucket_seconds: int | None = None, reuse_input: bool = False) -> DataFrame:
    """Add ``_seq``: 1-based row number per key in ``order`` (whose first
    element must be ``time_col``), computed without a per-key sort.

    ``reuse_input``: build the count table from the shuffled rows (for an
    input that is expensive to compute twice) instead of a second read.

    For a scan the groups follow the rows, not the clock (``density_chunks``):
    a burst that puts most of a symbol's rows into one hour is cut into many.
    For an expensive input:

    1. rank inside (key, time bucket) — parallel over buckets;
    2. count per (key, bucket) — partial aggregation, a tiny table;
    3. running sum of earlier buckets' counts per key over that tiny table;
    4. join the offsets back (AQE broadcasts it when its runtime size is
       under the broadcast threshold, else it shuffle-joins).
    """
    if not reuse_input:
        chunked = density_chunks(df, keys, time_col, bucket_seconds)
        rank = F.row_number().over(Window.partitionBy(*keys, "_chunk").orderBy(*order))
        return chunked.withColumn(SEQ, (F.col("_off") + rank).cast("long")).drop("_chunk", "_off")
    bucket = "_bucket"
    with_b = df.withColumn(bucket, chunk_index(F.col(time_col), bucket_width(df, bucket_seconds)))
    local = with_b.withColumn(
        "_lrank", F.row_number().over(Window.partitionBy(*keys, bucket).orderBy(*order)))
    # Read the counts off the ranked rows with all their columns, so both
    # branches share one shuffle (ReusedExchange) and the input is computed once.
    whole = F.struct(*[F.col(c) for c in local.columns])
    counts = (local.groupBy(*keys, bucket).agg(F.max_by(whole, F.col("_lrank")).alias("_w"))
                   .select(*keys, bucket, F.col("_w._lrank").alias("_n")))
    offsets = counts.withColumn(
        "_off",
        F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy(bucket)
                                    .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("_n")
    o = offsets.select(*[F.col(k).alias(f"_o_{k}") for k in [*keys, bucket]], "_off")
    cond = [local[k].eqNullSafe(o[f"_o_{k}"]) for k in [*keys, bucket]]
    return (local.join(o, on=cond, how="inner")
                 .withColumn(SEQ, (F.col("_off") + F.col("_lrank")).cast("long"))
                 .drop("_off", "_lrank", bucket, *[f"_o_{k}" for k in [*keys, bucket]]))


def density_chunks(df: DataFrame, keys: list[str], time_col: str, bucket_seconds: int | None = None,
                   rows: int | None = None) -> DataFrame:
    """Add ``_chunk`` (consecutive time slices of a key holding about
    ``rows`` rows together) and ``_off`` (the key's rows before the chunk).

    A narrow read counts rows per (key, fine slice) with partial aggregation;
    the running count cuts the slices into chunks, and the small slice table is
    joined back (AQE broadcasts it where it is small). A chunk holds at most
    ``rows`` rows plus those of its last slice."""
    fine = max(1, bucket_width(df, bucket_seconds) // FINE_SLICES)
    rows = sort_rows(df, rows)
    with_f = df.withColumn("_fine", chunk_index(F.col(time_col), fine))
    counts = with_f.groupBy(*keys, "_fine").agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy(*keys).orderBy("_fine").rowsBetween(Window.unboundedPreceding, -1)
    slices = (counts.withColumn("_before", F.coalesce(F.sum("_n").over(run), F.lit(0)))
                    .withColumn("_chunk", F.floor(F.col("_before") / rows).cast("long"))
                    .withColumn("_off", F.min("_before").over(Window.partitionBy(*keys, "_chunk"))))
    o = slices.select(*[F.col(k).alias(f"_o_{k}") for k in [*keys, "_fine"]], "_chunk", "_off")
    cond = [with_f[k].eqNullSafe(o[f"_o_{k}"]) for k in [*keys, "_fine"]]
    return with_f.join(o, on=cond, how="inner").drop("_fine", *[f"_o_{k}" for k in [*keys, "_fine"]])


def row_halo(df: DataFrame, halo: int, chunk_rows: int | None = None) -> DataFrame:
    """From ``_seq``: add ``_part``/``_halo`` so a ROWS frame reaching back
    ``halo`` rows sees all its rows inside one (key, _part) partition. A row
    is copied into every later chunk its reach (seq .. seq + halo) touches —
    one extra copy for the last ``halo`` rows of a chunk when
    ``halo < chunk_rows``."""
    chunk_rows = chunk_size(df, chunk_rows)
    z = F.col(SEQ) - 1
    own = F.floor(z / chunk_rows).cast("long")
    last = F.floor((z + int(halo)) / chunk_rows).cast("long")
    p = df.select("*", own.alias("_own"), F.explode(F.sequence(own, last)).alias(PART))
    return p.withColumn(IS_HALO, F.col(PART) != F.col("_own")).drop("_own")


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(IS_HALO)).drop(PART, IS_HALO)


def lag_by_key(df: DataFrame, keys: list[str], time_col: str, order: list[Column],
               cols: list[str], prefix: str = "prev_", bucket_seconds: int | None = None,
               reuse_input: bool = True, tie_col: str | None = None, slices: Slices | None = None) -> DataFrame:
    """``lag(c) OVER (PARTITION BY keys ORDER BY order)`` for each c in cols,
    evaluated per (key, slice).

    Slices follow the density of the rows (``plans.slices``; counted here unless
    given, ``bucket_seconds`` forces clock buckets); ``order`` is the time and ``tie_col``.
    Where every key has one slice, that is the plain window. Else the first row of a slice takes
    its previous values from the last row of the previous non-empty slice: from a per-(key, slice)
    ``max_by`` table (partial aggregation; size = number of slices) lagged
    once more, then joined back. One shuffle of the data instead of one task
    per key.
    """
    ostruct = F.struct(*order)
    vals = F.struct(*[F.col(c) for c in cols])
    if bucket_seconds:
        bucket = "_bucket"
        with_b = df.withColumn(bucket, chunk_index(F.col(time_col), bucket_seconds))
    else:
        slices = slices or slices_of(df, keys, time_col, tie_col, split_instants=tie_col is not None, spread_untied=False)
        if not slices.cut:
            prev = F.lag(vals).over(Window.partitionBy(*keys).orderBy(*order))
            return (df.withColumn("_prev", prev).withColumns({f"{prefix}{c}": F.col(f"_prev.{c}") for c in cols})
                      .drop("_prev"))
        bucket, with_b = SLICE, with_slice(df, slices, time_col, tie_col, free_first=True)  # null ties sort first
    w = Window.partitionBy(*keys, bucket).orderBy(*order)
    local = with_b.withColumn("_prev", F.lag(vals).over(w))
    if reuse_input:
        # The side table reads every column of the lagged rows, so both
        # branches share one identical shuffle (a ReusedExchange) and an
        # expensive input is computed once.
        whole = F.struct(*[F.col(c) for c in local.columns])
        lastv = (local.groupBy(*keys, bucket).agg(F.max_by(whole, ostruct).alias("_w"))
                      .select(*keys, bucket,
                              F.struct(*[F.col(f"_w.{c}").alias(c) for c in cols]).alias("_last")))
    else:
        lastv = with_b.groupBy(*keys, bucket).agg(F.max_by(vals, ostruct).alias("_last"))
    last = (lastv.withColumn("_carry", F.lag("_last").over(Window.partitionBy(*keys).orderBy(bucket)))
                 .drop("_last"))
    o = last.select(*[F.col(k).alias(f"_o_{k}") for k in [*keys, bucket]], "_carry")
    cond = [local[k].eqNullSafe(o[f"_o_{k}"]) for k in [*keys, bucket]]
    j = local.join(o, on=cond, how="left")
    prev = F.coalesce(F.col("_prev"), F.col("_carry"))
    return (j.withColumns({f"{prefix}{c}": prev[c] for c in cols})
             .drop("_prev", "_carry", bucket, *[f"_o_{k}" for k in [*keys, bucket]]))


def range_frame(df: DataFrame, keys: list[str], time_col: str, tie_col: str, value_col: str,
                lookback_seconds: int, bucket_seconds: int, out: str = "_rf",
                strict: bool = False, peers: bool = True) -> DataFrame:
    """Aggregates of ``value_col`` over the rows of the same key whose time
    lies in ``[t - lookback, t]`` (``(t - lookback, t]`` when ``strict``), in
    linear time.

    Spark evaluates a sliding RANGE frame by re-aggregating the whole frame
    for every row: O(rows x rows per frame), which grows with data density.
    Here the frame is cut at bucket edges (the look-back is a whole number
    ``m`` of buckets): the current bucket up to ``t`` (a running frame), the
    ``m - 1`` full buckets before it (a small per-bucket table, slid over
    ``m - 1`` rows), and the tail of bucket ``b - m`` from ``t - lookback``
    on (that bucket's rows, shifted by the look-back into bucket ``b``, with a
    reverse running frame). Every piece is an incremental frame, all in one
    shuffle of the rows plus one copy.

    ``peers`` keeps RANGE semantics for rows at exactly ``t`` (all included);
    without it only rows with (time, tie) <= the current row's count.
    Adds struct ``out`` with fields max, min, first (value of the earliest
    row by (time, tie)), first_time, count, sum. ``df`` is read for the rows,
    their shifted copies and the bucket table: pass a scan or a written
    table, not an expensive plan.

    A bucket of a key that holds more rows than a task should sort is cut into
    slices by density (``_sliced_frame``); with ``peers`` the rows of one instant, which
    share one value, stay together.
    """
    L, B = int(lookback_seconds), int(bucket_seconds)
    if L % B:
        raise ValueError("the look-back must be a whole number of buckets")
    m = L // B
    t = F.col(time_col)
    b = chunk_index(t, B)
    shift = F.make_dt_interval(secs=F.lit(L))
    own = df.select("*", b.alias("_b"), F.lit(1).alias("_role"), t.alias("_st"), t.alias("_ot"),
                    F.col(tie_col).alias("_tie"), F.col(value_col).alias("_v"))
    start = df.select(*keys, (b + m).alias("_b"), F.lit(0).alias("_role"), (t + shift).alias("_st"),
                      t.alias("_ot"), F.col(tie_col).alias("_tie"), F.col(value_col).alias("_v"))
    free = F.lit(None).cast("long").alias("_tie")  # copies stand beside all rows of their instant
    line = own.select(*keys, "_st", F.col("_tie").cast("long").alias("_tie")).unionByName(start.select(*keys, "_st", free))
    slices = slices_of(line, keys, "_st", "_tie", within=B, split_instants=not peers)
    parts = [own, start]
    if m > 1:
        stats = (df.groupBy(*keys, b.alias("_b"))
                   .agg(F.max(value_col).alias("_bmax"), F.min(value_col).alias("_bmin"),
                        F.min_by(F.struct(t.alias("t"), F.col(tie_col).alias("k"), F.col(value_col).alias("v")),
                                 F.struct(t, F.col(tie_col))).alias("_bfirst"),
                        F.count(F.lit(1)).alias("_bcnt"), F.sum(value_col).alias("_bsum")))
        mw = Window.partitionBy(*keys).orderBy("_b").rangeBetween(-(m - 1), -1)
        mid = stats.select(*keys, "_b", F.lit(2).alias("_role"),  # one row per bucket
                           F.max("_bmax").over(mw).alias("_mmax"), F.min("_bmin").over(mw).alias("_mmin"),
                           F.min_by("_bfirst", F.struct(F.col("_bfirst.t"), F.col("_bfirst.k"))).over(mw).alias("_mfirst"),
                           F.sum("_bcnt").over(mw).alias("_mcnt"), F.sum("_bsum").over(mw).alias("_msum"))
        if slices.cut:
            return _sliced_frame(df, keys, own, start, mid, slices, strict, peers, out)
        parts.append(mid)
    elif slices.cut:
        return _sliced_frame(df, keys, own, start, None, slices, strict, peers, out)
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)

    is_own, is_start = F.col("_role") == 1, F.col("_role") == 0
    vo, vs = F.when(is_own, F.col("_v")), F.when(is_start, F.col("_v"))
    ordo = F.when(is_own, F.struct(F.col("_ot"), F.col("_tie")))
    ords = F.when(is_start, F.struct(F.col("_ot"), F.col("_tie")))
    part = [*keys, "_b"]
    if peers:
        run = Window.partitionBy(*part).orderBy("_st").rangeBetween(Window.unboundedPreceding, 0)
    else:
        run = Window.partitionBy(*part).orderBy("_st", "_tie", "_role").rowsBetween(Window.unboundedPreceding, 0)
    role_order = F.col("_role").desc() if strict else F.col("_role").asc()
    suf = Window.partitionBy(*part).orderBy(F.col("_st").desc(), role_order) \
        .rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*part)
    fs = F.struct(F.col("_ot").alias("t"), F.col("_v").alias("v"))
    # One select per frame spec: Catalyst evaluates each spec in one Window pass.
    r = u.select("*",
                 F.max(vo).over(run).alias("_rmax"), F.min(vo).over(run).alias("_rmin"),
                 F.min_by(F.when(is_own, fs), ordo).over(run).alias("_rfirst"),
                 F.count(F.when(is_own, F.lit(1))).over(run).alias("_rcnt"),
                 F.sum(vo).over(run).alias("_rsum"))
    r = r.select("*",
                 F.max(vs).over(suf).alias("_smax"), F.min(vs).over(suf).alias("_smin"),
                 F.min_by(F.when(is_start, fs), ords).over(suf).alias("_sfirst"),
                 F.count(F.when(is_start, F.lit(1))).over(suf).alias("_scnt"),
                 F.sum(vs).over(suf).alias("_ssum"))
    if m > 1:
        r = r.select(*[c for c in r.columns if c not in ("_mmax", "_mmin", "_mfirst", "_mcnt", "_msum")],
                     F.max("_mmax").over(whole).alias("_mmax"), F.min("_mmin").over(whole).alias("_mmin"),
                     F.max("_mfirst").over(whole).alias("_mfirst"),
                     F.max("_mcnt").over(whole).alias("_mcnt"), F.max("_msum").over(whole).alias("_msum"))
        r = r.withColumn("_mfirst", F.when(F.col("_mfirst").isNotNull(),
                                           F.struct(F.col("_mfirst.t").alias("t"), F.col("_mfirst.v").alias("v"))))
    else:
        r = r.withColumns({"_mmax": F.lit(None).cast("double"), "_mmin": F.lit(None).cast("double"),
                           "_mfirst": F.lit(None).cast(r.schema["_rfirst"].dataType),
                           "_mcnt": F.lit(None).cast("long"), "_msum": F.lit(None).cast("double")})
    first = F.coalesce("_sfirst", "_mfirst", "_rfirst")
    res = F.struct(
        F.greatest("_rmax", "_mmax", "_smax").alias("max"),
        F.least("_rmin", "_mmin", "_smin").alias("min"),
        first["v"].alias("first"), first["t"].alias("first_time"),
        (F.coalesce("_rcnt", F.lit(0)) + F.coalesce("_mcnt", F.lit(0)) + F.coalesce("_scnt", F.lit(0))).alias("count"),
        (F.coalesce("_rsum", F.lit(0.0)) + F.coalesce("_msum", F.lit(0.0)) + F.coalesce("_ssum", F.lit(0.0))).alias("sum"),
    )
    keep = df.columns
    return r.filter(is_own).select(*keep, res.alias(out))


def _sliced_frame(df: DataFrame, keys: list[str], own: DataFrame, start: DataFrame, mid: DataFrame | None,
                  slices: Slices, strict: bool, peers: bool, out: str) -> DataFrame:
    """``range_frame`` where some bucket is cut: the running frames run per (key, bucket, slice), and what
    lies in the bucket's other slices (own rows before, shifted rows after) comes from their totals."""
    lead = F.col("_role") == 0
    u = own.unionByName(start, allowMissingColumns=True).withColumn("_cut", F.when(~lead, F.col("_tie").cast("long")))
    u = with_slice(u, slices, "_st", "_cut", free_first=strict).drop("_cut")
    part = [*keys, "_b", SLICE]
    row = F.struct(F.col("_ot").alias("t"), F.col("_tie").alias("k"), F.col("_v").alias("v"))

    def pieces(which: Column) -> list[Column]:
        """max, min, earliest row, count and sum of the rows of one role."""
        v = F.when(which, F.col("_v"))
        return [F.max(v), F.min(v), F.min(F.when(which, row)), F.count(F.when(which, F.lit(1))), F.sum(v)]
    fields = ["max", "min", "first", "cnt", "sum"]
    if peers:
        run = Window.partitionBy(*part).orderBy("_st").rangeBetween(Window.unboundedPreceding, 0)
    else:
        run = Window.partitionBy(*part).orderBy("_st", "_tie", "_role").rowsBetween(Window.unboundedPreceding, 0)
    role_order = F.col("_role").desc() if strict else F.col("_role").asc()
    suf = Window.partitionBy(*part).orderBy(F.col("_st").desc(), role_order).rowsBetween(Window.unboundedPreceding, 0)
    r = u.select("*", *[c.over(run).alias(f"_r{f}") for c, f in zip(pieces(~lead), fields)])
    r = r.select("*", *[c.over(suf).alias(f"_s{f}") for c, f in zip(pieces(lead), fields)])
    totals = u.groupBy(*part).agg(*[c.alias(f"_o{f}") for c, f in zip(pieces(~lead), fields)],
                                  *[c.alias(f"_l{f}") for c, f in zip(pieces(lead), fields)])
    line = Window.partitionBy(*keys, "_b").orderBy(SLICE)
    before, after = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(1, Window.unboundedFollowing)
    merge = [F.max, F.min, F.min, F.sum, F.sum]
    c = totals.select(*part, *[g(f"_o{f}").over(before).alias(f"_b{f}") for g, f in zip(merge, fields)],
                      *[g(f"_l{f}").over(after).alias(f"_a{f}") for g, f in zip(merge, fields)])
    if mid is not None:
        names = ["_mmax", "_mmin", "_mfirst", "_mcnt", "_msum"]
        q = mid.select(*[F.col(k).alias(f"_q_{k}") for k in [*keys, "_b"]], *names)
        c = c.join(q, [c[k].eqNullSafe(q[f"_q_{k}"]) for k in [*keys, "_b"]], "left").drop(*[f"_q_{k}" for k in [*keys, "_b"]])
    else:
        c = c.withColumns({f"_m{f}": F.lit(None).cast(totals.schema[f"_o{f}"].dataType) for f in fields})
    o = c.select(*[F.col(k).alias(f"_o_{k}") for k in part], *[f"_{x}{f}" for x in "bam" for f in fields])
    rows = r.where(~lead)
    j = rows.join(o, [rows[k].eqNullSafe(o[f"_o_{k}"]) for k in part], "left")

    def over(which: str):
        return [F.col(f"_{x}{which}") for x in "rsbam"]
    first = F.least(*over("first"))
    count, total = [sum((F.coalesce(x, F.lit(0)) for x in over(f)), F.lit(0)) for f in ("cnt", "sum")]
    return j.select(*df.columns, F.struct(
        F.greatest(*over("max")).alias("max"), F.least(*over("min")).alias("min"), first["v"].alias("first"),
        first["t"].alias("first_time"), count.cast("long").alias("count"), total.cast("double").alias("sum")).alias(out))

"""Sharding along a Hilbert curve over quantised metadata.

Each metadata dimension is quantised by its own quantiles (of texts: exact ones over whole
values, so a frequent value begins a cell of its own); the cell
coordinates give a Hilbert index, rows are range-partitioned and sorted by it,
and the order is cut into runs. Neighbouring rows of a run agree in several
dimensions at once, so the shard files' min/max statistics prune on any of them.
Only narrow rows (id, size, checksum, index) are sorted; the sorted rows are
written to the shared folder once, so that positions don't depend on a re-run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .common import materialise, running, ship


def hilbert_index(coords: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of rows of non-negative coordinates below
    2**bits (Skilling's transposed form, then bit interleaving); whole columns at once."""
    x = coords.T.astype(np.int64).copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations and reflections, highest bit first
        low = q - 1
        for i in range(dims):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _measure(df: DataFrame, name: str) -> Column:
    """Numerics as double (null: below all), anything else as its whole text (null: empty)."""
    if isinstance(df.schema[name].dataType, NumericType):
        return F.coalesce(F.col(name).cast("double"), F.lit(-1e300))
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_cuts(df: DataFrame, col: str, cells: int) -> list[str]:
    """The values of a text column that hold a quantile: at most ``cells - 1``, in code-point order.
    Values are counted first, so a value that many rows share is one row of what is sorted."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n"))
    line = running(counts, [F.col("value").cast("binary")], {"before": F.col("n")})
    total = df.count()
    step = F.lit(total / cells) if total else F.lit(1.0)
    holds = F.floor((F.col("before") + F.col("n") - 1) / step) > F.floor((F.col("before") - 1) / step)
    return sorted((r["value"] for r in line.where(holds & (F.col("before") > 0)).select("value").collect()), key=str.encode)


def quantise(df: DataFrame, dims: dict[str, Column], bits: int) -> DataFrame:
    """Adds ``cell_<name>``: how many of the dimension's quantile cuts the value reaches (0 .. 2**bits - 1)."""
    shares = [k / 2**bits for k in range(1, 2**bits)]
    kinds = {n: df.select(c.alias("c")).schema["c"].dataType.typeName() for n, c in dims.items()}
    numbers = {n: c for n, c in dims.items() if kinds[n] != "string"}
    found = df.agg(F.count("*"), *[F.percentile_approx(c, shares, 1000).alias(n) for n, c in numbers.items()]).first()
    for n, c in dims.items():
        if n in numbers:
            tests = [c > F.lit(float(e)) for e in sorted(set(found[n] or []))]
        else:
            tests = [c >= F.lit(e) for e in text_cuts(df.select(c.alias("c")), "c", 2**bits)]
        df = df.withColumn(f"cell_{n}", sum((F.when(t, 1).otherwise(0) for t in tests), F.lit(0)))
    return df


def hilbert_shards(docs: DataFrame, dims: list[str], shards: int = 40, id_col: str = "doc_id",
                   text_col: str = "text", bits: int = 5) -> DataFrame:
    """(id, size, crc, hilbert, shard, slot): every row's place. ``id_col`` may be any
    whole number that tells what is to be told apart; null and repeated ids are placed like others.

    size: UTF-8 bytes of the text (null: none) plus 16. Law ``rows``: shard row
    counts differ by one at most; slots count from 0 in curve order. Null
    metadata sorts first, rows of one cell are ordered by id, checksum and size
    (repeated rows are interchangeable), and an empty table gives no rows.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    slim = docs.select(F.col(id_col).cast("long").alias("id"), (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text).alias("crc"), *[_measure(docs, d).alias(f"dim_{k}") for k, d in enumerate(dims)])
    slim = materialise(slim, "shard-rows")
    names = {str(k): F.col(f"dim_{k}") for k in range(len(dims))}
    cells = quantise(slim, names, bits).select("id", "size", "crc", *[f"cell_{n}" for n in names])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            coords = np.stack([b.column(3 + k).to_numpy(zero_copy_only=False) for k in range(len(dims))], axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(hilbert_index(coords, bits))],
                                             ["id", "size", "crc", "hilbert"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(n, part, np.int64)), pa.array(np.arange(at, at + n))],
                                             [*b.schema.names, "part", "nth"])
            at += n

    order = ["hilbert", "id", "crc", "size"]
    ranked = (cells.mapInArrow(index, "id long, size long, crc long, hilbert long")
              .repartitionByRange(*order).sortWithinPartitions(*order)
              .mapInArrow(number, "id long, size long, crc long, hilbert long, part long, nth long"))
    ranked = materialise(ranked, "shard-order")
    parts = ranked.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()  # one row per partition
    firsts, total = {}, 0
    for p in parts:
        firsts[p["part"]] = total
        total += p["n"]
    if not total:
        return ranked.select("id", "size", "crc", "hilbert", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    offsets = ranked.sparkSession.createDataFrame(list(firsts.items()), "part long, first long")
    base, extra = divmod(total, shards)
    rank = F.col("first") + F.col("nth")
    long_rows = extra * (base + 1)  # the first `extra` shards hold one row more
    shard = F.when(rank < long_rows, F.expr(f"(first + nth) div {base + 1}")).otherwise(
        F.lit(extra) + F.expr(f"(first + nth - {long_rows}) div {max(base, 1)}"))
    out = ranked.join(F.broadcast(offsets), "part").withColumn("shard", shard.cast("int"))
    start = F.col("shard") * base + F.least(F.col("shard"), F.lit(extra))
    return out.select("id", "size", "crc", "hilbert", "shard", (rank - start).cast("long").alias("slot"))


ROW = "__row"


def write_shards(docs: DataFrame, dims: list[str], path: str, shards: int = 40, text_col: str = "text",
                 per_task: int = 500_000) -> None:
    """Every row of ``docs`` (all columns) into its shard's folder, in slot order; readers prune by the files' statistics.

    Rows are numbered first (in a written copy, so the numbers hold), whatever their
    ids are: null and repeated ids, and equal rows, are written once each. A shard of over ``per_task`` rows is
    several files, each a run of slots."""
    own = materialise(docs.withColumn(ROW, F.monotonically_increasing_id()), "shard-docs")
    placed = hilbert_shards(own, dims, shards, ROW, text_col).select(F.col("id").alias(ROW), F.col("shard").alias("__shard"), F.col("slot").alias("__slot"))
    run = F.floor(F.col("__slot") / per_task)
    (own.join(placed, ROW).drop(ROW).repartition("__shard", run).sortWithinPartitions("__shard", "__slot")
     .withColumnRenamed("__shard", "shard").drop("__slot").write.partitionBy("shard").parquet(path))

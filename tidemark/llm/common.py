"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import struct
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Ids from here on stand for null ids inside an operator: above every real id.
NULL_ID = 2**62


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would
    (sent by the driver; nothing has to be installed or on a shared path)."""
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="tidemark-")  # the driver serves the file from here as long as it lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "tidemark.zip")
    with zipfile.ZipFile(path, "w") as z:
        for at, _, files in sorted(os.walk(top)):
            for f in sorted(files):
                if f.endswith(".py"):
                    z.write(os.path.join(at, f), os.path.relpath(os.path.join(at, f), os.path.dirname(top)))
    sc.addPyFile(path)
    sc._tidemark_shipped = True


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, so
    a lost executor costs a re-read and not the jobs before it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with, for each of ``sums``, the sum over all rows before in ``order``.

    Range partitions are summed on their own; what lies before a partition comes
    from a table of one row per partition, so no task sorts everything.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "running")
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    tops = dealt.groupBy("__part").agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    tops = tops.select("__part", *[F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(f"__{n}") for n in sums])
    own = dealt.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(n) for n, c in sums.items()])
    out = own.join(tops, "__part")
    return out.select(*df.columns, *[(F.col(n) + F.col(f"__{n}")).alias(n) for n in sums])


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, UPPER.lower())


def crc_bucket(id_col: str, mod: int) -> Column:
    """crc32 of the id's decimal text, modulo ``mod`` (null id: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % mod


def parts_for(total: int | None, per_part: int) -> int:
    return max(1, -(-int(total or 0) // per_part))


def pack(*arrays: np.ndarray) -> bytes:
    """Several numeric arrays as one compressed blob (byte planes, zstd)."""
    head = struct.pack("<B", len(arrays))
    body = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        head += struct.pack("<cBQ", a.dtype.kind.encode(), a.dtype.itemsize, len(a))
        body.append(a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes())
    return head + zstandard.ZstdCompressor(level=1).compress(b"".join(body))


def unpack(blob: bytes) -> list[np.ndarray]:
    n, at, specs = blob[0], 1, []
    for _ in range(n):
        kind, width, size = struct.unpack_from("<cBQ", blob, at)
        specs.append((np.dtype(f"{kind.decode()}{width}"), size))
        at += struct.calcsize("<cBQ")
    total = sum(d.itemsize * s for d, s in specs)
    body = zstandard.ZstdDecompressor().decompress(blob[at:], max_output_size=max(1, total)) if total else b""
    out, at = [], 0
    for dtype, size in specs:
        planes = np.frombuffer(body, np.uint8, dtype.itemsize * size, at).reshape(dtype.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(dtype))
        at += dtype.itemsize * size
    return out


def give_back() -> None:
    """Return freed memory to the system: workers are reused, and what one stage's
    arrays left in the allocators would stay beside the next stage's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])
    return starts, np.diff(np.r_[starts, len(sorted_values)])


def mix64(x: np.ndarray) -> np.ndarray:
    """Bit mixer for uint64 arrays, so that any bits can serve as a bucket."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))

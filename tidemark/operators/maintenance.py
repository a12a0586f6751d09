"""Table maintenance and layer registration (§2.1)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import hadoop_path, path_exists
from ..storage import Files

#: Files below this size are small; so much is packed into one file.
SMALL_BYTES, TARGET_BYTES = 64 << 20, 256 << 20
#: Small files that one run replaces at most: the pointer names them until they are removed.
MOST_FILES = 10_000
POINTERS = "_pointer"


def _pointer(files: Files) -> tuple[int, dict]:
    """The newest pointer: what of the table's files a reader must not see."""
    n = max((int(x) for x in files.names(POINTERS) if x.isdigit()), default=0)
    return n, json.loads(files.read(f"{POINTERS}/{n}")) if n else {"paths": [], "names": []}


def _point(files: Files, n: int, paths: list[str], names: list[str]) -> None:
    files.write(f"{POINTERS}/{n}", json.dumps({"paths": paths, "names": names}))
    files.delete(f"{POINTERS}/{n - 2}")


def _visible(spark: SparkSession, path: str, fmt: str, state: dict) -> DataFrame:
    df = spark.read.format(fmt).load(path)
    if state["paths"]:  # both are decided on the listing: hidden files aren't opened
        df = df.where(~F.col("_metadata.file_path").isin(state["paths"]))
    if state["names"]:
        df = df.where(~F.col("_metadata.file_name").isin(state["names"]))
    return df


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table that may be compacted at any time: its files without those that the pointer hides.
    Files that were appended since are seen at once."""
    return _visible(spark, path, fmt, _pointer(Files(spark, path))[1])


def small_file_bins(files: DataFrame, partition_col: str, target: int) -> DataFrame:
    """(partition, path, size) of small files -> (path, bin): neighbours that fill one
    target file together; a file that would stand alone is left as it is."""
    before = Window.partitionBy(partition_col).orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    binned = files.withColumn("bin", F.floor(F.coalesce(F.sum("size").over(before), F.lit(0)) / target).cast("long"))
    together = F.count(F.lit(1)).over(Window.partitionBy(partition_col, "bin"))
    return binned.withColumn("_n", together).where("_n > 1").select("path", "size", "bin")


def compact_table(spark: SparkSession, path: str, partition_col: str = "symbol", fmt: str = "parquet",
                  small: int = SMALL_BYTES, target: int = TARGET_BYTES, most: int = MOST_FILES) -> DataFrame:
    """Pack the small files of a partitioned table into few, in place; the table as it reads then.

    Only files below ``small`` bytes are read (chosen by ``_metadata.file_size`` on the
    listing), packed per partition value into bins of ``target`` bytes, rewritten beside the table and
    compared with what they replace (count and sum of row hashes). The switch is one pointer
    file: the new files are moved in hidden, then one rename hides the old ones instead. A reader
    that goes by the pointer (``read_table``) sees the old or the new files, never both, and large files
    are never touched. An interrupted run leaves hidden files only; ``remove_hidden``
    deletes those and the replaced ones once no reader needs them. More than ``most`` small files
    take several runs.
    """
    files = Files(spark, path)
    n, state = _pointer(files)
    df = _visible(spark, path, fmt, state)
    meta = F.col("_metadata")
    little = df.where(meta["file_size"] < small)
    found = little.select(partition_col, meta["file_path"].alias("path"), meta["file_size"].alias("size")).distinct()
    bins = small_file_bins(found, partition_col, target).orderBy("path").limit(most).persist()
    try:
        replaced = [r["path"] for r in bins.select("path").collect()]  # at most ``most`` names
        if not replaced:
            return df
        rows = (little.withColumn("_path", meta["file_path"]).where(F.col("_path").isin(replaced))
                .join(bins.select(F.col("path").alias("_path"), F.col("bin").alias("_bin")), "_path").drop("_path"))
        staged = f"{path}/_staged-{n + 1}"
        by_bin = rows.repartition(partition_col, "_bin")
        by_bin.write.mode("overwrite").format(fmt).partitionBy(partition_col, "_bin").save(staged)
    finally:
        bins.unpersist()
    after = spark.read.format(fmt).load(staged)
    gone = df.where(F.col("_metadata.file_path").isin(replaced))
    cols = [c for c in df.columns if c != partition_col] + [partition_col]
    before, now = _fingerprint(gone, cols), _fingerprint(after.withColumn(partition_col, after[partition_col].cast(df.schema[partition_col].dataType)), cols)
    if before != now:
        raise RuntimeError(f"compaction changed the rows: {before} -> {now}")
    moves = _staged_files(spark, staged, path, f"compacted-{n + 1}")
    _point(files, n + 1, state["paths"], state["names"] + [name for _, _, name in moves])
    for source, folder, name in moves:
        files.fs.mkdirs(folder)
        if not files.fs.rename(source, folder.suffix("/" + name)):
            raise RuntimeError(f"could not move {source}")
    _point(files, n + 2, state["paths"] + replaced, state["names"])  # the switch
    files.delete(f"_staged-{n + 1}")
    return read_table(spark, path, fmt)


def _staged_files(spark: SparkSession, staged: str, path: str, prefix: str) -> list[tuple]:
    """(staged file, its folder in the table, its unique name there) of every rewritten file."""
    fs, root = hadoop_path(spark, staged)
    table, out = hadoop_path(spark, path)[1], []
    for part in fs.listStatus(root):
        if part.isDirectory():
            for b in fs.listStatus(part.getPath()):
                for f in fs.listStatus(b.getPath()):
                    name = f"{prefix}-{len(out)}.{f.getPath().getName().split('.', 1)[-1]}"
                    out.append((f.getPath(), table.suffix("/" + part.getPath().getName()), name))
    return out


def remove_hidden(spark: SparkSession, path: str) -> int:
    """Delete the files that the pointer hides, once no reader uses an older pointer; how many there were."""
    files = Files(spark, path)
    n, state = _pointer(files)
    uri, jpath = spark.sparkContext._jvm.java.net.URI, spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for p in state["paths"]:
        files.fs.delete(jpath(uri(p)), False)
    if n:
        _point(files, n + 1, [], state["names"])
    return len(state["paths"])


def rebalanced(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows of a value together, in partitions of about the advisory size."""
    names = ", ".join(f"`{c}`" for c in cols)
    return df.sparkSession.sql(f"SELECT /*+ REBALANCE({names}) */ * FROM {{d}}", d=df)


def _fingerprint(df: DataFrame, cols: list[str]) -> tuple:
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("h")).first()
    return r.n, r.h


def register_layer_views(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> list[str]:
    """Register each existing layer path as a temp view; missing layers are
    skipped (tolerated), as the serving API does."""
    done = []
    for name, path in paths.items():
        if not path_exists(spark, path):
            continue
        spark.read.format(fmt).load(path).createOrReplaceTempView(name)
        done.append(name)
    return done


def scan_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table scan by path inside SQL (the path is a parameter)."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


"""Session construction and shared-folder helpers.

Everything time related runs with the session time zone pinned to UTC; the
reference converts epoch values with local time in places, which is a bug we
do not reproduce.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Fixed settings: reference defaults that must stay as they are.
SESSION_TIME_ZONE = "UTC"


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs.

    On a cluster the submitter usually owns the session; `prepare()` is what
    library entry points call on whatever session they are given.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder
        .master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", SESSION_TIME_ZONE)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what the operators rely on: UTC session time and AQE."""
    spark.conf.set("spark.sql.session.timeZone", SESSION_TIME_ZONE)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read it from the session. Only a local master (one machine, as in tests)
    may leave it unset and gets a fresh local folder, removed at exit; on a
    cluster an unset folder is an error, because executors would write to
    their own disks and not see each other's files.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not is_local(sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", d)
        sc.setCheckpointDir(d)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def is_local(master: str) -> bool:
    """One JVM on one machine (``local-cluster`` isn't: its executors have folders of their own)."""
    return master == "local" or master.startswith("local[")


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-path of the shared folder for one run of one job."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and a lost executor costs a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) as Spark itself resolves it, default file system included."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a folder, whether or not it is there."""
    fs, p = hadoop_path(spark, path)
    return fs.delete(p, True)


def drop_scratch(spark: SparkSession) -> int:
    """Remove the scratch copies made so far; call it once their results have
    been consumed (results read them lazily). Returns how many were there."""
    n = 0
    while _scratch:
        fs, p = hadoop_path(spark, _scratch.pop())
        n += bool(fs.delete(p, True))
    return n

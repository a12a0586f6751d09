"""Tables that a stream appends to batch by batch, read through a manifest.

A batch writes its rows into a folder of its own and then commits: one small
manifest file names every folder that is live after the batch. Readers list the few
manifests that are kept, read the newest and open the folders it names; folders without a
commit don't exist for them. No folder of an earlier batch is ever probed, so
a batch costs the same number of file-system calls however long the stream has run.

A retried batch starts from the manifest before it and replaces its own folder
and manifest: exactly once into the table. While it commits, a batch also merges
finished folders, ``fan`` of one level into one of the next, so after ``n`` batches about
``fan * log(n)`` folders are live. Folders that a merge replaced stay until no kept
manifest names them.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..storage import Files

BATCH = "batch_id"
PART = "_part"
#: Folders of one level that are merged, manifests that are kept.
FAN, KEEP = 8, 3
#: Folders that hold more bytes together aren't merged any more.
MERGE_BYTES = 1 << 30


def merged_away(parts: list[dict], fan: int, most: int) -> list[dict]:
    """The oldest ``fan`` neighbouring parts of one level that may be merged, lowest level first; none: empty."""
    for level in sorted({p["level"] for p in parts}):
        same = [p for p in parts if p["level"] == level][:fan]
        if len(same) == fan and sum(p["bytes"] for p in same) <= most:
            return same
    return []


class BatchTable:
    """A table under ``root`` of rows with their ``batch_id``, optionally partitioned by columns of the rows."""

    def __init__(self, spark: SparkSession, root: str, by: tuple[str, ...] = (), fan: int = FAN, merge_bytes: int = MERGE_BYTES,
                 options: dict[str, str] | None = None, sort: tuple[str, ...] = ()):
        self.spark, self.root, self.by, self.fan, self.most = spark, root.rstrip("/"), tuple(by), fan, merge_bytes
        self.options, self.sort = {"compression": "zstd"} | (options or {}), tuple(sort)
        self.files = Files(spark, self.root)

    def latest(self, before: int | None = None) -> dict | None:
        """The newest manifest (of a batch before ``before``): one listing and one read."""
        ids = [int(x) for x in self.files.names("_manifest") if x.isdigit()]
        n = max((i for i in ids if before is None or i < before), default=None)
        return None if n is None else json.loads(self.files.read(f"_manifest/{n}"))

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Rows of one batch, and its commit."""
        out = df.withColumn(BATCH, F.lit(batch_id).cast("long"))
        self._save(out, f"{PART}=b{batch_id}")
        self.commit(batch_id, f"{PART}=b{batch_id}", out.schema.json())

    def commit(self, batch_id: int, folder: str, schema: str) -> None:
        before = self.latest(batch_id) or {"parts": [], "retired": []}
        parts, retired = before["parts"], before["retired"]
        if old := merged_away(parts, self.fan, self.most):
            parts = [p for p in parts if p not in old]
            name = f"{PART}=m{old[0]['first']}-{old[-1]['last']}-{batch_id}"
            self._merge(old, name, schema)
            whole = {"folder": name, "level": old[0]["level"] + 1, "first": old[0]["first"], "last": old[-1]["last"],
                     "bytes": sum(p["bytes"] for p in old)}
            parts = sorted([*parts, whole], key=lambda p: p["first"])
            retired = retired + [{"folder": p["folder"], "at": batch_id} for p in old]
        own = {"folder": folder, "level": 0, "first": batch_id, "last": batch_id, "bytes": self.files.size(folder)}
        gone = [r for r in retired if r["at"] <= batch_id - KEEP]
        state = {"batch": batch_id, "schema": schema, "parts": [*parts, own], "retired": [r for r in retired if r not in gone]}
        self.files.write(f"_manifest/{batch_id}", json.dumps(state))
        for r in gone:  # no kept manifest names them
            self.files.delete(r["folder"])
        self.files.delete(f"_manifest/{batch_id - KEEP}")

    def read(self, before: int | None = None) -> DataFrame:
        """The rows of all committed batches (before ``before``), with their ``batch_id``."""
        state = self.latest(before)
        if state is None:
            raise FileNotFoundError(f"no committed batch under {self.root}")
        return self._open(state["parts"], state["schema"])

    def batch(self, batch_id: int) -> DataFrame:
        """The rows of the newest committed batch, ``batch_id``, from its own folder."""
        state = self.latest(batch_id + 1)
        return self._open([p for p in state["parts"] if p["first"] == p["last"] == batch_id], state["schema"])

    def _open(self, parts: list[dict], schema: str) -> DataFrame:
        rows = self.spark.read.schema(StructType.fromJson(json.loads(schema))).option("basePath", self.root)
        return rows.parquet(*[f"{self.root}/{p['folder']}" for p in parts]).drop(PART)

    def _save(self, df: DataFrame, folder: str) -> None:
        if self.sort:
            df = df.sortWithinPartitions(*self.by, *self.sort)
        w = df.write.mode("overwrite").options(**self.options)
        (w.partitionBy(*self.by) if self.by else w).parquet(f"{self.root}/{folder}")

    def _merge(self, parts: list[dict], name: str, schema: str) -> None:
        hint = f"REBALANCE({', '.join(self.by)})" if self.by else "REBALANCE"
        rows = self.fold(self._open(parts, schema))
        self._save(self.spark.sql(f"SELECT /*+ {hint} */ * FROM {{d}}", d=rows), name)

    def fold(self, rows: DataFrame) -> DataFrame:
        """What a merge keeps of the merged rows: all."""
        return rows

"""Batch tables (manifest, merging) and the seen-id table."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.session import hadoop_path, scratch_path
from tidemark.streaming import batches, seen
from tidemark.streaming.batches import BatchTable
from tidemark.streaming.seen import SeenIds


def _rows(table, **kw):
    return sorted((r.batch_id, r.k, r.v) for r in table.read(**kw).collect())


def test_calls_per_batch_stay_constant(spark, monkeypatch):
    """1,000 commits: the same few file-system calls each, a bounded number of folders and manifests."""
    root = scratch_path(spark, "t-calls")
    monkeypatch.setattr(BatchTable, "_merge", lambda self, *a: None)
    monkeypatch.setattr(batches.Files, "size", lambda self, name: setattr(self, "calls", self.calls + 1) or 10)
    t = BatchTable(spark, root)
    calls = []
    for n in range(1000):
        before = t.files.calls
        t.commit(n, f"b{n}", "{}")
        calls.append(t.files.calls - before)
    assert max(calls) <= 7 + batches.FAN and sum(calls[900:]) <= 1.1 * sum(calls[100:200])
    state = t.latest()
    assert state["batch"] == 999 and len(state["parts"]) <= 4 * batches.FAN and len(state["retired"]) <= 4 * batches.FAN
    assert sum(p["last"] - p["first"] + 1 for p in state["parts"]) == 1000
    assert len([x for x in t.files.names("_manifest") if x.isdigit()]) == batches.KEEP
    before = t.files.calls
    t.latest()
    assert t.files.calls - before == 2  # a reader: one listing, one read


@pytest.mark.parametrize("by", [(), ("k",)])
def test_merging_keeps_rows_and_retries_replace(spark, by):
    root = scratch_path(spark, "t-merge")
    t = BatchTable(spark, root, by=by, fan=2)
    want = []
    for n in range(9):
        rows = [(f"k{i % 3}", 100 * n + i) for i in range(n % 4)]  # batches without rows among them
        df = spark.createDataFrame(rows, "k string, v long")
        if n == 5:  # a first try that got as far as its commit
            t.write(spark.createDataFrame([("wrong", -1)], "k string, v long"), n)
        t.write(df, n)
        want += [(n, *r) for r in rows]
        if n == 6:  # a folder that was never committed
            df.write.parquet(f"{root}/_part=b77")
        assert _rows(t) == sorted(want)
    assert _rows(t, before=8) == sorted(x for x in want if x[0] < 8)
    folders = [p["folder"] for p in t.latest()["parts"]]
    assert any(f.startswith("_part=m") for f in folders) and len(folders) < 9
    fs, p = hadoop_path(spark, root)
    left = {s.getPath().getName() for s in fs.listStatus(p)} - {"_manifest", "_part=b77"}
    named = set(folders) | {r["folder"] for r in t.latest()["retired"]}
    assert left == named  # nothing else is kept


def test_large_folders_are_not_merged():
    parts = [{"folder": str(i), "level": 0, "first": i, "last": i, "bytes": 10} for i in range(8)]
    assert len(batches.merged_away(parts, 8, 80)) == 8 and batches.merged_away(parts, 8, 79) == []
    assert batches.merged_away(parts[:7], 8, 80) == []


SCHEMA = "id string, t long, note string"


@pytest.mark.parametrize("handed", [500, 0])
def test_seen_ids_have_no_horizon(spark, monkeypatch, handed):
    monkeypatch.setattr(seen, "HANDED", handed)  # 0: no id is handed to the scan, prefixes prune alone
    rnd = random.Random(2)
    out, ids = scratch_path(spark, "t-out"), scratch_path(spark, "t-seen")
    h = SeenIds(spark, out, ids, "id", ["t"], prefixes=4)
    first = {}
    for n in range(11):
        rows = [(rnd.choice([None, *(f"id{k}" for k in range(40))]), 10_000 * n + rnd.randrange(100), f"{n}-{i}") for i in range(12)]
        rows += [("early", 5, "again")] if n in (0, 10) else []  # the same id after ten batches
        rows += [("late", -10**9, "late")] if n == 7 else []  # far behind all others, but first of its id
        batch = spark.createDataFrame(rows, SCHEMA)
        for r in sorted(rows, key=lambda r: (r[1], r[2])):
            first.setdefault(r[0], (n, *r))
        h(batch, n)
        if n in (3, 8):
            h(batch, n)  # a retry
    got = h.out.read().collect()
    assert sorted(((r.batch_id, r.id, r.t, r.note) for r in got), key=str) == sorted(first.values(), key=str)
    assert any(p["level"] for p in h.seen.latest()["parts"])  # through merged folders too


def test_seen_ids_read_only_their_prefixes(spark):
    out, ids = scratch_path(spark, "t-out"), scratch_path(spark, "t-seen")
    h = SeenIds(spark, out, ids, "id", [], prefixes=16)
    h(spark.createDataFrame([(f"x{i}", i, "") for i in range(300)], SCHEMA), 0)
    one = spark.createDataFrame([("x7", 0, "")], SCHEMA).withColumn("prefix", F.pmod(F.xxhash64("id"), F.lit(16)).cast("int"))
    plan = h.known(1, one)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(prefix" in plan or "PartitionFilters: [prefix" in plan or "(prefix" in plan.split("PartitionFilters")[1][:80]
    assert h.known(1, one).count() == 1  # the id itself is handed to the scan as well
    assert h.known(0, one) is None


def test_seen_ids_take_little_room(spark):
    """Bloom filters follow the ids of a file, and a prefix has one file a batch however many tasks wrote the rows."""
    import pathlib
    out, ids = scratch_path(spark, "t-out"), scratch_path(spark, "t-seen")
    h = SeenIds(spark, out, ids, "id", [], prefixes=16)
    rows = [(f"x{i}", i, "") for i in range(400)] + [(None, 0, "")]
    for n, part in enumerate((rows[:200], rows)):
        h(spark.createDataFrame(part, SCHEMA).repartition(8), n)
    files = [f for f in pathlib.Path(ids.removeprefix("file:")).rglob("*.parquet")]
    assert len(files) <= 2 * 16 and sum(f.stat().st_size for f in files) < 200_000
    assert h.out.read().count() == h.seen.read().distinct().count() == 401


def test_rows_are_shuffled_once_by_id(spark):
    rows = seen.first_rows(spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 3, "z")], SCHEMA), "id", ["t"])
    assert sorted(map(tuple, rows.collect()), key=str) == [("a", 1, "y"), (None, 3, "z")]
    old = spark.createDataFrame([("a",)], "_id string")
    met = rows.join(old.hint("merge"), F.col("id") == F.col("_id"), "left_anti")
    assert [r.note for r in met.collect()] == ["z"]
    assert met._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == 2


def test_counts_add_up_over_merges_and_retries(spark):
    from tidemark.streaming.last_rows import Counts
    t = Counts(spark, scratch_path(spark, "t-counts"), ["k"], fan=2)
    want = {}
    for n in range(9):
        rows = [(random.Random(n).choice(["a", None, "c"]),) for _ in range(n)]
        t(spark.createDataFrame(rows, "k string"), n)
        if n == 4:
            t(spark.createDataFrame(rows, "k string"), n)
        for (k,) in rows:
            want[k] = want.get(k, 0) + 1
    assert {r.k: r.n for r in t.totals().collect()} == want
    assert t.read().count() <= 3 * len(t.latest()["parts"])


def test_input_is_admitted_by_bytes(spark):
    """Files of 1, 1, 4 and 1 parts: a limit of 2 takes whole files until it is reached."""
    import os

    import pytest

    from tidemark.streaming.sources import read_stream, release
    staged, src = scratch_path(spark, "t-staged"), scratch_path(spark, "t-admitted")
    os.makedirs(staged.removeprefix("file:"))
    sizes = [1, 1, 4, 1]
    for i, n in enumerate(sizes):
        with open(f"{staged.removeprefix('file:')}/part-{i}.json", "w") as f:
            f.write('{"key": "0123456789"}\n' * n * 100)
    release(spark, [f"{staged}/part-{i}.json" for i in range(4)], src)
    got = []
    q = (read_stream(spark, "json", path=src, schema="key string", max_bytes=2 * 100 * len('{"key": "0123456789"}\n')).writeStream
         .foreachBatch(lambda b, n: got.append(b.count() // 100)).option("checkpointLocation", scratch_path(spark, "t-adm-ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert got == [2, 4, 1]
    with pytest.raises(ValueError):
        read_stream(spark, "json", path=src, max_per_trigger=1, max_bytes=1)

"""Exact de-duplication against a minimal perfect hash of historical digests.

Rows are reduced to (id, SHA-256 of the normalised text). Distinct digests are
pre-aggregated with map-side combine (largest id, count), hash-partitioned into
buckets of bounded size, and each bucket builds a minimal perfect hash over
its *historical* distinct digests: one slot per digest, holding the full digest
and the winner's locator. Digests of newly arrived rows are looked up; the slot's
32 bytes are compared, members are folded into the slot, nonmembers are grouped
on their own. Finally every row looks its digest up again; buckets with many
rows are salted and their (small) index is copied to each salt, so a text that
makes up a third of all rows is spread over many tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialise, pack, parts_for, ship, unpack

GAMMA = 1.7
NO_ID = -(2**63)


def _words(digests: np.ndarray) -> np.ndarray:
    return digests.reshape(-1, 32).view("<u8")


def _hash(words: np.ndarray, level: int) -> np.ndarray:
    x = np.full(len(words), 0x9E3779B97F4A7C15 * (level + 1) % 2**64, np.uint64)
    for k in range(4):
        x = (x ^ words[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def build_mphf(digests: np.ndarray) -> list[np.ndarray]:
    """Levels of bit arrays: at each level the keys that land alone in a position
    own it, the rest go on to the next level. A key's slot is its bit's rank
    over all levels, hence 0..n-1 without gaps. ``digests``: distinct, n x 32 bytes."""
    words, levels = _words(digests), []
    while len(words):
        size = max(1, int(GAMMA * len(words)))
        at = (_hash(words, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        words = words[~alone[at]]
    return levels


def mphf_slots(levels: list[np.ndarray], digests: np.ndarray) -> np.ndarray:
    """Slot of each digest, -1 where no level claims it. A nonmember may get a
    member's slot: compare the digest held there."""
    words = _words(digests)
    out, open_, base = np.full(len(words), -1, np.int64), np.arange(len(words)), 0
    for k, bits in enumerate(levels):
        if not len(open_):
            break
        at = (_hash(words[open_], k) % np.uint64(len(bits))).astype(np.int64)
        rank = np.cumsum(bits)
        own = bits[at]
        out[open_[own]] = base + rank[at[own]] - 1
        open_, base = open_[~own], base + int(rank[-1])
    return out


def _bytes(col: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, 32)


def _fill(levels, digests, values, dtype):
    out = np.zeros((len(digests),) + np.shape(values)[1:], dtype)
    out[mphf_slots(levels, digests)] = values
    return out


INDEX = "bucket long, index binary, rows long"


def _build(key, t):
    digest, old = _bytes(t["digest"]), np.array(t["hist"].to_pylist(), bool)
    top, n = t["top"].to_numpy(), t["n"].to_numpy()
    hist = digest[old]
    levels = build_mphf(hist)
    slot_digest = _fill(levels, hist, hist, np.uint8)
    slot_top, slot_n = _fill(levels, hist, top[old], np.int64), _fill(levels, hist, n[old], np.int64)
    new, new_top, new_n = digest[~old], top[~old], n[~old]
    slot = mphf_slots(levels, new)
    member = slot >= 0
    member[member] = (slot_digest[slot[member]] == new[member]).all(axis=1)
    np.maximum.at(slot_top, slot[member], new_top[member])
    np.add.at(slot_n, slot[member], new_n[member])
    rest = new[~member]  # distinct already: grouped before the shuffle
    rest_levels = build_mphf(rest)
    blob = []
    for lv, dg, tp, ct in ((levels, slot_digest, slot_top, slot_n),
                           (rest_levels, _fill(rest_levels, rest, rest, np.uint8),
                            _fill(rest_levels, rest, new_top[~member], np.int64),
                            _fill(rest_levels, rest, new_n[~member], np.int64))):
        sizes = np.array([len(x) for x in lv], np.int64)
        bits = np.packbits(np.concatenate(lv)) if lv else np.zeros(0, np.uint8)
        blob += [sizes, bits, dg.reshape(-1), tp, ct]
    return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "index": pa.array([pack(*blob)], pa.binary()),
                     "rows": pa.array([int(n.sum())], pa.int64())})


def _open(blob: bytes):
    parts = unpack(blob)
    for k in (0, 5):
        sizes, bits, dg, top, n = parts[k:k + 5]
        flat = np.unpackbits(bits, count=int(sizes.sum())).astype(bool)
        yield np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else [], dg.reshape(-1, 32), top, n


RESULT = "id long, digest binary, keep_id long, group_size long, kept boolean"


def _look_up(rows: pa.Table, index: pa.Table) -> pa.Table:
    ids, digest = rows["id"].to_numpy(), _bytes(rows["digest"])
    keep, size = np.full(len(ids), NO_ID), np.zeros(len(ids), np.int64)
    for blob in index["index"].to_pylist()[:1]:
        for levels, dg, top, n in _open(blob):
            slot = mphf_slots(levels, digest)
            hit = slot >= 0
            hit[hit] = (dg[slot[hit]] == digest[hit]).all(axis=1)
            keep[hit], size[hit] = top[slot[hit]], n[slot[hit]]
    kept = ids == keep
    at = np.flatnonzero(kept)  # repeated rows of the winner: one stays
    first = np.unique(digest[at].view("V32").reshape(-1), return_index=True)[1] if len(at) else at
    kept[:] = False
    kept[at[first]] = True
    null = lambda x: pa.array(x, pa.int64(), mask=x == NO_ID)
    return pa.table({"id": null(ids), "digest": rows["digest"], "keep_id": null(keep),
                     "group_size": pa.array(size), "kept": pa.array(kept)})


def exact_dedup(docs: DataFrame, is_history: Column, id_col: str = "doc_id", text_col: str = "text",
                per_bucket: int = 50_000) -> DataFrame:
    """One row per document: id, digest (SHA-256 of the text with A-Z
    lower-cased), keep_id (largest id of the equal texts), group_size, kept.

    ``is_history`` marks the rows the index is built from; the others are
    looked up in it. The result doesn't depend on the mark. Null text counts as
    empty, a null id is below every id, of repeated rows of a winner one is kept,
    an empty table gives no rows; other columns are not read.
    """
    ship(docs.sparkSession)
    keyed = materialise(docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.unhex(F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).cast("binary"), 256)).alias("digest"),
        F.coalesce(is_history, F.lit(False)).alias("hist")), "exact-dedup")  # narrow: texts are read once
    buckets = parts_for(keyed.count(), per_bucket)
    bucket = F.pmod(F.xxhash64("digest"), F.lit(buckets))
    groups = keyed.groupBy("digest", "hist").agg(F.max("id").alias("top"), F.count("*").alias("n"))
    index = groups.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(_build, INDEX)
    salts = F.greatest(F.lit(1), F.ceil(F.col("rows") / (2 * per_bucket))).cast("long")
    counts = groups.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("rows")).select("bucket", salts.alias("salts"))
    # one narrow row per bucket: broadcast up to a million buckets, shuffled beyond
    counts = F.broadcast(counts) if buckets <= 1_000_000 else counts
    rows = (keyed.withColumn("bucket", bucket).join(counts, "bucket")
            .select("bucket", F.pmod(F.xxhash64("id"), "salts").alias("salt"), "id", "digest"))
    index = index.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("rows")
    return rows.groupBy("bucket", "salt").cogroup(index.groupBy("bucket", "salt")).applyInArrow(_look_up, RESULT)

"""SimHash near-de-duplication by pigeonhole blocks.

A document's fingerprint is the bitwise majority of the XXH64 values of its word
shingles. The 64 bits are split into ``max_bits + agree`` blocks: two
fingerprints at most ``max_bits`` apart agree on at least ``agree`` whole
blocks, so joining on every combination of ``agree`` blocks misses no pair,
and the Hamming distance decides. Fingerprints are made distinct first
(copies are one node); a block bucket is one sorted run that is streamed
through a task, and yields a spanning forest of its links (linear in its
size) instead of all its pairs: only reachability is asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, runs, ship
from .components import connected_components

BITS = 64
SEED = 42


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """Majority bits over the shingles' hashes, repeats included; a bit is 1 if
    more than half have it. Fewer words than a shingle: the whole sequence is
    one; no words: zero."""
    words = (text or b"").lower().split()  # bytes: A-Z only, and the six ASCII spaces only
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(flat, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    h = xxhash.xxh64_digest
    raw = b"".join([h(flat[s:e], SEED) for s, e in zip(starts[:len(words) - shingle + 1].tolist(),
                                                       ends[shingle - 1:].tolist())])
    bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > len(bits)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                 row_col: str | None = None) -> DataFrame:
    """(id, fp[, row]) for every row; fp is the fingerprint as a signed long, row the binary ``row_col``."""
    row = [F.col(row_col).cast("binary").alias("row")] if row_col else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            fp = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), *b.columns[2:]], ["id", "fp", *b.schema.names[2:]])
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), *row
                       ).mapInArrow(run, "id long, fp long" + (", row binary" if row else ""))


def block_masks(max_bits: int, agree: int) -> list[int]:
    """One mask for every combination of ``agree`` of the blocks, as signed longs."""
    cuts = np.linspace(0, BITS, max_bits + agree + 1).round().astype(int)
    blocks = [sum(1 << i for i in range(a, b)) for a, b in zip(cuts[:-1], cuts[1:])]
    masks = [sum(c) for c in combinations(blocks, agree)]
    return [m - 2**64 if m >= 2**63 else m for m in masks]


def spanning_links(fp: np.ndarray, node: np.ndarray, max_bits: int) -> tuple[list, list]:
    """Links that connect what the bucket's links within ``max_bits`` connect:
    breadth-first over the nodes not reached yet, so dense groups end early."""
    a, b, open_ = [], [], np.arange(len(fp))
    while len(open_) > 1:
        queue, open_ = [open_[0]], open_[1:]
        root = node[queue[0]]
        while queue and len(open_):
            near = np.bitwise_count(fp[open_] ^ fp[queue.pop()]) <= max_bits
            if near.any():
                got = open_[near]
                queue.extend(got.tolist())
                a.extend([int(root)] * len(got))
                b.extend(node[got].tolist())
                open_ = open_[~near]
    return a, b


def _bucket_links(max_bits: int):
    def of(table, key, fp, node):
        """Links of whole buckets, given sorted by (table, key)."""
        fp = fp.view(np.uint64)
        starts = np.flatnonzero(np.r_[True, (table[1:] != table[:-1]) | (key[1:] != key[:-1])]) if len(fp) else []
        size = np.diff(np.r_[starts, len(fp)]) if len(fp) else np.zeros(0, int)
        two = np.asarray(starts, int)[size == 2]
        near = np.bitwise_count(fp[two] ^ fp[two + 1]) <= max_bits
        a, b = node[two[near]].tolist(), node[two[near] + 1].tolist()
        for s, n in zip(np.asarray(starts, int)[size > 2].tolist(), size[size > 2].tolist()):
            x, y = spanning_links(fp[s:s + n], node[s:s + n], max_bits)
            a += x
            b += y
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []  # the last bucket may go on in the next batch
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(cols[0]):
                continue
            if held and held[-1][0][-1] == cols[0][-1] and held[-1][1][-1] == cols[1][-1] \
                    and held[-1][0][0] == cols[0][0] and held[-1][1][0] == cols[1][0]:
                held.append(cols)  # all of one bucket so far
                continue
            cols = [np.concatenate(x) for x in zip(*held, cols)]
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield of(*[c[:cut] for c in cols])
            held = [[c[cut:] for c in cols]]
        if held:
            yield of(*[np.concatenate(x) for x in zip(*held)])
    return run


def block_buckets(nodes: DataFrame, masks: list[int], per_chunk: int) -> DataFrame:
    """(t, k, fp, node): every row once per mask, a bucket being one (t, k). One with
    more than ``per_chunk`` rows is dealt into chunks, and every two chunks are a bucket."""
    tables = F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"))
                                 for i, m in enumerate(masks)]))
    keyed = nodes.select(tables.alias("x"), "fp", "node").select("x.t", "x.k", "fp", "node")
    sizes = keyed.groupBy("t", "k").agg(F.count("*").alias("n")).where(F.col("n") > per_chunk)
    sizes = sizes.select("t", "k", F.ceil(F.col("n") / per_chunk).cast("long").alias("s"))
    # at most len(masks) / per_chunk of the rows
    dealt = (keyed.join(F.broadcast(sizes), ["t", "k"], "left").withColumn("s", F.coalesce("s", F.lit(1).cast("long")))
             .withColumn("own", F.pmod(F.xxhash64("fp"), "s"))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("s") - 1)))
             .where("s = 1 OR own <> other"))
    pair = F.least("own", "other") * F.col("s") + F.greatest("own", "other")
    return dealt.select((F.col("t") + len(masks) * pair).alias("t"), "k", "fp", "node")


def near_links(nodes: DataFrame, max_bits: int = 4, agree: int = 2, per_chunk: int = 50_000) -> DataFrame:
    """(a, b) links over (fp, node) rows with distinct fp that connect exactly
    what all links at ``max_bits`` or fewer differing bits connect. A bucket in a
    task has about ``2 * per_chunk`` rows at most."""
    ship(nodes.sparkSession)
    keyed = block_buckets(nodes, block_masks(max_bits, agree), per_chunk)
    return (keyed.repartition("t", "k").sortWithinPartitions("t", "k")
            .mapInArrow(_bucket_links(max_bits), "a long, b long"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                  max_bits: int = 4, agree: int = 2, row_col: str | None = None) -> DataFrame:
    """(id, fp, component_id[, row, kept]) per document: the smallest id reachable over
    links of at most ``max_bits`` differing fingerprint bits, itself included.

    Null text counts as empty (fingerprint zero); a null id is part of its
    group, links it and never names it, and a group of null ids only has a null one.
    Repeated rows get equal results; an empty table gives none. ``row_col`` (binary)
    tells rows of one id apart: kept is then true for one row of a named group,
    the smallest by id and row, and for all rows of a group of null ids only.
    """
    prints = materialise(fingerprints(docs, id_col, text_col, shingle, row_col), "simhash")
    own = F.struct("id", "row") if row_col else F.col("id")
    first = F.min(F.when(F.col("id").isNotNull(), own)) if row_col else F.min(own)
    nodes = prints.groupBy("fp").agg(first.alias("first"))
    nodes = materialise(nodes.select("fp", F.col("fp").alias("node"), "first"), "simhash-nodes")
    found = connected_components(near_links(nodes, max_bits, agree))
    member = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("group"), "first")
    named = member.groupBy("group").agg(F.min("first").alias("least"))
    got = prints.join(member.join(named, "group").select("fp", "least"), "fp", "left")
    if not row_col:
        return got.select("id", "fp", F.col("least").alias("component_id"))
    return got.select("id", "fp", F.col("least.id").alias("component_id"), "row",
                      F.coalesce(F.col("least") == own, F.col("least").isNull()).alias("kept"))

import hashlib
import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import embedding_dedup as emb
from tidemark.llm import exact_dedup as exact
from tidemark.llm import simhash
from tidemark.llm import substring_dedup as sub
from tidemark.llm.common import pack, unpack
from tidemark.llm.components import connected_components

from .helpers import documents, empty


def split(t):
    return (t or "").encode().split()


def test_pack_round_trip():
    cols = [np.arange(5), np.zeros(0, np.uint32), np.array([7], np.uint8), np.random.default_rng(1).random(9)]
    for a, b in zip(cols, unpack(pack(*cols))):
        assert a.dtype == b.dtype and (a == b).all()


def test_components_chain_star_and_ties(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(20)] + [(300, 300), (None, 4), (7, 6), (501, 500)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(20)} | {500: 500, 501: 500}
    assert got == want
    assert connected_components(empty(spark, "a long, b long")).count() == 0


def brute_substring(rows, window=13):
    """rows: (id, text); the contract on whole texts, window by window."""
    first = {}
    for i, t in rows:
        w = split(t)
        for p in range(len(w) - window + 1):
            s = tuple(w[p:p + window])
            first[s] = min(first.get(s, i), i)
    out = []
    for i, t in rows:
        w = split(t)
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out)


def test_substring_rows_of_one_id(spark):
    """Two texts of one id: what one repeats is cut from it, the other keeps all its words; repeated rows stay equal."""
    words = lambda k, n: " ".join(f"{k}{i}" for i in range(n))
    p = words("p", 20)
    rows = [(1, p + " x"), (7, p + " " + words("a", 60)), (7, words("z", 60)), (7, words("z", 60)), (9, words("z", 30)), (None, p), (None, words("n", 40))]
    got = sub.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), carry=["doc_id"]).collect()
    assert sorted(((r.id, r.n_words, r.n_removed) for r in got), key=str) == sorted(
        [(1, 21, 0), (7, 80, 20), (7, 60, 0), (7, 60, 0), (9, 30, 30), (None, 20, 20), (None, 40, 0)], key=str)
    assert {r.kept_text for r in got if r.id == 7} == {words("a", 60), words("z", 60)}
    two = [(3, p + " a"), (3, p + " b")]  # one of the two keeps the passage
    got = sub.substring_dedup(spark.createDataFrame(two, "doc_id long, text string")).collect()
    assert sorted(r.n_removed for r in got) == [0, 20] and all(r.id == 3 for r in got)


@pytest.mark.parametrize("group_bytes", [4 << 20, 3000])
def test_substring_brute_force(spark, group_bytes):
    docs = documents(spark).where("doc_id is not null")
    want = brute_substring([(r.doc_id, r.text) for r in docs.collect()])
    # extra columns with the operator's own names don't matter
    got = sub.substring_dedup(docs.withColumn("blob", F.lit(1)).withColumn("id", F.lit(2)), group_bytes=group_bytes)
    rows = got.collect()
    assert sorted((r.id, r.n_words, r.n_removed, r.kept_text) for r in rows) == want
    assert sum(r.n_removed for r in rows) > 0
    for r in rows:
        assert sum(s["last"] - s["first"] + 1 for s in r.spans) == r.n_removed


def test_substring_many_random_tables(spark):
    rnd = random.Random(3)
    for _ in range(3):  # few words: many chance repeats, inside documents too
        rows = [(i, " ".join(rnd.choice("ab") for _ in range(rnd.randrange(0, 60)))) for i in range(40)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        got = sub.substring_dedup(docs, group_bytes=500)
        assert sorted((r.id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()) == brute_substring(rows)


def test_substring_null_ids_cut_text_and_empty(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(5, f"Head\n{passage}\n tail"), (9, f"x  y\n{passage}\nz"), (None, passage), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s"))
    got = sub.substring_dedup(docs, carry=["source"], cut_text=True).collect()
    by = {(r.id, r.n_words): r for r in got}
    assert by[5, 22].kept_text == rows[0][1] and by[5, 22].n_removed == 0
    assert by[9, 23].kept_text == "x  y\nz" and by[9, 23].extra == '{"source":"s"}'
    assert by[None, 20].n_removed == 20 and by[None, 20].kept_text == ""
    assert by[None, 0].n_removed == 0
    assert sub.substring_dedup(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        sub.substring_dedup(docs, window=12, block=7)


def test_substring_one_hash_per_batch():
    """A passage in every document of a batch is sent for two of them."""
    import pyarrow as pa
    passage = " ".join(f"p{i}" for i in range(30))
    batch = pa.RecordBatch.from_arrays([pa.array(range(500)), pa.array([passage] * 500)], ["id", "text"])
    entries = [sub._open(b) for t in sub._probe(7, 13, 1, 1)(iter([batch])) for b in t["blob"].to_pylist()]
    asked = sum(int((e[2] & sub.KNOWN == 0).sum()) for e in entries)
    assert asked == 2 * 24


def test_mphf_is_minimal_and_perfect():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 256, (5000, 32), np.uint8), axis=0)
    levels = exact.build_mphf(keys)
    slots = exact.mphf_slots(levels, keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    assert exact.mphf_slots(exact.build_mphf(keys[:0]), keys).max() == -1
    other = rng.integers(0, 256, (2000, 32), np.uint8)
    at = exact.mphf_slots(levels, other)
    assert at.max() < len(keys)  # nonmembers may hit a slot: bytes decide


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


@pytest.mark.parametrize("history", ["true", "false", "doc_id % 2 = 0"])
def test_exact_brute_force(spark, history):
    docs = documents(spark).withColumn("digest", F.lit("clash")).withColumn("kept", F.lit(0))
    rows = docs.collect()
    groups = {}
    for r in rows:
        groups.setdefault(lower(r.text), []).append(r.doc_id)
    key = lambda i: -10**9 if i is None else i
    want = []
    for r in rows:
        g = groups[lower(r.text)]
        want.append((r.doc_id, max(g, key=key), len(g), hashlib.sha256(lower(r.text).encode()).hexdigest()))
    got = exact.exact_dedup(docs, F.expr(history), per_bucket=10).collect()
    srt = lambda x: sorted(x, key=lambda t: (key(t[0]), key(t[1]), *t[2:]))
    assert srt((r.id, r.keep_id, r.group_size, bytes(r.digest).hex()) for r in got) == srt(want)
    assert sum(r.kept for r in got) == len(groups)  # one row of each group, repeated winners too
    assert all(key(r.id) == key(r.keep_id) for r in got if r.kept)


def test_exact_empty(spark):
    assert exact.exact_dedup(empty(spark), F.lit(True)).count() == 0


def slow_fingerprint(text, n=4):
    w = lower(text).encode().split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, linked):
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def test_simhash_brute_force(spark):
    docs = documents(spark, seed=8, n=90).withColumn("fp", F.lit(1)).withColumn("component_id", F.lit(1))
    rows = docs.collect()
    fps = [slow_fingerprint(r.text) for r in rows]
    ids = [r.doc_id for r in rows]
    at = range(len(rows))
    order = [i if ids[i] is not None else None for i in at]
    linked = [(a, b) for a in at for b in at if a < b and bin(fps[a] ^ fps[b]).count("1") <= 4]
    assert len(linked) > 10 and order
    low = components(at, linked)
    names = {}
    for i in at:
        if ids[i] is not None:
            names[low[i]] = min(names.get(low[i], ids[i]), ids[i])
    key = lambda t: tuple(-10**9 if x is None else x for x in t)
    want = sorted(((ids[i], fps[i] - 2**64 if fps[i] >= 2**63 else fps[i], names.get(low[i])) for i in at), key=key)
    got = sorted((tuple(r) for r in simhash.simhash_dedup(docs).collect()), key=key)
    assert got == want
    assert simhash.simhash_dedup(empty(spark)).count() == 0


def test_simhash_links_through_null_ids(spark, monkeypatch):
    """1 and 2 are near the null row only; the null rows at the end have no named partner."""
    rows = [(1, "a"), (None, "b"), (2, "c"), (None, "d"), (None, "e"), (7, "f"), (None, "g")]
    x = 0x0123456789ABCDEF
    fps = {"a": x, "b": x ^ 0xF, "c": x ^ 0xFF, "d": ~x & 2**64 - 1, "e": ~x & 2**64 - 1 ^ 1, "f": x ^ 0xFFFF0000, "g": x ^ 0xFFFE0000}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    signed = {t: f - 2**64 if f >= 2**63 else f for t, f in fps.items()}
    prints = spark.createDataFrame([(i, signed[t]) for i, t in rows], "id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *a, **b: prints)
    got = {r.fp: r.component_id for r in simhash.simhash_dedup(docs).collect()}
    assert {t: got[signed[t]] for t in fps} == {"a": 1, "b": 1, "c": 1, "d": None, "e": None, "f": 7, "g": 7}


def test_simhash_hash_is_sparks(spark):
    """XXH64 with seed 42 is also what Spark's own function gives."""
    r = spark.sql("select xxhash64('a b c d') h").first()
    assert r.h & (2**64 - 1) == simhash.fingerprint(b"A b  c\nd")


def test_pigeonhole_misses_no_pair():
    rnd = random.Random(4)
    masks = simhash.block_masks(4, 2)
    assert len(masks) == math.comb(6, 2)
    for _ in range(3000):
        x = rnd.getrandbits(64)
        y = x
        for b in rnd.sample(range(64), 4):
            y ^= 1 << b
        assert any((x ^ y) & (m & (2**64 - 1)) == 0 for m in masks)


def test_spanning_links_connect_the_same():
    rnd = random.Random(6)
    base = rnd.getrandbits(64)
    fps = np.array([base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(6))) for _ in range(200)], np.uint64)
    fps = np.unique(fps)
    n = len(fps)
    links = [(a, b) for a in range(n) for b in range(a) if bin(int(fps[a] ^ fps[b])).count("1") <= 4]
    a, b = simhash.spanning_links(fps, np.arange(n), 4)
    assert len(a) < n
    assert components(range(n), links) == components(range(n), list(zip(a, b)))


def test_simhash_large_buckets_are_split(spark):
    """One template: all fingerprints share two blocks, most are further than 4 bits apart."""
    rnd = random.Random(7)
    fps = sorted({rnd.getrandbits(40) for _ in range(300)})
    fps = sorted({*fps, *(f ^ 1 << rnd.randrange(40) for f in fps[::3])})
    nodes = spark.createDataFrame([(f, f) for f in fps], "fp long, node long")
    parts = simhash.block_buckets(nodes, simhash.block_masks(4, 2), 50)
    assert parts.groupBy("t", "k").count().agg(F.max("count")).first()[0] < 180  # of 400
    pairs = [(a, b) for a in fps for b in fps if a < b and bin(a ^ b).count("1") <= 4]
    assert len(pairs) >= 100
    for per_chunk in (50, 50_000):
        got = [tuple(r) for r in simhash.near_links(nodes, per_chunk=per_chunk).collect()]
        assert components(fps, got) == components(fps, pairs)


def vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 16))
    rows = [(i, base[i % 40] + rng.standard_normal(16) * rng.choice([0.0, 0.1, 0.25])) for i in range(300)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    rows += [(400, rows[3][1]), (401, [2 * x for x in rows[3][1]]), rows[5], (402, None), (403, []), (404, [0.0] * 16),
             (405, [float("nan")] * 16), (406, [float("inf")] + [1.0] * 15), (407, [None] + [1.0] * 15), (None, rows[3][1]),
             (408, [1.0, 0.0]), (409, [2.0, 0.0])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("node", F.lit(1)).withColumn("size", F.lit(2))


def test_embedding_brute_force(spark):
    df = vectors(spark)
    rows = df.collect()
    x = [None if r.vec_id is None or not r.embedding or any(v is None or not math.isfinite(v) for v in r.embedding)
         or not any(r.embedding) else np.array(r.embedding, float) for r in rows]
    at = [i for i in range(len(rows)) if x[i] is not None]
    linked = [(a, b) for a in at for b in at if a < b and len(x[a]) == len(x[b])
              and x[a] @ x[b] / np.linalg.norm(x[a]) / np.linalg.norm(x[b]) >= 0.95]
    low, n = components(at, linked), dict.fromkeys(range(len(rows)), 0)
    names = {}
    for i in at:
        names[low[i]] = min(names.get(low[i], rows[i].vec_id), rows[i].vec_id)
    for a, b in linked:
        n[a] += 1
        n[b] += 1
    want = []
    for i, r in enumerate(rows):
        c = names[low[i]] if i in low else r.vec_id
        want.append((r.vec_id, n[i], c, c is not None and r.vec_id == c))
    key = lambda t: tuple(-1 if v is None else v for v in t)
    for per_chunk in (6000, 40):
        got = emb.embedding_dedup(df, per_chunk=per_chunk).collect()
        assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert sum(n.values()) > 100
    assert emb.embedding_dedup(empty(spark, "vec_id long, embedding array<float>")).count() == 0


def test_embedding_count_is_calibrated():
    """Pairs exactly at the threshold reach the count nearly always, random ones hardly ever."""
    place, half, need = emb.calibrate(0.95, 16, 0.9999)
    rng = np.random.default_rng(9)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal((4000, 64))
    y -= (x * y).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    a = emb.directions(64, 18)
    for z, low, high in ((0.95 * x + math.sqrt(1 - 0.95**2) * y, 0.998, 1.0), (y, 0.0, 0.02)):
        gap = np.abs((x - z) @ a)
        found = (gap[:, :2] <= place).all(1) & ((gap[:, 2:] <= half).sum(1) >= need)
        assert low <= found.mean() <= high


def test_projections_as_bytes_lose_no_collision():
    rng = np.random.default_rng(4)
    p, r = rng.standard_normal(200) * 2, rng.standard_normal(300) * 2
    p[:20], r[:20] = p[0] + np.arange(20) * 0.1, p[0]  # gaps at the very edge of windows
    gap, flag = np.empty((200, 300), np.uint8), np.empty((200, 300), bool)
    for half in (0.0, 0.1, 0.5, 0.7, 1.33, 2.5, 4.2):
        near = np.abs(p[:, None] - r[None, :]) <= half
        got = emb.collide(emb.levels(p), emb.levels(r), emb.window(half), gap, flag)
        assert got[near].all()
        if half < 2:  # and few others, those a whole turn away left out
            assert (got & (np.abs(p[:, None] - r[None, :]) > half + 2 * emb.LEVEL)).mean() < 0.2
    apart = np.abs(p[:, None] - r[None, :]) < 3
    got = emb.collide(emb.levels(p), emb.levels(r), emb.window(0.7), gap, flag)
    assert not (got & apart & (np.abs(p[:, None] - r[None, :]) > 0.75)).any()

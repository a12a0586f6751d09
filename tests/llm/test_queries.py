"""The registered queries without SQL, run whole and held against brute force: columns, types, digests, flags."""

import hashlib
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import embedding_dedup, quality
from tidemark.llm.common import crc_bucket
from tidemark.llm.queries import QUERIES

from .helpers import documents
from .test_dedup import components, slow_fingerprint


def crc(i, mod):
    return zlib.crc32(str(i).encode()) % mod


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("queries"))
    docs = documents(spark, n=90).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    docs.write.parquet(f"{at}/documents.parquet")
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    spark.createDataFrame([(i, k % 2, 0) for k, i in enumerate(ids[::2])], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


@pytest.fixture(scope="module")
def texts(spark, tables):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}


def run(spark, tables, name, columns):
    df = QUERIES[name](spark, tables)
    assert df.dtypes[:len(columns)] == columns
    return df.collect()


def test_op4_query(spark, tables, texts):
    rows = run(spark, tables, "op4_language_id", [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")])
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        letters = any(map(str.isalpha, texts[r.doc_id] or ""))
        assert r.held_out == (crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not letters) and r.lang_pred in ("en", "fr", "und")


def test_op5_query(spark, tables, texts):
    rows = run(spark, tables, "op5_hilbert_sharding", [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"),
                                                       ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")])
    raw = {i: (t or "").encode() for i, t in texts.items()}
    assert {(r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in rows} == {
        (i, len(b) + 16, zlib.crc32(b), "rows", None) for i, b in raw.items()} and len(rows) == len(raw)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    per = [len(slots[k]) for k in range(40)]
    assert set(slots) == set(range(40)) and max(per) - min(per) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_op7_query(spark, tables, texts):
    rows = run(spark, tables, "op7_simhash_dedup", [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")])
    fp = {i: slow_fingerprint(t) for i, t in texts.items()}
    ids = sorted(fp)
    low = components(ids, [(a, b) for a in ids for b in ids if a < b and bin(fp[a] ^ fp[b]).count("1") <= 4])
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {(i, f"{fp[i]:016x}", low[i]) for i in ids} and len(rows) == len(ids)


def test_op8_query(spark, tables, texts):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lib.no_truncation()
    lib.no_padding()
    rows = run(spark, tables, "op8_bpe", [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")])
    want = set()
    for i, t in texts.items():
        ids = lib.encode(t or "", add_special_tokens=False).ids
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        want.add((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert set(map(tuple, rows)) == want and len(rows) == len(want)


def test_op9_query(spark, tables, texts):
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = run(spark, tables, "op9_packing", [("doc_id", "bigint"), ("piece", "int"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"),
                                              ("sequence_id", "bigint"), ("offset", "bigint")])
    want, filled = set(), defaultdict(list)
    for i, t in texts.items():
        ids = lib.encode(t or "", add_special_tokens=False).ids + [0]
        for n, s in enumerate(range(0, len(ids), 2048)):
            cut = ids[s:s + 2048]
            want.add((i, n, s, len(cut), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in cut))))
    assert {tuple(r)[:5] for r in rows} == want and len(rows) == len(want)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(filled) <= -(-sum(r.length for r in rows) // 2048) + 1


def test_op10_query_and_its_labels(spark, tables, texts):
    rows = run(spark, tables, "op10_quality", [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")])
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.held_out == (crc(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    docs, labels = spark.read.parquet(f"{tables}/documents.parquet"), spark.read.parquet(f"{tables}/labels.parquet")
    learn = crc_bucket("doc_id", 5) != 0
    a = quality.train(docs, labels, learn)
    b = quality.train(docs, labels.withColumn("quality", F.when(~learn, 1 - F.col("quality")).otherwise(F.col("quality"))), learn)
    t = next(t for t in texts.values() if t and len(t) > 200).encode()
    assert a.score(t, quality.Words()) == b.score(t, quality.Words())  # held-out labels are not learned from


def test_embedding_lengths_leave_the_range_of_doubles(spark):
    """Parallel vectors are copies whatever their length; the squares of these are no finite, or no other, doubles than zero."""
    rows = [(1, [1e200, 2e200, 0.0]), (2, [2e200, 4e200, 0.0]), (3, [1e-200, 2e-200, 0.0]), (4, [5e-324, 1e-323, 0.0]), (5, [-1e200, 0.0, 1e-300]),
            (6, [1.0, 2.0, 0.0]), (7, [0.0, 0.0, 3e307])]
    got = embedding_dedup.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.id: (r.n_links, r.component_id) for r in got} == {1: (4, 1), 2: (4, 1), 3: (4, 1), 4: (4, 1), 6: (4, 1), 5: (0, 5), 7: (0, 7)}
    assert Counter(r.kept for r in got) == {True: 3, False: 4}

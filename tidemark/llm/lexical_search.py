"""Ranked lexical search with bit-sliced Bloom signatures.

Indexing gives every document a Bloom filter of its terms; a block of documents is
stored slice by slice: slice ``j`` is the bitmap of the block's documents whose filter has bit ``j``. The
documents that may hold a term are the AND of the term's few slices, always a
superset. A term that occurs often is entered once per level (at least 1, 2,
3, 4, 6, 8, ... times), so slices also bound how often a document may hold it.

For a query, the sum over its terms of weight times the largest contribution that
the slices and the document's length allow is an upper bound of the document's
score. The documents with the best bounds are scored exactly; their k-th best
score is a score that the answer reaches at least, so every document whose bound is below it is
provably out, and all others are scored exactly from their whole text.

Documents of like numbers of entries share a block (and a signature width), so
a very long document fills its own filter and no other's. Queries are taken in
blocks of bounded size; nothing about the documents goes to the driver but
the sums over all of them and, per query, the k-th score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, give_back, materialise, pack, ship, unpack

#: Fixed value: the characters that a term is made of.
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
#: Occurrences from which a term is entered once more.
LEVELS = [1, 2, 3, 4, 6, 8, 12, 16, 32, 64, 256, 1024]
#: Bits of a filter per entry, and bits set by one.
BITS, HASHES = 10, 3
#: Bytes of one block's slices, and documents of one block, at most.
BLOCK_BYTES, BLOCK_DOCS = 1 << 20, 8192
#: Terms whose document counts a task holds before it hands them on.
HELD = 300_000

INDEX = "width long, ids binary, sizes binary, slices binary, term string, df long"


def terms_of(text: str) -> list[str]:
    """The terms of a whole text whose A-Z are lower-cased already."""
    return TERM.findall(text)


def _bits(term: str, level: int, width: int) -> list[int]:
    """The slices of one entry: all of them hold a document that has the term so often."""
    h = xxhash.xxh64_intdigest(term.encode(), level)
    a, b = h & 0xFFFFFFFF, h >> 32 | 1
    return [(a + k * b) % width for k in range(HASHES)]


class _Block:
    """Documents of one signature width, until they are written."""

    def __init__(self, width: int):
        self.width, self.ids, self.sizes, self.at = width, [], [], []
        self.room = min(BLOCK_DOCS, max(8, BLOCK_BYTES * 8 // width // 8 * 8))

    def add(self, doc_id: int | None, n: int, bits: np.ndarray) -> None:
        self.at.append(bits)
        self.ids.append(doc_id)
        self.sizes.append(n)

    def out(self) -> tuple:
        docs = -(-len(self.ids) // 8) * 8
        matrix = np.zeros((self.width, docs), bool) if self.width * docs <= BLOCK_BYTES * 8 else None
        bits, row = np.concatenate(self.at).astype(np.int64), np.repeat(np.arange(len(self.at)), [len(x) for x in self.at])
        if matrix is not None:
            matrix[bits, row] = True
            slices = np.packbits(matrix, axis=1).reshape(-1)
        else:  # one very long document and its seven neighbours
            slices = np.zeros(self.width * docs // 8, np.uint8)
            np.bitwise_or.at(slices, bits * (docs // 8) + row // 8, (128 >> (row % 8)).astype(np.uint8))
        known = np.array([i is not None for i in self.ids], bool)
        ids = np.array([i or 0 for i in self.ids], np.int64)
        return self.width, pack(ids, known), pack(np.array(self.sizes, np.int64)), pack(slices)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blocks: dict[int, _Block] = {}
    df: Counter = Counter()
    hashed: dict[str, int] = {}
    levels = np.array(LEVELS)

    def rows(out: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*out))
        types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["width", "ids", "sizes", "slices", "term", "df"])

    def counted() -> pa.RecordBatch:
        out = rows([(None, None, None, None, t, n) for t, n in df.items()])
        df.clear()
        return out
    for b in batches:
        for i, text in zip(b.column(0).to_pylist(), b.column(1)):
            tf = Counter(terms_of(text.as_py() or ""))
            if not tf:
                continue
            df.update(tf.keys())
            if len(hashed) > HELD:
                hashed.clear()
            low = np.empty(len(tf), np.uint64)
            for k, t in enumerate(tf):
                h = hashed.get(t)
                if h is None:
                    h = hashed[t] = xxhash.xxh64_intdigest(t.encode(), 1)
                low[k] = h
            hashes = [low]  # level 1 of every term, further levels of the few that are frequent
            hashes.append(np.array([xxhash.xxh64_intdigest(t.encode(), x) for t, n in tf.items() if n > 1
                                    for x in range(2, int((levels <= n).sum()) + 1)], np.uint64))
            h = np.concatenate(hashes)
            width = 1 << max(10, int(BITS * len(h) - 1).bit_length())
            a, step = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32) | np.uint64(1)
            bits = np.concatenate([(a + np.uint64(k) * step) % np.uint64(width) for k in range(HASHES)]).astype(np.uint32)
            block = blocks.setdefault(width, _Block(width))
            block.add(i, tf.total(), bits)
            if len(block.ids) >= block.room:
                yield rows([(*block.out(), None, None)])
                del blocks[width]
            if len(df) >= HELD:
                yield counted()
    for block in blocks.values():
        yield rows([(*block.out(), None, None)])
    if df:
        yield counted()
    give_back()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Blocks of signatures (width, ids, sizes, slices) and partial document counts (term, df), in one
    written table. Documents without a term are in no block."""
    ship(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("id"), ascii_lower(F.col(text_col).cast("string")).alias("text"))
    return materialise(own.where("text IS NOT NULL").mapInArrow(_index, INDEX), "lexical-index")


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = words = 0
    for b in batches:
        for x in b.column(0).to_pylist():
            size = unpack(x)[0]
            n, words = n + len(size), words + int(size.sum())
    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([words], pa.int64())], ["docs", "words"])


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


class Queries:
    """A block of queries: per query its terms with weights (repeats added up), and the corpus totals."""

    def __init__(self, docs: int, words: int, items: list[tuple[int, dict[str, int]]]):
        self.docs, self.words, self.items = docs, words, items

    def length_factor(self, n):
        return 25 + 75 * n * self.docs // max(1, self.words)

    def score(self, terms: dict[str, int], tf: Counter, n: int) -> int:
        m = 8 * self.length_factor(n)
        return sum(w * (10**9 * tf[t] // (1000 * tf[t] + m)) for t, w in terms.items() if t in tf)


def _largest(queries: Queries, sizes: np.ndarray) -> np.ndarray:
    """Per level the largest contribution of a document whose term is at that level at most (int64, level by document)."""
    m = np.array([queries.length_factor(n) for n in sizes.tolist()], np.int64)
    tops = [np.minimum(x - 1, sizes) for x in LEVELS[1:]] + [sizes]
    return np.array([10**9 * t // (1000 * t + 8 * m) for t in tops])


def _bounds(queries: Queries, width: int, sizes: np.ndarray, slices: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(query's place, upper bound of every document's score) of one block."""
    docs = -(-len(sizes) // 8)
    slices = slices.reshape(width, docs)
    gain = np.diff(_largest(queries, sizes), axis=0, prepend=0)
    known: dict[str, np.ndarray] = {}

    def most(term: str) -> np.ndarray:
        out = np.zeros(len(sizes), np.int64)
        alive = np.full(docs, 255, np.uint8)
        for level in range(len(LEVELS)):  # a document at one level is at all lower ones
            for j in _bits(term, level + 1, width):
                alive = alive & slices[j]
            if not alive.any():
                break
            out += gain[level] * np.unpackbits(alive, count=len(sizes))
        return out
    for k, (_, terms) in enumerate(queries.items):
        total = np.zeros(len(sizes), np.int64)
        for t, w in terms.items():
            if t not in known:
                known[t] = most(t)
            total += w * known[t]
        yield k, total


FOUND = "item_id long, doc_id long, bound long"


def _candidates(shared, tops: int, floors: dict[int, int] | None):
    """Without floors: of every block and query the ``tops`` best bounds; else all that reach the query's floor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        for b in batches:
            for width, ids, sizes, slices in zip(*(c.to_pylist() for c in b.columns)):
                ids, known = unpack(ids)
                out = []
                for k, bound in _bounds(queries, width, unpack(sizes)[0], unpack(slices)[0]):
                    item = queries.items[k][0]
                    at = np.flatnonzero(bound >= max(1, (floors or {}).get(item, 1)))
                    if floors is None and len(at) > tops:
                        at = at[np.argpartition(-bound[at], tops - 1)[:tops]]
                    out.append((np.full(len(at), item), ids[at], known[at], bound[at]))
                item, own, known, bound = map(np.concatenate, zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(own, mask=~known.astype(bool)), pa.array(bound)],
                                                 ["item_id", "doc_id", "bound"])
    return run


SCORED = "item_id long, doc_id long, score long"


def _exact(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        own = dict(queries.items)
        for b in batches:
            out = []
            for i, text, items in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                tf = Counter(terms_of(text.as_py()))
                n = tf.total()
                out += [(item, i, queries.score(own[item], tf, n)) for item in items]
            cols = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["item_id", "doc_id", "score"])
    return run


#: Candidate pairs that are sent to every task at most (8 bytes each, and an id a document); more are joined by a shuffle.
SENT = 500_000


def _rescored(docs: DataFrame, found: DataFrame, shared) -> DataFrame:
    """Exact scores of the found (item, document) pairs, from whole texts."""
    wanted = materialise(found.groupBy("doc_id").agg(F.collect_set("item_id").alias("items")), "lexical-wanted")
    pairs = wanted.agg(F.sum(F.size("items") + 1)).first()[0] or 0
    asked = F.broadcast(wanted) if pairs <= SENT else wanted
    text = docs.join(asked, docs["id"].eqNullSafe(wanted["doc_id"]))
    return text.select("id", "text", "items").mapInArrow(_exact(shared), SCORED).where("score > 0")


def _best(scored: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return scored.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def _blocks(items: DataFrame, id_col: str, text_col: str, per_block: int) -> Iterator[dict[int, Counter]]:
    """The queries' terms by id, in the order of the ids: blocks of ``per_block`` queries, or fewer
    where they have over 50 times as many terms."""
    own = items.select(F.col(id_col).cast("long").alias("id"), ascii_lower(F.col(text_col).cast("string")).alias("text"))
    held: dict[int, Counter] = {}
    size = 0
    for r in own.where("id IS NOT NULL").orderBy("id").toLocalIterator():
        if r["id"] not in held and (len(held) >= per_block or size >= 50 * per_block):
            yield held
            held, size = {}, 0
        terms = Counter(terms_of(r["text"] or ""))
        held.setdefault(r["id"], Counter()).update(terms)
        size += len(terms)
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", doc_text: str = "text",
           item_id: str = "item_id", item_text: str = "text", per_block: int = 2000, tops: int = 40) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: item_id, rank (from 1), doc_id, score.

    Equal scores go by ascending id, null ids last. Rows that share an id are documents
    of their own and are all scored. Items without a term, and with a null id, find
    nothing; equal items are searched each for itself, items that share an id as one query of all their
    terms. Null and empty texts have no terms and count nowhere; texts may be of any length. Other columns
    are ignored; empty tables give no rows. ``tops``: documents scored first to
    learn the least score of an answer; it never changes a result.
    """
    spark = docs.sparkSession
    index = build_index(docs, doc_id, doc_text)
    blocks = index.where("width IS NOT NULL").select("width", "ids", "sizes", "slices")
    totals = blocks.select("sizes").mapInArrow(_sizes, "docs long, words long").agg(F.sum("docs"), F.sum("words")).first()
    n, words = totals[0] or 0, totals[1] or 0
    own = docs.select(F.col(doc_id).cast("long").alias("id"), ascii_lower(F.col(doc_text).cast("string")).alias("text")).where("text IS NOT NULL")
    out = spark.createDataFrame([], "item_id long, doc_id long, score long, rank int")
    for held in _blocks(items, item_id, item_text, per_block):
        asked = spark.createDataFrame([(t,) for t in sorted(set().union(*held.values()))], "term string")
        df = {r["term"]: r["df"] for r in  # bounded by the block's terms
              index.where("term IS NOT NULL").join(F.broadcast(asked), "term").groupBy("term").agg(F.sum("df").alias("df")).collect()}
        weights = {t: weight(n, f) for t, f in df.items()}
        queries = Queries(n, words, [(i, {t: c * weights[t] for t, c in terms.items() if t in weights}) for i, terms in held.items()])
        shared = spark.sparkContext.broadcast(queries)
        first = blocks.mapInArrow(_candidates(shared, tops, None), FOUND)
        by = Window.partitionBy("item_id").orderBy(F.col("bound").desc(), "doc_id")
        first = first.withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= tops)
        scored = materialise(_best(_rescored(own, first, shared), k), "lexical-first")
        floors = {r["item_id"]: r["floor"] for r in  # one number per query of the block
                  scored.where(F.col("rank") == k).select("item_id", F.col("score").alias("floor")).collect()}
        rest = blocks.mapInArrow(_candidates(shared, tops, floors), FOUND)
        out = out.unionByName(materialise(_best(_rescored(own, rest, shared), k), "lexical-best"))
    return out.select("item_id", "rank", "doc_id", "score")

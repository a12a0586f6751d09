"""Substring de-duplication with fixed-block anchors.

Every document indexes its non-overlapping blocks of ``block`` words and probes the
index with every rolling window of ``block`` words. A repeat of ``window`` words
holds a whole aligned block if ``window >= 2 * block - 1``, so no repeat escapes.
Hits are then extended: around each hit, the windows of ``window`` words that hold
it are compared across documents, and runs of repeated windows join up to
the maximal exact repeats whose words are removed.

Both rounds move packed arrays, not rows: a map task sorts a batch's hashes, sends a hash
at most twice per batch whatever its number of copies, and packs what goes to
one bucket into one compressed row. A passage that a third of all documents
share is thus a few entries per batch. Documents travel in groups by a hash of
their id, compressed. No pairs of documents are ever formed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, give_back, materialise, mix64, pack, parts_for, running, runs, ship, unpack

ROW = "bucket long, blob binary"
_WORD = re.compile(rb"[^\x20\x09-\x0d]+")
#: Words hashed together; documents are never cut, so a longer one is a batch of its own.
BATCH_WORDS = 1 << 20
MULTIPLIERS = np.random.Generator(np.random.PCG64(977)).integers(1, 2**63, (2, 512), dtype=np.uint64) | np.uint64(1)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, one document after another, and each document's word count."""
    words = [t.split() for t in texts]  # bytes: exactly the six ASCII spaces
    n = np.fromiter(map(len, words), np.int64, len(words))
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(w) for ws in words for w in ws), np.uint64, int(n.sum())), n


def rolling(hashes: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """Hash of the ``width`` words from each position on (as if the array went on with zeros)."""
    padded = np.r_[hashes, np.zeros(width - 1, np.uint64)]
    out = np.zeros(len(hashes), np.uint64)
    for j in range(width):
        out += padded[j:j + len(hashes)] * MULTIPLIERS[which, j]
    return mix64(out)


def _places(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every word: its document's index, its position in it, the words from it to the end."""
    doc = np.repeat(np.arange(len(n)), n)
    pos = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    return doc, pos, np.repeat(n, n) - pos


def _entries(ids: np.ndarray, pos: np.ndarray, flag: np.ndarray, hashes: np.ndarray) -> list[np.ndarray]:
    """Arrays of one packed row, by id and position: ids and positions as differences."""
    order = np.lexsort((pos, ids))
    ids, pos, flag, hashes = ids[order], pos[order], flag[order], hashes[order]
    starts, size = runs(ids)
    step = np.diff(np.r_[0, pos])
    step[starts] = pos[starts]
    return [np.diff(np.r_[np.int64(0), ids[starts]]), size.astype(np.uint32), step.astype(np.uint32), flag, hashes]


def _open(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    gap, size, step, flag, hashes = unpack(blob)
    ids, size = np.cumsum(gap), size.astype(np.int64)
    total = np.cumsum(step.astype(np.int64))
    first = np.cumsum(size) - size
    base = np.where(first > 0, total[first - 1], 0) if len(first) else first
    return np.repeat(ids, size), total - np.repeat(base, size), flag, hashes


def _scatter(bucket: np.ndarray, *cols: np.ndarray) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(bucket, kind="stable")
    starts, size = runs(bucket[order])
    for s, n in zip(starts.tolist(), size.tolist()):
        at = order[s:s + n]
        yield int(bucket[at[0]]), pack(*_entries(*[c[at] for c in cols]))


def _table(rows: Iterator[tuple[int, bytes]]) -> pa.RecordBatch:
    b, blobs = list(zip(*rows)) or ((), ())
    return pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(blobs, pa.binary())], ["bucket", "blob"])


ANCHOR, ANSWER, KNOWN = 1, 2, 4  # is an aligned block; wants an answer; needs none, it is a hit


def _collapse(ids, pos, flag, hashes):
    """Of every hash its first place in each document; whether it is in several of them."""
    order = np.lexsort((pos, ids, hashes))
    ids, pos, flag, hashes = ids[order], pos[order], flag[order], hashes[order]
    same = np.zeros(len(ids), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (ids[1:] == ids[:-1])
    first = np.flatnonzero(~same)
    if len(first):
        flag = np.bitwise_or.reduceat(flag, first)
    ids, pos, hashes = ids[first], pos[first], hashes[first]
    starts, size = runs(hashes)
    return ids, pos, flag, hashes, starts, size


def _grouped(texts, ids, limit=BATCH_WORDS):
    """Slices of documents of about ``limit`` words (by bytes)."""
    s, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t) // 5
        if size >= limit:
            yield texts[s:k + 1], ids[s:k + 1]
            s, size = k + 1, 0
    if s < len(texts):
        yield texts[s:], ids[s:]


def doc_group(ids: np.ndarray, groups: int) -> np.ndarray:
    return (mix64(ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(groups)).astype(np.int64)


def _probe(block: int, window: int, buckets: int, groups: int):
    """Blocks and probes of each batch, to the buckets of their hashes; hits known within the
    batch go to the first bucket of their document's group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            all_texts = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
            for texts, ids in _grouped(all_texts, b.column(0).to_numpy()):
                words, n = word_hashes(texts)
                doc, pos, rest = _places(n)
                ok = (rest >= block) & (n[doc] >= window)
                flag = np.where(pos % block == 0, ANCHOR, 0).astype(np.uint8)[ok]
                ids, pos, flag, hashes, starts, size = _collapse(ids[doc[ok]], pos[ok], flag, rolling(words, block)[ok])
                many = np.repeat(size > 1, size)
                bucket = (hashes % np.uint64(buckets)).astype(np.int64)
                short = (hashes >> np.uint64(32)).astype(np.uint32)
                one = ~many
                yield _table(_scatter(bucket[one], ids[one], pos[one], flag[one] | np.uint8(ANSWER), short[one]))
                if many.any():
                    s = starts[size > 1]
                    e = s + size[size > 1] - 1
                    anchor = np.bitwise_or.reduceat(flag, starts)[size > 1]
                    both = np.r_[s, e]  # the hash goes on for two of its documents
                    yield _table(_scatter(bucket[both], ids[both], pos[both], np.r_[anchor, anchor], short[both]))
                    known = np.full(int(many.sum()), KNOWN, np.uint8)
                    yield _table(_scatter(doc_group(ids[many], groups) % buckets, ids[many], pos[many], known, short[many] * 0))
        give_back()
    return run


def _gather(t: pa.Table):
    parts = [_open(x) for x in t["blob"].to_pylist()]
    return [np.concatenate(c) for c in zip(*parts)]


def _by_group(ids, pos, groups) -> pa.Table:
    none = np.zeros(len(ids), np.uint8)
    return pa.Table.from_batches([_table(_scatter(doc_group(ids, groups), ids, pos, none, none))])


def _match(groups: int):
    """Places whose hash is in two documents and an aligned block in one of them."""
    def run(t: pa.Table) -> pa.Table:
        ids, pos, flag, hashes = _gather(t)
        known = flag & KNOWN > 0
        order = np.flatnonzero(~known)
        order = order[np.argsort(hashes[order], kind="stable")]
        starts, size = runs(hashes[order])
        hit = np.zeros(len(ids), bool)
        if len(starts):
            x = ids[order]
            met = (np.minimum.reduceat(x, starts) != np.maximum.reduceat(x, starts)) & (
                np.bitwise_or.reduceat(flag[order], starts) & ANCHOR > 0)
            hit[order] = np.repeat(met, size)
        hit = hit & (flag & ANSWER > 0) | known
        return _by_group(ids[hit], pos[hit], groups)
    return run


def _earlier(groups: int):
    """Places whose window is also in a document with a smaller id."""
    def run(t: pa.Table) -> pa.Table:
        ids, pos, flag, hashes = _gather(t)
        low, known = hashes, flag & KNOWN > 0
        order = np.flatnonzero(~known)
        order = order[np.argsort(low[order], kind="stable")]
        starts, size = runs(low[order])
        hit = known.copy()
        if len(starts):
            hit[order] = np.repeat(np.minimum.reduceat(ids[order], starts), size) < ids[order]
        return _by_group(ids[hit], pos[hit], groups)
    return run


DOCS = "bucket long, ids binary, sizes binary, body binary, extra binary"


def _ship(groups: int):
    """Documents by group: per batch and group one row, its texts compressed together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            texts = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
            extra = [t or b"" for t in b.column(2).cast(pa.binary()).to_pylist()]
            group = doc_group(ids, groups)
            order = np.argsort(group, kind="stable")
            starts, size = runs(group[order])
            rows = []
            for s, n in zip(starts.tolist(), size.tolist()):
                at = order[s:s + n].tolist()
                sizes = np.array([[len(texts[i]), len(extra[i])] for i in at], np.int64)
                squeeze = zstandard.ZstdCompressor(level=3).compress
                rows.append((int(group[at[0]]), ids[at].tobytes(), pack(sizes.reshape(-1)),
                             squeeze(b"".join([texts[i] for i in at])), squeeze(b"".join([extra[i] for i in at]))))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
                                             ["bucket", "ids", "sizes", "body", "extra"])
    return run


def _documents(t: pa.Table) -> Iterator[tuple[np.ndarray, list[bytes], list[bytes]]]:
    for ids, sizes, body, extra in zip(*(t[c].to_pylist() for c in ("ids", "sizes", "body", "extra"))):
        size = unpack(sizes)[0].reshape(-1, 2)
        out = []
        for blob, n in ((body, size[:, 0]), (extra, size[:, 1])):
            raw = zstandard.ZstdDecompressor().decompress(blob, max_output_size=max(1, int(n.sum())))
            ends = np.cumsum(n).tolist()
            out.append([raw[a:b] for a, b in zip([0, *ends[:-1]], ends)])
        yield np.frombuffer(ids, np.int64), *out


def _starts_by_id(found: pa.Table):
    """Lookup id -> word positions."""
    if not found.num_rows:
        return lambda i: None
    ids, pos, *_ = _gather(found)
    order = np.argsort(ids, kind="stable")
    ids, pos = ids[order], pos[order]
    starts, size = runs(ids)
    spans = dict(zip(ids[starts].tolist(), zip(starts.tolist(), (starts + size).tolist())))
    return lambda i: pos[slice(*spans[i])] if i in spans else None


def _alike(hashes: np.ndarray, at: np.ndarray, last: int) -> np.ndarray:
    """All positions up to ``last`` with the hash that one of ``at`` has (one place stood for them)."""
    at = at[at < last]
    return np.flatnonzero(np.isin(hashes[:last], hashes[at])) if last > 0 and len(at) else np.zeros(0, np.int64)


def _extend(block: int, window: int, buckets: int, groups: int):
    """Windows around the hits of a group's documents, to the buckets of their hashes."""
    def run(docs: pa.Table, hits: pa.Table) -> pa.Table:
        places, out = _starts_by_id(hits), []
        for ids, texts, _ in _documents(docs):
            keep = [k for k, i in enumerate(ids.tolist()) if places(i) is not None]
            for some, own in _grouped([texts[k] for k in keep], ids[keep]):
                words, n = word_hashes(some)
                anchors, low, high = rolling(words, block), rolling(words, window), rolling(words, window, 1)
                at = []
                for k, (s, size) in enumerate(zip((np.cumsum(n) - n).tolist(), n.tolist())):
                    near = _alike(anchors[s:s + size], places(int(own[k])), size - block + 1)
                    near = np.unique((near[:, None] - np.arange(window - block + 1)).reshape(-1))
                    at.append(s + near[(near >= 0) & (near <= size - window)])
                at = np.concatenate(at)
                doc, pos, _ = _places(n)
                out.append((own[doc[at]], pos[at], low[at], high[at]))
        if not out:
            return pa.Table.from_batches([_table(iter(()))])
        ids, pos, low, high = [np.concatenate(c) for c in zip(*out)]
        bucket = low % np.uint64(buckets)
        # 40 bits of one hash and 24 of another, beside the bucket that the first one's other bits gave
        both = ((low >> np.uint64(24)) << np.uint64(24)) ^ (high >> np.uint64(40))
        ids, pos, at, both, starts, size = _collapse(ids, pos, bucket.astype(np.int64), both)
        flag = np.zeros(len(ids), np.uint8)
        later = np.repeat(size > 1, size)
        later[starts] = False  # the smallest id of the group's copies asks for all of them
        flag[later] = KNOWN
        where = np.where(later, doc_group(ids, groups) % buckets, at)
        return pa.Table.from_batches([_table(_scatter(where, ids, pos, flag, np.where(later, np.uint64(0), both)))])
    return run


RESULT = "id long, n_words long, n_removed long, spans array<struct<first:int,last:int>>, kept_text string, extra string"


def _cut(window: int, cut_text: bool):
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        places, rows = _starts_by_id(found), []
        for ids, texts, extra in _documents(docs):
            for i, text, more in zip(ids.tolist(), texts, extra):
                words = text.split()
                spans, at, gone = [], places(i), 0
                if at is not None and len(words) >= window:
                    hashes, n = word_hashes([text])
                    at = _alike(rolling(hashes, window), at, len(words) - window + 1)
                    covered = np.zeros(len(words) + 1, np.int64)
                    np.add.at(covered, at, 1)
                    np.add.at(covered, at + window, -1)
                    covered = np.cumsum(covered[:-1]) > 0
                    gone = int(covered.sum())
                    s, size = runs(covered)
                    on = covered[s] if len(s) else s
                    spans = [{"first": a, "last": b} for a, b in zip(s[on].tolist(), (s + size - 1)[on].tolist())]
                    words = [w for w, c in zip(words, covered.tolist()) if not c]
                kept = b" ".join(words)
                if cut_text:
                    kept = _without(text, spans) if spans else text
                rows.append((i, len(words) + gone, gone, spans, kept.decode(), more.decode()))
        cols = list(zip(*rows)) or [()] * 6
        span = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        types = [pa.int64(), pa.int64(), pa.int64(), span, pa.string(), pa.string()]
        return pa.table([pa.array(c, t) for c, t in zip(cols, types)],
                        names=["id", "n_words", "n_removed", "spans", "kept_text", "extra"])
    return run


def _without(text: bytes, spans: list[dict]) -> bytes:
    """The text without the words of the spans and the white space after each."""
    at = [m.span() for m in _WORD.finditer(text)]
    out, s = [], 0
    for x in spans:
        out.append(text[s:at[x["first"]][0]])
        s = at[x["last"] + 1][0] if x["last"] + 1 < len(at) else len(text)
    return b"".join([*out, text[s:]])


def _text_digest():
    return F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)


def _places_of_texts(own: DataFrame) -> DataFrame | None:
    """(of, digest, place): the place of every different (id, text) in the order of id and digest.
    None where each id has one text: then the ids serve as they are."""
    texts = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    several = own.groupBy("id").agg(F.min(texts).alias("a"), F.max(texts).alias("b")).where("a <> b")
    if not several.take(1):
        return None
    pairs = own.select(F.col("id").alias("of"), _text_digest().alias("digest")).distinct()
    return materialise(running(pairs, [F.col("of"), F.col("digest")], {"place": F.lit(1).cast("long")}), "places")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, block: int = 7,
                    carry: list[str] | None = None, cut_text: bool = False, group_bytes: int = 4 << 20) -> DataFrame:
    """Removes each word covered by a window of ``window`` words whose sequence also
    starts in a document with a smaller id, judged on the input.

    (id, n_words, n_removed, spans of removed words, kept_text, extra): kept_text is
    the kept words joined by one space, or with ``cut_text`` the text as it was
    without the removed words; extra is JSON of the ``carry`` columns. Null and
    empty texts have no words. Repeated rows
    don't count against each other and get equal results. Different texts under one
    id are documents of their own, in the order of their digests. Rows with a null id
    come after all others, ordered by a hash of their text. Ids are below 2**62.
    An empty table gives no rows.
    """
    if window < 2 * block - 1:
        raise ValueError("a window may miss every aligned block: window >= 2 * block - 1 is needed")
    ship(docs.sparkSession)
    text = F.col(text_col).cast("string")
    unnamed = F.lit(NULL_ID) + F.shiftrightunsigned(F.xxhash64(text), 2)
    own = docs.select(F.coalesce(F.col(id_col).cast("long"), unnamed).alias("id"), text.alias("text"),
                      (F.to_json(F.struct(*carry)) if carry else F.lit("")).alias("extra"))
    total = docs.agg(F.sum(F.octet_length(text) + 64)).first()[0]
    named = own
    places = _places_of_texts(own)
    if places is not None:  # from here on a document's id is its place
        named = own.join(places, (own["id"] == places["of"]) & (_text_digest() == places["digest"])).select(
            places["place"].alias("id"), "text", "extra")
    own = named
    buckets = groups = parts_for(total, group_bytes)
    hits = (own.select("id", "text").mapInArrow(_probe(block, window, buckets, groups), ROW)
            .groupBy("bucket").applyInArrow(_match(groups), ROW))
    shipped = own.mapInArrow(_ship(groups), DOCS)
    found = (shipped.groupBy("bucket").cogroup(hits.groupBy("bucket"))
             .applyInArrow(_extend(block, window, buckets, groups), ROW)
             .groupBy("bucket").applyInArrow(_earlier(groups), ROW))
    out = shipped.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(_cut(window, cut_text), RESULT)
    if places is not None:
        back = places.select(F.col("place").alias("id"), "of")
        out = out.join(back, "id").withColumn("id", F.col("of")).drop("of")
    return out.withColumn("id", F.when(F.col("id") < NULL_ID, F.col("id")))


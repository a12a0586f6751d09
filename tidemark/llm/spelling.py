"""Grouping of spelling variants by blocked Gram matrices of letter counts.

A word is a vector of letter counts. One inserted, deleted or replaced letter
changes the squared distance of two such vectors by at most two, so the pairs
worth looking at are read off the products of blocks of count vectors
(|a|^2 + |b|^2 - 2ab <= 2) and only those are compared letter by letter.

Blocks are cells: the letters are dealt into a few groups, and a word's counts
per group (their sum is its length) name its cell. Two words one edit apart lie
in one cell or in adjacent ones: a replacement moves one unit between two groups,
an insertion adds one. Every word stays in its cell and visits the adjacent cells on one
side, so each pair of blocks meets once; crowded cells are dealt into chunks
that meet pairwise. Tasks return what each word keeps of its partners (their
number and the most frequent one), never pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, give_back, materialise, ship

#: Fixed value: the letters that words are made of.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Words counted in a task before they are handed on.
HELD = 400_000
#: Letters of one chunk at most, where its words are long.
CHUNK_LETTERS = 16 << 20
_FOLD = {ord(c): c.lower() for c in UPPER}


def typo(doc_id: int | None, word: str, every: int) -> str:
    """``word`` as a document writes it: where ``every`` divides the crc32 of ``<doc_id>:<word>``,
    without the letter that the crc32 names."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if every and h % every == 0:
        k = h % len(word)
        return word[:k] + word[k + 1:]
    return word


def _count(every: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def out() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return got
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                if not text:
                    continue
                for run_, n in Counter(RUN.findall(text)).items():
                    if len(run_) >= least:  # a deletion only shortens
                        w = typo(i, run_.lower() if run_.isascii() else run_.translate(_FOLD), every)
                        if len(w) >= least:
                            total[w] += n
                if len(total) >= HELD:
                    yield out()
        if total:
            yield out()
        give_back()
    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 199, least_letters: int = 6,
               least_n: int = 5) -> DataFrame:
    """(word, n): words of at least ``least_letters`` letters and ``least_n`` occurrences in all whole texts."""
    ship(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return (own.mapInArrow(_count(every, least_letters), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n))


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of each word (rows padded with zeros) and the lengths."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    out = np.zeros((len(words), int(size.max(initial=0))), np.uint8)  # no letter is above U+00FF
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    return out, size


def _counts(codes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Letter counts, exact in the type they have."""
    letters, at = np.unique(codes, return_inverse=True)
    at = at.reshape(codes.shape)
    kind = np.float32 if size.max(initial=0) <= 2000 else np.float64
    flat = np.bincount((np.arange(len(codes))[:, None] * len(letters) + at).reshape(-1), minlength=len(codes) * len(letters))
    counts = flat.reshape(len(codes), len(letters)).astype(kind)
    return counts[:, letters > 0]


def one_edit(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Which rows differ by exactly one inserted, deleted or replaced letter (zeros pad the rows)."""
    out = np.zeros(len(a), bool)
    same = la == lb
    out[same] = (a[same] != b[same]).sum(axis=1) == 1
    for x, lx, y, ly in ((a, la, b, lb), (b, lb, a, la)):  # x is one letter longer
        at = np.flatnonzero(lx == ly + 1)
        if len(at):
            x, y, width = x[at], y[at], x.shape[1] - 1
            inside = np.arange(width) < ly[at][:, None]
            front, back = (x[:, :-1] != y[:, :-1]) & inside, (x[:, 1:] != y[:, :-1]) & inside
            first = np.where(front.any(axis=1), front.argmax(axis=1), width)
            last = np.where(back.any(axis=1), width - back[:, ::-1].argmax(axis=1), 0)  # one past the last difference
            out[at] = last <= first
    return out


def near_pairs(words: list[str], home: np.ndarray, tile: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of words one edit apart: each pair of two home words once, and all of a home word and a visitor."""
    order = np.r_[np.flatnonzero(home), np.flatnonzero(~home)]
    codes, size = _codes([words[i] for i in order.tolist()])
    counts = _counts(codes, size)
    norm = (counts * counts).sum(axis=1)
    n = int(home.sum())
    step = max(1, min(4 * tile, (8 << 20) // max(1, codes.shape[1])))
    for s in range(0, n, tile):
        for t in range(s, len(order), 4 * tile):
            e = min(s + tile, n)
            far = norm[s:e, None] + norm[None, t:t + 4 * tile] - 2 * (counts[s:e] @ counts[t:t + 4 * tile].T)
            i, j = np.nonzero(far <= 2)
            i, j = i + s, j + t
            keep = (i < j) & (abs(size[i] - size[j]) <= 1)
            i, j = i[keep], j[keep]
            for k in range(0, len(i), step):
                x, y = i[k:k + step], j[k:k + step]
                ok = one_edit(codes[x], size[x], codes[y], size[y])
                if ok.any():
                    yield order[x[ok]], order[y[ok]]


PARTNERS = "word string, n_near long, top_n long, top string"


def _meet(t: pa.Table) -> pa.Table:
    words, n, home = t["word"].to_pylist(), t["n"].to_numpy(), t["home"].to_numpy(zero_copy_only=False)
    alphabet = np.empty(len(words), np.int64)  # place of each word in code-point order
    alphabet[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    near = np.zeros(len(words), np.int64)
    best = np.full(len(words), -1, np.int64)

    def better(own: np.ndarray, other: np.ndarray) -> None:
        o = np.lexsort((alphabet[other], -n[other], own))
        own, other = own[o], other[o]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        own, other = own[first], other[first]
        had = best[own]
        wins = (had < 0) | (n[other] > n[had]) | (n[other] == n[had]) & (alphabet[other] < alphabet[had])
        best[own[wins]] = other[wins]
    for i, j in near_pairs(words, home):
        near += np.bincount(np.r_[i, j], minlength=len(words))
        better(np.r_[i, j], np.r_[j, i])
    at = np.flatnonzero(near).tolist()
    return pa.table([pa.array([words[i] for i in at], pa.string()), pa.array(near[at], pa.int64()),
                     pa.array(n[best[at]], pa.int64()), pa.array([words[best[i]] for i in at], pa.string())],
                    names=["word", "n_near", "top_n", "top"])


def _groups(word: Column, groups: int) -> Column:
    """Letters of each group: a letter's group is its code point modulo ``groups``."""
    whole = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]
    return F.array(*[F.length(word) - F.length(F.regexp_replace(word, "[" + "".join(c for c in whole if ord(c) % groups == g) + "]", ""))
                     for g in range(groups)])


def partners(words: DataFrame, groups: int = 4, per_chunk: int = 8000) -> DataFrame:
    """(word, n_near, top_n, top) of (word, n): how many words are one edit apart, and the most
    frequent of them (ties: smallest in code-point order). Words without any are left out."""
    spark = words.sparkSession
    ship(spark)
    own = materialise(words.select("word", "n", _groups(F.col("word"), groups).alias("cell")), "spelling-words")
    load = F.greatest(F.count("*") / per_chunk, F.sum(F.length("word")) / CHUNK_LETTERS)
    cells = own.groupBy("cell").agg(F.greatest(F.ceil(load), F.lit(1)).cast("int").alias("chunks"))
    unit = [tuple(int(g == k) for g in range(groups)) for k in range(groups)]
    steps = [tuple(x - y for x, y in zip(a, b)) for a, b in combinations(unit, 2)] + unit
    moved = F.array(*[F.zip_with("cell", F.array(*map(F.lit, s)), lambda c, d: c + d) for s in steps])
    visits = own.select("word", "n", F.explode(moved).alias("cell")).where(F.array_min("cell") >= 0)
    mine = F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int")
    at_home = own.join(cells, "cell").withColumn("own", mine)
    # a chunk meets itself, the later chunks of its cell and all visitors of the cell
    met = at_home.select("cell", F.explode(F.sequence(F.lit(0), "own")).alias("chunk"), "word", "n", "own")
    met = met.select("cell", "chunk", "word", "n", (F.col("chunk") == F.col("own")).alias("home"))
    guests = visits.join(cells, "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
                                               "word", "n", F.lit(False).alias("home"))
    got = met.unionByName(guests).groupBy("cell", "chunk").applyInArrow(_meet, PARTNERS)
    top = F.min(F.struct((-F.col("top_n")).alias("n"), F.col("top").alias("word")))
    return (got.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("t"))
            .select("word", "n_near", (-F.col("t.n")).alias("top_n"), F.col("t.word").alias("top")))


def roots(links: DataFrame, rounds: int) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last, in steps that double."""
    at = materialise(links.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(rounds):
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = materialise(at.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return at


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 199,
                      least_letters: int = 6, least_n: int = 5, ratio: int = 5, groups: int = 4,
                      per_chunk: int = 8000) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    form: the most frequent word one edit apart, if at least ``ratio`` times as
    frequent (ties: smallest in code-point order), else null; root: the end of the chain of forms, the word
    itself if it has none. Null and empty texts have no words, a null id is
    written as nothing before the colon; repeated rows count again. Words and texts may be of any length.
    Other columns are ignored; an empty table gives no rows.
    """
    words = materialise(vocabulary(docs, id_col, text_col, every, least_letters, least_n), "spelling-vocabulary")
    near = partners(words, groups, per_chunk)
    formed = F.col("top_n") >= ratio * F.col("n")
    own = materialise(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("top")).alias("form"), F.when(formed, F.col("top_n")).alias("form_n")), "spelling-forms")
    # every step of a chain is at least `ratio` times as frequent: the chain's length is a logarithm
    top, depth = own.agg(F.max("n")).first()[0] or 0, 1
    while least_n * ratio ** (depth + 1) <= top:
        depth += 1
    ends = roots(own.where("form IS NOT NULL"), (depth - 1).bit_length())
    return own.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Quality classifier: logistic regression over hashed word n-grams.

Words are the runs between ASCII white space. Features are hashed n-grams of the
words themselves (1 and 2) and of their written shapes (1 to 3; a shape keeps
letter case and marks but not the letters, and tells a word that repeats the one
before it). A document's features are the square roots of the n-grams' shares, so
its vector has length one however long it is. Weights are learned with
follow-the-regularised-leader updates on a bounded sample and scored as a sparse
dot product.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import Remembered
from .common import pack, ship, unpack
from .ftrl import Ftrl, probabilities

BITS = 16
DIM = 1 << BITS
_RUN = re.compile(rb"(.)\1+")
_KIND = bytes(ord("X") if 65 <= b <= 90 else ord("x") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b
              for b in range(256))


def shape(word: bytes) -> bytes:
    """Letters as X or x, digits as 0, runs shortened to one."""
    return _RUN.sub(rb"\1", word.translate(_KIND))


class Words:
    """Word -> hash of the word and of its shape, remembered up to a bound."""

    def __init__(self):
        self.known = Remembered(300_000)

    def codes(self, words: list[bytes]) -> np.ndarray:
        get, out = self.known.new.get, []
        for w in words:
            c = get(w)
            if c is None and (c := self.known.get(w)) is None:
                c = xxhash.xxh32_intdigest(w) << 32 | xxhash.xxh32_intdigest(shape(w))
                if len(w) <= 64:
                    self.known.put(w, c)
            out.append(c)
        return np.array(out, np.uint64)


def _hash(*parts: np.ndarray) -> np.ndarray:
    h = np.full(len(parts[-1]), 0x9E3779B97F4A7C15 + len(parts), np.uint64)
    for p in parts:
        h = (h ^ p) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: bytes | None, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features and values; feature 0 is the constant, the only one of a text without words."""
    codes = words.codes((text or b"").split())
    word, form = codes >> np.uint64(32), codes & np.uint64(0xFFFFFFFF)
    form = form.copy()
    if len(codes) > 1:
        form[1:][codes[1:] == codes[:-1]] = 1  # a repeat
    mark = np.uint64(1 << 40)
    parts = [_hash(word), _hash(word[:-1], word[1:]), _hash(form + mark), _hash(form[:-1] + mark, form[1:]),
             _hash(form[:-2] + mark, form[1:-1], form[2:])] if len(codes) else []
    at = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    at, n = np.unique(at[at > 0], return_counts=True)
    return np.r_[0, at], np.r_[1.0, np.sqrt(n / max(1, n.sum()))]


@dataclass
class QualityModel:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(DIM))

    def score(self, text: bytes | None, words: Words) -> float:
        at, x = features(text, words)
        return float(probabilities(np.array([self.weights[at] @ x]))[0])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Words()
    for b in batches:
        blobs = []
        for t in b.column(2).cast(pa.binary()).to_pylist():
            at, x = features(t, words)
            blobs.append(pack(at.astype(np.uint16), x.astype(np.float32)))
        yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(blobs, pa.binary())], ["place", "label", "features"])


def train(docs: DataFrame, labels: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = 8000, epochs: int = 4) -> QualityModel:
    """Fits on at most ``sample`` labelled documents with ``learnable`` true (over
    the labels' columns), the first by a hash of their id.

    Null ids and labels are not learned from; of several labels of one id the
    lowest counts; no labels give the constant score one half.
    """
    ship(docs.sparkSession)
    marked = (labels.where(learnable & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(label_col).cast("int").alias("label"))
              .withColumn("place", F.xxhash64("id", F.lit(11))).orderBy("place", "id").limit(sample))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = (texts.join(F.broadcast(marked), "id").select("place", "label", "text")  # ``sample`` narrow rows at most
            .mapInArrow(_rows, "place long, label int, features binary"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = sorted({(p, y, blob) for b in batches for p, y, blob in zip(*(c.to_pylist() for c in b.columns))})
        if not data:
            return
        model = Ftrl(DIM, 1, alpha=1.0, l1=1e-3, l2=1e-4)
        data = [(y, *unpack(blob)) for _, y, blob in data]
        for _ in range(epochs):
            for y, at, x in data:
                model.learn(at.astype(np.int64), x.astype(np.float64), int(y > 0))
        yield pa.RecordBatch.from_arrays([pa.array([pack(model.weights()[0])], pa.binary())], ["weights"])

    got = rows.repartition(1).mapInArrow(fit, "weights binary").collect()
    return QualityModel(unpack(bytes(got[0]["weights"]))[0]) if got else QualityModel()


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", out: str = "quality_score") -> DataFrame:
    """``docs`` with the score (0 to 1, higher: the good label is likelier) of the
    whole text; null and empty texts get the constant's score. A same-named
    column is replaced, rows are never dropped."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size

    @F.pandas_udf("double")
    def judge(texts):
        import pandas as pd
        words, model = _words(), shared.value
        return pd.Series([model.score(None if t is None else t.encode(), words) for t in texts], dtype="float64")

    return docs.withColumn(out, judge(F.col(text_col).cast("string")))


_memory: list[Words] = []


def _words() -> Words:
    """One memory per worker."""
    if not _memory:
        _memory.append(Words())
    return _memory[0]

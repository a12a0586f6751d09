"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of hashed character n-grams of the whole text (one to
three letters, lower case, everything else a space). Document frequencies come
from every document learned from; the regression is trained with
follow-the-regularised-leader and elastic-net penalties on a bounded sample, a part
of which is set aside to calibrate the softmax temperature. The model is a few
dense arrays of fixed size, however large the corpus is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pack, ship, unpack
from .ftrl import Ftrl, probabilities, temperature

DIM = 1 << 14
#: Texts are counted in blocks of so many letters.
BLOCK = 1 << 20


def counts(text: str) -> np.ndarray:
    """How often each hashed n-gram (1 to 3 letters) occurs in the whole text."""
    out = np.zeros(DIM, np.int64)
    for s in range(0, len(text), BLOCK):
        c = np.frombuffer(text[max(0, s - 2):s + BLOCK].lower().encode("utf-32-le", "replace"), "<u4")
        skip = min(s, 2)  # the block's n-grams end after it
        c = np.where((c < 97) | ((c > 122) & (c < 170)), np.uint32(32), c).astype(np.uint32)
        one = c * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + c[1:]
        three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(0xC2B2AE3D) + c[2:]
        for k, h in enumerate((one, two, three)):
            h = h[max(0, skip - k):]
            out += np.bincount(((h ^ (h >> np.uint32(16))) * np.uint32(0x27D4EB2F)) >> np.uint32(32 - 14), minlength=DIM)
    return out


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _tfidf(tf: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(tf)
    x = np.log1p(tf[at]) * idf[at]
    norm = np.sqrt(x @ x)
    return at, x / norm if norm else x


@dataclass
class LanguageModel:
    languages: list[str] = field(default_factory=list)
    idf: np.ndarray = field(default_factory=lambda: np.ones(DIM))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((DIM, 0)))
    temperature: float = 1.0

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and calibrated probability; ``und`` and 0 for null texts, texts
        without a letter, and where nothing was learned."""
        if not self.languages or not has_letter(text):
            return "und", 0.0
        if len(self.languages) == 1:
            return self.languages[0], 1.0
        at, x = _tfidf(counts(text), self.idf)
        p = probabilities(x @ self.weights[at] / self.temperature)
        k = int(p.argmax())
        return self.languages[k], float(p[k])


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, docs = np.zeros(DIM + 1, np.int64), 0
    for b in batches:
        for t in b.column(0).to_pylist():
            total[:DIM] += counts(t or "") > 0
            docs += 1
    total[DIM] = docs
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["feature", "df"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        blobs = []
        for t in b.column(1).to_pylist():
            tf = counts(t or "")
            at = np.flatnonzero(tf)
            blobs.append(pack(at.astype(np.uint16), tf[at].astype(np.uint32)))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(blobs, pa.binary())], ["lang", "place", "features"])


def train(docs: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = 1500, epochs: int = 3) -> LanguageModel:
    """Learns from the rows with ``learnable`` true, a text and a language.

    Document frequencies cover all of them; weights and temperature are fitted
    on at most ``per_language`` documents of each language, the first by a hash
    of their id (one in five for the temperature). Nothing to learn from: an
    empty model.
    """
    ship(docs.sparkSession)
    own = docs.where(learnable & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"))
    df = own.select("text").mapInArrow(_document_frequency, "feature long, df long").groupBy("feature").agg(F.sum("df").alias("df"))
    freq = np.zeros(DIM + 1)
    for r in df.collect():  # one row per feature: DIM at most
        freq[r["feature"]] = r["df"]
    idf = np.log((1 + freq[DIM]) / (1 + freq[:DIM])) + 1
    place = F.xxhash64("id", F.lit(7))
    slim = own.select("id", "lang", place.alias("place")).distinct()
    # Hashes are uniform, so about twice the rows wanted lie under a bound that follows from a language's
    # count; only those are ranked, however frequent the language is. (One row per language is broadcast:
    # the model has a column for each.)
    share = slim.groupBy("lang").agg((F.lit(2.0 * per_language) / F.count("*")).alias("share"))
    near = slim.join(F.broadcast(share), "lang").where(F.col("place") / F.lit(2.0**64) + 0.5 <= F.col("share"))
    first = Window.partitionBy("lang").orderBy("place", "id")
    chosen = (near.withColumn("nth", F.row_number().over(first))
              .where(F.col("nth") <= per_language).select("id", "lang", "place"))
    # at most per_language rows a language: small enough to broadcast
    sample = own.join(F.broadcast(chosen), ["id", "lang"]).select("lang", "text", "place")
    rows = sample.mapInArrow(_features, "lang string, place long, features binary")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = sorted({(p, lang, blob) for b in batches for lang, p, blob in zip(*(c.to_pylist() for c in b.columns))})
        names = sorted({lang for _, lang, _ in data})
        if not names:
            return
        data = [(names.index(lang), *_tfidf(_dense(blob), idf)) for _, lang, blob in data]
        held, fitted = data[::5], [d for i, d in enumerate(data) if i % 5] or data
        model = Ftrl(DIM, max(2, len(names)), alpha=0.5, l1=2e-3, l2=1e-3)
        for _ in range(epochs):
            for y, at, x in fitted:
                model.learn(at, x, y)
        w = model.weights()
        t = temperature(np.array([w[:, at] @ x for _, at, x in held]), np.array([y for y, *_ in held])) if len(names) > 1 else 1.0
        yield pa.RecordBatch.from_arrays([pa.array([names], pa.list_(pa.string())), pa.array([pack(w.T.reshape(-1))], pa.binary()),
                                          pa.array([t])], ["languages", "weights", "temperature"])

    got = rows.repartition(1).mapInArrow(fit, "languages array<string>, weights binary, temperature double").collect()
    if not got:
        return LanguageModel(idf=idf)
    return LanguageModel(list(got[0]["languages"]), idf, unpack(bytes(got[0]["weights"]))[0].reshape(DIM, -1), got[0]["temperature"])


def _dense(blob: bytes) -> np.ndarray:
    at, n = unpack(blob)
    out = np.zeros(DIM, np.int64)
    out[at] = n
    return out


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text",
             lang_out: str = "lang_pred", score_out: str = "lang_score") -> DataFrame:
    """``docs`` with two more columns (same-named ones are replaced): predicted
    language and calibrated probability of the whole text. Rows are never
    dropped; an empty table stays empty."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size

    @F.pandas_udf("lang string, score double")
    def guess(texts):
        import pandas as pd
        model = shared.value
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang", "score"])

    got = guess(F.col(text_col).cast("string"))
    return (docs.withColumn("__guess", got).withColumns({lang_out: F.col("__guess.lang"), score_out: F.col("__guess.score")})
            .drop("__guess"))

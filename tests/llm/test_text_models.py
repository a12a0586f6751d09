import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import language_id as lid
from tidemark.llm import quality
from tidemark.llm.common import crc_bucket, load
from tidemark.llm.ftrl import Ftrl, probabilities, temperature

from .helpers import documents, empty

SF = "/root/testdata/sf0.01"


def test_ftrl_learns_and_stays_sparse():
    rng = np.random.default_rng(1)
    model = Ftrl(50, 3, alpha=0.5, l1=0.5)
    for _ in range(3000):
        y = int(rng.integers(3))
        at = np.unique(np.r_[y, rng.integers(3, 50, 4)])
        model.learn(at, np.ones(len(at)), y)
    w = model.weights()
    assert [int(w[:, k].argmax()) for k in range(3)] == [0, 1, 2]
    assert (w == 0).mean() > 0.2
    assert abs(probabilities(np.array([1.0, 2.0, 3.0])).sum() - 1) < 1e-12


def test_temperature_undoes_overconfidence():
    rng = np.random.default_rng(2)
    s = rng.standard_normal((4000, 3)) * 2
    y = np.array([rng.choice(3, p=probabilities(r)) for r in s])
    assert 4 < temperature(s * 5, y) < 6.2


def test_counts_do_not_depend_on_blocks(monkeypatch):
    text = "".join(random.Random(3).choice("abcé ,Z😀") for _ in range(5000))
    whole = lid.counts(text)
    monkeypatch.setattr(lid, "BLOCK", 7)
    assert (lid.counts(text) == whole).all() and whole.sum() == 3 * len(text) - 3


def test_language_held_out_accuracy(spark):
    docs = load(spark, SF, "documents")
    model = lid.train(docs, crc_bucket("doc_id", 4) != 2)
    got = lid.identify(docs.where(crc_bucket("doc_id", 4) == 2), model).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.95
    assert all(0 <= r.lang_score <= 1 for r in got)
    assert (model.weights == 0).mean() > 0.3  # elastic net


def test_language_edge_cases(spark):
    docs = documents(spark).withColumn("lang_pred", F.lit("clash")).withColumn("lang_score", F.lit(3))
    model = lid.train(docs, F.lit(True))
    rows = lid.identify(docs, model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if not r.text or not any(map(str.isalpha, r.text)):
            assert (r.lang_pred, r.lang_score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "fr")
    nothing = lid.train(empty(spark), F.lit(True))
    assert nothing.languages == [] and nothing.predict("word") == ("und", 0.0)
    assert lid.identify(empty(spark), nothing).count() == 0
    one = lid.train(docs.where("lang = 'en'"), F.lit(True))
    assert one.predict("word") == ("en", 1.0)


def test_language_learns_from_marked_rows_only(spark):
    docs = documents(spark)
    changed = docs.withColumn("lang", F.when(crc_bucket("doc_id", 4) == 2, F.lit("xx")).otherwise(F.col("lang")))
    a, b = (lid.train(d, crc_bucket("doc_id", 4) != 2) for d in (docs, changed))
    assert a.languages == b.languages and (a.weights == b.weights).all() and a.temperature == b.temperature


def test_quality_held_out_accuracy(spark):
    docs, labels = load(spark, SF, "documents"), load(spark, SF, "labels")
    model = quality.train(docs, labels, crc_bucket("doc_id", 5) != 0)
    got = (quality.score(docs, model, out="s").join(labels, "doc_id").where(crc_bucket("doc_id", 5) == 0)
           .select("s", "quality").collect())
    assert np.mean([(r.s >= 0.3) == (r.quality == 1) for r in got]) > 0.9


def test_quality_edge_cases(spark):
    docs = documents(spark).withColumn("score", F.lit("clash")).withColumn("label", F.lit(1))
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (4, 1, 0), (None, 1, 0), (7, None, 1), (10, 1, 0), (1, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels, F.lit(True))
    rows = quality.score(docs, model, out="score").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").split()}) == 1
    untrained = quality.train(docs, labels.where("false"), F.lit(True))
    assert {r.score for r in quality.score(docs, untrained, out="score").collect()} == {0.5}
    assert quality.score(empty(spark), untrained).count() == 0


def test_quality_shapes():
    assert quality.shape(b"THE!!") == b"X!" and quality.shape(b"The,") == b"Xx," and quality.shape(b"a1###") == b"x0#"
    w = quality.Words()
    at, x = quality.features(b"a a a", w)
    assert abs((x[1:] ** 2).sum() - 1) < 1e-9 and at[0] == 0


def test_shape_covers_the_whole_word():
    assert quality.shape(b"ab" * 200 + b"1Z-") == b"x0X-"

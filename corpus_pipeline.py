"""Cleaning and packing of a document corpus: language ID, exact and near
de-duplication, substring de-duplication, packing.

Each stage takes (spark, docs, sf_dir) and all its predecessor kept, and all but the last return
the columns of ``documents``. No stage's result can be stated in SQL as a whole
(learned weights, XXH64 fingerprints, vocabulary merges), so there is no
``ORACLE_SQL``; ``tests/llm`` checks the stages against brute force.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import language_id, packing
from tidemark.llm.common import ascii_lower, crc_bucket, load, materialise
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.simhash import simhash_dedup
from tidemark.llm.substring_dedup import substring_dedup
from tidemark.session import prepare

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A language is accepted from this calibrated probability on.
LEAST_SCORE = 0.5

#: Rows handed to a Python worker at a time: whole texts, so Spark's default of 10,000 is tens of megabytes, several times over.
BATCH_ROWS = 1500
#: Chunks that a worker remembers in packing: it keeps them beside what the other stages need.
REMEMBERED = 100_000

ORACLE_SQL = None


def _bounded_batches(stage):
    """The stage with at most BATCH_ROWS documents in a worker's batch. The setting stays: a stage's result is
    written after the stage returns."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)
    return run


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without any letter and those no learned language fits with
    LEAST_SCORE; nothing to learn from: only letterless ones go."""
    model = language_id.train(docs, F.col("doc_id").isNotNull())
    got = language_id.identify(docs.select(*COLUMNS), model)
    ok = (F.col("lang_pred") != "und") & (F.col("lang_score") >= LEAST_SCORE)
    if not model.languages:
        ok = F.col("text").rlike(r"\p{L}")
    return got.where(ok).select(*COLUMNS)


def _digest() -> Column:
    """SHA-256 of the text with A-Z lower-cased, as the exact stage takes it."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(F.col("text"), F.lit(""))).cast("binary"), 256))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts (A-Z lower-cased) stays: the largest id, null ids last."""
    kept = (exact_dedup(docs, F.coalesce(crc_bucket("doc_id", 2) == 0, F.lit(False))).where("kept")
            .select(F.col("id").alias("__id"), F.col("digest").alias("__digest")))
    own = docs.select(*COLUMNS, _digest().alias("__digest"))
    one = Window.partitionBy("__digest", "doc_id").orderBy("source", "lang", "n_chars", "text")
    met = own.join(kept, (own["__digest"] == kept["__digest"]) & own["doc_id"].eqNullSafe(kept["__id"]), "left_semi")
    return met.withColumn("__nth", F.row_number().over(one)).where("__nth = 1").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays (4-word shingles, 4 bits): the smallest id, of
    several texts under it the smallest digest; a group of null ids only keeps its rows.
    Rows go one by one (id and digest), whatever other rows share their id."""
    own = docs.select(*COLUMNS, _digest().alias("__digest"))
    gone = (simhash_dedup(own, shingle=4, max_bits=4, row_col="__digest").where("NOT kept")
            .select(F.col("id").alias("__id"), F.col("row").alias("__row")).distinct())
    # id and digest tell all rows apart after the exact stage
    return own.join(gone, (own["__digest"] == gone["__row"]) & own["doc_id"].eqNullSafe(gone["__id"]), "left_anti").select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that also start in a document with a smaller id; documents left
    without any word go."""
    got = substring_dedup(docs, carry=["lang", "source"], cut_text=True).where("n_words > n_removed")
    more = F.from_json("extra", "lang string, source string")
    return got.select(F.col("id").alias("doc_id"), F.col("kept_text").alias("text"), more["lang"].alias("lang"),
                      more["source"].alias("source"), F.length("kept_text").cast("long").alias("n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2048, remember=REMEMBERED).withColumnRenamed("id", "doc_id")


STAGES = [(name, _bounded_batches(stage)) for name, stage in [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack_sequences),
]]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    prepare(spark)
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The contract queries of the thirteen operators and, where SQL can express one, its DuckDB twin.

Each takes its rows through its operator over the whole table; digest columns
are derived here from the operators' real outputs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare
from . import bpe, exact_dedup, language_id, lexical_search, packing, quality, sharding, simhash, source_mix, spelling
from . import substring_dedup, url_filter
from . import embedding_dedup as embedding
from .common import UPPER, crc_bucket, load

#: The rule set that pages are judged by.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
SHARDS = 40
SEQUENCE_LENGTH = 2048
QUALITY_THRESHOLD = 0.3
#: The mix's weights over the sources, its share of all words, and the most of a source or document.
MIX_WEIGHTS, MIX_SHARE, MIX_MOST = [5, 2, 1], 1.5, 2


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = substring_dedup.substring_dedup(load(spark, sf_dir, "documents"))
    return got.select(F.col("id").alias("doc_id"), "n_words", "n_removed",
                      F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.embedding_dedup(load(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, rule string")
    got = url_filter.filter_pages(load(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return got.select("page_id", F.col("url_host").alias("host"), F.col("url_path").alias("path"),
                      F.col("url_rule").alias("rule"), F.col("url_verdict").alias("verdict"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = language_id.train(docs, crc_bucket("doc_id", 4) != 2)
    got = language_id.identify(docs.select("doc_id", "text"), model, score_out="score")
    return got.select("doc_id", F.coalesce(crc_bucket("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op5_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = sharding.hilbert_shards(load(spark, sf_dir, "documents"), ["lang", "source", "n_chars", "doc_id"], SHARDS)
    return got.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one half, by a hash of the id, is the history; the other half arrives against it
    got = exact_dedup.exact_dedup(load(spark, sf_dir, "documents"), crc_bucket("doc_id", 2) == 0)
    return got.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.simhash_dedup(load(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return got.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = public_tokenizers.path("byte_bpe_50k.json")
    got = bpe.decode(bpe.encode(load(spark, sf_dir, "documents"), vocab), vocab)
    return got.select(F.col("id").alias("doc_id"), F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = packing.pack(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), SEQUENCE_LENGTH)
    return got.select(F.col("id").alias("doc_id"), "piece", "start", F.col("length").cast("long").alias("length"),
                      F.col("crc").alias("ids_crc32"), "sequence_id", "offset")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, load(spark, sf_dir, "labels"), crc_bucket("doc_id", 5) != 0)
    got = quality.score(docs, model, out="score")
    return got.select("doc_id", F.coalesce(crc_bucket("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(load(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), 10)


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = source_mix.mix(load(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_SHARE, MIX_MOST)
    return got.select("doc_id", "size", "source_size", "target", "taken", "source")


OPERATORS = [op1_substring_dedup, op2_embedding_dedup, op3_url_filter, op4_language_id, op5_hilbert_sharding,
             op6_exact_dedup, op7_simhash_dedup, op8_bpe, op9_packing, op10_quality, op11_spelling_variants,
             op12_lexical_search, op13_source_mix]


def _prepared(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepare(spark), sf_dir)
    return run


QUERIES = {q.__name__: _prepared(q) for q in OPERATORS}

_RULES = ", ".join(f"('{v}', '{r}')" for v, r in URL_RULES)

SQL = {
    "op1_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(ws[p:p + 12], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM w WHERE len(ws) >= 13)),
dup AS (
  SELECT doc_id, p FROM windows JOIN (SELECT s, min(doc_id) AS low FROM windows GROUP BY s) USING (s) WHERE low < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p FROM dup),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
    "op2_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
good AS (
  SELECT * FROM v WHERE x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0
    AND len(list_filter(x, lambda e: e <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.95),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
deg AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM v LEFT JOIN deg ON deg.a = vec_id LEFT JOIN low ON low.a = vec_id""",
    "op3_url_filter": rf"""
WITH rules(verdict, rule) AS (VALUES {_RULES}),
r AS (SELECT verdict, rule, substr(rule, 1, instr(rule, '/') - 1) AS rh, substr(rule, instr(rule, '/')) AS rp FROM rules),
p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{UPPER.lower()}') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
u AS (SELECT DISTINCT host, path FROM p),
best AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM u JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path)
SELECT page_id, p.host, p.path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN best ON p.host = best.host AND p.path = best.path""",
    "op6_exact_dedup": f"""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    "op11_spelling_variants": rf"""
WITH RECURSIVE crc AS (  -- the table of crc32, by its rule
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
found AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{UPPER.lower()}') AS w
  FROM documents),
counted AS (SELECT doc_id, w, count(*) AS n FROM found WHERE length(w) >= 6 GROUP BY ALL),
named AS (SELECT *, hex(encode(concat(doc_id, ':', w))) AS x FROM counted),
hashed AS (
  SELECT w, n, xor(list_reduce(list_concat([4294967295], list_transform(range(0, length(x), 2), lambda i:
      16 * (instr('0123456789ABCDEF', substr(x, i + 1, 1)) - 1) + instr('0123456789ABCDEF', substr(x, i + 2, 1)) - 1)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM named, crc),
written AS (
  SELECT n, CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word
  FROM hashed),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM written WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) AS l, substr(word, i + 1) AS r
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
one AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.i = b.i AND a.l = b.l AND a.r = b.r AND a.word <> b.word
  UNION SELECT cut.word, v.word FROM cut JOIN v ON v.word = l || r
  UNION SELECT v.word, cut.word FROM cut JOIN v ON v.word = l || r),
near AS (
  SELECT one.word, count(*) AS n_near, max(n) AS top_n, first(other ORDER BY n DESC, other) AS top
  FROM one JOIN v ON v.word = other GROUP BY one.word),
f AS (
  SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 5 * n THEN top END AS form,
         CASE WHEN top_n >= 5 * n THEN top_n END AS form_n
  FROM v LEFT JOIN near USING (word)),
walk AS (
  SELECT word, word AS last, 0 AS step FROM f
  UNION ALL SELECT walk.word, f.form, step + 1 FROM walk JOIN f ON f.word = walk.last WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(last, step) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN ends USING (word)""",
    "op12_lexical_search": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (
  SELECT item_id, term, count(*) AS c FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
size AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM size),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
scored AS (
  SELECT item_id, tf.r, doc_id, CAST(sum(c * CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
         * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term) JOIN size ON size.r = tf.r, total GROUP BY item_id, tf.r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
}

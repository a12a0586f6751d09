import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import url_filter
from tidemark.llm.common import materialise
from tidemark.llm.queries import URL_RULES

from .helpers import documents, empty

URLS = ["https://a.example.net/en/x", "http://EXAMPLE.NET/en", "http://example.net/EN/", "http://x.net", "http://x.net?q=/", "http://x.net/",
        "http://notnet/", "http://net/", "http://deep.a.b.example.com/de/1#f", "http://myexample.com/de/", "http://example.com/de?x",
        "http://w.org/fr/", "http://w.org:80/fr/", "ftp://x.org/fr/?a", "//x.net/", "x.net/", "", None, "http:///p", "http://", "a://b://c.net/",
        "http://example.com/de/" + "y" * 5000, "http://" + "a." * 300 + "net/", "http://x\n.net/\nq"]


def judge(url):
    """The contract, rule by rule."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        k = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:k]), rest[k:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    best = None
    for verdict, rule in URL_RULES:
        h, p = rule[:rule.index("/")], rule[rule.index("/"):]
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return host, path, best and best[1], best[0] if best else "allow"


@pytest.mark.parametrize("limit", [100_000, 0])
def test_urls_rule_by_rule(spark, monkeypatch, limit):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", limit)
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS + URLS[:3])], "page_id long, url string, url_host string")
    rules = spark.createDataFrame(URL_RULES, "verdict string, rule string")
    got = url_filter.filter_pages(pages, rules).collect()
    assert len(got) == len(URLS) + 3
    for r in got:
        assert (r.url_host, r.url_path, r.url_rule, r.url_verdict) == judge(r.url), r.url
    assert url_filter.filter_pages(pages.where("false"), rules).count() == 0
    none = url_filter.filter_pages(pages, rules.where("false"), default="block").collect()
    assert {(r.url_rule, r.url_verdict) for r in none} == {(None, "block")}


def test_rules_of_one_text_and_nulls(spark):
    rules = spark.createDataFrame([("allow", "a.b/"), ("block", "a.b/"), ("block", None), (None, "c.d/"), ("block", "e.f")],
                                  "verdict string, rule string")
    pages = spark.createDataFrame([("http://a.b/",), ("http://c.d/",), ("http://x.e.f",)], "url string")
    got = {r.url: r.url_verdict for r in url_filter.filter_pages(pages, rules).collect()}
    assert got == {"http://a.b/": "block", "http://c.d/": "allow", "http://x.e.f": "block"}


def run_stages(spark, docs):
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(materialise(stage(spark, kept[-1], "unused"), f"test-{name}"))
    return kept


def test_pipeline_stages(spark):
    docs = documents(spark).withColumn("__id", F.lit(3)).withColumn("kept", F.lit("clash"))
    kept = run_stages(spark, docs)
    for k in range(1, 5):
        assert kept[k].columns == corpus_pipeline.COLUMNS
    rows = [x.collect() for x in kept]
    fold = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    # language ID: letterless texts go, no text is changed
    assert all(any(map(str.isalpha, r.text)) for r in rows[1])
    # exact: one row of each text, with the largest id
    groups = {}
    for r in rows[1]:
        groups.setdefault(fold(r.text), []).append(-1 if r.doc_id is None else r.doc_id)
    assert sorted((-1 if r.doc_id is None else r.doc_id, fold(r.text)) for r in rows[2]) == sorted((max(i), t) for t, i in groups.items())
    # near copies: the smallest id of each group, by brute force
    from .test_dedup import components, slow_fingerprint
    two = [r for r in rows[2]]
    fps, at = [slow_fingerprint(r.text) for r in two], range(len(two))
    order = sorted(at, key=lambda i: 10**9 if two[i].doc_id is None else two[i].doc_id)
    rank = {i: n for n, i in enumerate(order)}
    low = components(at, [(rank[a], rank[b]) for a in at for b in at if a < b and bin(fps[a] ^ fps[b]).count("1") <= 4])
    assert {two[order[n]].doc_id for n in low if low[n] == n} == {r.doc_id for r in rows[3]}
    # passages: as the contract's brute force cuts them
    from .test_dedup import brute_substring
    want = {i: t for i, n, gone, t in brute_substring([(r.doc_id, r.text) for r in rows[3] if r.doc_id is not None]) if n > gone}
    got = {r.doc_id: b" ".join(r.text.encode().split()).decode() for r in rows[4] if r.doc_id is not None}
    assert got == want and all(r.n_chars == len(r.text) for r in rows[4])
    assert {r.doc_id for r in rows[5]} == {r.doc_id for r in rows[4]}


def test_near_copies_go_row_by_row(spark):
    """White space makes near copies with one fingerprint; rows that share an id with one stay."""
    a, b, c, d, e = (" ".join(f"{k}{i}" for i in range(30)) for k in "abcde")
    wide = lambda t, gap="  ": t.replace(" ", gap)
    rows = [(1, a), (None, wide(a)), (None, b), (-1, c), (7, d), (7, wide(a)), (7, e), (7, wide(e)), (None, wide(c, " \t"))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, "unused").collect()]
    assert len(got) == 5 and {x for x in got if x[1] not in (e, wide(e))} == {(1, a), (None, b), (-1, c), (7, d)}
    assert sum(t in (e, wide(e)) for _, t in got) == 1  # two texts of one id in one group: one of them


def test_pipeline_run_with_repeated_ids(spark, tmp_path):
    """``run`` as registered: rows that share an id go through all stages as rows; the clean one is packed whole."""
    words = lambda k, n: " ".join(f"{k}{i}" for i in range(n))
    p = "the quick brown fox " + words("word", 30)
    rows = [(1, p + " x"), (7, p + " the " + words("a", 60)), (7, "the old " + words("z", 60)), (8, words("q", 40)), (8, words("q", 40)), (9, "123 456"), (10, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    from tidemark.llm.packing import word_encoder
    import public_tokenizers
    encode = word_encoder(public_tokenizers.path("word_bpe_49k.json")).encode
    length = lambda t: len(next(iter(encode([t.encode()])))) // 4 + 1
    assert sorted((r.doc_id, r.length) for r in got) == sorted(
        [(1, length(p + " x")), (7, length("the " + words("a", 60))), (7, length("the old " + words("z", 60))), (8, length(words("q", 40)))])


def test_pipeline_empty(spark):
    assert run_stages(spark, empty(spark))[-1].count() == 0


def test_package_is_shipped(spark):
    """Workers import the operators from what the driver sent."""
    sent = spark.range(1).mapInArrow(lambda it: it, "id long").count()
    assert sent == 1 and "tidemark.llm.common" in sys.modules

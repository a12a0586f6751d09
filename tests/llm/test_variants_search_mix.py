import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lexical_search as search
from tidemark.llm import source_mix as mix
from tidemark.llm import spelling
from tidemark.llm.queries import MIX_MOST, MIX_SHARE, MIX_WEIGHTS, QUERIES, SQL

from .helpers import documents, empty


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


# spelling variants


def brute_variants(rows, every, least_n, ratio):
    n = Counter()
    for i, t in rows:
        for w in spelling.RUN.findall(t or ""):
            n[spelling.typo(i, lower(w), every)] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= least_n}
    near = defaultdict(set)
    masks = defaultdict(set)
    for w in n:
        for k in range(len(w)):
            masks[w[:k] + "*" + w[k + 1:]].add(w)
            if (x := w[:k] + w[k + 1:]) in n:
                near[w].add(x)
                near[x].add(w)
    for ws in masks.values():
        for w in ws:
            near[w] |= ws - {w}
    form = {}
    for w in n:
        top = min(near[w], key=lambda x: (-n[x], x), default=None)
        if top and n[top] >= ratio * n[w]:
            form[w] = top

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {(w, form.get(w), root(w), k, len(near[w]), n.get(form.get(w))) for w, k in n.items()}


@pytest.mark.parametrize("groups,per_chunk", [(4, 8000), (3, 3)])
def test_spelling_brute_force(spark, groups, per_chunk):
    rnd = random.Random(3)
    base = ["abcdef", "abcdeg", "abcdefg", "zabcdef", "abdcef", "éabcdè", "éabcde", "fedcba", "aaaaaa", "aaaaaaa", "x" * 3000, "x" * 2999 + "y", "chainz", "chaina", "chainab"]
    rows = []
    for k, w in enumerate(base):  # counts apart by the ratio, and ties
        for _ in range([2, 6, 18, 2, 6, 6, 2, 54, 6, 2, 2, 6, 4, 20, 90][k]):
            rows.append((rnd.randrange(500), f"1{w.upper() if rnd.random() < .3 else w}-" + rnd.choice(["", "short", "123 ÷"])))
    rows += [(None, "abcdef abcdeh"), (7, None), (8, ""), rows[0], (9, "ABCDEF×ab abcdeh")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(1))
    got = spelling.spelling_variants(docs, every=5, least_n=2, ratio=3, groups=groups, per_chunk=per_chunk).collect()
    want = brute_variants([(r.doc_id, r.text) for r in docs.collect()], 5, 2, 3)
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert any(r.root != (r.form or r.word) for r in got)  # a chain of two steps is among them


def test_one_edit():
    words = ["abcdef", "abcdeg", "abcdefg", "bcdef", "abdcef", "abcdef", "abXdef", "aabcdef"]
    codes, size = spelling._codes(words)
    a, b = map(np.ravel, np.meshgrid(range(len(words)), range(len(words))))
    got = spelling.one_edit(codes[a], size[a], codes[b], size[b])

    def cuts(w):
        return {w[:k] + w[k + 1:] for k in range(len(w))}
    for i, j, ok in zip(a, b, got):
        x, y = words[i], words[j]
        differ = sum(p != q for p, q in zip(x, y)) == 1 if len(x) == len(y) else (x in cuts(y) or y in cuts(x))
        assert ok == differ, (x, y)


def test_spelling_empty(spark):
    assert spelling.spelling_variants(empty(spark)).count() == 0
    assert spelling.spelling_variants(documents(spark).where("text IS NULL OR text = ''")).count() == 0


# ranked search


def brute_search(docs, items, k):
    tf = [(i, Counter(search.terms_of(lower(t)))) for i, t in docs]
    tf = [(i, c) for i, c in tf if c]
    n, words = len(tf), sum(c.total() for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for item, terms in items.items():
        found = []
        for i, c in tf:
            m = 25 + 75 * c.total() * n // words
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t, q in terms.items() if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("per_block,tops,sent", [(2000, 40, 500_000), (2, 1, 0)])
def test_search_brute_force(spark, monkeypatch, per_block, tops, sent):
    monkeypatch.setattr(search, "SENT", sent)  # 0: candidates are joined by a shuffle
    docs = documents(spark).withColumn("id", F.lit(9)).withColumn("score", F.lit("clash"))
    rows = [(5, "w1 w2 w3 w3 common7"), (2, "COMMON1 common2, common3"), (9, "same same é ünï"), (4, ""), (6, None), (None, "w1"),
            (7, "nowhere"), (8, "w5 " * 30), (8, "w6 x"), (1, "tail 1 😀")]
    items = spark.createDataFrame(rows, "item_id long, text string").withColumn("rank", F.lit("clash"))
    asked = {}
    for i, t in rows:
        if i is not None:
            asked.setdefault(i, Counter()).update(search.terms_of(lower(t)))
    want = brute_search([(r.doc_id, r.text) for r in docs.collect()], asked, 5)
    got = search.search(docs, items, 5, per_block=per_block, tops=tops).collect()
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=str) == want


def test_search_bounds_are_never_too_low(spark):
    rnd = random.Random(1)
    texts = [" ".join(f"t{int(rnd.expovariate(.02))}" for _ in range(rnd.choice([3, 50, 4000]))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = search.build_index(docs).where("width IS NOT NULL").collect()
    assert len({r.width for r in index}) > 1  # long documents have filters of their own
    q = search.Queries(60, sum(len(t.split()) for t in texts), [(0, {f"t{k}": k + 1 for k in range(30)})])
    seen = 0
    for r in index:
        ids, _ = search.unpack(r.ids)
        sizes, slices = search.unpack(r.sizes)[0], search.unpack(r.slices)[0]
        for i, n, bound in zip(ids, sizes, next(search._bounds(q, r.width, sizes, slices))[1]):
            assert bound >= q.score(q.items[0][1], Counter(texts[i].split()), n)
            seen += 1
    assert seen == 60


def test_search_empty(spark):
    items = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert search.search(empty(spark), items).count() == 0
    assert search.search(documents(spark), items.where("item_id = 0")).count() == 0


# mixing


def brute_targets(sizes, weights, share, most):
    """Source sizes by source -> targets, excess shared again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full = set()
    while True:
        rest = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        total = sum(w[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else rest * w[s] / total for s in names}
        over = {s for s in names if target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


def mixture(spark, n=900):
    rnd = random.Random(8)
    rows = [(i, " ".join("w" for _ in range(rnd.choice([0, 1, 2, 5, 40, 41, 300]))), rnd.choice(["hot"] * 4 + ["b", "é", "Z", None]))
            for i in range(n)]
    rows += [(None, "a b c", "hot")] * 57 + [(None, "a b", None)] * 20 + [rows[3], rows[3], (-1, None, "b"), (-2, "x " * 20000, "b"), (-3, " \t", "nothing")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("key", F.lit("clash")).withColumn("x", F.lit(1))


@pytest.mark.parametrize("per_chunk", [64, 5])
def test_mix(spark, monkeypatch, per_chunk):
    monkeypatch.setattr(mix, "COPIES", 10)  # repeated rows over several tasks
    docs = mixture(spark)
    got = mix.mix(docs, [5, 2, 1], 1.5, 2, per_chunk=per_chunk).collect()
    own = [(r.doc_id, r.source, len((r.text or "").split())) for r in docs.collect()]
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter(own)
    sizes = Counter()
    for _, s, n in own:
        sizes[s] += n
    want = brute_targets(sizes, [5, 2, 1], 1.5, 2)
    taken, most = Counter(), defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(want[r.source], abs=1e-6) and r.source_size == sizes[r.source]
        assert r.taken == r.copies * r.size and r.taken <= 2 * r.size
        wanted = r.target / r.source_size if r.source_size else 0
        assert math.floor(wanted + 1e-9) <= r.copies <= math.ceil(wanted - 1e-9) or not r.size
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r.size)
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(4, most[s] / 2)
    assert taken["hot"] == pytest.approx(want["hot"], rel=0.002)


def test_mix_reruns_agree(spark):
    docs = mixture(spark, 200)

    def rows(df, **more):
        return Counter(map(tuple, mix.mix(df, [5, 2, 1], **more).select("doc_id", "source", "size", "taken").collect()))
    one = rows(docs)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert rows(docs.repartition(7)) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    other = rows(docs, seed=1)
    assert other != one


def test_meeting_keeps_the_words_and_the_odds(spark):
    """Over many draws two fractions keep their means; in each the words are the same, and one is integral."""
    d = spark.range(4000).select(
        F.struct(F.col("id").alias("key"), F.lit(30).alias("size"), F.lit(.3).alias("x")).alias("a"),
        F.struct((-F.col("id")).alias("key"), F.lit(50).alias("size"), F.lit(.6).alias("x")).alias("b"))
    x, y = mix._meet(d["a"], d["b"], F.lit(0))
    got = d.select(x.alias("x"), y.alias("y")).toPandas()
    assert np.allclose(30 * got.x + 50 * got.y, 39) and got.min().min() > -1e-9 and got.max().max() < 1 + 1e-9
    whole = lambda v: np.isclose(v, 0) | np.isclose(v, 1)
    assert (whole(got.x) | whole(got.y)).all()
    assert abs(got.x.mean() - .3) < .02 and abs(got.y.mean() - .6) < .02


def test_mix_edges(spark):
    assert mix.mix(empty(spark), [5, 2, 1]).count() == 0
    none = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mix.mix(none, [5, 2, 1]).collect()] == [(0, 0.0, 0)] * 2


def test_mix_plan_is_native(spark):
    plan = mix.mix(documents(spark), [5, 2, 1])._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "ExistingRDD"))


# the registered queries against their SQL and brute force


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    docs = documents(spark, n=80).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    variants = " ".join(["colour"] * 40 + ["color"] * 3 + ["colours"] * 9 + ["cologr"] * 5)
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 5 == 0, F.concat_ws(" ", "text", F.lit(variants))).otherwise(F.col("text")))
    docs.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, "w1 w2 colour"), (3, "common1 common2 w9 w9"), (4, None)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_lexical_search"])
def test_queries_match_their_sql(spark, tables, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{tables}/{t}.parquet/*.parquet')")
    got = QUERIES[name](spark, tables)
    want = con.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert got.columns == names
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)
    assert got.count() >= 4


def test_mix_query(spark, tables):
    got = QUERIES["op13_source_mix"](spark, tables)
    assert got.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    assert [t for _, t in got.dtypes[:5]] == ["bigint", "bigint", "bigint", "double", "bigint"]
    rows = got.collect()
    docs = spark.read.parquet(f"{tables}/documents.parquet").collect()
    assert {(r.doc_id, r.size) for r in rows} == {(r.doc_id, len((r.text or "").split())) for r in docs} and len(rows) == len(docs)
    sizes = Counter()
    for r in docs:
        sizes[r.source] += len((r.text or "").split())
    want = brute_targets(sizes, MIX_WEIGHTS, MIX_SHARE, MIX_MOST)
    assert all(r.target == pytest.approx(want[r.source], abs=1e-6) and r.taken <= 2 * r.size for r in rows)

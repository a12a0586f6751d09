"""URL rules by hashed host-suffix / path-prefix expressions.

Every distinct URL is expanded into the expressions a rule could have (host
suffixes on label borders, path prefixes), restricted to the label counts and
path lengths that occur in the rule set, so the expansion is bounded by the
rules and not by the URL. Expressions meet the rules in an equi-join on the
first bytes of their digest; the full digest then confirms the hit, and the
longest rule wins. All of it is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rule tables up to this many rows are broadcast (counted first), larger ones shuffle.
BROADCAST_RULES = 100_000
PREFIX_HEX = 8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def prepare_rules(rules: DataFrame) -> DataFrame:
    """(verdict, rule) -> host, path, digest. A rule is ``host/path...``: the
    host up to the first slash, the path from it on. Null or repeated rules
    count once; of one rule with both verdicts ``block`` wins."""
    r = (rules.where("rule is not null and verdict is not null")
         .groupBy("rule").agg(F.max("verdict").alias("verdict")))
    cut = F.expr("locate('/', rule)")
    return (r.withColumn("rule_host", F.when(cut > 0, F.expr("substring(rule, 1, locate('/', rule) - 1)")).otherwise(F.col("rule")))
            .withColumn("rule_path", F.when(cut > 0, F.expr("substring(rule, locate('/', rule))")).otherwise(F.lit("")))
            .withColumn("rule_host", F.lower("rule_host"))
            .withColumn("digest", F.sha2(F.concat_ws("\n", "rule_host", "rule_path"), 256))
            .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX)))


def judge_urls(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """(url, host, path, rule, verdict) for every distinct url, null included.

    A rule fits its host and all subdomains when the path starts with the
    rule's path (case-sensitively). The longest rule text wins; at equal length
    the longer host, then the text order. No rule: null and ``default``.
    Null urls and urls without ``://`` have empty host and path and fit none.
    """
    u = urls.select(F.col(url).alias("url")).distinct().select(
        "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = prepare_rules(rules)
    shape = known.agg(F.collect_set(F.size(F.split("rule_host", r"\."))), F.collect_set(F.length("rule_path")),
                      F.count("*")).first()
    if not shape[2]:
        return u.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    labels = ", ".join(str(int(x)) for x in sorted(shape[0]))
    lengths = ", ".join(str(int(x)) for x in sorted(shape[1]))
    parts = u.withColumn("n", F.size(F.split("host", r"\.")))
    hosts = F.expr(f"explode(transform(filter(array({labels}), k -> k <= n AND host <> ''), k -> substring_index(host, '.', -k)))")
    paths = F.expr(f"explode(transform(filter(array({lengths}), k -> k <= length(path)), k -> substring(path, 1, k)))")
    expr = (parts.withColumn("h", hosts).withColumn("p", paths)
            .withColumn("digest", F.sha2(F.concat_ws("\n", "h", "p"), 256))
            .select("url", "digest", F.substring("digest", 1, PREFIX_HEX).alias("prefix")))
    side = known.select("prefix", F.col("digest").alias("full"), "rule", "verdict", "rule_host")
    side = F.broadcast(side) if shape[2] <= BROADCAST_RULES else side
    hits = expr.join(side, "prefix").where(F.col("digest") == F.col("full"))
    best = hits.groupBy("url").agg(F.max(F.struct(
        F.length("rule").alias("n"), F.length("rule_host").alias("hn"), "rule", "verdict")).alias("best"))
    return (u.join(best, "url", "left")
            .select("url", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


def filter_pages(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """All rows of ``pages`` with ``url_host, url_path, url_rule, url_verdict``.

    Rows are kept as they are, repeated ones too; only their distinct urls are
    judged, and a frequent url is one key of a left join whose large side
    adaptive execution splits. Clashing columns of ``pages`` are replaced.
    """
    names = {"host": "url_host", "path": "url_path", "rule": "url_rule", "verdict": "url_verdict"}
    judged = judge_urls(pages, rules, url, default).select(
        F.col("url").alias("__url"), *[F.col(k).alias(v) for k, v in names.items()])
    left = pages.drop(*names.values())
    return left.join(judged, left[url].eqNullSafe(judged["__url"]), "left").drop("__url")

"""Verdicts on URLs: given rules first, then association rules mined by FP-growth.

Rules of (host, path) decide where they fit. The URLs they decide are also the
labels (others may be given): FP-growth finds token combinations that go together
with a verdict. Rules with enough support and confidence are kept and matched by an
inverted index from token to rule: a rule matches a URL when as many of the URL's
tokens point to it as it has. Only DataFrame functions and Spark's own FP-growth.

A URL is a handful of tokens, one per place (domain ending, site, host labels,
first directories, kind of the last segment, extension, query, fragment), so that a
transaction stays short. Equal token sets are matched once.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchloom.llm.common import materialise

#: (verdict, host, path): fits the host and its subdomains where the path starts with the rule's; the longest wins.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
MIN_SUPPORT, MIN_CONFIDENCE = 0.01, 0.6
#: For a URL that no rule of either kind decides.
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both are empty for a null or a url without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(url)), r"(?s)^[^?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def given_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(name + start)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """At most ten tokens, sorted."""
    labels, segments = F.split(host, r"\."), F.split(path, "/")
    last = F.element_at(segments, -1)

    def segment(k: int) -> Column:
        s = F.get(segments, F.lit(k))
        return F.when(F.length(s) > 0, F.when(s.rlike(r"^[0-9]+(\.[a-z]+)?$"), F.lit(f"{k}:#")).otherwise(F.concat(F.lit(f"{k}:"), s)))

    found = [
        F.when(F.length(host) > 0, F.concat(F.lit("end:"), F.element_at(labels, -1))),
        F.when(F.size(labels) > 1, F.concat(F.lit("site:"), F.array_join(F.slice(labels, -2, 2), "."))),
        F.when(F.size(labels) > 2, F.concat(F.lit("sub:"), F.element_at(labels, -3))),
        F.when(F.size(labels) > 3, F.concat(F.lit("front:"), F.element_at(labels, 1))),
        segment(1), segment(2),
        F.when(last.rlike(r"\.[A-Za-z0-9]{1,5}$"), F.concat(F.lit("ext:"), F.regexp_extract(last, r"\.([A-Za-z0-9]{1,5})$", 1))),
        F.when(F.contains(url, F.lit("?")), F.concat(F.lit("query:"), F.regexp_extract(url, r"\?([^=&#]*)", 1))),
        F.when(F.contains(url, F.lit("#")), F.lit("fragment")),
        F.when(path.endswith("/"), F.lit("slash")),
    ]
    return F.array_sort(F.array_compact(F.array(*found)))


def mine(labelled: DataFrame, support: float = MIN_SUPPORT, confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(rule_id, items, size, verdict, confidence, support) from rows (tokens, verdict)."""
    items = labelled.select(F.array_append("tokens", F.concat(F.lit("="), F.col("verdict"))).alias("items"))
    if items.isEmpty():
        empty = "rule_id long, items array<string>, size int, verdict string, confidence double, support double"
        return labelled.sparkSession.createDataFrame([], empty)
    found = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(items).associationRules
    verdict = F.element_at("consequent", 1)
    kept = found.filter(verdict.startswith("=") & ~F.exists("antecedent", lambda t: t.startswith("=")))
    return kept.select(
        F.xxhash64(F.array_join(F.array_sort("antecedent"), "\x1f"), verdict).alias("rule_id"), F.col("antecedent").alias("items"), F.size("antecedent").alias("size"),
        F.substring(verdict, 2, 100).alias("verdict"), "confidence", "support")


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, verdict, confidence) of the best matching rule of every token set (key, tokens) that has one.

    Best is the most confident, then the longest, then the best supported.
    """
    index = rules.select("rule_id", "size", "verdict", "confidence", "support", F.explode("items").alias("token"))
    hits = sets.select("key", F.explode("tokens").alias("token")).join(index, "token")
    whole = hits.groupBy("key", "rule_id", "size", "verdict", "confidence", "support").agg(F.count("*").alias("n")).filter("n = size")
    best = whole.groupBy("key").agg(F.max(F.struct("confidence", "size", "support", "verdict")).alias("best"))
    return best.select("key", F.col("best.verdict").alias("mined"), F.col("best.confidence").alias("confidence"))


def judge(pages: DataFrame, rules=RULES, support: float = MIN_SUPPORT, confidence: float = MIN_CONFIDENCE, labels: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages``: (page_id, host, path, rule, verdict, mined, confidence).

    Labels are the given rules' verdicts, or the rows (page_id, verdict) of ``labels``.
    Null urls and urls without ``://`` have empty host and path, fit no rule and get
    the verdict of what is mined for the empty token set, which is none: DEFAULT.
    Rows without a page_id and repeated rows each give a row. Only ``page_id`` and
    ``url`` are read, so further columns may have any name. An empty table gives no row.
    """
    url = F.col("url")
    host, path = host_and_path(url)
    parsed = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = given_rule(F.col("host"), F.col("path"), rules)
    marked = parsed.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("given"), tokens(F.coalesce(url, F.lit("")), F.col("host"), F.col("path")).alias("tokens"))
    marked = materialise(marked.withColumn("key", F.array_join("tokens", "\x1f")), "url-tokens")
    known = marked.filter("given is not null").select("tokens", F.col("given").alias("verdict"))
    if labels is not None:
        known = marked.join(labels.select("page_id", "verdict"), "page_id").select("tokens", "verdict")
    mined = materialise(mine(known, support, confidence), "url-rules")
    found = match(marked.select("key", "tokens").distinct(), mined)
    return marked.join(found, "key", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("given", "mined", F.lit(DEFAULT)).alias("verdict"), "mined", "confidence")

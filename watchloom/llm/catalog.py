"""The queries of this folder, with production parameters, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchloom.llm import (
    decontamination, divergence, html_text, language_model, licences, packing, passages, pii, simhash, topk, toxicity, url_rules, vafile,
)
from watchloom.llm.common import table
from watchloom.session import prepare_session


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.learn(pages))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    return pii.find(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    return language_model.score(table(spark, sf_dir, "documents"))


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    return url_rules.judge(table(spark, sf_dir, "pages"))


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    return passages.deduplicate(table(spark, sf_dir, "documents")).drop("kept")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    return licences.find(table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_vafile(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    return vafile.cluster(table(spark, sf_dir, "embeddings"))


OPERATORS = (
    op1_html_text, op2_pii, op3_simhash, op4_topk, op5_language_model, op6_url_rules, op7_suffix_array, op8_toxicity, op9_decontamination,
    op10_packing, op11_licences, op12_divergence, op13_vafile,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {"op4_topk": OP4_SQL, "op11_licences": licences.sql(), "op12_divergence": divergence.SQL, "op13_vafile": vafile.sql()}


OP4_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS p FROM embeddings
  WHERE embedding IS NOT NULL AND NOT list_contains([x IS NULL OR NOT isfinite(x) FOR x IN embedding], true)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([z[1] * z[2] FOR z IN list_zip(q.p, c.p)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.p) = len(c.p)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""

"""Tables behind the dashboard and the printed report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from watchloom.functions.quantiles import exact_quantile


def kpi_summary(entities: DataFrame, findings: DataFrame, ranking: DataFrame) -> DataFrame:
    """One row: entities, findings, ranked entities and their mean attention index."""
    mean = ranking.agg(F.avg("attention_index").alias("mean")).scalar()
    return findings.sparkSession.range(1).select(
        entities.agg(F.count(F.lit(1)).alias("n")).scalar().alias("entities"),
        findings.agg(F.count(F.lit(1)).alias("n")).scalar().alias("findings"),
        ranking.agg(F.count(F.lit(1)).alias("n")).scalar().alias("ranked"),
        F.coalesce(mean, F.lit(0.0)).alias("avg_attention_index"),
    )


def portfolio_status(ranking: DataFrame, q: float = 0.8) -> DataFrame:
    """(status, entity_id, attention_index): 0 is Good, the top fifth Critical."""
    cut = exact_quantile(ranking, [], "attention_index", q, "cut").scalar()
    idx = F.col("attention_index")
    return ranking.select(
        F.when(idx == 0, "Good").when(idx >= cut, "Critical").otherwise("Warning").alias("status"),
        "entity_id", "attention_index",
    )


def risk_levels(ranking: DataFrame) -> DataFrame:
    """(entity_id, attention_index, risk_level) by fixed bands, highest index first."""
    idx = F.col("attention_index")
    level = F.when(idx > 0.3, "Critical").when(idx > 0.1, "Warning").otherwise("Good")
    return ranking.select("entity_id", "attention_index", level.alias("risk_level")).orderBy(
        F.desc("attention_index"), "entity_id"
    )


def top_findings(findings: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` most severe findings (a distributed top-n)."""
    return findings.orderBy(F.col("severity").desc_nulls_last(), "detector_id", "entity_id", "target_id").limit(n)


def filter_findings(findings: DataFrame, detector_id: str | None = None, entity_id: str | None = None) -> DataFrame:
    """All findings matching the given filters."""
    if detector_id is not None:
        findings = findings.filter(F.col("detector_id") == detector_id)
    if entity_id is not None:
        findings = findings.filter(F.col("entity_id") == entity_id)
    return findings


def explore_findings(findings: DataFrame, n: int = 50, **filters) -> tuple[DataFrame, DataFrame]:
    """(first ``n`` matches, one-row total) as the explorer shows them."""
    matching = filter_findings(findings, **filters)
    total = matching.agg(F.count(F.lit(1)).alias("findings"))
    return matching.orderBy("detector_id", "entity_id", "target_id").limit(n), total


def findings_by(findings: DataFrame, key: str) -> DataFrame:
    """Distinct filter values of a column with their number of findings."""
    return findings.groupBy(key).agg(F.count(F.lit(1)).alias("findings"))

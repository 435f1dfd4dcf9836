"""Finding scores, capability scores and the entity ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from watchloom.config import DEFAULTS, GLOBAL_ENTITY, Settings


def finding_score(cfg: Settings = DEFAULTS) -> Column:
    """severity share x effect size x confidence, with the defaults for nulls."""
    return (
        F.coalesce("severity", F.lit(cfg.default_severity)) / F.lit(cfg.severity_scale)
        * F.coalesce("effect_size", F.lit(cfg.default_effect))
        * F.coalesce("confidence", F.lit(cfg.default_confidence))
    )


def score_findings(findings: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    return findings.withColumn("score", finding_score(cfg))


def noisy_or(score: Column, ceiling: float) -> Column:
    """Aggregate 1 - product(1 - s), each score clamped to [0, ceiling]; null scores count as none."""
    clamped = F.greatest(F.lit(0.0), F.least(score, F.lit(ceiling)))
    return 1.0 - F.product(F.coalesce(1.0 - F.when(score.isNotNull(), clamped), F.lit(1.0)))


def capability_columns(findings: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """One row per entity, one column per capability.

    Each capability is its own conditional product in one aggregate: a single shuffle
    by entity, partially aggregated, and the zero fill comes for free.
    """
    mapped = list(cfg.detector_capabilities)
    score = finding_score(cfg)
    columns = []
    for capability in cfg.weights:
        named = [d for d, caps in cfg.detector_capabilities.items() if capability in caps]
        speaks = F.col("detector_id").isin(named) if named else F.lit(False)
        if capability in cfg.default_capabilities:
            speaks = speaks | ~F.col("detector_id").isin(mapped)
        columns.append(noisy_or(F.when(speaks, score), cfg.score_ceiling).alias(capability))
    return findings.groupBy("entity_id").agg(*columns)


def capability_scores(findings: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """(entity_id, capability, score), every capability present."""
    return capability_columns(findings, cfg).unpivot(
        "entity_id", list(cfg.weights), "capability", "score"
    )


def entity_ranking(findings: DataFrame, cfg: Settings = DEFAULTS, drop_global: bool = False) -> DataFrame:
    """(entity_id, attention_index, capability_scores): the weighted mean of the capabilities.

    Unsorted; ``sort_ranking`` orders it for a reader. Findings about analysts rank
    under GLOBAL unless ``drop_global``.
    """
    if drop_global:
        findings = findings.filter(F.col("entity_id") != GLOBAL_ENTITY)
    total = sum(cfg.weights.values())
    weighted = sum((F.col(f"`{c}`") * F.lit(float(w)) for c, w in cfg.weights.items()), F.lit(0.0))
    as_map = F.create_map(*[x for c in cfg.weights for x in (F.lit(c), F.col(f"`{c}`"))])
    return capability_columns(findings, cfg).select(
        "entity_id",
        F.round(weighted / F.lit(float(total)), 4).alias("attention_index") if total > 0
        else F.lit(0.0).alias("attention_index"),
        as_map.alias("capability_scores"),
    )


def sort_ranking(ranking: DataFrame) -> DataFrame:
    return ranking.orderBy(F.desc("attention_index"), "entity_id")


def top_entities(ranking: DataFrame, n: int = 5) -> DataFrame:
    """(rank, entity_id, attention_index) of the first ``n``; only those are numbered."""
    top = sort_ranking(ranking).limit(n).select("entity_id", "attention_index")
    place = Window.partitionBy(F.lit(0)).orderBy(F.desc("attention_index"), "entity_id")
    return top.select(F.row_number().over(place).alias("rank"), "entity_id", "attention_index")

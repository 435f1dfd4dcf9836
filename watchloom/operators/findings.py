"""The finding record every detector returns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from watchloom.config import GLOBAL_ENTITY
from watchloom.schemas import FINDING


def finding(
    df: DataFrame,
    detector_id: str,
    target,
    severity,
    rationale: Column,
    entity=None,
    **evidence: Column,
) -> DataFrame:
    """Rows of ``df`` as findings.

    ``severity`` may be a column name, a number, or None (then scored with the
    default). ``evidence`` keeps the measured numbers behind the finding.
    """
    sev = F.col(severity) if isinstance(severity, str) else F.lit(severity)
    pairs = [x for name, col in evidence.items() for x in (F.lit(name), col.cast("double"))]
    return df.select(
        F.lit(detector_id).alias("detector_id"),
        (F.col(entity) if entity else F.lit(GLOBAL_ENTITY)).alias("entity_id"),
        (F.col(target) if isinstance(target, str) else target).alias("target_id"),
        sev.cast("int").alias("severity"),
        F.lit(None).cast("double").alias("effect_size"),
        F.lit(None).cast("double").alias("confidence"),
        rationale.alias("rationale"),
        (F.create_map(*pairs) if pairs else F.lit(None)).cast(FINDING["evidence"].dataType).alias("evidence"),
    )

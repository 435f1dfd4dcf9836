"""Detector recall against planted weaknesses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from watchloom.operators.detectors import DETECTORS


def recall_by_detector(findings: DataFrame, truth: DataFrame, detectors=None) -> DataFrame:
    """(detector_id, truth, hits, recall): share of planted targets found; 1.0 without any.

    Targets count once per detector on both sides.
    """
    planted = truth.select(F.col("finding_id").alias("detector_id"), "target_id").distinct()
    found = findings.select("detector_id", "target_id").distinct().withColumn("hit", F.lit(1))
    counted = (
        planted.join(found, ["detector_id", "target_id"], "left")
        .groupBy("detector_id").agg(F.count(F.lit(1)).alias("truth"), F.count("hit").alias("hits"))
    )
    names = F.array(*[F.lit(d) for d in (detectors or DETECTORS)])
    every = findings.sparkSession.range(1).select(F.explode(names).alias("detector_id"))
    return every.join(counted, "detector_id", "left").select(
        "detector_id", F.coalesce("truth", F.lit(0)).alias("truth"), F.coalesce("hits", F.lit(0)).alias("hits"),
        F.coalesce(F.col("hits") / F.col("truth"), F.lit(1.0)).alias("recall"),
    )

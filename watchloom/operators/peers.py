"""Peer benchmarks: entities against others of their sector and size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from watchloom.config import DEFAULTS, Settings
from watchloom.functions.quantiles import exact_quantile
from watchloom.functions.timing import duration_micros, seconds_to_micros
from watchloom.sources.tables import SocTables

METRICS = ("alert_volume", "fast_closures")


def peer_features(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """(entity_id, sector, size_tier, alert_volume, fast_closures), zero-alert entities kept."""
    fast = F.col("closed_ts").isNotNull() & (
        duration_micros("created_ts", "closed_ts") < seconds_to_micros(cfg.fast_close_seconds)
    )
    counts = t.alerts.groupBy("entity_id").agg(
        F.count("alert_id").alias("volume"), F.count(F.when(fast, 1)).alias("fast")
    )
    return (
        t.entities.select("entity_id", "sector", "size_tier").join(counts, "entity_id", "left")
        .groupBy("entity_id", "sector", "size_tier")
        .agg(F.sum(F.coalesce("volume", F.lit(0))).alias("alert_volume"),
             F.sum(F.coalesce("fast", F.lit(0))).alias("fast_closures"))
    )


def robust_z(long: DataFrame, keys: list[str], value: str, scale: float) -> DataFrame:
    """Adds ``z``: (x - median) / (scale x MAD) within ``keys``.

    A zero MAD falls back to (x - mean) / sample deviation, and that to 0. ``n`` is the
    group's row count.
    """
    stats = long.groupBy(*keys).agg(
        F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_std"), F.count(F.lit(1)).alias("n")
    )
    median = exact_quantile(long, keys, value, 0.5, "_median")
    spread = long.join(median, keys).select(*keys, F.abs(F.col(value) - F.col("_median")).alias("_dev"))
    mad = exact_quantile(spread, keys, "_dev", 0.5, "_mad")
    summary = stats.join(median, keys).join(mad, keys)
    x = F.col(value)
    z = (
        F.when(F.col("_mad") != 0, (x - F.col("_median")) / (F.col("_mad") * F.lit(scale)))
        .when(F.col("_std") != 0, (x - F.col("_mean")) / F.col("_std"))
        .otherwise(F.lit(0.0))
    )
    return long.join(summary, keys, "left").withColumn("z", z).drop("_mean", "_std", "_median", "_mad")


def peer_robust_z(features: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """(entity_id, peer_group, metric, value, n, z): robust z per peer group and metric.

    Both metrics go through one pass. Entities without a peer group get a null z.
    """
    grouped = features.withColumn("peer_group", F.concat("sector", F.lit(" - "), "size_tier"))
    long = grouped.unpivot(["entity_id", "peer_group"], list(METRICS), "metric", "value")
    known = robust_z(long.filter(F.col("peer_group").isNotNull()), ["peer_group", "metric"], "value", cfg.mad_scale)
    lone = long.filter(F.col("peer_group").isNull()).select(
        "peer_group", "metric", "entity_id", "value",
        F.lit(None).cast("long").alias("n"), F.lit(None).cast("double").alias("z"),
    )
    return known.select("peer_group", "metric", "entity_id", "value", "n", "z").unionByName(lone)


def peer_benchmarks(features: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Features plus peer_group, alert_volume_z and fast_closure_z, shrunk by n / (n + k)."""
    z = peer_robust_z(features, cfg)
    shrunk = z.withColumn("z", F.coalesce(F.col("z") * (F.col("n") / (F.col("n") + cfg.shrink_k)), F.lit(0.0)))
    wide = shrunk.groupBy("entity_id").agg(
        F.first("peer_group").alias("peer_group"),
        F.max(F.when(F.col("metric") == "alert_volume", F.col("z"))).alias("alert_volume_z"),
        F.max(F.when(F.col("metric") == "fast_closures", F.col("z"))).alias("fast_closure_z"),
    )
    return features.join(wide, "entity_id")


def peer_outliers(benchmarks: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    beyond = (F.abs("alert_volume_z") > cfg.outlier_z) | (F.abs("fast_closure_z") > cfg.outlier_z)
    return benchmarks.filter(beyond).select("entity_id", "peer_group", "alert_volume_z", "fast_closure_z")

"""Negative space (NS-01 .. NS-06): what should be there and is not."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from watchloom.config import DEFAULTS, Settings
from watchloom.functions.scalars import one_row
from watchloom.operators.execution_gaps import case_links
from watchloom.operators.findings import finding
from watchloom.sources.tables import SocTables


_SALTS = 64


def missing_cells(subjects: DataFrame, expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Expected cells a subject lacks; ``expected`` and ``observed`` must be distinct.

    Subjects that have as many expected cells as there are lack none and are out before
    anything is expanded. The others meet the expected cells by an equality join on a
    salt, each cell in one of ``_SALTS`` shares, so neither side is gathered anywhere, and
    lose those they have. A cell common to a share s of n subjects is one of at most
    |observed| / (s n), so even with every subject in deficit the grid has at most
    |observed| / s rows.
    """
    cell, who = expected.columns, subjects.columns
    total = F.coalesce(expected.agg(F.count(F.lit(1)).alias("n")).scalar(), F.lit(0))
    had = observed.join(expected, cell, "left_semi").groupBy(*who).agg(F.count(F.lit(1)).alias("_had"))
    short = subjects.join(had, who, "left").filter(F.coalesce("_had", F.lit(0)) < total).drop("_had")
    shares = expected.withColumn("_salt", F.pmod(F.xxhash64(*cell), F.lit(_SALTS)).cast("int"))
    spread = short.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    grid = spread.join(shares, "_salt").select(*who, *cell)
    return grid.join(observed.select(*who, *cell), [*who, *cell], "left_anti")


def ns_01(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """Critical asset no alert refers to."""
    heard = t.alerts.filter(F.col("asset_id").isNotNull()).select("asset_id").distinct()
    silent = (
        t.assets.filter(F.col("criticality") == cfg.critical_label)
        .select("entity_id", "asset_id", "type")
        .join(heard, "asset_id", "left_anti").distinct()
    )
    return finding(
        silent, "NS-01", "asset_id", None, entity="entity_id",
        rationale=F.format_string("Critical asset of type '%s' produced no alert in the period.", "type"),
    )


def ns_02(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """Alert category that most entities see and this one does not."""
    pairs = t.alert_counts("entity_id", "category").select("entity_id", "category")
    total = t.entities.agg(F.countDistinct("entity_id").alias("n")).scalar()
    common = (
        pairs.filter(F.col("category").isNotNull())
        .groupBy("category").agg(F.count("entity_id").alias("entities"))
        .filter(F.try_divide("entities", total) >= cfg.common_category_share)
        .select("category")
    )
    missing = missing_cells(t.entities.select("entity_id"), common, pairs)
    return finding(
        missing, "NS-02", "category", 3, entity="entity_id",
        rationale=F.format_string("Category '%s' is common among entities but missing here.", "category"),
    )


def ns_03(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """High-severity alert in no case."""
    in_case = case_links(t.cases).select("alert_id").distinct()
    orphans = t.alerts.filter(F.col("severity") >= cfg.high_severity).join(in_case, "alert_id", "left_anti")
    return finding(
        orphans, "NS-03", "alert_id", "severity", entity="entity_id",
        rationale=F.format_string("Alert of severity %d was raised but no case was opened.", "severity"),
    )


def ns_04(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """Entity with far fewer alerts than its assets would suggest."""
    exposure = t.assets.groupBy("entity_id").agg(F.count(F.lit(1)).alias("assets"))
    both = exposure.join(t.alert_counts("entity_id"), "entity_id", "left")
    rate = both.filter(F.col("rows").isNotNull()).agg(
        (F.sum("rows") / F.sum("assets")).alias("rate")
    ).scalar()
    rated = both.select(
        "entity_id", F.coalesce("rows", F.lit(0)).alias("alerts"), (F.col("assets") * rate).alias("expected")
    )
    low = rated.filter(F.col("alerts") < F.col("expected") * cfg.low_activity_ratio)
    return finding(
        low, "NS-04", "entity_id", 4, entity="entity_id",
        rationale=F.format_string("%d alerts observed, about %d expected from the assets.", "alerts",
                                  F.col("expected").cast("long")),
        alerts=F.col("alerts"), expected=F.col("expected"),
    )


def ns_05(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """Asset type an entity owns but never sees an alert on."""
    heard = (
        t.alerts.filter(F.col("asset_id").isNotNull()).select("asset_id").distinct()
        .withColumn("heard", F.lit(1))
    )
    silent = (
        t.assets.select("entity_id", "asset_id", "type").join(heard, "asset_id", "left")
        .groupBy("entity_id", "type").agg(F.count(F.lit(1)).alias("assets"), F.count("heard").alias("heard"))
        .filter(F.col("heard") == 0)
    )
    return finding(
        silent, "NS-05", "type", 3, entity="entity_id",
        rationale=F.format_string("%d assets of type '%s', none with an alert.", "assets", "type"),
        assets=F.col("assets"),
    )


def entity_volumes(t: SocTables) -> DataFrame:
    """(entity_id, alerts) for every entity, zero where it has none."""
    counts = t.alert_counts("entity_id").select("entity_id", F.col("alerts").alias("n"))
    return (
        t.entities.groupBy("entity_id").agg(F.count(F.lit(1)).alias("copies"))
        .join(counts, "entity_id", "left")
        .select("entity_id", (F.coalesce("n", F.lit(0)) * F.col("copies")).alias("alerts"))
    )


def global_zscore(df: DataFrame, value: str, out: str = "z") -> DataFrame:
    """Adds (value - mean) / sample standard deviation; null when the deviation is 0."""
    stats = one_row(df.agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")))
    return df.withColumn(out, (F.col(value) - stats["mean"]) / F.nullif(stats["std"], F.lit(0.0)))


def ns_06(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """Entity whose alert volume lies far below all others."""
    low = global_zscore(entity_volumes(t), "alerts").filter(F.col("z") < cfg.volume_z)
    return finding(
        low, "NS-06", "entity_id", 5, entity="entity_id",
        rationale=F.format_string("Alert volume %d is an outlier among all entities (z %.2f).", "alerts", "z"),
        alerts=F.col("alerts"), z=F.col("z"),
    )

"""Canonical tables: load, union of sources, views."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from watchloom import schemas
from watchloom.session import materialise
from watchloom.sources import store
from watchloom.sources.conform import conform


def read_table(spark: SparkSession, name: str, paths: Iterable[str], stores: Iterable[str] = ()) -> DataFrame:
    """One table over several Parquet locations and submission stores, united by column name.

    Each location keeps the columns it has (the footer schema, not inference over
    data); a location without files is skipped, and with none left the result is
    an empty frame of the declared schema, so detectors give no rows, not errors.
    """
    schema = schemas.TABLES[name]
    parts = []
    for path in paths:
        try:
            parts.append(conform(spark.read.parquet(path), schema))
        except AnalysisException as err:
            if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    parts += [part for part in (store.snapshot(spark, base, name) for base in stores) if part is not None]
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


@dataclass(frozen=True)
class SocTables:
    """The working set the detectors read.

    ``rollup`` is optional: alert counts by entity, day, category and severity, which
    lets every volume detector of an assessment read one shared aggregate.
    """

    entities: DataFrame
    assets: DataFrame
    alerts: DataFrame
    cases: DataFrame
    events: DataFrame
    notes: DataFrame
    escalations: DataFrame
    rollup: DataFrame | None = None

    def with_rollup(self) -> SocTables:
        """Count the alerts once; the counts are written to the shared folder.

        The table has a row per entity, day, category and severity seen, however many
        alerts there are.
        """
        rollup = (
            self.alerts
            .groupBy("entity_id", F.to_date("created_ts").alias("day"), "category", "severity")
            .agg(F.count(F.lit(1)).alias("rows"), F.count("alert_id").alias("alerts"))
        )
        return replace(self, rollup=materialise(rollup, "alert-rollup"))

    def alert_counts(self, *keys: str) -> DataFrame:
        """(keys, rows, alerts): all alert rows and rows with an id, per key.

        Keys are any of entity_id, day, category, severity.
        """
        if self.rollup is not None:
            return self.rollup.groupBy(*keys).agg(
                F.sum("rows").alias("rows"), F.sum("alerts").alias("alerts")
            )
        dated = self.alerts.withColumn("day", F.to_date("created_ts"))
        return dated.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("rows"), F.count("alert_id").alias("alerts")
        )


def load_tables(spark: SparkSession, base_dir: str, sources=("synthetic", "real")) -> SocTables:
    """All seven tables of every source: ``<base_dir>/<source>/<table>.parquet`` and what was submitted to the source."""
    roots = [f"{base_dir}/{s}" for s in sources]
    return SocTables(**{name: read_table(spark, name, [f"{r}/{name}.parquet" for r in roots], roots) for name in schemas.TABLES})


def register_views(tables: SocTables) -> list[str]:
    """Temp views ``<table>_view`` for SQL users."""
    names = []
    for name in schemas.TABLES:
        getattr(tables, name).createOrReplaceTempView(f"{name}_view")
        names.append(f"{name}_view")
    return names


def clear_views(spark: SparkSession) -> int:
    """Drop the working set; returns how many views existed."""
    return sum(spark.catalog.dropTempView(f"{name}_view") for name in schemas.TABLES)

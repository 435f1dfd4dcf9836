"""Exploratory checks (EX-02 .. EX-08); EX-01 lives in ``isolation_forest``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from watchloom.config import DEFAULTS, Settings
from watchloom.functions.ordering import position_within
from watchloom.functions.scalars import one_row
from watchloom.functions.timing import duration_seconds, micros
from watchloom.operators.findings import finding
from watchloom.operators.negative_space import missing_cells
from watchloom.sources.tables import SocTables

_HOUR = 3_600_000_000


def case_event_paths(events: DataFrame, *carry: str) -> DataFrame:
    """(carry, case_id, position, event_type): events of a case in time order, ties by type.

    The path stays in rows: no task holds the whole path of a case. ``carry`` names
    columns that are constant within a case.
    """
    placed = events.select(*carry, "case_id", "event_type", micros("ts").alias("at"))
    slot = F.floor(F.col("at") / F.lit(_HOUR)).cast("long")
    return position_within(
        placed, [*carry, "case_id"], slot, [F.col("at"), F.col("event_type")]
    ).select(*carry, "case_id", "position", "event_type")


def ex_02(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """Analyst with the same event path in every case that has events.

    Cases on one path have the same number of events of each type, which counts
    alone can tell. Only analysts passing that are put in order, so the costly part
    never sees a case that is unlike its owner's others.
    """
    owners = t.cases.filter(F.col("owner").isNotNull()).select("case_id", "owner")
    alike = (
        t.events.groupBy("case_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
        .join(owners, "case_id")
        .groupBy("owner", "event_type")
        .agg(F.count(F.lit(1)).alias("cases"), F.min("n").alias("lo"), F.max("n").alias("hi"))
        .groupBy("owner")
        .agg(F.min("cases").alias("least"), F.max("cases").alias("most"), F.max(F.col("hi") - F.col("lo")).alias("gap"))
        .filter((F.col("least") == F.col("most")) & (F.col("least") >= cfg.path_min_cases) & (F.col("gap") == 0))
        .select("owner")
    )
    theirs = t.events.join(owners.join(alike, "owner", "left_semi"), "case_id")
    paths = (
        case_event_paths(theirs, "owner")
        .groupBy("owner", "position", "event_type").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("owner", "position").agg(F.count(F.lit(1)).alias("variants"), F.sum("n").alias("cases"))
        .groupBy("owner").agg(
            F.count(F.lit(1)).alias("steps"), F.max("variants").alias("variants"),
            F.min("cases").alias("fewest"), F.max("cases").alias("cases"),
        )
    )
    same = paths.filter(
        (F.col("variants") == 1) & (F.col("fewest") == F.col("cases")) & (F.col("cases") >= cfg.path_min_cases)
    )
    return finding(
        same, "EX-02", "owner", 4,
        rationale=F.format_string("All %d cases follow the same path of %d events.", "cases", "steps"),
        cases=F.col("cases"), steps=F.col("steps"),
    )


def ex_03(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """Analyst whose handling time hardly varies.

    The deviation is rounded to nine decimals, so that the comparison does not depend
    on the order in which partial results were merged.
    """
    closed = t.cases.filter(F.col("owner").isNotNull() & F.col("closed_ts").isNotNull())
    spread = closed.groupBy("owner").agg(
        F.count("case_id").alias("cases"),
        F.round(F.stddev_samp(duration_seconds("opened_ts", "closed_ts")), 9).alias("std"),
    )
    steady = spread.filter((F.col("cases") >= cfg.steady_min_cases) & (F.col("std") < cfg.steady_max_std))
    return finding(
        steady, "EX-03", "owner", 4,
        rationale=F.format_string("Handling time over %d cases deviates by only %.2f seconds.", "cases", "std"),
        cases=F.col("cases"), std=F.col("std"),
    )


def half_counts(alerts: DataFrame) -> DataFrame:
    """(entity_id, alerts, h1, h2): alerts up to and after the middle of an entity's span.

    Alerts are counted per entity and hour first. An hour lies wholly in one half
    unless the middle falls into it, so raw alerts are looked at again for one hour
    per entity only, and a busy entity is spread over its hours throughout.
    """
    timed = alerts.select("entity_id", micros("created_ts").alias("at")).withColumn(
        "hour", F.floor(F.col("at") / F.lit(_HOUR)).cast("long"))
    hourly = timed.groupBy("entity_id", "hour").agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi"))
    span = hourly.groupBy("entity_id").agg(
        F.sum("n").alias("alerts"), (F.min("lo") + F.max("hi")).alias("twice_mid"))
    placed = hourly.join(span, "entity_id")
    early, late = F.col("hi") * 2 <= F.col("twice_mid"), F.col("lo") * 2 > F.col("twice_mid")
    whole = placed.select(
        "entity_id", "alerts", F.when(early, F.col("n")).otherwise(0).alias("h1"),
        F.when(late, F.col("n")).otherwise(0).alias("h2"))
    middle = placed.filter(~early & ~late).select("entity_id", "hour", "twice_mid")
    cut = timed.join(middle, ["entity_id", "hour"]).select(
        "entity_id", F.lit(None).cast("long").alias("alerts"),
        (F.col("at") * 2 <= F.col("twice_mid")).cast("long").alias("h1"),
        (F.col("at") * 2 > F.col("twice_mid")).cast("long").alias("h2"))
    return whole.unionByName(cut).groupBy("entity_id").agg(
        F.max("alerts").alias("alerts"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2"))


def ex_04(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """Entity whose alert volume collapses in the second half of its span."""
    drifted = half_counts(t.alerts).filter(
        (F.col("alerts") >= cfg.drift_min_alerts)
        & (F.col("h1") > cfg.drift_min_first_half)
        & (F.col("h2") < F.col("h1") * cfg.drift_ratio)
    )
    return finding(
        drifted, "EX-04", "entity_id", 3, entity="entity_id",
        rationale=F.format_string("Alert volume fell from %d in the first half to %d in the second.", "h1", "h2"),
        h1=F.col("h1"), h2=F.col("h2"),
    )


def category_severity_grid(t: SocTables) -> DataFrame:
    """(category, severity, alerts, share of all alerts); the total counts every row."""
    cells = t.alert_counts("category", "severity")
    total = cells.agg(F.sum("rows").alias("n")).scalar()
    return (
        cells.filter(F.col("category").isNotNull() & F.col("severity").isNotNull())
        .select("category", "severity", F.col("rows").alias("alerts"), (F.col("rows") / total).alias("share"))
    )


def ex_05(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """Common (category, severity) cell an active entity lacks.

    With a share above 5 % there are at most 19 common cells.
    """
    common = category_severity_grid(t).filter(F.col("share") > cfg.grid_share).select("category", "severity")
    cells = t.alert_counts("entity_id", "category", "severity")
    active = (
        cells.filter(F.col("entity_id").isNotNull()).groupBy("entity_id").agg(F.sum("rows").alias("n"))
        .filter(F.col("n") >= cfg.grid_min_alerts).select("entity_id")
    )
    missing = missing_cells(active, common, cells)
    return finding(
        missing, "EX-05", F.format_string("%s_Sev%d", "category", "severity"), 4, entity="entity_id",
        rationale=F.format_string("%s of severity %d is common overall but absent here.", "category", "severity"),
    )


def ex_06(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """Root cause frequent in one entity and seen in no other."""
    per_entity = (
        t.cases.filter(F.col("root_cause").isNotNull())
        .groupBy("root_cause", "entity_id").agg(F.count(F.lit(1)).alias("n"))
    )
    lone = (
        per_entity.groupBy("root_cause")
        .agg(F.count(F.lit(1)).alias("entities"), F.sum("n").alias("cases"), F.min("entity_id").alias("entity_id"))
        .filter((F.col("entities") == 1) & (F.col("cases") >= cfg.root_cause_min_cases))
    )
    return finding(
        lone, "EX-06", "root_cause", 3, entity="entity_id",
        rationale=F.format_string("Root cause used in %d cases here and in no other entity.", "cases"),
        cases=F.col("cases"),
    )


def ex_07(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """Entity whose alert volume stops in the last days of the overall period.

    Days without alerts count as zero, so sums over the day counts are enough; the
    zero-filled series itself is ``daily_series`` below.
    """
    daily = t.alert_counts("entity_id", "day").filter(F.col("day").isNotNull())
    period = one_row(daily.agg(
        F.max("day").alias("last"), (F.datediff(F.max("day"), F.min("day")) + 1).alias("days")
    ))
    recent = F.col("day") > F.date_sub(period["last"], cfg.flatline_days)
    sums = daily.groupBy("entity_id").agg(
        F.sum(F.when(recent, F.col("alerts")).otherwise(0)).alias("recent"),
        F.sum(F.when(recent, 0).otherwise(F.col("alerts"))).alias("prior"),
    ).withColumn("days", period["days"])
    means = sums.filter(F.col("days") >= cfg.flatline_days).select(
        "entity_id",
        (F.col("recent") / F.lit(float(cfg.flatline_days))).alias("recent"),
        F.try_divide("prior", F.col("days") - cfg.flatline_days).alias("prior"),
    )
    flat = means.filter((F.col("recent") < cfg.flatline_recent) & (F.col("prior") > cfg.flatline_prior))
    return finding(
        flat, "EX-07", "entity_id", 4, entity="entity_id",
        rationale=F.format_string("Daily alerts fell from %.1f to %.1f in the last days.", "prior", "recent"),
        recent=F.col("recent"), prior=F.col("prior"),
    )


def daily_series(df: DataFrame, key: str, ts: str) -> DataFrame:
    """(key, day, rows): one row for every day of the overall period, zero-filled."""
    counts = df.groupBy(key, F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    period = one_row(counts.agg(F.min("day").alias("first"), F.max("day").alias("last")))
    grid = counts.select(key).distinct().select(
        key, F.explode(F.sequence(period["first"], period["last"], F.expr("interval 1 day"))).alias("day")
    )
    return grid.join(counts, [key, "day"], "left").select(key, "day", F.coalesce("rows", F.lit(0)).alias("rows"))


def ex_08(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """Analyst who gives every alert the same disposition."""
    per_value = (
        t.alerts.filter(F.col("analyst_id").isNotNull() & F.col("disposition").isNotNull())
        .groupBy("analyst_id", "disposition").agg(F.count(F.lit(1)).alias("n"))
    )
    uniform = (
        per_value.groupBy("analyst_id")
        .agg(F.sum("n").alias("alerts"), F.count(F.lit(1)).alias("values"), F.min("disposition").alias("value"))
        .filter((F.col("alerts") > cfg.regular_min_alerts) & (F.col("values") == 1))
    )
    return finding(
        uniform, "EX-08", "analyst_id", 4,
        rationale=F.format_string("All %d alerts were given disposition '%s'.", "alerts", "value"),
        alerts=F.col("alerts"),
    )

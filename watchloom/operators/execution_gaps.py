"""Execution gaps (EG-01 .. EG-06): work that was done, but badly."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from watchloom.config import DEFAULTS, Settings
from watchloom.functions.timing import duration_micros, duration_seconds, micros, seconds_to_micros
from watchloom.operators.findings import finding
from watchloom.sources.tables import SocTables


def case_links(cases: DataFrame, *extra: str) -> DataFrame:
    """(case_id, alert_id): one row per distinct alert of a case."""
    return cases.select("case_id", *extra, F.explode(F.array_distinct("alert_ids")).alias("alert_id"))


def eg_01(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """High-severity alert closed within seconds. One narrow stage."""
    fast = t.alerts.filter(
        (F.col("severity") >= cfg.high_severity)
        & F.col("closed_ts").isNotNull()
        & (duration_micros("created_ts", "closed_ts") < seconds_to_micros(cfg.fast_close_seconds))
    )
    seconds = duration_seconds("created_ts", "closed_ts")
    return finding(
        fast, "EG-01", "alert_id", "severity", entity="entity_id",
        rationale=F.format_string("High-severity alert closed after %.1f seconds.", seconds),
        close_seconds=seconds,
    )


def eg_02(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """Case closed too fast for its severity. One narrow stage."""
    fast = t.cases.filter(
        (F.col("severity") >= cfg.case_min_severity)
        & (duration_micros("opened_ts", "closed_ts") < seconds_to_micros(cfg.case_fast_seconds))
    )
    seconds = duration_seconds("opened_ts", "closed_ts")
    return finding(
        fast, "EG-02", "case_id", "severity", entity="entity_id",
        rationale=F.format_string("Case closed after %.1f seconds despite its severity.", seconds),
        close_seconds=seconds,
    )


def eg_03(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """Closed high-severity alert with a case but no escalation, by alert or by case.

    Links and escalations first shrink to one row per alert id in a partial
    aggregate, so an id listed in a third of all cases costs one row per task.
    """
    escalated_case = (
        t.escalations.filter(F.col("case_id").isNotNull()).select("case_id").distinct()
        .withColumn("escalated", F.lit(1))
    )
    by_case = (
        case_links(t.cases).join(escalated_case, "case_id", "left")
        .select("alert_id", F.lit(1).alias("in_case"), F.coalesce("escalated", F.lit(0)).alias("escalated"))
    )
    by_alert = t.escalations.filter(F.col("alert_id").isNotNull()).select(
        "alert_id", F.lit(0).alias("in_case"), F.lit(1).alias("escalated")
    )
    unescalated = (
        by_case.unionByName(by_alert).groupBy("alert_id")
        .agg(F.max("in_case").alias("in_case"), F.max("escalated").alias("escalated"))
        .filter((F.col("in_case") == 1) & (F.col("escalated") == 0))
        .select("alert_id")
    )
    closed = t.alerts.filter((F.col("severity") >= cfg.high_severity) & F.col("closed_ts").isNotNull())
    return finding(
        closed.join(unescalated, "alert_id", "left_semi"), "EG-03", "alert_id", "severity", entity="entity_id",
        rationale=F.lit("High-severity alert was closed without any escalation."),
    )


def eg_04(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """Analyst whose notes mostly repeat one text.

    Whole texts are normalised and hashed before the shuffle, and counted per
    (owner, text) first, so neither long texts nor a busy owner travel.
    """
    normal = F.regexp_replace(F.lower(F.trim(F.col("text"))), r"\s+", " ")
    notes = t.notes.select("case_id", F.unhex(F.md5(normal)).alias("body"))
    owners = t.cases.filter(F.col("owner").isNotNull()).select("case_id", "owner")
    per_owner = (
        notes.join(owners, "case_id")
        .groupBy("owner", "body").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("owner").agg(F.sum("n").alias("notes"), F.max("n").alias("same"))
    )
    share = F.col("same") / F.col("notes")
    flagged = per_owner.filter((F.col("notes") >= cfg.template_min_notes) & (share >= cfg.template_share))
    return finding(
        flagged, "EG-04", "owner", 3,
        rationale=F.format_string("%d of %d notes carry the same text.", "same", "notes"),
        notes=F.col("notes"), share=share,
    )


def eg_05(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """Rule whose cases never see an analyst action."""
    worked = t.events.select("case_id").distinct().withColumn("worked", F.lit(1))
    rules = t.alerts.filter(F.col("rule_id").isNotNull()).select("alert_id", "rule_id")
    per_rule = (
        case_links(t.cases).join(worked, "case_id", "left")
        .join(rules, "alert_id")
        .groupBy("rule_id", "case_id").agg(F.max("worked").alias("worked"))
        .groupBy("rule_id").agg(F.count(F.lit(1)).alias("cases"), F.count("worked").alias("worked"))
    )
    idle = per_rule.filter((F.col("cases") >= cfg.idle_rule_min_cases) & (F.col("worked") == 0))
    return finding(
        idle, "EG-05", "rule_id", 3,
        rationale=F.format_string("Rule opened %d cases, none of which has an analyst action.", "cases"),
        cases=F.col("cases"),
    )


def closure_peaks(cases: DataFrame, window_seconds: int) -> DataFrame:
    """(owner, peak): most closures of an owner inside any window of that length.

    Closures are counted per (owner, microsecond) and cut into slots one window
    long; each count also goes to the next slot as history. A sliding sum then
    works inside (owner, slot), so a busy owner is spread over all its slots.
    """
    width = window_seconds * 1_000_000
    ticks = (
        cases.filter(F.col("owner").isNotNull() & F.col("closed_ts").isNotNull())
        .groupBy("owner", micros("closed_ts").alias("at")).agg(F.count(F.lit(1)).alias("n"))
    )
    slot = F.floor(F.col("at") / F.lit(width)).cast("long")
    placed = ticks.select(
        "owner", "at", "n",
        F.explode(F.array(
            F.struct(slot.alias("slot"), F.lit(True).alias("own")),
            F.struct((slot + 1).alias("slot"), F.lit(False).alias("own")),
        )).alias("p"),
    ).select("owner", "at", "n", "p.slot", "p.own")
    trailing = Window.partitionBy("owner", "slot").orderBy("at").rangeBetween(-width, 0)
    return (
        placed.withColumn("inside", F.sum("n").over(trailing))
        .filter("own").groupBy("owner").agg(F.max("inside").alias("peak"))
    )


def eg_06(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """Analyst closing many cases at once."""
    peaks = closure_peaks(t.cases, cfg.bulk_window_seconds)
    return finding(
        peaks.filter(F.col("peak") >= cfg.bulk_min_closures), "EG-06", "owner", 3,
        rationale=F.format_string(f"%d cases closed within {cfg.bulk_window_seconds} seconds.", "peak"),
        peak=F.col("peak"),
    )

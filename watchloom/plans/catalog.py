"""Every query by name: ``(spark, sf_dir) -> DataFrame`` over the derived tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from watchloom import schemas
from watchloom.functions.timing import duration_seconds
from watchloom.operators import (
    audit, evaluation, exploratory, negative_space, peers, quality, reports, sampling, scoring,
)
from watchloom.operators.detectors import DETECTORS, all_findings
from watchloom.operators.isolation_forest import analyst_features, anomaly_scores
from watchloom.plans.assessment import assess
from watchloom.plans.star import Star, star
from watchloom.session import materialise, prepare_session, scratch_path
from watchloom.sources import bundle, export, store
from watchloom.sources.coerce import coerce_table, to_list, to_severity, to_timestamp
from watchloom.sources.conform import conform
from watchloom.sources.csv_scan import ROW_ID, read_csv_robust
from watchloom.sources.mapping import map_columns
from watchloom.sources.tables import load_tables, read_table
from watchloom.sources.validate import drop_duplicates_keep_first, prepare

KEY = ["detector_id", "entity_id", "target_id", "severity"]

# Numbers shown next to a detector's findings.
EVIDENCE = {
    "EG-01": ["close_seconds"], "EG-02": ["close_seconds"], "EG-04": ["notes", "share"], "EG-05": ["cases"],
    "EG-06": ["peak"], "NS-04": ["alerts", "expected"], "NS-05": ["assets"], "NS-06": ["alerts", "z"],
    "EX-01": ["score"], "EX-02": ["cases", "steps"], "EX-03": ["cases", "std"], "EX-04": ["h1", "h2"],
    "EX-06": ["cases"], "EX-07": ["recent", "prior"], "EX-08": ["alerts"],
}

_QUERIES: dict[str, Callable[[Star], DataFrame]] = {}


def query(fn):
    _QUERIES[fn.__name__] = fn
    return fn


def r6(col):
    return F.round(col, 6)


def _detector_query(detector_id: str) -> Callable[[Star], DataFrame]:
    def run(s: Star) -> DataFrame:
        found = DETECTORS[detector_id](s.tables())
        return found.select(*KEY, *[r6(F.col("evidence")[e]).alias(e) for e in EVIDENCE.get(detector_id, [])])

    return run


for _id in DETECTORS:
    _QUERIES[_id.lower().replace("-", "_")] = _detector_query(_id)


def findings(s: Star) -> DataFrame:
    """All findings, as the table an assessment writes."""
    return assess(s.tables())


def ranking(f: DataFrame) -> DataFrame:
    return scoring.entity_ranking(f).select("entity_id", "attention_index")


# ---- detectors, scoring, ranking


@query
def all_findings_union(s: Star) -> DataFrame:
    """The same findings as one lazy union, without an assessment run."""
    return all_findings(s.tables()).select(*KEY)


@query
def ex_01_features(s: Star) -> DataFrame:
    return analyst_features(s.tables()).select(
        "analyst", "total_cases", r6("avg_closure_time").alias("avg_closure_time"),
        r6("fast_closure_rate").alias("fast_closure_rate"),
    )


@query
def ex_01_desks(s: Star) -> DataFrame:
    """Anomaly scores of (analyst, rule) pairs: more subjects than a tree samples."""
    t = s.tables()
    pairs = t.cases.withColumn("owner", F.concat("owner", F.lit("/"), "rule_id"))
    features = materialise(analyst_features(replace(t, cases=pairs)), "desk-features")
    return anomaly_scores(features).select("analyst", "score")


@query
def finding_scores(s: Star) -> DataFrame:
    return scoring.score_findings(findings(s)).select(*KEY, r6("score").alias("score"))


@query
def capability_scores(s: Star) -> DataFrame:
    return scoring.capability_scores(findings(s)).select("entity_id", "capability", r6("score").alias("score"))


@query
def entity_ranking(s: Star) -> DataFrame:
    return scoring.sort_ranking(ranking(findings(s)))


@query
def ranking_top5(s: Star) -> DataFrame:
    return scoring.top_entities(ranking(findings(s)), 5)


# ---- peers


@query
def peer_features(s: Star) -> DataFrame:
    return peers.peer_features(s.tables())


@query
def peer_robust_z(s: Star) -> DataFrame:
    z = peers.peer_robust_z(peers.peer_features(s.tables()))
    return z.select("entity_id", "peer_group", "metric", r6("z").alias("z"))


@query
def peer_benchmarks(s: Star) -> DataFrame:
    return peers.peer_benchmarks(peers.peer_features(s.tables())).select(
        "entity_id", "sector", "size_tier", "alert_volume", "fast_closures", "peer_group",
        r6("alert_volume_z").alias("alert_volume_z"), r6("fast_closure_z").alias("fast_closure_z"),
    )


@query
def peer_outliers(s: Star) -> DataFrame:
    out = peers.peer_outliers(peers.peer_benchmarks(peers.peer_features(s.tables())))
    return out.select("entity_id", "peer_group", r6("alert_volume_z").alias("alert_volume_z"),
                      r6("fast_closure_z").alias("fast_closure_z"))


# ---- sampling and evaluation


@query
def weighted_draws(s: Star) -> DataFrame:
    return sampling.weighted_draws(ranking(findings(s)), 200).select("draw", "entity_id")


@query
def uniform_sample(s: Star) -> DataFrame:
    return sampling.uniform_sample(findings(s).select(*KEY), KEY[:3], 25)


@query
def review_sample(s: Star) -> DataFrame:
    f = findings(s)
    return sampling.review_sample(f, ranking(f), 10)


@query
def sample_composition(s: Star) -> DataFrame:
    f = findings(s)
    return sampling.sample_composition(sampling.review_sample(f, ranking(f), 50))


@query
def lift_over_random(s: Star) -> DataFrame:
    f = findings(s)
    return sampling.lift_over_random(f, ranking(f), s.truth().select("target_id"), 10, 50)


@query
def recall_by_detector(s: Star) -> DataFrame:
    return evaluation.recall_by_detector(findings(s), s.truth()).select(
        "detector_id", "truth", "hits", r6("recall").alias("recall"))


# ---- reports


@query
def kpi_summary(s: Star) -> DataFrame:
    f = findings(s)
    return reports.kpi_summary(s.tables().entities, f, ranking(f)).withColumn(
        "avg_attention_index", r6("avg_attention_index"))


@query
def portfolio_status(s: Star) -> DataFrame:
    return reports.portfolio_status(ranking(findings(s)))


@query
def risk_levels(s: Star) -> DataFrame:
    return reports.risk_levels(ranking(findings(s)))


@query
def top_findings(s: Star) -> DataFrame:
    return reports.top_findings(findings(s).select(*KEY))


@query
def findings_filter(s: Star) -> DataFrame:
    return reports.filter_findings(findings(s).select(*KEY), "EG-02", "ENT-08")


@query
def findings_by_detector(s: Star) -> DataFrame:
    return reports.findings_by(findings(s), "detector_id")


# ---- primitives


@query
def duration(s: Star) -> DataFrame:
    return s.raw("events").select("event_id", duration_seconds(
        F.expr("timestamp_ntz '2024-01-01 00:00:00'"), "ts").alias("seconds"))


@query
def daily_series_gapfill(s: Star) -> DataFrame:
    return exploratory.daily_series(s.tables().alerts, "entity_id", "created_ts")


@query
def global_zscore(s: Star) -> DataFrame:
    per_user = s.raw("events").groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))
    return negative_space.global_zscore(per_user, "events").withColumn("z", r6("z"))


@query
def category_severity_grid(s: Star) -> DataFrame:
    return exploratory.category_severity_grid(s.tables()).withColumn("share", r6("share"))


@query
def case_event_paths(s: Star) -> DataFrame:
    return exploratory.case_event_paths(s.tables().events)


# ---- audit


def audit_events(s: Star) -> DataFrame:
    """Events in five chains, long ones: a chain is an account group."""
    return s.raw("events").select(
        (F.col("user_id") % 5).alias("chain"), "event_id", "ts",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), "event_type", F.col("props").alias("data"),
    )


def audit_chains(s: Star, events: DataFrame | None = None) -> DataFrame:
    """Linked in slices of 2,000 blocks, so that long chains go over several rounds."""
    return audit.build_chains(audit_events(s) if events is None else events, "chain", ["ts", "event_id"], F.to_date("ts"), slice_size=2000)


@query
def audit_block_hash(s: Star) -> DataFrame:
    blocks = audit_events(s).withColumnRenamed("event_id", "index").withColumn(
        "prev_hash", F.lit(audit.GENESIS_PREV))
    return blocks.select("index", audit.block_hash().alias("hash"))


@query
def audit_chain_build(s: Star) -> DataFrame:
    return audit_chains(s).select("chain", "index", "prev_hash", "hash")


@query
def audit_verify(s: Star) -> DataFrame:
    """Chains of which some blocks were altered after hashing and, in one, a stretch is gone."""
    altered = F.when(F.substring("hash", 1, 2) == "00", F.concat("data", F.lit(" "))).otherwise(F.col("data"))
    blocks = audit_chains(s).filter("not (chain = 3 and index between 100 and 119)").withColumn("data", altered)
    return audit.verify_chain(blocks.withColumn("computed", audit.block_hash()), ["chain"])


@query
def audit_seal(s: Star) -> DataFrame:
    return audit.seal(audit_chains(s), ["chain"])


@query
def audit_removed_stretch(s: Star) -> DataFrame:
    """A stretch is taken out of two chains and they are linked anew: the chains verify, the seal shows where."""
    before = audit_chains(s)
    kept = before.filter("not (chain = 1 and index between 120 and 139) and not (chain = 4 and index > 150)")
    events = kept.withColumnRenamed("index", "event_id").withColumn("ts", F.col("timestamp").cast("timestamp_ntz"))
    after = audit_chains(s, events.select("chain", "event_id", "ts", "timestamp", "event_type", "data"))
    whole = audit.verify_chain(after.withColumn("computed", audit.block_hash()), ["chain"]).select("chain", "valid")
    return audit.against_seal(after, audit.seal(before, ["chain"]), ["chain"]).join(whole, "chain")


@query
def audit_last_block(s: Star) -> DataFrame:
    return audit.last_block(audit_chains(s), ["chain"]).select("chain", "index", "hash")


@query
def audit_ledger(s: Star) -> DataFrame:
    return audit.ledger(audit_chains(s), ["chain"]).select("index", "chain", "timestamp", "event_type", "data")


# ---- sources, ingest, quality


@query
def src_union_by_name(s: Star) -> DataFrame:
    """Two submitted folders with different columns, read as one table."""
    alerts, base = s.tables().alerts, scratch_path(s.spark, "union")
    alerts.filter("nk < 12").select("alert_id", "entity_id", "category", "severity", "created_ts", "status").write.parquet(
        f"{base}/synthetic/alerts.parquet")
    alerts.filter("nk >= 12").select(
        "status", "alert_id", "entity_id", "category", "severity", "created_ts", "analyst_id", "k").write.parquet(
        f"{base}/real/alerts.parquet")
    paths = [f"{base}/{p}/alerts.parquet" for p in ("synthetic", "real", "absent")]
    return read_table(s.spark, "alerts", paths).select(
        "alert_id", "entity_id", "category", "severity", "created_ts", "status", "analyst_id", "shift")


def raw_alerts(s: Star) -> DataFrame:
    """Alerts as a messy submission: odd headers, text cells, some bad or missing values."""
    stamp = "date_format(created_ts, \"yyyy-MM-dd'T'HH:mm:ss\")"
    return s.tables().alerts.selectExpr(
        f"k as {ROW_ID}",
        "case when k % 29 = 0 then alert_id || '-' else alert_id end as `Alert ID`",
        "asset_id as `Hostname`", "rule_id as `Signature`",
        "case when k % 31 = 0 then null else category end as `Alert-Type`",
        "case k % 5 when 0 then 'High' when 1 then ' critical' when 2 then '2.9' when 3 then 'unknown' else"
        " cast(severity as string) end as `Sev`",
        f"case when k % 43 = 0 then '31/04/2024 10:00' when k % 2 = 0 then {stamp}"
        " else date_format(created_ts, 'd/M/yyyy H:mm:ss') end as `Timestamp`",
        "status as `State`", "disposition as `Verdict`", "analyst_id as `Assigned To`", "'x' as `Comment`",
    )


@query
def ingest_map_columns(s: Star) -> DataFrame:
    mapped, _ = map_columns(raw_alerts(s), schemas.ALERT, keep=(ROW_ID,))
    return mapped.select("alert_id", "rule_id", "category", "severity", "created_ts", "status", "disposition",
                         "analyst_id")


@query
def ingest_parse_list(s: Star) -> DataFrame:
    """The alert list of a case in twelve spellings."""
    cells = s.tables().cases.selectExpr(
        "k",
        "case when k % 12 = 7 then '[\"A\\\\\"' || k || '\", \"c\"]' when k % 12 = 8 then '[[''A'', ''' || k || '''], ''c'']'"
        " when k % 12 = 9 then '[\"A' || k || '\", null, true]' when k % 12 = 10 then '(''A' || k || ''', 1.50)'"
        " when k % 12 = 11 then '[A' || k || ', B]' else case k % 12 when 0 then '[''A' || k || ''', ''B,' || k || ''']' when 1 then '[\"A' || k || '\"]'"
        " when 2 then 'A' || k || '; B' || k || ';' when 3 then 'A' || k || '|B' || k"
        " when 4 then 'A' || k || ', B' || k || ' , C' when 5 then ' A' || k || ' ' else '  ' end end as cell",
    )
    return cells.select("k", F.concat_ws("~", to_list("cell")).alias("items"),
                        F.coalesce(F.size(to_list("cell")), F.lit(-1)).alias("n"))


@query
def ingest_severity(s: Star) -> DataFrame:
    cells = s.tables().alerts.selectExpr(
        "k",
        "case k % 11 when 0 then 'High' when 1 then ' CRITICAL ' when 2 then 'info' when 3 then '3' when 4 then '2.9'"
        " when 5 then '-1.5' when 6 then 'inf' when 7 then 'nan' when 8 then 'urgent' when 9 then '99'"
        " else cast(severity as string) end as cell",
    )
    return cells.select("k", to_severity("cell").alias("severity"))


@query
def ingest_timestamp(s: Star) -> DataFrame:
    cells = s.tables().alerts.selectExpr(
        "k",
        "case k % 8 when 0 then date_format(created_ts, \"yyyy-MM-dd'T'HH:mm:ss\")"
        " when 1 then date_format(created_ts, \"yyyy-MM-dd HH:mm:ss\") || '+02:00'"
        " when 2 then date_format(created_ts, 'dd/MM/yyyy HH:mm') when 3 then date_format(created_ts, 'd-M-yyyy H:mm:ss')"
        " when 4 then date_format(created_ts, 'yyyy-MM-dd') when 5 then date_format(created_ts, 'd MMM yyyy H:mm')"
        " when 6 then '31/04/2026' else 'soon' end as cell",
    )
    return cells.select("k", to_timestamp("cell").alias("ts"))


@query
def ingest_coerce(s: Star) -> DataFrame:
    mapped, _ = map_columns(raw_alerts(s), schemas.ALERT, keep=(ROW_ID,))
    return coerce_table(mapped, schemas.ALERT, keep=(ROW_ID,)).withColumnRenamed(ROW_ID, "k").select(
        "k", "alert_id", "category", "severity", "created_ts", "status")


@query
def ingest_dedup(s: Star) -> DataFrame:
    """First alert of each asset, alerts without one counting as one."""
    rows = s.tables().alerts.selectExpr(
        f"k as {ROW_ID}", "case when k % 3 = 0 then null else asset_id end as asset_id", "alert_id")
    return drop_duplicates_keep_first(rows, "asset_id").select("asset_id", "alert_id")


def prepared_alerts(s: Star):
    return prepare(raw_alerts(s), "alerts", schemas.ALERT, "ENT-SUB", "alert_id")


@query
def ingest_rejects(s: Star) -> DataFrame:
    return prepared_alerts(s).all_rejects.drop("file")


@query
def ingest_accepted(s: Star) -> DataFrame:
    return prepared_alerts(s).ok.select(
        "alert_id", "entity_id", "category", "severity", "created_ts", "status", "disposition", "analyst_id", "shift")


@query
def dq_completeness(s: Star) -> DataFrame:
    return prepared_alerts(s).completeness()


@query
def dq_quality_score(s: Star) -> DataFrame:
    return prepared_alerts(s).report()


@query
def dq_integrity(s: Star) -> DataFrame:
    return quality.integrity(s.tables())


@query
def dq_missing_analyst(s: Star) -> DataFrame:
    alerts = s.tables().alerts.withColumn("analyst_id", F.when(F.col("k") % 13 != 0, F.col("analyst_id")))
    return quality.missing_analyst(alerts).withColumn("missing_percent", r6("missing_percent"))


@query
def dq_orphan_alerts(s: Star) -> DataFrame:
    """Alerts on assets nobody knows: some alerts name an id that was never registered."""
    t = s.tables()
    asset = F.when(F.col("k") % 17 == 0, F.concat(F.lit("AST-X"), "k")).when(F.col("k") % 19 != 0, F.col("asset_id"))
    return quality.orphan_alerts(replace(t, alerts=t.alerts.withColumn("asset_id", asset)))


@query
def ingest_numbers(s: Star) -> DataFrame:
    """Reported figures of a period as text cells; those that are no number become null."""
    cells = s.tables().alerts.selectExpr(
        "k", "entity_id", "'2024-01' as period",
        "case k % 6 when 0 then cast(k as string) || '.25' when 1 then ' -7 ' when 2 then '1e3' when 3 then 'n.b.' when 4 then '' end as reported_mttr_mins",
        "case when k % 4 = 0 then 'ninety' else cast(k % 100 as string) end as reported_sla_percent")
    return coerce_table(cells, schemas.KPI_REPORT, keep=("k",)).select("k", "reported_mttr_mins", "reported_sla_percent")


@query
def finding_rationales(s: Star) -> DataFrame:
    """Why a finding was raised, of detectors whose text has no rounded number."""
    found = [DETECTORS[d](s.tables()) for d in ("NS-01", "NS-02", "NS-03", "NS-05")]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.select(*KEY[:3], "rationale")


@query
def missing_tables(s: Star) -> DataFrame:
    """Alerts alone are there: detectors that need other tables give nothing, the others what they give with all."""
    base = scratch_path(s.spark, "alone")
    s.tables().alerts.write.parquet(f"{base}/real/alerts.parquet")
    return all_findings(load_tables(s.spark, base)).select(*KEY)


@query
def upsert_entity(s: Star) -> DataFrame:
    """A store after one entity was submitted again with all its alerts re-opened."""
    path = scratch_path(s.spark, "store")
    store.commit(s.spark, path, {"alerts": s.tables().alerts})
    again = s.tables().alerts.filter("entity_id = 'ENT-08'").withColumn("status", F.lit("Reopened"))
    bundle.upsert_entity(again, path, "alerts", "ENT-08")
    return store.snapshot(s.spark, path, "alerts").select("alert_id", "entity_id", "status")


@query
def append_validated(s: Star) -> DataFrame:
    path = scratch_path(s.spark, "append")
    for half in ("nk < 12", "nk >= 12"):
        bundle.append_validated(s.tables().alerts.filter(half), path, schemas.ALERT)
    return s.spark.read.parquet(path).select("alert_id", "entity_id", "severity", "closed_ts")


def sent_as_json(s: Star) -> str:
    """Every row of five tables in JSON documents; documents of alerts name their entity again."""
    names, path = ("entities", "assets", "alerts", "cases", "events"), scratch_path(s.spark, "json")
    rows = {n: conform(getattr(s.tables(), n), schemas.TABLES[n]) for n in names}
    rows["assets"] = rows["assets"].withColumn("environment_zone", F.lit("OT"))  # required, and not in the derived table
    one = {n: F.struct(*(F.col(c).alias(schemas.FILE_ALIASES.get(c, c)) for c in schemas.TABLES[n].fieldNames())) for n in names}
    named = rows["entities"].select("entity_id", F.array(one["entities"]).alias("entities"))
    docs = rows["alerts"].select("entity_id", F.array(one["alerts"]).alias("alerts")).join(named, "entity_id").drop("entity_id")
    for n in names:
        if n != "alerts":
            docs = docs.unionByName(rows[n].select(F.array(one[n]).alias(n)), allowMissingColumns=True)
    docs.write.json(path)
    return path


@query
def json_bundle(s: Star) -> DataFrame:
    """Five tables sent as JSON documents; the entities are sent twice. Rows per table and entity, as the assessment reads them."""
    base = scratch_path(s.spark, "json-store")
    again = scratch_path(s.spark, "json")
    s.tables().entities.select(F.array(F.struct(*schemas.ENTITY.fieldNames())).alias("entities")).write.json(again)
    for path in (sent_as_json(s), again):
        bundle.ingest_json(s.spark, path, f"{base}/real", lines=True)
    t = load_tables(s.spark, base)
    checks = {"entities": "sector", "assets": "monitored_flag", "alerts": "closed_ts", "cases": "size(alert_ids)", "events": "ts"}
    parts = [getattr(t, n).groupBy(F.lit(n).alias("table"), "entity_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.expr(c)).alias("filled")) for n, c in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sent_as_csv(s: Star, where: str = "true") -> list[str]:
    """Alerts, cases and events of the orders in ``where`` as CSV files of three delimiters."""
    base, t = scratch_path(s.spark, "csv"), s.tables()
    cases = t.cases.filter(where)
    t.alerts.filter(where).drop("k", "nk", "entity_id").write.option("header", True).option("sep", ";").csv(f"{base}/alerts")
    cases.drop("k", "rule_id").withColumn("alert_ids", F.concat_ws("|", "alert_ids")).write.option("header", True).csv(f"{base}/cases")
    t.events.join(cases.select("case_id"), "case_id", "left_semi").write.option("header", True).option("sep", "\t").csv(f"{base}/events")
    return [f"{base}/{n}" for n in ("alerts", "cases", "events")]


@query
def csv_bundle(s: Star) -> DataFrame:
    """Alerts, cases and events sent as CSV: one report row per file."""
    prepared = bundle.prepare_csv_bundle(s.spark, "ENT-SUB", *sent_as_csv(s))
    out = [p.report() for p in prepared.values()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query
def csv_scan(s: Star) -> DataFrame:
    """Quoted cells over several lines, quotes in cells and accents, in files of two encodings."""
    base = scratch_path(s.spark, "csv-scan")
    rows = s.tables().alerts.selectExpr(
        "alert_id as `Alert ID`", "k as `Number`",
        "case k % 5 when 0 then 'first ' || k || chr(10) || 'second; \"' || category || '\"' when 1 then 'caf' || chr(233) || '; ' || k"
        " when 2 then '5\" pipe' when 3 then 'N/A' else category end as `Note`", "status as `State`")
    for name, encoding, where in (("a", "UTF-8", "Number % 2 = 0"), ("b", "ISO-8859-1", "Number % 2 = 1")):
        rows.filter(where).write.option("header", True).option("sep", ";").option("escape", '"').option("encoding", encoding).csv(f"{base}/{name}")
    return read_csv_robust(s.spark, f"{base}/*").select("Alert ID", "Number", "Note", "State")


@query
def csv_rejects(s: Star) -> DataFrame:
    """Rejected rows of a submission of two files, with their place in each; the second file repeats ids of the first."""
    base = scratch_path(s.spark, "csv-rejects")
    rows = s.tables().alerts.selectExpr(
        "k", "case when k % 7 = 3 then 'ALT-' || cast(k - 1 as string) else alert_id end as alert_id", "category",
        "case when k % 5 = 2 then 'so so' else cast(severity as string) end as severity",
        "date_format(created_ts, \"yyyy-MM-dd'T'HH:mm:ss\") as created_ts", "status")
    for name, where in (("a", "k % 3 = 0"), ("b", "k % 3 <> 0")):
        rows.filter(where).repartition(1).sortWithinPartitions("k").drop("k").write.option("header", True).csv(f"{base}/{name}")
    prepared = prepare(read_csv_robust(s.spark, f"{base}/*"), "alerts", schemas.ALERT, "ENT-SUB", "alert_id")
    return prepared.all_rejects


PROFILE = {"sector": "Power", "size_tier": "Tier 1", "region": "Region-1", "soc_model": "MSSP"}


@query
def csv_bundle_store(s: Star) -> DataFrame:
    """Rows in the store after two entities submitted CSV bundles, one of them twice: the second time replaces the first.

    All accepted rows are read back the way an assessment reads them.
    """
    base = scratch_path(s.spark, "csv-store")
    every = sent_as_csv(s)
    for entity, files in (("007", sent_as_csv(s, "k % 3 = 0")), ("ENT-9", every), ("007", every)):
        bundle.ingest_csv_bundle(s.spark, entity, *files, output_dir=f"{base}/real", profile=PROFILE)
    t = load_tables(s.spark, base)
    ids = {"entities": "sector", "alerts": "alert_id", "cases": "concat_ws('|', case_id, array_join(alert_ids, '|'))",
           "events": "concat_ws('|', case_id, cast(unix_micros(cast(ts as timestamp)) as string), event_type)"}
    parts = [getattr(t, n).selectExpr(f"'{n}' as table", "entity_id", f"{e} as item") for n, e in ids.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def csv_to_findings(s: Star) -> DataFrame:
    """From submitted CSV files to findings: bundle, store, load, assessment."""
    base = scratch_path(s.spark, "csv-findings")
    bundle.ingest_csv_bundle(s.spark, "007", *sent_as_csv(s), output_dir=f"{base}/real", profile=PROFILE)
    return assess(load_tables(s.spark, base)).select(*KEY)


@query
def export_manifest(s: Star) -> DataFrame:
    """Every exported file with its size and hash."""
    path = scratch_path(s.spark, "export")
    export.export_tables(s.tables(), path)
    export.export_truth(s.truth().withColumn("description", F.lit("planted")), path)
    return export.file_manifest(s.spark, path, "part-*")


@query
def export_row_counts(s: Star) -> DataFrame:
    """Rows per exported table, counted from the files."""
    path = scratch_path(s.spark, "export")
    export.export_tables(s.tables(), path)
    table = F.regexp_extract("file", r"/([a-z]+)\.parquet/", 1)
    counts = [export.manifest_row_counts(s.spark.read.parquet(f"{path}/{n}.parquet")) for n in schemas.TABLES]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out.groupBy(table.alias("table")).agg(F.sum("rows").alias("rows"))


@query
def export_review_queue(s: Star) -> DataFrame:
    f, path = findings(s), scratch_path(s.spark, "queue")
    export.export_review_queue(sampling.review_sample(f, ranking(f), 10), path)
    return s.spark.read.option("header", True).csv(path)


_RENAMED = {"all_findings_union": "all_findings", "duration": "duration_seconds"}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Callable[[Star], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare_session(spark)
            return fn(star(spark, sf_dir))

        return run

    return {_RENAMED.get(name, name): bind(fn) for name, fn in _QUERIES.items()}

"""One key holds more than a third of all rows."""

import pytest
from frames import entity, rows, tables
from pyspark.sql import functions as F

from watchloom.operators import execution_gaps as eg, exploratory as ex
from watchloom.sources.tables import SocTables

N = 240_000


@pytest.fixture
def small_partitions(spark):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    }
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def skewed(spark):
    ids = spark.range(0, N, 1, 16)
    hot = F.col("id") % 5 < 2
    alerts = ids.select(
        F.concat(F.lit("A"), "id").alias("alert_id"),
        F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("E"), F.col("id") % 2000)).alias("entity_id"),
        F.lit("Malware").alias("category"), F.lit(3).alias("severity"),
        F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, cast(pow(id % 1000, 2) / 10 as decimal(18, 6)))").alias("created_ts"),
    )
    cases = ids.select(
        F.concat(F.lit("C"), F.col("id") % 4000).alias("case_id"), F.lit("E1").alias("entity_id"),
        F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("W"), F.col("id") % 300)).alias("owner"),
        F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, cast((id * 37) % 900000 as decimal(18, 6)))").alias("closed_ts"),
    )
    return alerts, cases


def test_drift_spreads_the_hot_entity_over_its_hours(spark, small_partitions):
    alerts, _ = skewed(spark)
    out = ex.half_counts(alerts)
    got = {r["entity_id"]: (r["alerts"], r["h1"], r["h2"]) for r in out.collect()}
    times = [r["created_ts"] for r in alerts.filter("entity_id = 'HOT'").select("created_ts").collect()]
    mid = min(times) + (max(times) - min(times)) / 2
    assert got["HOT"] == (len(times), sum(t <= mid for t in times), sum(t > mid for t in times))
    assert sum(v[0] for v in got.values()) == sum(v[1] + v[2] for v in got.values()) == N
    raw_shuffles = [line for line in final_plan(out).splitlines() if "Exchange hashpartitioning(entity_id" in line]
    assert any("hour" in line for line in raw_shuffles)


def test_quantile_join_is_salted(spark, small_partitions):
    from watchloom.functions.quantiles import exact_quantile

    df = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 5 < 2, "HOT").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        ((F.col("id") * 7919) % 10_007).cast("double").alias("v"))
    out = exact_quantile(df, ["g"], "v", 0.5, "m")
    got = {r["g"]: r["m"] for r in out.collect()}
    want = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.percentile("v", F.lit(0.5)).alias("m")).collect()}
    assert got == want
    assert "SortMergeJoin [_k0" in final_plan(out) and "_salt" in final_plan(out)


def test_bulk_closures_of_a_hot_owner(spark):
    _, cases = skewed(spark)
    got = {r["owner"]: r["peak"] for r in eg.closure_peaks(cases, 60).collect()}
    times = sorted(r["closed_ts"] for r in cases.filter("owner = 'HOT'").select("closed_ts").collect())
    start, best = 0, 0
    for i, t in enumerate(times):
        while (t - times[start]).total_seconds() > 60:
            start += 1
        best = max(best, i - start + 1)
    assert got["HOT"] == best > 1
    assert len(got) == cases.select("owner").distinct().count()


def test_hot_case_path_is_numbered_over_many_tasks(spark):
    events = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("C"), F.col("id") % 5000)).alias("case_id"),
        F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, cast((id * 7919) % 86400 as int))").alias("ts"),
        F.concat(F.lit("t"), F.col("id") % 7).alias("event_type"),
    )
    paths = ex.case_event_paths(events)
    hot = [r["event_type"] for r in paths.filter("case_id = 'HOT'").orderBy("position").collect()]
    want = events.filter("case_id = 'HOT'").orderBy("ts", "event_type").toPandas()["event_type"].tolist()
    assert hot == want and paths.count() == 60_000


def test_scripted_analyst_is_found_next_to_a_hot_case(spark):
    big = spark.range(0, 50_000, 1, 8).select(
        F.lit("C0").alias("case_id"), F.lit("E1").alias("entity_id"),
        F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, cast(id as int))").alias("ts"),
        F.lit("note").alias("event_type"), F.lit("x").alias("actor"))
    from frames import at, case

    scripted = [{"case_id": f"C{c}", "entity_id": "E1", "ts": at(s), "event_type": k, "actor": "y"}
                for c in range(1, 7) for s, k in ((1, "enrich"), (2, "status"))]
    owners = [case(0, owner="BUSY")] + [case(i, owner="W") for i in range(1, 7)]
    base = tables(spark, cases=owners, entities=[entity("E1")])
    t = SocTables(**{**base.__dict__, "events": big.unionByName(rows(spark, "events", scripted))})
    assert [r["target_id"] for r in ex.ex_02(t).collect()] == ["W"]

import collections
import math
import random
from statistics import median, stdev

import pytest
from frames import alert, at, entity, tables
from pyspark.sql import functions as F

from watchloom.config import CAPABILITY_WEIGHTS
from watchloom.functions.ordering import first_by_uniform, first_within, position_within
from watchloom.functions.quantiles import exact_quantile
from watchloom.operators import evaluation, peers, reports, sampling, scoring

FINDING = "detector_id string, entity_id string, target_id string, severity int, effect_size double, confidence double"


def findings(spark, rows):
    return spark.createDataFrame([(*r, None, None)[:6] if len(r) == 4 else r for r in rows], FINDING)


def test_scores_and_ranking(spark):
    f = findings(spark, [
        ("EG-01", "E1", "a", 5, 1.0, 1.0),      # 1.0, clamped to 0.99
        ("NS-01", "E1", "b", 4, 0.8, 0.9),      # 0.576
        ("EG-01", "E2", "c", 3, 0.5, 0.8),      # 0.24
        ("XX-99", "E2", "d", None, None, None),  # unmapped, default severity: 0.432
        ("NS-06", "GLOBAL", "e", 5, None, None),
    ])
    scores = {(r["entity_id"], r["capability"]): r["score"] for r in scoring.capability_scores(f).collect()}
    assert len(scores) == 3 * 8
    assert scores["E1", "Investigation"] == pytest.approx(0.99)
    assert scores["E1", "Threat Detection"] == pytest.approx(0.576)
    assert scores["E1", "Security Operations"] == pytest.approx(0.576)
    assert scores["E1", "Cyber Resilience"] == 0.0
    assert scores["E2", "Security Operations"] == pytest.approx(0.432)
    ranked = scoring.sort_ranking(scoring.entity_ranking(f)).collect()
    assert [r["entity_id"] for r in ranked] == ["E1", "E2", "GLOBAL"]
    want = (0.99 * 1.2 + 0.99 * 1.0 + 0.576 * 1.5 + 0.576 * 1.0) / 9.2
    assert ranked[0]["attention_index"] == round(want, 4)
    assert ranked[0]["capability_scores"]["Operational Discipline"] == pytest.approx(0.99)
    assert scoring.entity_ranking(f, drop_global=True).count() == 2
    assert [r["rank"] for r in scoring.top_entities(scoring.entity_ranking(f), 2).collect()] == [1, 2]
    assert sum(CAPABILITY_WEIGHTS.values()) == pytest.approx(9.2)


def test_many_findings_do_not_overflow(spark):
    f = spark.range(20000).select(
        F.lit("NS-03").alias("detector_id"), F.lit("E1").alias("entity_id"), F.col("id").cast("string").alias("target_id"),
        F.lit(4).alias("severity"), F.lit(None).cast("double").alias("effect_size"),
        F.lit(None).cast("double").alias("confidence"))
    assert scoring.capability_columns(f).first()["Security Operations"] == 1.0


@pytest.mark.parametrize("n,q", [(1, 0.5), (2, 0.5), (14, 0.9), (27, 0.8), (101, 0.33), (9000, 0.5), (9001, 0.87)])
def test_exact_quantile_matches_sorting(spark, n, q):
    rng = random.Random(n)
    values = [rng.choice([rng.random(), 5.0, float(rng.randrange(4))]) for _ in range(n)]
    df = spark.createDataFrame([("g", v) for v in values] + [("h", 1.0), ("h", 2.0), ("n", None)], "k string, v double")
    s = sorted(values)
    pos = q * (n - 1)
    lo, hi = s[math.floor(pos)], s[math.ceil(pos)]
    got = {r["k"]: r["x"] for r in exact_quantile(df, ["k"], "v", q, "x").collect()}
    assert got["g"] == pytest.approx(lo + (hi - lo) * (pos - math.floor(pos)), rel=1e-12)
    assert got["h"] == pytest.approx(1.0 + q)
    assert "n" not in got
    alone = exact_quantile(df.filter("k = 'g'"), [], "v", q, "x").first()["x"]
    assert alone == got["g"]


@pytest.mark.parametrize("spread", ["even", "wide", "packed"])
def test_exact_quantile_of_a_million_values(spark, monkeypatch, spread):
    """One group of 10**6 distinct values, found by rounds of histograms; the other group is small."""
    from watchloom.functions import quantiles

    monkeypatch.setattr(quantiles, "LEAF", 500)
    v = {"even": "id * 0.5", "wide": "if(id % 2 = 0, -1, 1) * pow(2.0D, id % 2000 - 1000) * (1 + id / 1e7)",
         "packed": "if(id = 0, 1e300D, 1 + id * 1e-9)"}[spread]
    df = spark.range(10**6).selectExpr("'big' as k", f"cast({v} as double) as v")
    ends = spark.sql("select 'end' k, explode(array(double('-inf'), double('inf'), 1.0D)) v")
    q = 0.623
    got = {r["k"]: r["x"] for r in exact_quantile(df.union(ends), ["k"], "v", q, "x").collect()}
    assert got["big"] == pytest.approx(df.agg(F.percentile("v", F.lit(q)).alias("x")).first()["x"], rel=1e-12)
    assert got["end"] == float("inf") and exact_quantile(ends, ["k"], "v", 0.5, "x").first()["x"] == 1.0


def test_quantile_of_nothing(spark):
    assert exact_quantile(spark.createDataFrame([], "v double"), [], "v", 0.5, "x").count() == 0


def test_position_within_equals_sorting(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), rng.randrange(5000), i) for i in range(800)]
    df = spark.createDataFrame(rows, "k string, t int, i int")
    got = {(r["k"], r["position"]): r["i"]
           for r in position_within(df, ["k"], F.floor(F.col("t") / 100).cast("long"), [F.col("t"), F.col("i")]).collect()}
    for k in "abc":
        want = [i for _, i in sorted((t, i) for kk, t, i in rows if kk == k)]
        assert [got[k, p + 1] for p in range(len(want))] == want
    assert len(got) == 800


def _peer_tables(spark, volumes, sectors=None):
    ents = [entity(f"E{i}", sector=(sectors or {}).get(i, "Power")) for i in range(len(volumes))]
    alerts = [alert(f"{e}-{i}", entity=f"E{e}", closed_ts=at(10 if i == 0 else 999)) for e, n in enumerate(volumes) for i in range(n)]
    return tables(spark, entities=ents, alerts=alerts)


def test_peer_z_mad_std_and_zero(spark):
    vols = [10, 12, 14, 30]
    b = {r["entity_id"]: r for r in peers.peer_benchmarks(peers.peer_features(_peer_tables(spark, vols))).collect()}
    med = median(vols)
    mad = median(abs(v - med) for v in vols)
    for i, v in enumerate(vols):
        assert b[f"E{i}"]["alert_volume_z"] == pytest.approx((v - med) / (1.4826 * mad) * 4 / 7)
        assert b[f"E{i}"]["fast_closure_z"] == 0.0          # all 1: deviation 0
    vols = [5, 5, 5, 9]                                      # MAD 0, deviation not
    b = {r["entity_id"]: r for r in peers.peer_benchmarks(peers.peer_features(_peer_tables(spark, vols))).collect()}
    assert b["E3"]["alert_volume_z"] == pytest.approx((9 - 6) / stdev(vols) * 4 / 7)
    lone = peers.peer_benchmarks(peers.peer_features(_peer_tables(spark, [5, 0], {1: None}))).collect()
    assert {(r["entity_id"], r["alert_volume"], r["alert_volume_z"], r["peer_group"]) for r in lone} == {
        ("E0", 5, 0.0, "Power - Tier 1"), ("E1", 0, 0.0, None)}


def test_peer_outliers(spark):
    b = peers.peer_benchmarks(peers.peer_features(_peer_tables(spark, [10, 11, 12, 13, 200])))
    assert [r["entity_id"] for r in peers.peer_outliers(b).collect()] == ["E4"]


def _sample_inputs(spark):
    rows = [(d, e, f"{e}-{i}", i % 5 + 1) for e in ("E1", "E2", "E3") for i in range(8) for d in ("EG-01", "NS-03")]
    rows += [("NS-02", e, "Phishing", 5) for e in ("E1", "E2", "E3")] + [("NS-01", "E1", "quiet", None)]
    f = findings(spark, rows)
    ranking = spark.createDataFrame([("E1", 0.9), ("E2", 0.3), ("E3", 0.0)], "entity_id string, attention_index double")
    return f, ranking, rows


def _simulate(rows, drawn):
    """The sequential rule: worst finding whose target is not in the sample yet."""
    taken, out = set(), []
    for e in drawn:
        options = sorted((r for r in rows if r[1] == e and r[2] not in taken),
                         key=lambda r: (-(r[3] if r[3] is not None else -1), r[0], r[2]))
        if options:
            out.append(options[0])
            taken.add(options[0][2])
    return out


@pytest.mark.parametrize("n", [0, 1, 10, 1500, 6000])
def test_first_by_uniform_takes_the_smallest_numbers(spark, n):
    rng = random.Random(n)
    rows = [(g, rng.choice([rng.random(), 0.25, 0.0]), f"t{i}") for g, size in ((0, 5000), (1, 300), (2, 1)) for i in range(size)]
    first = first_by_uniform(spark.createDataFrame(rows, "g int, u double, t string"), ["g"], "u", ["t"], n, "place")
    got = {(r["g"], r["place"]): (r["u"], r["t"]) for r in first.collect()}
    want = {(g, i): r for g in range(3) for i, r in enumerate(sorted((u, t) for h, u, t in rows if h == g)[:n], 1)}
    assert got == want


@pytest.mark.parametrize("n", [1, 40, 1500])
def test_first_within_a_hot_group(spark, n):
    rows = [(0, i * 7919 % 4001) for i in range(4001)] + [(1, 5), (1, 5)]
    df = spark.createDataFrame(rows, "g int, v int")
    got = sorted((r["g"], r["place"], r["v"]) for r in first_within(df, ["g"], F.col("v") % 16, [F.col("v")], n, "place").collect())
    assert got == [(0, i + 1, i) for i in range(min(n, 4001))] + [(1, i + 1, 5) for i in range(min(n, 2))]


@pytest.mark.parametrize("budget", [10, 1500, 6000])
def test_no_budget_numbers_a_whole_replicate_in_one_task(spark, budget):
    f, ranking, _ = _sample_inputs(spark)
    truth = f.select("target_id")
    for df in (sampling.review_sample(f, ranking, budget), sampling.lift_over_random(f, ranking, truth, budget, 3)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        numbered = [line for line in plan.splitlines() if "row_number() windowspecdefinition" in line]
        assert numbered and not [line for line in numbered if "windowspecdefinition(replicate" in line and "_slice" not in line]


def test_replicates_of_the_pool_are_not_sent_to_the_driver(spark):
    """Exploded rows look small to the planner; what is broadcast is slices, the rows stay where they are."""
    rows = spark.range(3000).select(F.explode(F.sequence(F.lit(0), F.lit(49))).alias("g"), F.col("id").cast("string").alias("t"), F.rand(7).alias("u"))
    first = first_by_uniform(rows, ["g"], "u", ["t"], 10, "place")
    got = collections.Counter(r["g"] for r in first.collect())
    assert got == dict.fromkeys(range(50), 10)
    plan = first._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("BroadcastHashJoin" in line and "BuildRight" in line for line in joins)


@pytest.mark.parametrize("k", [1, 2, 5, 20, 80])
def test_review_sample_follows_the_sequential_rule(spark, k):
    f, ranking, rows = _sample_inputs(spark)
    sample = [r.asDict() for r in sampling.review_sample(f, ranking, k).collect()]
    n_explore = max(1, int(k * 0.2))
    targeted = sorted((r for r in sample if r["selection_reason"] == sampling.TARGETED), key=lambda r: r["draw"])
    explored = [r for r in sample if r["selection_reason"] == sampling.EXPLORATION]
    drawn = []
    if k > n_explore:
        drawn = [r["entity_id"] for r in sampling.weighted_draws(ranking, k - n_explore).orderBy("draw").collect()]
        assert len(drawn) == k - n_explore and "E3" not in drawn
    want = _simulate(rows, drawn)
    assert [(r["detector_id"], r["entity_id"], r["target_id"], r["severity"]) for r in targeted] == want
    assert len({r["target_id"] for r in targeted}) == len(targeted)
    assert not {r["target_id"] for r in explored} & {r["target_id"] for r in targeted}
    left = [r for r in rows if r[2] not in {t["target_id"] for t in targeted}]
    assert len(explored) == min(n_explore, len(left)) and len(sample) <= k


def test_weighted_draws_follow_the_weights(spark):
    _, ranking, _ = _sample_inputs(spark)
    counts = {r["entity_id"]: r["count"] for r in sampling.weighted_draws(ranking, 2000).groupBy("entity_id").count().collect()}
    assert set(counts) == {"E1", "E2"} and sum(counts.values()) == 2000
    assert 0.70 < counts["E1"] / 2000 < 0.80


def test_no_weight_gives_exploration_only(spark):
    f, ranking, _ = _sample_inputs(spark)
    sample = sampling.review_sample(f, ranking.withColumn("attention_index", F.lit(0.0)), 10)
    assert {r["selection_reason"] for r in sample.collect()} == {sampling.EXPLORATION}


def test_lift(spark):
    f, ranking, _ = _sample_inputs(spark)
    truth = spark.createDataFrame([("Phishing",), ("E1-4",)], "target_id string")
    row = sampling.lift_over_random(f, ranking, truth, 5, 10).first()
    assert row["optimized_yield"] > row["random_yield"] > 0
    none = sampling.lift_over_random(f, ranking, truth.limit(0), 5, 10).first()
    assert tuple(none) == (0.0, 0.0, 1.0)
    empty = sampling.lift_over_random(f.limit(0), ranking, truth, 5, 10).first()
    assert tuple(empty) == (0.0, 0.0, 1.0)
    # a budget above the number of findings is cut to it: every finding is seen
    all_seen = sampling.lift_over_random(f.limit(3), ranking, f.limit(3).select("target_id"), 50, 4).first()
    assert all_seen["random_yield"] == f.limit(3).select("target_id").distinct().count()


def test_recall(spark):
    f = findings(spark, [("EG-01", "E1", "a", 4), ("EG-01", "E1", "a", 4), ("EG-01", "E2", "z", 4)])
    truth = spark.createDataFrame([("EG-01", "a"), ("EG-01", "a"), ("EG-01", "b"), ("NS-03", "q")], "finding_id string, target_id string")
    got = {r["detector_id"]: r["recall"] for r in evaluation.recall_by_detector(f, truth).collect()}
    assert len(got) == 20 and got["EG-01"] == 0.5 and got["NS-03"] == 0.0 and got["EX-08"] == 1.0


def test_reports(spark):
    f, ranking, rows = _sample_inputs(spark)
    status = {r["entity_id"]: r["status"] for r in reports.portfolio_status(ranking).collect()}
    assert status == {"E1": "Critical", "E2": "Warning", "E3": "Good"}
    assert [(r["entity_id"], r["risk_level"]) for r in reports.risk_levels(ranking).collect()] == [
        ("E1", "Critical"), ("E2", "Warning"), ("E3", "Good")]
    top = reports.top_findings(f, 3).collect()
    assert [r["severity"] for r in top] == [5, 5, 5] and top[0]["detector_id"] == "EG-01"
    first, total = reports.explore_findings(f, 5, detector_id="NS-03", entity_id="E2")
    assert first.count() == 5 and total.first()["findings"] == 8
    assert {r["entity_id"]: r["findings"] for r in reports.findings_by(f, "entity_id").collect()}["E1"] == 18
    kpi = reports.kpi_summary(tables(spark, entities=[entity("E1")]).entities, f, ranking).first()
    assert (kpi["entities"], kpi["findings"], kpi["ranked"]) == (1, len(rows), 3)
    assert kpi["avg_attention_index"] == pytest.approx(0.4)

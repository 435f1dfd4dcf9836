"""Review samples: weighted draws of entities, their worst findings, and exploration.

All random choices are hashes of (seed, replicate, ...), so a sample is the same on
any cluster, and several replicates are drawn in one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from watchloom.config import DEFAULTS, Settings
from watchloom.functions.hashing import hash_bucket, uniform
from watchloom.functions.ordering import first_by_uniform, first_within
from watchloom.functions.scalars import one_row
from watchloom.session import materialise

# Labels of the two parts of a sample.
TARGETED = "Targeted (High Attention Index & Severity)"
EXPLORATION = "Exploration (Random Baseline)"

_FINDING = ["detector_id", "entity_id", "target_id"]
_UNITS = 10_000  # the attention index has four decimals: whole units sum exactly
_PICK = "array<struct<draw:int,detector_id:string,entity_id:string,target_id:string,severity:int>>"


def weight_intervals(ranking: DataFrame) -> DataFrame:
    """(entity_id, bucket, lo, hi): disjoint intervals as long as each entity's weight.

    Running sums are taken inside hash buckets and shifted by the bucket totals, of
    which there are at most 4096, so no task sees the whole ranking.
    """
    weighted = ranking.select(
        "entity_id", F.round(F.col("attention_index") * _UNITS).cast("long").alias("w"),
        hash_bucket("entity_id").alias("bucket"),
    )
    before = Window.partitionBy(F.lit(0)).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        weighted.groupBy("bucket").agg(F.sum("w").alias("total"))
        .withColumn("start", F.coalesce(F.sum("total").over(before), F.lit(0)))
        .select("bucket", "start")
    )
    upto = Window.partitionBy("bucket").orderBy("entity_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        weighted.join(starts, "bucket").withColumn("hi", F.col("start") + F.sum("w").over(upto))
        .select("entity_id", "bucket", (F.col("hi") - F.col("w")).alias("lo"), "hi")
    )


def weighted_draws(ranking: DataFrame, n, seed: int = 42, replicates: int = 1, max_n: int | None = None) -> DataFrame:
    """(replicate, draw, entity_id): ``n`` draws with replacement, by attention index.

    ``n`` is a number or a scalar column; ``max_n`` bounds it in the latter case. A
    draw finds its bucket in the short list of bucket ranges and then meets only
    the entities of that bucket.
    """
    limit = n if isinstance(n, Column) else F.lit(n)
    most = max_n if max_n is not None else n
    intervals = materialise(weight_intervals(ranking), "intervals")  # read twice below; a ranking is a long plan
    ranges = intervals.groupBy("bucket").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    spans = one_row(ranges.agg(
        F.max("hi").alias("total"), F.collect_list(F.struct("bucket", "lo", "hi")).alias("spans")
    ))
    draws = (
        ranking.sparkSession.range(replicates).select(F.col("id").cast("int").alias("replicate"))
        .select("replicate", F.explode(F.sequence(F.lit(0), F.lit(max(most - 1, 0)))).alias("draw"))
        .filter(F.col("draw") < limit)
        .withColumns({"x": F.floor(
            uniform(seed, F.lit("draw"), F.col("replicate"), F.col("draw")) * spans["total"]).cast("long"),
            "spans": spans["spans"]})
        .withColumn("bucket", F.get(F.filter(
            "spans", lambda s: (s["lo"] <= F.col("x")) & (F.col("x") < s["hi"])), F.lit(0))["bucket"])
    )
    return (
        draws.join(intervals, "bucket")
        .filter((F.col("lo") <= F.col("x")) & (F.col("x") < F.col("hi")))
        .select("replicate", "draw", "entity_id")
    )


def uniform_sample(df: DataFrame, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement: the smallest hashes (a distributed top-n)."""
    u = uniform(seed, F.lit("uniform"), *[F.col(k) for k in keys])
    return df.withColumn("_u", u).orderBy("_u", *keys).limit(n).drop("_u")


def _split_budget(budget: Column, cfg: Settings) -> tuple[Column, Column]:
    explore = F.greatest(F.lit(1), F.floor(budget * F.lit(cfg.explore_share)).cast("int"))
    return explore, F.greatest(F.lit(0), budget - explore)


def review_samples(
    findings: DataFrame, ranking: DataFrame, budget_k: int = 10, seed: int = 42,
    replicates: int = 1, cfg: Settings = DEFAULTS, budget: Column | None = None,
) -> DataFrame:
    """(replicate, draw, finding columns, selection_reason) for each replicate.

    Targeted part: each drawn entity, in draw order, gives its most severe finding
    whose target is not in the sample yet. At most n targets can be taken before a
    draw, so the n best distinct targets of an entity always hold the answer; the
    draw-by-draw choice then runs over lists bounded by the budget alone.
    Exploration: random findings among the targets not sampled.
    """
    budget = budget if budget is not None else F.lit(budget_k)
    n_explore, n_targeted = _split_budget(budget, cfg)
    most_targeted = max(0, budget_k - max(1, int(budget_k * cfg.explore_share)))
    most_explore = max(1, int(budget_k * cfg.explore_share))
    rows = findings.select("detector_id", "entity_id", "target_id", "severity")
    if most_targeted == 0:
        taken = None
    else:
        draws = materialise(weighted_draws(ranking, n_targeted, seed, replicates, max_n=most_targeted), "draws")
        worst = [F.col("severity").desc_nulls_last(), F.col("detector_id"), F.col("target_id")]
        per_target = Window.partitionBy("entity_id", "target_id").orderBy(*worst)
        drawn = (
            rows.join(F.broadcast(draws.select("entity_id").distinct()), "entity_id", "left_semi")  # <= draws rows
            .withColumn("r", F.row_number().over(per_target)).filter(F.col("r") == 1)
        )
        best = (
            first_within(drawn, ["entity_id"], hash_bucket("target_id", 2), worst, most_targeted, "place")
            .groupBy("entity_id").agg(F.array_sort(F.collect_list(F.struct(
                "place", "detector_id", "target_id", "severity"))).alias("options"))
        )

        def choose(taken: Column, d: Column) -> Column:
            seen = F.transform(taken, lambda p: p["target_id"])
            free = F.filter(d["options"], lambda o: ~F.array_contains(seen, o["target_id"]))
            return F.concat(taken, F.transform(F.slice(free, 1, 1), lambda o: F.struct(
                d["draw"].alias("draw"), o["detector_id"].alias("detector_id"), d["entity_id"].alias("entity_id"),
                o["target_id"].alias("target_id"), o["severity"].alias("severity"))).cast(_PICK))

        taken = (
            draws.join(best, "entity_id")
            .groupBy("replicate")
            .agg(F.array_sort(F.collect_list(F.struct("draw", "entity_id", "options"))).alias("draws"))
            .select("replicate", F.inline(F.aggregate("draws", F.array().cast(_PICK), choose)))
            .withColumn("selection_reason", F.lit(TARGETED))
        )
        taken = materialise(taken, "targeted")  # at most replicates x budget rows, read by each part below
    u = uniform(seed, F.lit("explore"), F.col("replicate"), F.col("detector_id"), F.col("entity_id"),
                F.col("target_id"))
    pool = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate"))
    if taken is not None:
        sampled = taken.select("replicate", "target_id")  # at most replicates x budget rows
        pool = pool.join(F.broadcast(sampled), ["replicate", "target_id"], "left_anti")
    explored = (
        first_by_uniform(pool.withColumn("u", u), ["replicate"], "u", _FINDING, most_explore, "r")
        .filter(F.col("r") <= n_explore)
        .select("replicate", (F.col("r") + (n_targeted - 1)).cast("int").alias("draw"), "detector_id", "entity_id",
                "target_id", "severity", F.lit(EXPLORATION).alias("selection_reason"))
    )
    return explored if taken is None else taken.unionByName(explored)


def review_sample(findings: DataFrame, ranking: DataFrame, budget_k: int = 10, seed: int = 42,
                  cfg: Settings = DEFAULTS) -> DataFrame:
    """One sample of at most ``budget_k`` findings for manual review."""
    return review_samples(findings, ranking, budget_k, seed, 1, cfg).drop("replicate")


def sample_composition(sample: DataFrame) -> DataFrame:
    return sample.groupBy("selection_reason").agg(F.count(F.lit(1)).alias("findings"))


def lift_over_random(
    findings: DataFrame, ranking: DataFrame, truth_targets: DataFrame, budget_k: int = 10,
    iterations: int = 50, seed: int = 42, cfg: Settings = DEFAULTS,
) -> DataFrame:
    """(random_yield, optimized_yield, lift_multiplier): planted targets hit per sample.

    ``truth_targets`` has a column target_id. All replicates of both samplers run as
    one job; of each replicate only the slices of random numbers travel that the budget reaches.
    """
    rows = findings.select("detector_id", "entity_id", "target_id", "severity")
    truth = truth_targets.select("target_id").distinct()
    available = rows.agg(F.count(F.lit(1)).cast("int").alias("n")).scalar()
    budget = F.least(F.lit(budget_k), available)
    u = uniform(seed, F.lit("random"), F.col("replicate"), F.col("detector_id"), F.col("entity_id"),
                F.col("target_id"))
    pool = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(iterations - 1))).alias("replicate")).withColumn("u", u)
    random = first_by_uniform(pool, ["replicate"], "u", _FINDING, budget_k).select("replicate", "target_id")
    random = materialise(random, "random")  # at most iterations x budget rows
    optimised = review_samples(rows, ranking, budget_k, seed, iterations, cfg, budget).select("replicate", "target_id")
    drawn = random.withColumn("kind", F.lit("random")).unionByName(optimised.withColumn("kind", F.lit("optimised")))
    hits = drawn.distinct().join(truth, "target_id", "left_semi")
    means = hits.agg(
        (F.count(F.when(F.col("kind") == "random", 1)) / F.lit(float(iterations))).alias("random"),
        (F.count(F.when(F.col("kind") == "optimised", 1)) / F.lit(float(iterations))).alias("optimised"),
        F.count(F.lit(1)).alias("hits"),
    )
    some_truth = truth.limit(1).agg(F.count(F.lit(1)).alias("n")).scalar()
    usable = (available > 0) & (some_truth > 0)
    return means.select(
        F.round(F.when(usable, F.col("random")).otherwise(0.0), 2).alias("random_yield"),
        F.round(F.when(usable, F.col("optimised")).otherwise(0.0), 2).alias("optimized_yield"),
        F.round(
            F.when(~usable, 1.0).when(F.col("random") > 0, F.try_divide("optimised", "random")).otherwise(0.0), 2
        ).alias("lift_multiplier"),
    )

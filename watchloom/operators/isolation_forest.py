"""EX-01: analysts isolated by a random forest over their case statistics.

Isolation Forest (Liu, Ting, Zhou 2008): each tree is grown from a bounded sample in
its own task, and all rows are scored by walking flat node arrays. Random
choices come from hashes, so a run is reproducible.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from watchloom.config import DEFAULTS, Settings
from watchloom.functions.hashing import uniform
from watchloom.functions.quantiles import exact_quantile
from watchloom.functions.timing import duration_micros, duration_seconds
from watchloom.operators.findings import finding
from watchloom.session import materialise
from watchloom.sources.tables import SocTables

FEATURES = ("total_cases", "avg_closure_time", "fast_closure_rate")
_EULER = 0.5772156649015329


def analyst_features(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """(analyst, total_cases, avg_closure_time, fast_closure_rate) over closed cases."""
    closed = t.cases.filter(F.col("owner").isNotNull() & F.col("closed_ts").isNotNull())
    fast = duration_micros("opened_ts", "closed_ts") < int(cfg.fast_close_seconds * 1_000_000)
    return closed.groupBy(F.col("owner").alias("analyst")).agg(
        F.count("case_id").alias("total_cases"),
        F.avg(duration_seconds("opened_ts", "closed_ts")).alias("avg_closure_time"),
        F.avg(fast.cast("double")).alias("fast_closure_rate"),
    )


def expected_depth(n: Column) -> Column:
    """Mean depth of an unsuccessful search among ``n`` rows."""
    n = n.cast("double")
    return (
        F.when(n <= 1, F.lit(0.0)).when(n == 2, F.lit(1.0))
        .otherwise(2.0 * (F.ln(n - 1.0) + F.lit(_EULER)) - 2.0 * (n - 1.0) / n)
    )


def _tree_grower(seed: int, sample: int, slots: int, width: int):
    """Grouped-map function: the at most ``sample`` rows of one tree -> its nodes.

    Everything it needs is inside, so workers need not import this package.
    """

    def pick(what: str, tree: int, node: int) -> float:
        # the number functions.hashing.uniform gives for the same parts
        digest = hashlib.md5(f"{seed}|{what}|{tree}|{node}".encode()).hexdigest()
        return int(digest[:13], 16) / 16.0 ** 13

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        x = np.array(pdf["x"].tolist(), dtype=float).reshape(len(pdf), width)
        max_depth = math.ceil(math.log2(max(min(sample, len(pdf)), 2)))
        nodes: list = [None] * slots
        todo = [(1, 0, np.arange(len(pdf)))]
        while todo:
            node, depth, rows = todo.pop()
            lo, hi = x[rows].min(axis=0), x[rows].max(axis=0)
            varying = np.flatnonzero(hi > lo)
            if depth >= max_depth or len(rows) <= 1 or len(varying) == 0:
                nodes[node - 1] = {"feature": None, "cut": None, "depth": depth, "rows": len(rows)}
                continue
            f = int(varying[int(pick("feature", tree, node) * len(varying))])
            cut = float(lo[f] + pick("cut", tree, node) * (hi[f] - lo[f]))
            nodes[node - 1] = {"feature": f, "cut": cut, "depth": depth, "rows": len(rows)}
            right = x[rows, f] > cut
            todo += [(2 * node, depth + 1, rows[~right]), (2 * node + 1, depth + 1, rows[right])]
        return pd.DataFrame({"tree": [tree], "nodes": [nodes]})

    return grow


def grow_forest(features: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """(tree, nodes): per tree a heap-indexed array of its nodes.

    Each tree sees the ``forest_sample`` rows with the smallest hashes, so the result
    is at most trees x 511 small structs whatever the input: a constant bound.
    """
    # The rank takes exactly the smallest hashes; Spark also limits each task's rows by it before the shuffle.
    by_hash = Window.partitionBy("tree").orderBy("u", "analyst")
    rows = (
        features.select(
            "analyst", F.array(*[F.col(f).cast("double") for f in FEATURES]).alias("x"),
            F.explode(F.sequence(F.lit(0), F.lit(cfg.forest_trees - 1))).alias("tree"),
        )
        .withColumn("u", uniform(cfg.forest_seed, F.lit("row"), F.col("tree"), F.col("analyst")))
        .withColumn("rank", F.row_number().over(by_hash))
        .filter(F.col("rank") <= cfg.forest_sample)
    )
    slots = 2 ** (_levels(cfg) + 1) - 1
    return rows.select("tree", "x").groupBy("tree").applyInPandas(
        _tree_grower(cfg.forest_seed, cfg.forest_sample, slots, len(FEATURES)),
        "tree int, nodes array<struct<feature:int,cut:double,depth:int,rows:long>>",
    )


def _levels(cfg: Settings) -> int:
    return max(1, (cfg.forest_sample - 1).bit_length())


#: Nodes of all trees; the forest goes to every task.
MOST_NODES = 1_000_000


def _flat_forest(features: DataFrame, cfg: Settings) -> tuple[np.ndarray, ...]:
    """(feature, cut, path length) of all trees, one row a tree, nodes by heap index; -1 is a leaf."""
    slots = 2 ** (_levels(cfg) + 1) - 1
    if cfg.forest_trees * slots > MOST_NODES:
        raise ValueError(f"a forest of {cfg.forest_trees} trees with up to {slots} nodes is over the {MOST_NODES} nodes sent to every task")
    feature = np.full((cfg.forest_trees, slots + 1), -1, np.int64)
    cut, rows, depth = (np.zeros(feature.shape) for _ in range(3))
    for tree, nodes in grow_forest(features, cfg).collect():
        for k, node in enumerate(nodes, 1):
            if node is not None:
                feature[tree, k] = -1 if node["feature"] is None else node["feature"]
                cut[tree, k], rows[tree, k], depth[tree, k] = node["cut"] or 0.0, node["rows"], node["depth"]
    return feature, cut, depth + depth_of(rows)


def depth_of(n: np.ndarray) -> np.ndarray:
    """``expected_depth`` of an array."""
    big = np.maximum(n, 3.0)
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, 2.0 * (np.log(big - 1.0) + _EULER) - 2.0 * (big - 1.0) / big))


def anomaly_scores(features: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """``features`` plus ``score`` in (0, 1); higher is easier to isolate.

    The forest is flat arrays of a constant size, and a task walks all trees for a batch of
    rows at a time: one step down all of them is one lookup by (row, tree). Rows are neither
    multiplied nor shuffled.
    """
    n = features.count()
    if not n:
        return features.select("analyst", *FEATURES, F.lit(None).cast("double").alias("score"))
    psi = min(cfg.forest_sample, n)
    norm, levels = float(depth_of(np.array([psi]))[0]), _levels(cfg)
    feature, cut, length = _flat_forest(features, cfg)
    names = ["analyst", *FEATURES, "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = np.arange(len(feature))[None, :]
        for batch in batches:
            x = np.stack([batch.column(f).cast(pa.float64()).to_numpy(zero_copy_only=False) for f in FEATURES], axis=1)
            at = np.ones((len(x), len(feature)), np.int64)
            for _ in range(levels):
                f = feature[trees, at]
                right = np.take_along_axis(x, np.maximum(f, 0), axis=1) > cut[trees, at]
                at = np.where(f < 0, at, 2 * at + right)
            depth = length[trees, at].mean(axis=1)
            score = pa.array(np.power(2.0, -depth / norm)) if norm else pa.nulls(len(x), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:-1]), score], names)

    scored = features.select("analyst", *FEATURES)
    schema = T.StructType([*scored.schema.fields, T.StructField("score", T.DoubleType())])
    # Rounded, so that a score does not depend on the order its terms were summed in.
    return scored.mapInArrow(run, schema).withColumn("score", F.round("score", 9))


def ex_01(t: SocTables, cfg: Settings = DEFAULTS) -> DataFrame:
    """Analysts whose score lies strictly above the contamination quantile.

    The features (one row per analyst) and the scores are read several times, so
    each is written once to the shared folder.
    """
    features = materialise(analyst_features(t, cfg), "analyst-features")
    scores = materialise(anomaly_scores(features, cfg), "analyst-scores")
    cut = exact_quantile(scores, [], "score", 1.0 - cfg.forest_contamination, "cut").scalar()
    odd = scores.filter(F.col("score") > cut)
    return finding(
        odd, "EX-01", "analyst", 4,
        rationale=F.format_string(
            "Case statistics stand out: %d cases, %.2f%% closed fast.", "total_cases",
            F.col("fast_closure_rate") * 100),
        score=F.col("score"), total_cases=F.col("total_cases"), fast_closure_rate=F.col("fast_closure_rate"),
    )

"""Exact top-k by distributed histogram selection.

Vectors are integer vectors; the score is their inner product. Rows are packed into
blocks, query blocks meet candidate blocks in lanes, and a task multiplies two blocks
at a time. Each round scores everything and adds up, per query, how many scores fall
into the bins of the interval known to hold its k-th score; the bin that holds it is
the next interval. When bins are one wide the k-th score is known. A last pass
keeps the scores that reach it, and ties go to the smaller id.

A block reports no bin below its own k-th best, and of ties no more than k ids: those
cannot be in the result, so neither equal vectors nor dense bins make many rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from watchloom.llm.common import materialise, parts

K = 10
SCALE = 1024
BINS = 2048
QUERY_ROWS, CANDIDATE_ROWS = 256, 4096


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, dim, parts): usable rows as integers; null or non-finite components and null ids take no part."""
    x = F.col("embedding")
    usable = F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    rows = vectors.select("vec_id", "embedding").filter(F.coalesce(usable, F.lit(False)))
    ints = F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double")))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.size(x).alias("dim"), ints.alias("parts"))


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """(dim, block, rows, ids, matrix): up to ``size`` vectors of one length as one row, in the fewest bytes a component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                mine = np.flatnonzero(dims == dim)
                for at in range(0, len(mine), size):
                    part = batch.take(pa.array(mine[at: at + size]))
                    row = part.column("row").to_numpy(zero_copy_only=False)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([dim], pa.int32()), pa.array([int(row[0])], pa.int64()), pa.array([row.astype("<i8").tobytes()], pa.binary()),
                        pa.array([part.column("vec_id").to_numpy(zero_copy_only=False).astype("<i8").tobytes()], pa.binary()),
                        pa.array([_packed(np.asarray(part.column("parts").flatten()).astype("<i8"))], pa.binary())],
                        ["dim", "block", "rows", "ids", "matrix"])

    return rows.mapInArrow(run, "dim int, block long, rows binary, ids binary, matrix binary")


def _packed(values: np.ndarray) -> bytes:
    low, high = int(values.min(initial=0)), int(values.max(initial=0))
    return next(values.astype(f"<i{n}") for n in (1, 2, 4, 8) if -(1 << 8 * n - 1) <= low and high < 1 << 8 * n - 1).tobytes()


def _unpacked(matrix: bytes, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(matrix, dtype=f"<i{len(matrix) // (rows * dim) if dim else 8}").reshape(rows, dim).astype(np.int64)


def _scores(q: bytes, c: bytes, q_rows: int, c_rows: int, dim: int) -> np.ndarray:
    a, b = _unpacked(q, q_rows, dim), _unpacked(c, c_rows, dim)
    if dim and float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * dim >= 2.0**53:
        return a @ b.T
    return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)  # exact below 2**53


def _met(queries: DataFrame, candidates: DataFrame, lanes: int) -> DataFrame:
    """Query blocks beside candidate blocks: each candidate block lies in one lane, query blocks go to all.

    The planner takes exploded rows to be as small as they were before, so without the hint
    it may send the query blocks, once for every lane, to the driver.
    """
    left = queries.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    right = candidates.select(
        "dim", F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int").alias("lane"), F.col("rows").alias("c_rows"), F.col("ids").alias("c_ids"), F.col("matrix").alias("c_matrix"))
    return left.hint("merge").join(right, ["dim", "lane"])


def _each(batch: pa.RecordBatch) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """A pair of blocks, its scores, and which are of two different rows."""
    for k in range(batch.num_rows):
        pair = batch.slice(k, 1).to_pylist()[0]
        q, c = (np.frombuffer(pair[x], dtype="<i8") for x in ("rows", "c_rows"))
        scores = _scores(pair["matrix"], pair["c_matrix"], len(q), len(c), pair["dim"])
        own = q[:, None] == c[None, :]
        yield pair, scores, ~own


def search(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows of every query row, ties to the smaller vec_id.

    ``is_query`` is a condition on ``vec_id``. Fewer candidates give all of them.
    Vectors meet those of their own length only. A repeated row is a row of its own:
    it is a candidate of its twin, and a query twice asked is answered twice (with
    equal ranks). Finite components so large that inner products might not fit 64 bits
    are refused. Only ``vec_id`` and ``embedding`` are read, so further columns may
    have any name. An empty table gives no row.
    """
    spark = vectors.sparkSession
    rows = materialise(quantised(vectors, scale), "topk-vectors")
    norms = F.aggregate("parts", F.lit(0.0), lambda a, v: a + v.cast("double") * v)
    bound = int(rows.agg(F.max(norms)).first()[0] or 0) + 1  # no inner product is larger
    if bound >= 1 << 62:
        raise ValueError(f"components of up to {math.isqrt(bound):.3g} after scaling have inner products beyond 64 bits")
    candidates = materialise(_blocks(rows.select("row", "vec_id", "dim", "parts"), CANDIDATE_ROWS), "topk-candidates")
    lanes = max(1, min(parts(spark) * 2, candidates.count()))  # more would be copies of the queries that meet nothing
    queries = materialise(_blocks(rows.filter(is_query).select("row", "vec_id", "dim", "parts"), QUERY_ROWS), "topk-queries")

    def first_state(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, block, q in zip(*(batch.column(c).to_pylist() for c in ("dim", "block", "rows"))):
                n = len(q) // 8
                yield pa.RecordBatch.from_arrays([
                    pa.array([block] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([-bound] * n, pa.int64()),
                    pa.array([k] * n, pa.int64())], ["block", "slot", "low", "need"])

    # Interval [low, low + width) of the k-th score, and how many of those at or above `low` in it are wanted.
    state = queries.select("dim", "block", "rows").mapInArrow(first_state, "block long, slot int, low long, need long")
    span = 2 * bound + 1
    while span > 1:
        width = -(-span // BINS)
        state = materialise(_refined(_met(_with_state(queries, state), candidates, lanes), state, width, span, k), "topk-state")
        span = width
    best = _reached(_met(_with_state(queries, state), candidates, lanes), k)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "vec_row")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _with_state(queries: DataFrame, state: DataFrame) -> DataFrame:
    """Query blocks with the lower ends of their queries, in the order of their rows (at most QUERY_ROWS)."""
    lows = state.groupBy("block").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "low"))), lambda s: s["low"]).alias("lows"))
    return queries.join(lows, "block")


def _refined(met: DataFrame, state: DataFrame, width: int, span: int, k: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair, scores, other in _each(batch):
                low = np.array(pair["lows"], dtype=np.int64)[:, None]
                bins = np.where(other, np.clip((scores - low) // width, -1, -(-span // width)), -1)
                if bins.shape[1] > k:
                    least = np.partition(bins, bins.shape[1] - k, axis=1)[:, bins.shape[1] - k]
                    bins = np.where(bins >= least[:, None], bins, -1)
                slot, column = np.nonzero(bins >= 0)
                keys, n = np.unique(np.stack([slot, bins[slot, column]], axis=1), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(n), pair["block"], dtype=np.int64)), pa.array(keys[:, 0].astype(np.int32)), pa.array(keys[:, 1].astype(np.int64)),
                    pa.array(n.astype(np.int64))], ["block", "slot", "bin", "n"])

    counted = met.mapInArrow(count, "block long, slot int, bin long, n long").groupBy("block", "slot", "bin").agg(F.sum("n").alias("n"))
    down = Window.partitionBy("block", "slot").orderBy(F.desc("bin"))
    summed = counted.withColumn("upto", F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, 0)))
    # The highest bin that, with all above it, holds enough; with too few scores the interval stays at its lower end.
    holding = summed.join(state, ["block", "slot"]).filter(F.col("upto") >= F.col("need")).groupBy("block", "slot").agg(F.max("bin").alias("bin"))
    # Scores above the interval are in its top bin, so the wanted number stays as it is.
    return state.join(holding, ["block", "slot"], "left").select(
        "block", "slot", (F.col("low") + F.coalesce("bin", F.lit(0)) * width).alias("low"), "need")


def _reached(met: DataFrame, k: int) -> DataFrame:
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair, scores, other in _each(batch):
                low = np.array(pair["lows"], dtype=np.int64)[:, None]
                slot, column = np.nonzero((scores >= low) & other)
                q_rows, q_ids, c_rows, c_ids = (np.frombuffer(pair[c], dtype="<i8") for c in ("rows", "ids", "c_rows", "c_ids"))
                found = scores[slot, column]
                order = np.lexsort((c_rows[column], c_ids[column], -found, slot))
                slot, column, found = slot[order], column[order], found[order]
                first = np.searchsorted(slot, slot)
                mine = np.arange(len(slot)) - first < k
                slot, column, found = slot[mine], column[mine], found[mine]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (q_rows[slot], q_ids[slot], c_rows[column], c_ids[column], found)], ["query_row", "query_id", "vec_row", "vec_id", "score"])

    return met.mapInArrow(keep, "query_row long, query_id long, vec_row long, vec_id long, score long")

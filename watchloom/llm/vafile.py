"""Centroid clustering over a vector-approximation file.

Every vector is compressed to ``BITS`` bits a dimension: the cell of that dimension its
component falls in. Cells are cut at quantiles of a sample of ``SAMPLE`` rows; the outer
ones reach to the least and greatest component of all rows, so each cell is a true interval.

An assignment reads the approximations. Tables of (dimensions, cells, centroid) give the
least and greatest possible squared distance to each centroid; a centroid whose least is over
another's greatest cannot be nearest. Where one is left and it is the vector's cluster already,
the vector itself is not read. The others, with undecided or changed cluster, are fetched by a
join on the row number and measured against the centroids left. The vector's own squared
length is common to all its distances and stays out of the intervals, which makes them much
narrower. Cluster sums change only by
vectors that change cluster. Vectors lie bucketed by row number, so a round shuffles the
fetched approximations alone.

All arithmetic is on integers. Components beyond 2**26 after scaling are refused, since squared
distances would no longer fit 64 bits. Centroids (k x dimensions) are on the driver and in the
tasks: their size is a parameter.

Defined cases: vectors of another length, null, or with null or non-finite components take no
part; null vec_ids are clustered but never start a centroid; rows of one vec_id start in the
order of their components; equal distances go to the smaller number; with fewer than k vectors
there are as many centroids as vectors; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchloom.llm.common import materialise, parts, scratch_path

DIMENSIONS = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
SEED = 2
#: Bits a dimension.
BITS = 6
#: Rows that cell borders are taken from, those with the smallest hash.
SAMPLE = 4096
MOST = 1 << 26
_CHUNK = 4096


def quantised(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, parts): usable vectors as integers."""
    x = F.col("embedding")
    usable = (F.size(x) == dimensions) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(F.coalesce(usable, F.lit(False)))
    scaled = F.transform(x, lambda v: F.lit(float(scale)) * v.cast("double"))
    ints = F.transform(scaled, lambda v: F.when((v >= -float(MOST)) & (v < float(MOST)), F.floor(v)).otherwise(
        F.raise_error(F.lit(f"a component beyond {MOST} after scaling: distances would not fit 64 bits"))).cast("int"))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", ints.alias("parts"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), width).astype(np.int64)


def first_centroids(rows: DataFrame, k: int, seed: int = SEED) -> np.ndarray:
    named = rows.filter("vec_id is not null").withColumn("hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    return np.array([r["parts"] for r in named.orderBy("hash", "parts").limit(k).collect()], dtype=np.int64)


class Cells:
    """Cell borders of each dimension: cell c holds the integers from ``low[d, c]`` to ``high[d, c]``."""

    def __init__(self, sample: np.ndarray, least: np.ndarray, most: np.ndarray, bits: int = BITS):
        n, width = 1 << bits, sample.shape[1]
        self.bits = bits
        self.inner, self.low, self.high = [], np.zeros((width, n), np.int64), np.zeros((width, n), np.int64)
        for d in range(width):
            ordered = np.sort(sample[:, d])
            cuts = np.unique(ordered[(np.arange(1, n) * len(ordered)) // n])
            cuts = cuts[cuts > least[d]]
            self.inner.append(cuts)
            lows = np.concatenate([[least[d]], cuts])
            highs = np.concatenate([cuts - 1, [most[d]]])
            self.low[d, : len(lows)], self.high[d, : len(lows)] = lows, highs
            self.low[d, len(lows):], self.high[d, len(lows):] = lows[-1], highs[-1]

    def cell(self, values: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(cuts, values[:, d], "right") for d, cuts in enumerate(self.inner)], axis=1).astype(np.uint8)

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(dimensions, cells, centroids): least and greatest part of the distance that each cell adds.

        Measured from the centroids' mean m, the squared distance of v and c is |v|^2 - 2vc + |c|^2. The first
        part is the same for all centroids and is left out; the rest is linear in v, so a cell's ends bound it.
        """
        mean = centroids.sum(axis=0) // len(centroids)
        from_mean = centroids - mean
        at_low = -2 * (self.low - mean[:, None])[:, :, None] * from_mean.T[:, None, :]
        at_high = -2 * (self.high - mean[:, None])[:, :, None] * from_mean.T[:, None, :]
        square = (from_mean**2).T[:, None, :]
        return np.minimum(at_low, at_high) + square, np.maximum(at_low, at_high) + square


def packed(cells: np.ndarray, bits: int) -> list[bytes]:
    planes = np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - bits:]
    return [row.tobytes() for row in np.packbits(planes.reshape(len(cells), -1), axis=1)]


def unpacked(rows: list[bytes], width: int, bits: int) -> np.ndarray:
    planes = np.unpackbits(np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1), axis=1, count=width * bits).reshape(len(rows), width, bits)
    return np.packbits(np.concatenate([np.zeros((len(rows), width, 8 - bits), np.uint8), planes], axis=2), axis=2)[:, :, 0]


def bounds(cells: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(rows x centroids): least and greatest distance, both less what is common to all centroids."""
    least, greatest = (np.zeros((len(cells), t.shape[2]), np.int64) for t in tables)
    for d in range(cells.shape[1]):
        least += tables[0][d][cells[:, d]]
        greatest += tables[1][d][cells[:, d]]
    return least, greatest


def _borders(rows: DataFrame, dimensions: int, sample: int, bits: int) -> Cells:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = most = None
        for batch in batches:
            if batch.num_rows:
                values = _matrix(batch.column("parts"), dimensions)
                low, high = values.min(axis=0), values.max(axis=0)
                least, most = (low, high) if least is None else (np.minimum(least, low), np.maximum(most, high))
        if least is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x.tolist()], pa.list_(pa.int64())) for x in (least, most)], ["least", "most"])

    ends = rows.select("parts").mapInArrow(run, "least array<long>, most array<long>")
    least, most = ends.agg(*(F.array(*(f(F.get(c, d)) for d in range(dimensions))) for f, c in ((F.min, "least"), (F.max, "most")))).first()
    taken = rows.orderBy(F.xxhash64("row")).select("parts").limit(sample).collect()
    return Cells(np.array([r["parts"] for r in taken], dtype=np.int64), np.array(least), np.array(most), bits)


def _bucketed(rows: DataFrame) -> DataFrame:
    """The vectors as a table bucketed by row number in the shared folder: joins on it do not shuffle them."""
    spark, n = rows.sparkSession, parts(rows.sparkSession)
    name = f"watchloom_vectors_{uuid.uuid4().hex}"
    rows.repartition(n, "row").write.bucketBy(n, "row").sortBy("row").option("path", scratch_path(spark, "va-vectors")).saveAsTable(name)
    return spark.table(name)


def approximations(rows: DataFrame, cells: Cells, dimensions: int) -> DataFrame:
    """(row, cells, cluster): the approximation file, nothing assigned yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows_packed = packed(cells.cell(_matrix(batch.column("parts"), dimensions)), cells.bits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(rows_packed, pa.binary()), pa.nulls(len(rows_packed), pa.int32())], ["row", "cells", "cluster"])

    return rows.select("row", "parts").mapInArrow(run, "row long, cells binary, cluster int")


def narrowed(va: DataFrame, cells: Cells, centroids: np.ndarray, every: bool = False) -> DataFrame:
    """(row, cells, cluster, left, fetch): which centroids each interval leaves, and whether the vector is needed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = cells.tables(centroids)
        for whole in batches:
            for at in range(0, whole.num_rows, _CHUNK):
                batch = whole.slice(at, _CHUNK)
                if not batch.num_rows:
                    continue
                least, greatest = bounds(unpacked(batch.column("cells").to_pylist(), len(cells.low), cells.bits), tables)
                left = least <= greatest.min(axis=1)[:, None]
                held = batch.column("cluster").fill_null(-1).to_numpy(zero_copy_only=False)
                settled = (left.sum(axis=1) == 1) & (left.argmax(axis=1) == held)
                marks = np.packbits(left, axis=1)
                yield pa.RecordBatch.from_arrays([
                    batch.column("row"), batch.column("cells"), batch.column("cluster"), pa.array([m.tobytes() for m in marks], pa.binary()),
                    pa.array(~settled | every)], ["row", "cells", "cluster", "left", "fetch"])

    return va.mapInArrow(run, "row long, cells binary, cluster int, left binary, fetch boolean")


def measured(fetched: DataFrame, centroids: np.ndarray, dimensions: int) -> DataFrame:
    """Fetched vectors against the centroids their intervals left.

    One row a vector (row, vec_id, cells, cluster, distance), and per task and changed
    cluster one row without a row number: what its count and sums change by.
    """
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, _CHUNK):
                batch = whole.slice(at, _CHUNK)
                n = batch.num_rows
                values = _matrix(batch.column("parts"), dimensions)
                marks = np.frombuffer(b"".join(batch.column("left").to_pylist()), np.uint8).reshape(n, -1)
                left = np.unpackbits(marks, axis=1, count=k).astype(bool)
                distance = np.full((n, k), np.iinfo(np.int64).max)
                for c in range(k):
                    mine = np.flatnonzero(left[:, c])
                    distance[mine, c] = ((values[mine] - centroids[c]) ** 2).sum(axis=1)
                new = distance.argmin(axis=1)  # the first of equals
                old = batch.column("cluster").fill_null(-1).to_numpy(zero_copy_only=False)
                moved = new != old
                for to, sign in ((new, 1), (old, -1)):
                    these = moved & (to >= 0)
                    count += sign * np.bincount(to[these], minlength=k)
                    np.add.at(sums, to[these], sign * values[these])
                yield pa.RecordBatch.from_arrays([
                    batch.column("row"), batch.column("vec_id"), batch.column("cells"), pa.array(new.astype(np.int32)),
                    pa.array(distance[np.arange(n), new]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64()))], names)
        of = np.flatnonzero(count.astype(bool) | sums.any(axis=1))
        yield pa.RecordBatch.from_arrays([
            pa.nulls(len(of), pa.int64()), pa.nulls(len(of), pa.int64()), pa.nulls(len(of), pa.binary()), pa.array(of.astype(np.int32)),
            pa.nulls(len(of), pa.int64()), pa.array(count[of]), pa.array(sums[of].tolist(), pa.list_(pa.int64()))], names)

    names = ["row", "vec_id", "cells", "cluster", "distance", "count", "sums"]
    return fetched.select("row", "vec_id", "cells", "cluster", "left", "parts").mapInArrow(
        run, "row long, vec_id long, cells binary, cluster int, distance long, count long, sums array<long>")


def cluster(
    vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED, bits: int = BITS,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector."""
    if not 1 <= bits <= 8:
        raise ValueError("cells have one to eight bits")
    spark = vectors.sparkSession
    rows = _bucketed(quantised(vectors, dimensions, scale))
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        if rows.isEmpty():
            return spark.createDataFrame([], RESULT)
        raise ValueError("no vector has an id to start a centroid from")
    cells = _borders(rows, dimensions, SAMPLE, bits)
    va = materialise(approximations(rows, cells, dimensions), "va-cells")
    count, sums = [0] * len(centroids), [[0] * dimensions for _ in centroids]
    for step in range(rounds + 1):
        last = step == rounds
        seen = materialise(narrowed(va, cells, centroids, every=last), "va-left")
        found = materialise(measured(seen.filter("fetch").join(rows, "row"), centroids, dimensions), "va-measured")
        if last:
            return _result(found.filter("row is not null"), centroids)
        changes = found.filter("row is null").groupBy("cluster").agg(
            F.sum("count").alias("n"), F.array(*(F.sum(F.get("sums", d)) for d in range(dimensions))).alias("sums"))
        for r in changes.collect():  # at most one row a centroid
            count[r["cluster"]] += r["n"]
            sums[r["cluster"]] = [a + b for a, b in zip(sums[r["cluster"]], r["sums"])]
        centroids = np.array([[x // n for x in s] if n else c.tolist() for c, s, n in zip(centroids, sums, count)], dtype=np.int64)
        va = seen.filter("not fetch").select("row", "cells", "cluster").unionByName(found.filter("row is not null").select("row", "cells", "cluster"))
    raise AssertionError("the last round returns")


RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def _result(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    per = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # one row a centroid
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    total = sum(per.values())
    if total >= 2**63:
        raise OverflowError("the inertia does not fit 64 bits")
    facts = assigned.sparkSession.createDataFrame(
        [(c, s, total, hashes[c]) for c, s in per.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(*(c.split()[0] for c in RESULT.split(", ")))


def sql(k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED) -> str:
    """The same in DuckDB's SQL: every vector against every centroid in every round."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, vec_id, parts, cluster, distance FROM (
    SELECT v.r, v.vec_id, v.parts, c.cluster, x.distance, row_number() OVER (PARTITION BY v.r ORDER BY x.distance, c.cluster) AS k
    FROM v, c{i} c, LATERAL (SELECT CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(v.parts, c.parts)]) AS BIGINT) AS distance) x)
  WHERE k = 1),""")
        if i < rounds:
            steps.append(f"""
m{i} AS (
  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS parts FROM (
    SELECT cluster, d, sum(CAST(x AS HUGEINT)) AS s, count(*) AS n
    FROM (SELECT cluster, unnest(parts) AS x, unnest(range(len(parts))) AS d FROM a{i}) GROUP BY cluster, d) GROUP BY cluster),
c{i + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.parts, c.parts) AS parts FROM c{i} c LEFT JOIN m{i} m USING (cluster)),""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS parts FROM embeddings
  WHERE len(embedding) = {dimensions} AND NOT list_contains([x IS NULL OR NOT isfinite(x) FOR x IN embedding], true)),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), parts) - 1 AS INTEGER) AS cluster, parts
  FROM v WHERE vec_id IS NOT NULL ORDER BY cluster LIMIT {k}),{''.join(steps)}
per AS (SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM a{rounds} GROUP BY cluster)
SELECT vec_id, cluster, distance, cluster_inertia, (SELECT CAST(sum(distance) AS BIGINT) FROM a{rounds}) AS inertia,
  sha256(array_to_string(c.parts, ',')) AS centroid_sha256
FROM a{rounds} JOIN per USING (cluster) JOIN c{rounds} c USING (cluster)
"""

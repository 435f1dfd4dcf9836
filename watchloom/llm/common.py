"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from watchloom.session import materialise, scratch_path

__all__ = ["components", "document_bytes", "materialise", "parts", "scratch_path", "table", "rows_of"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def parts(spark: SparkSession) -> int:
    """The session's shuffle partitions: the one figure by which work is cut."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def document_bytes(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id``, the named columns and the text as UTF-8 bytes (null: empty)."""
    return docs.select("doc_id", *columns, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def rows_of(batches: Iterator[pa.RecordBatch], *columns: str, at_most: int = 512) -> Iterator[tuple[list, ...]]:
    """Batches in slices of few rows, each column as a list, so that only some texts are Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, at_most):
            part = batch.slice(start, at_most)
            yield tuple(part.column(c).to_pylist() for c in columns)


def bucket_of(column: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")


def components(edges: DataFrame, name: str, most_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a long, b long): (node, root), root the smallest node reachable.

    Alternating star contraction: every round links each node's larger neighbours to
    the smallest one near it, then the smaller ones likewise; both are a grouped
    minimum and a join, so no neighbour list is ever gathered. The number of rounds
    grows with the logarithm of the longest chain. Each round is written to the
    shared folder, and a count of changed links decides whether to go on.
    """

    def large_star(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b"), F.col("a")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return both.filter("v > u").join(least, "u").select(F.col("v").alias("b"), F.col("m").alias("a"))

    def small_star(e: DataFrame) -> DataFrame:
        low = e.filter("a < b").select(F.col("b").alias("u"), F.col("a").alias("v"))
        least = low.groupBy("u").agg(F.min("v").alias("m"))
        moved = low.join(least, "u").filter("v <> m").select(F.col("v").alias("b"), F.col("m").alias("a"))
        return moved.union(least.select(F.col("u").alias("b"), F.col("m").alias("a")))

    now = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    spark = edges.sparkSession
    now = materialise(now, f"{name}-links")
    before = None
    for _ in range(most_rounds):
        now = materialise(small_star(large_star(now)).select("a", "b").distinct(), f"{name}-links")
        # The set of links is a star per component, and stays, once a round changes nothing.
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = state
    raise RuntimeError(f"{spark.sparkContext.appName}: components did not settle in {most_rounds} rounds")

"""Positions and running sums that never put one whole group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def position_within(
    df: DataFrame,
    keys: Sequence[str],
    slot: Column,
    order: Sequence[Column],
    out: str = "position",
) -> DataFrame:
    """1-based position of each row inside its group, in ``order``.

    ``slot`` must not decrease along ``order`` (an hour, or an index block). Slots are
    counted first, the counts are summed up along the slots of a group, and rows
    are numbered inside (group, slot) only. A group with a third of all rows is
    thus spread over as many tasks as it has slots.
    """
    keys = list(keys)
    slotted = df.withColumn("_slot", slot)
    before = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slotted.groupBy(*keys, "_slot").agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    inside = Window.partitionBy(*keys, "_slot").orderBy(*order)
    return (
        slotted.join(offsets, [*keys, "_slot"])
        .withColumn(out, F.row_number().over(inside) + F.col("_offset"))
        .drop("_slot", "_offset")
    )


SLICES = 4096


def first_by_uniform(df: DataFrame, keys: Sequence[str], u: str, order: Sequence[str], n: int, out: str = "position") -> DataFrame:
    """The ``n`` rows of each group with the smallest ``u`` (a number in [0, 1)), ties by ``order``, with their position.

    Rows are counted by slice of ``u`` first, and only the slices that start before the
    ``n``-th row are read: at most ``n`` of a group's 4096. Rows are numbered inside a
    slice, so however large ``n`` or a group is, neither is sorted in one task. Rows
    with a null key or ``u`` are left out. The slices are sent to the rows, never the rows
    to the slices: groups are replicates or the like, known to be few, whereas rows that were
    just exploded over them look as small to the planner as they were before.
    """
    keys = list(keys)
    sliced = df.withColumn("_slice", F.floor(F.col(u) * F.lit(SLICES)).cast("int"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    needed = (
        sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0))).filter(F.col("_offset") < n)
        .select(*keys, "_slice", "_offset")
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy(u, *order)
    return (
        sliced.join(F.broadcast(needed), [*keys, "_slice"])  # at most min(n, SLICES) rows a group
        .withColumn(out, F.row_number().over(inside) + F.col("_offset")).filter(F.col(out) <= n)
        .drop("_slice", "_offset")
    )


def first_within(df: DataFrame, keys: Sequence[str], salt: Column, order: Sequence[Column], n: int, out: str = "position") -> DataFrame:
    """The first ``n`` rows of each group in ``order``, with their position; taken inside (group, salt) before they meet."""
    parted = Window.partitionBy(*keys, "_salt").orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    part = df.withColumn("_salt", salt).withColumn(out, F.row_number().over(parted)).filter(F.col(out) <= n).drop("_salt")
    return part.withColumn(out, F.row_number().over(whole)).filter(F.col(out) <= n)

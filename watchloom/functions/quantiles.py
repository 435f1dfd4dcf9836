"""Exact quantiles per group by selection over histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from watchloom.session import materialise

#: Bins of one histogram.
BINS = 4096
#: A bin of at most so many distinct values is put in order.
LEAF = 65_536
_SALTS = 16
_ROUNDS = 8


def exact_quantile(df: DataFrame, keys: Sequence[str], value: str, q: float, out: str) -> DataFrame:
    """Quantile ``q`` of ``value`` per group, linearly interpolated, as (keys, out). Nulls take no part.

    Values are counted first, so repeated ones cost one row. Each group then looks for the
    one or two ranks it needs: the interval known to hold a rank is cut into ``BINS`` equal
    bins, the bins are counted, and the one that holds the rank is the next interval, narrowed
    to the values in it. The first cut is on a logarithmic scale, so from then on an interval
    is about a factor of two wide and few rounds reach the last bit of a number. When no
    interval has more than ``LEAF`` distinct values they are put in order. No task ever orders more than that, whatever the size of a group or the spread of
    its values; small groups need no round at all.
    """
    keys = list(keys)
    names = [f"_k{i}" for i in range(len(keys))] or ["_k0"]
    renamed = [F.col(k).alias(n) for k, n in zip(keys, names)] or [F.lit(0).alias("_k0")]
    rows = df.filter(F.col(value).isNotNull()).select(*renamed, F.col(value).cast("double").alias("_v"))
    counts = rows.groupBy(*names, "_v").agg(F.count(F.lit(1)).alias("_c"))
    cells = materialise(counts.withColumn("_salt", F.pmod(F.xxhash64("_v"), F.lit(_SALTS)).cast("int")), "quantile-values")

    pos = F.lit(float(q)) * (F.col("_n") - 1)
    whole = cells.groupBy(*names).agg(F.sum("_c").alias("_n"), *_extent()).withColumn("_pos", pos)
    ranks = F.array_distinct(F.array(F.floor("_pos"), F.ceil("_pos")))
    state = materialise(whole.select(
        *names, "_pos", F.explode(ranks).alias("_rank"), F.lit(0).cast("long").alias("_below"), "_lo", "_hi", "_cells"), "quantile-intervals")
    for step in range(_ROUNDS):
        most = state.agg(F.max("_cells")).first()[0]
        if most is None or most <= LEAF:
            break
        state = materialise(_narrowed(cells, state, names, _magnitude if step == 0 else _itself), "quantile-intervals")

    running = Window.partitionBy(*names, "_rank").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = _inside(cells, state, names).withColumn("_cum", F.col("_below") + F.sum("_c").over(running))
    hit = ordered.groupBy(*names).agg(
        F.min(F.when(F.col("_cum") > F.floor("_pos"), F.col("_v"))).alias("_a"),
        F.min(F.when((F.col("_cum") > F.ceil("_pos")) & (F.col("_rank") == F.ceil("_pos")), F.col("_v"))).alias("_z"),
        F.first("_pos").alias("_pos"))
    between = F.when(F.col("_a") == F.col("_z"), F.col("_a")).otherwise(
        F.col("_a") + (F.col("_z") - F.col("_a")) * (F.col("_pos") - F.floor("_pos")))
    return hit.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], between.alias(out))


def _extent() -> list[Column]:
    return [F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_cells")]


def _inside(cells: DataFrame, state: DataFrame, names: list[str]) -> DataFrame:
    """Values of each interval. Salted by value, so that a large group meets its interval in several tasks."""
    salted = state.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return cells.join(salted, [*names, "_salt"]).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))


def _itself(v: Column) -> Column:
    return v


def _magnitude(v: Column) -> Column:
    """Rises with ``v`` like its logarithm on either side of 0; 745 is beyond the logarithm of the smallest double."""
    return F.when(v == 0, 0.0).otherwise(F.signum(v) * (F.ln(F.abs(v)) + 745.0))


def _narrowed(cells: DataFrame, state: DataFrame, names: list[str], scale) -> DataFrame:
    """The bin of each interval that holds its rank. Infinities and NaN have bins of their own at the ends."""
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    top = 1.7976931348623157e308
    # halves, so that the width of the widest interval is finite too
    at, low, high = (scale(x) / 2 for x in (v, F.greatest(lo, F.lit(-top)), F.least(hi, F.lit(top))))
    share = F.try_divide(at - low, high - low)
    number = F.when(v == float("-inf"), -1).when(F.isnan(v), BINS + 1).when(v == float("inf"), BINS).otherwise(
        F.least(F.floor(share * BINS), F.lit(BINS - 1)))
    binned = _inside(cells, state, names).groupBy(*names, "_rank", F.coalesce(number, F.lit(0)).alias("_bin")).agg(
        F.first("_pos").alias("_pos"), F.first("_below").alias("_before"), F.sum("_c").alias("_c"), *_extent())
    upto = Window.partitionBy(*names, "_rank").orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = binned.withColumn("_cum", F.col("_before") + F.sum("_c").over(upto))
    holds = (F.col("_cum") > F.col("_rank")) & (F.col("_cum") - F.col("_c") <= F.col("_rank"))
    return counted.filter(holds).select(*names, "_pos", "_rank", (F.col("_cum") - F.col("_c")).alias("_below"), "_lo", "_hi", "_cells")

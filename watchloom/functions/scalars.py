"""One-row results used as columns of another frame, without a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def one_row(df: DataFrame) -> Column:
    """The single row of ``df`` as a struct column (an uncorrelated scalar subquery).

    Spark runs it once and feeds the value to every task, so no join is planned.
    """
    return df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row")).scalar()

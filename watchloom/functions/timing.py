"""Time arithmetic in whole microseconds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def micros(ts) -> Column:
    """Microseconds since the epoch of a UTC timestamp (with or without zone)."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(col.cast("timestamp"))


def duration_micros(start, end) -> Column:
    return micros(end) - micros(start)


def duration_seconds(start, end) -> Column:
    """Seconds between two timestamps, negative when ``end`` lies before ``start``.

    Subtracting whole microseconds first keeps the fraction exact.
    """
    return duration_micros(start, end) / F.lit(1_000_000.0)


def seconds_to_micros(seconds: float) -> int:
    return int(round(seconds * 1_000_000))

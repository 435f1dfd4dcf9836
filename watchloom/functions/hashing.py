"""Reproducible uniform numbers from a hash, so samples do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# 13 hex digits = 52 bits: every value is exact in a double.
_HEX_DIGITS = 13
_SCALE = float(16 ** _HEX_DIGITS)


def uniform(*parts) -> Column:
    """A number in [0, 1) fixed by ``parts`` (columns or literals), joined with ``|``."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))
    return F.conv(F.substring(digest, 1, _HEX_DIGITS), 16, 10).cast("double") / F.lit(_SCALE)


def hash_bucket(col, hex_digits: int = 3) -> Column:
    """Bucket number of a key: 16 ** hex_digits buckets of about equal size."""
    return F.conv(F.substring(F.md5(F.col(col) if isinstance(col, str) else col), 1, hex_digits), 16, 10).cast("int")

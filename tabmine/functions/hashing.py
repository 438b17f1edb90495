"""Seeded, partition-independent hashing used for splits, samples and draws.

``md5(concat_ws('-', key..., seed))`` is computed identically by Spark and
DuckDB, so every seeded operator is reproducible in the SQL oracle and does
not depend on how the input happens to be partitioned (``rand(seed)`` does).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_key(*parts) -> Column:
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("-", *[c.cast("string") for c in cols]))


def hash_int(*parts) -> Column:
    """Non-negative integer from the first 8 hex digits of the md5 (0..2^32-1)."""
    return F.conv(F.substring(md5_key(*parts), 1, 8), 16, 10).cast("bigint")


def hash_unit(*parts) -> Column:
    """Uniform double in [0, 1) from the md5 prefix."""
    return hash_int(*parts) / F.lit(4294967296.0)

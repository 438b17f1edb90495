"""Helpers the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmine.session import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Space and \t \n \v \f \r.
BLANKS = " \t\n\x0b\x0c\r"
#: What separates words: every ASCII character but digits and a-z (texts are lower-cased first).
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Tables up to this many bytes are broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under spark.checkpoint.dir and read it back (computed once, lineage cut)."""
    return materialize(df, f"llm-{name}")


def text_of(col: str | Column) -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, nothing else: lower() where the string is ASCII, translate() elsewhere."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, UPPER.lower()))


def digest128(c: Column) -> Column:
    """128-bit key of a string, 16 bytes."""
    return F.unhex(F.md5(c))


def small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (a staged table) with a broadcast hint if its rows fit in ``limit`` bytes, else as it is.

    Beyond the limit the join is a shuffle join, whose skewed partitions AQE splits.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def words_of(lowered: Column) -> Column:
    """Words of a lower-cased text as an array."""
    return F.array_remove(F.split(lowered, WORD_GAP), "")

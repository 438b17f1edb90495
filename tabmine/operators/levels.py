"""Learned level tables (F3/F4): (column, level, code), kept as a table and joined.

A level seen at least ``min_freq`` times is itself; rarer ones pool into one
level, and null is a level like any other. A level's code is its place among its
column's pooled levels in byte order; what training never saw takes the rare
level's code, or the place after the last where nothing was rare. Tables are
sorted by range, so neither one task nor the driver holds a column's levels,
and are broadcast only while their counted bytes stay below a bound. A column
with more than ``slots`` levels is coded by hash instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabmine.session import materialize

MISSING = "__missing__"
INFREQUENT = "__infrequent__"
UNSEEN = "__unseen__"
#: Level tables up to this many bytes are broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def level_of(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit(MISSING))


@dataclass(frozen=True)
class ColumnLevels:
    """What the driver keeps of a column: its pooled levels' number, bytes and digest, and the rare level's code."""
    n: int = 0
    octets: int = 0
    digest: int = 0
    rare: int | None = None
    hashed: bool = False


@dataclass
class Levels:
    """``table`` (column, level, code) and a few numbers per column; equal if the levels are."""
    table: DataFrame = field(compare=False)
    columns: dict[str, ColumnLevels] = field(default_factory=dict)
    slots: int = 1 << 18

    def width(self, col: str) -> int:
        """Codes a column can have."""
        c = self.columns[col]
        return self.slots if c.hashed else c.n + (c.rare is None)

    def attach(self, df: DataFrame, code: str = "_ix", level: str | None = None) -> DataFrame:
        """``df`` with every column's code (double, nominal) and, if asked for, its pooled level."""
        for col, c in self.columns.items():
            v = level_of(col)
            if c.hashed:
                ix, name = F.pmod(F.xxhash64(v), F.lit(self.slots)), v
            else:
                t = self.table.where(F.col("column") == col).select(
                    F.col("level").alias("__level"), F.col("code").alias("__code"))
                t = F.broadcast(t) if c.octets + 16 * c.n <= BROADCAST_BYTES else t
                df = df.withColumn("__v", v).join(t, F.col("__v") == F.col("__level"), "left")
                other = c.n if c.rare is None else c.rare
                ix = F.coalesce("__code", F.lit(other))
                name = F.coalesce("__level", F.lit(UNSEEN if c.rare is None else INFREQUENT))
            attr = {"ml_attr": {"type": "nominal", "name": f"{col}{code}", "num_vals": self.width(col)}}
            df = df.withColumns({f"{col}{code}": ix.cast("double")} | ({f"{col}{level}": name} if level else {}))
            df = df.withMetadata(f"{col}{code}", attr).drop("__v", "__level", "__code")
        return df


def numbered(pooled: DataFrame) -> DataFrame:
    """(column, level, code, octets) of distinct (column, level): code counts from 0 per column in byte order.

    Sorted by range and staged; a partition's first place per column comes from
    the counts of those before it, at most a row per column and partition.
    """
    t = materialize(pooled.repartitionByRange("column", "level").sortWithinPartitions("column", "level")
                    .withColumns({"__p": F.spark_partition_id(), "__i": F.monotonically_increasing_id()}), "levels-sorted")
    per = t.groupBy("column", "__p").agg(F.count(F.lit(1)).alias("__n"), F.min("__i").alias("__first"))
    upto = Window.partitionBy("column").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("__before", F.coalesce(F.sum("__n").over(upto), F.lit(0))).drop("__n")
    return t.join(per, ["column", "__p"]).select(
        "column", "level", (F.col("__before") + F.col("__i") - F.col("__first")).alias("code"))


def fit_levels(df: DataFrame, cols: Sequence[str], min_freq: int, slots: int = 1 << 18) -> Levels:
    """Levels of ``cols`` learned from ``df``; a column without rows has none.

    All columns in one pass: unpivot, count, pool. A value that reads like a
    reserved level (missing, infrequent) shares that level.
    """
    spark = df.sparkSession
    if not cols:
        return Levels(spark.createDataFrame([], "column string, level string, code long"), {}, slots)
    lv = df.select(*[level_of(c).alias(c) for c in cols]).unpivot([], list(cols), "column", "level")
    n = lv.groupBy("column", "level").agg(F.count(F.lit(1)).alias("n"))
    pooled = n.select("column", F.when(F.col("n") >= min_freq, F.col("level")).otherwise(INFREQUENT).alias("level")).distinct()
    table = materialize(numbered(pooled), "levels")
    row = F.xxhash64("level", "code").cast("decimal(38,0)")
    got = {r["column"]: ColumnLevels(r["n"], r["octets"], int(r["digest"]), r["rare"], r["n"] > slots)
           for r in table.groupBy("column").agg(
               F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("level")).alias("octets"), F.sum(row).alias("digest"),
               F.max(F.when(F.col("level") == INFREQUENT, F.col("code"))).alias("rare")).collect()}
    return Levels(table, {c: got.get(c, ColumnLevels()) for c in cols}, slots)

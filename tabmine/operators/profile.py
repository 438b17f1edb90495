"""Profiling aggregates.

Whole-table profiles are single aggregates over all columns (one scan), then
unpivoted to long form. Quantiles/medians go through ``exact_quantiles``
(distributed, no per-group value map on one reducer). Only one-row scalars
(totals, min/max) ever reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmine.operators.ranks import exact_quantiles
from tabmine.session import materialize


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A1: null count and missing % per column (one aggregate)."""
    cols = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"nulls__{c}") for c in cols])
    st = F.inline(F.array(*[F.struct(F.lit(c).alias("column"),
                                     F.col(f"nulls__{c}").cast("bigint").alias("null_count"))
                            for c in cols]))
    return agg.select("_n", st).select(
        "column", "null_count",
        F.round(F.col("null_count") * 100.0 / F.col("_n"), 6).alias("missing_pct"))


def schema_profile(df: DataFrame) -> DataFrame:
    """P10: dtype, non-null count and row count per column."""
    cols = df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(f"nn__{c}") for c in cols])
    st = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                                     F.col(f"nn__{c}").cast("bigint").alias("non_null"))
                            for c in cols]))
    return agg.select(F.col("_n").cast("bigint").alias("n_rows"), st).select(
        "column", "dtype", "non_null", "n_rows")


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """A2: distinct non-null values per column (exact, or HLL++ when ``approx``)."""
    fn = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.countDistinct
    agg = df.agg(*[fn(F.col(c)).alias(f"d__{c}") for c in cols])
    st = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"d__{c}").cast("bigint").alias("n_distinct"))
                            for c in cols]))
    return agg.select(st)


def to_long(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids..., column, value double) long form of numeric columns."""
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(ids), list(cols), "column", "value")


def describe_numeric(df: DataFrame, cols: Sequence[str], ndigits: int = 6) -> DataFrame:
    """A3: count, mean, sample std, min, exact quartiles, max per column."""
    lg = to_long(df, cols).where(F.col("value").isNotNull())
    base = lg.groupBy("column").agg(F.count(F.lit(1)).cast("bigint").alias("count"),
                                    F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                                    F.min("value").alias("min"), F.max("value").alias("max"))
    q = (exact_quantiles(lg, "value", [0.25, 0.5, 0.75], ["column"])
         .groupBy("column").pivot("q", [0.25, 0.5, 0.75]).agg(F.first("value")))
    q = q.toDF("column", "q25", "q50", "q75")
    r = lambda c: F.round(c, ndigits)
    return base.join(q, "column").select("column", "count", r(F.col("mean")).alias("mean"),
                                         r(F.col("std")).alias("std"), r(F.col("min")).alias("min"),
                                         r(F.col("q25")).alias("q25"), r(F.col("q50")).alias("q50"),
                                         r(F.col("q75")).alias("q75"), r(F.col("max")).alias("max"))


def value_counts(df: DataFrame, col: str, top: int | None = None, ndigits: int = 6) -> DataFrame:
    """Frequency table (nulls excluded), share of non-null rows.

    Ties in count are broken by value ascending; ``top`` keeps the first N
    (a distributed take-ordered, not a sort of everything on one task).
    """
    nn = df.where(F.col(col).isNotNull())
    total = nn.count()
    g = nn.groupBy(col).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    g = g.withColumn("share", F.round(F.col("n") / F.lit(float(total)), ndigits))
    if top is not None:
        g = g.orderBy(F.desc("n"), F.asc(col)).limit(top)
    return g


def top_keys(df: DataFrame, col: str, top: int) -> DataFrame:
    """The ``top`` most frequent non-null keys (a bounded, broadcastable set)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
              .orderBy(F.desc("_n"), F.asc(col)).limit(top).select(col))


def keep_top(df: DataFrame, col: str, top: int) -> DataFrame:
    """P5: semi-join against the top-N key set (N rows: broadcast by design)."""
    return df.join(F.broadcast(top_keys(df, col, top)), col, "left_semi")


def group_stats(df: DataFrame, key: str, value: str, median: bool = True, ndigits: int = 6) -> DataFrame:
    """Mean, count (and exact median) of ``value`` per non-null ``key``."""
    d = df.where(F.col(key).isNotNull())
    out = d.groupBy(key).agg(F.round(F.avg(value), ndigits).alias("mean"),
                             F.count(F.col(value)).cast("bigint").alias("count"))
    if median:
        m = exact_quantiles(d, value, [0.5], [key]).select(key, F.round(value, ndigits).alias("median"))
        out = out.join(m, key, "left")
    return out


def group_medians(df: DataFrame, groups: Sequence[str], cols: Sequence[str], ndigits: int = 6) -> DataFrame:
    """Exact medians of several columns per group in one distributed pass.

    Long form (groups..., column, median).
    """
    lg = to_long(df, cols, groups)
    m = exact_quantiles(lg, "value", [0.5], [*groups, "column"])
    return m.select(*groups, "column", F.round("value", ndigits).alias("median"))


def box_stats(df: DataFrame, group: str, value: str, ndigits: int = 6) -> DataFrame:
    """Quartiles, 1.5·IQR whiskers and outlier count per group.

    Whiskers are the most extreme values inside the fences. Rows are counted per
    (group, value) first, so quartiles come from the counts and a hot group
    meets its fences as one row per distinct value.
    """
    d = df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
    d = materialize(d.groupBy(group, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n")), "box-counts")
    q = (exact_quantiles(d, "_v", [0.25, 0.5, 0.75], [group], weight="_n")
         .groupBy(group).pivot("q", [0.25, 0.5, 0.75]).agg(F.first("_v")))
    q = q.toDF(group, "q1", "median", "q3")
    lo_f = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi_f = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    j = d.join(q, group)
    inside = (F.col("_v") >= lo_f) & (F.col("_v") <= hi_f)
    r = lambda c: F.round(c, ndigits)
    return j.groupBy(group).agg(
        F.sum("_n").cast("bigint").alias("n"),
        r(F.first("q1")).alias("q1"), r(F.first("median")).alias("median"), r(F.first("q3")).alias("q3"),
        r(F.min(F.when(inside, F.col("_v")))).alias("whisker_lo"),
        r(F.max(F.when(inside, F.col("_v")))).alias("whisker_hi"),
        F.sum(F.when(inside, 0).otherwise(F.col("_n"))).cast("bigint").alias("n_outliers"))


def histogram(df: DataFrame, col, bins: int, lo: float | None = None, hi: float | None = None,
              ndigits: int = 6) -> DataFrame:
    """Equal-width histogram; last bin closed; values outside [lo, hi]
    are dropped. Without bounds, min/max of the data are used (one scalar job).
    Columns: bin, bin_lo, bin_hi, n (empty bins omitted).
    """
    x = F.col(col) if isinstance(col, str) else col
    d = df.select(x.cast("double").alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    if lo is None or hi is None:
        mm = d.agg(F.min("_x").alias("a"), F.max("_x").alias("b")).first()
        lo = mm["a"] if lo is None else lo
        hi = mm["b"] if hi is None else hi
        if lo is None:
            lo, hi = 0.0, 1.0
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
    lo, hi = float(lo), float(hi)
    w = (hi - lo) / bins
    d = d.where((F.col("_x") >= F.lit(lo)) & (F.col("_x") <= F.lit(hi)))
    b = F.least(F.floor((F.col("_x") - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo)), F.lit(bins - 1))
    g = d.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return g.select("bin", F.round(F.lit(lo) + F.col("bin") * F.lit(w), ndigits).alias("bin_lo"),
                    F.round(F.lit(lo) + (F.col("bin") + 1) * F.lit(w), ndigits).alias("bin_hi"), "n")


def hexbin_counts(df: DataFrame, x: str, y: str, gridsize: int = 40, ndigits: int = 6) -> DataFrame:
    """Hexagonal 2-D density (two offset lattices, nearest centre).

    Same cell geometry as the usual plotting hexbin: ``nx = gridsize``,
    ``ny = int(nx / sqrt(3))``, x range padded by 1e-9 of its width. Only
    non-empty cells are returned (min count 1) with log10 of the count.
    Columns: lattice, ix, iy, n, log10_n, x_center, y_center.
    """
    d = df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).where(
        F.col("_x").isNotNull() & F.col("_y").isNotNull())
    mm = d.agg(F.min("_x").alias("x0"), F.max("_x").alias("x1"),
               F.min("_y").alias("y0"), F.max("_y").alias("y1")).first()
    nx = gridsize
    ny = int(nx / math.sqrt(3))
    x0, x1, y0, y1 = mm["x0"], mm["x1"], mm["y0"], mm["y1"]
    if x0 is None:
        return d.sparkSession.createDataFrame([], T.StructType([
            T.StructField("lattice", T.IntegerType()), T.StructField("ix", T.IntegerType()),
            T.StructField("iy", T.IntegerType()), T.StructField("n", T.LongType()),
            T.StructField("log10_n", T.DoubleType()), T.StructField("x_center", T.DoubleType()),
            T.StructField("y_center", T.DoubleType())]))
    if x0 == x1:
        x0, x1 = x0 - 0.1 * abs(x0 or 1), x1 + 0.1 * abs(x1 or 1)
    if y0 == y1:
        y0, y1 = y0 - 0.1 * abs(y0 or 1), y1 + 0.1 * abs(y1 or 1)
    pad = 1e-9 * (x1 - x0)
    x0, x1 = x0 - pad, x1 + pad
    sx, sy = (x1 - x0) / nx, (y1 - y0) / ny
    ixf = (F.col("_x") - F.lit(x0)) / F.lit(sx)
    iyf = (F.col("_y") - F.lit(y0)) / F.lit(sy)
    c = d.select(ixf.alias("fx"), iyf.alias("fy"))
    c = c.select("fx", "fy", F.bround("fx", 0).cast("int").alias("ix1"), F.bround("fy", 0).cast("int").alias("iy1"),
                 F.floor("fx").cast("int").alias("ix2"), F.floor("fy").cast("int").alias("iy2"))
    d1 = (F.col("fx") - F.col("ix1")) ** 2 + 3.0 * (F.col("fy") - F.col("iy1")) ** 2
    d2 = (F.col("fx") - F.col("ix2") - 0.5) ** 2 + 3.0 * (F.col("fy") - F.col("iy2") - 0.5) ** 2
    first = d1 < d2
    cell = c.select(F.when(first, 1).otherwise(2).alias("lattice"),
                    F.when(first, F.col("ix1")).otherwise(F.col("ix2")).alias("ix"),
                    F.when(first, F.col("iy1")).otherwise(F.col("iy2")).alias("iy"))
    g = cell.groupBy("lattice", "ix", "iy").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    off = F.when(F.col("lattice") == 2, 0.5).otherwise(0.0)
    return g.select("lattice", "ix", "iy", "n", F.round(F.log10("n"), ndigits).alias("log10_n"),
                    F.round(F.lit(x0) + (F.col("ix") + off) * F.lit(sx), ndigits).alias("x_center"),
                    F.round(F.lit(y0) + (F.col("iy") + off) * F.lit(sy), ndigits).alias("y_center"))

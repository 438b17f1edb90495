"""Distributed prefix sums over sorted values (T3) and what builds on them.

``prefix_by_value`` never orders all rows in one partition:

1. aggregate the input to distinct ``(groups, value)`` rows (partial+final
   hash aggregate: a hot value or group collapses map-side);
2. cut the value axis into ``parts`` ranges with ``percentile_approx`` (a
   bounded sketch);
3. per ``(groups, bucket)`` totals -> offsets (a table of at most
   ``groups x parts`` rows; without groups it is read on the driver);
4. running sums inside ``partitionBy(groups, bucket)`` windows plus the
   bucket offset.

A group holding a third of all rows is still spread over ``parts`` tasks.
Ranks, exact interpolated quantiles, ROC/PR cumulatives and AUC all use it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def default_parts(df: DataFrame) -> int:
    """As many value buckets as shuffle partitions, which grow with the cluster."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def _bucket_of(v: Column, cuts: list[float]) -> Column:
    """Number of cut points strictly below ``v``, by bisection in a sorted literal array."""
    if not cuts:
        return F.lit(0)
    held = F.array(*[F.lit(float(c)) for c in cuts])
    strides = F.array(*[F.lit(1 << k) for k in range(len(cuts).bit_length() - 1, -1, -1)])
    return F.aggregate(strides, F.lit(0), lambda at, step: F.when(
        F.coalesce(F.get(held, at + step - 1) < v.cast("double"), F.lit(False)), at + step).otherwise(at))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null; the left side's keys stay."""
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(r[f"_r_{k}"])
    return left.join(r, on, how).drop(*[f"_r_{k}" for k in keys])


def value_cuts(df: DataFrame, value: str, parts: int) -> list[float]:
    """Approximate equi-depth cut points of ``value`` (driver gets <= parts numbers)."""
    if parts <= 1:
        return []
    fr = [i / parts for i in range(1, parts)]
    row = df.select(F.percentile_approx(F.col(value).cast("double"), fr, 10000).alias("c")).first()
    return sorted(set(x for x in (row["c"] or []) if x is not None))


def prefix_by_value(df: DataFrame, value: str, measures: Sequence[str], groups: Sequence[str] = (),
                    parts: int | None = None, pre_aggregated: bool = False,
                    totals_out: dict | None = None) -> DataFrame:
    """For every distinct ``(groups, value)``: the measure sums at that value,
    ``<m>_before`` (sum over strictly smaller values in the group) and
    ``<m>_total`` (group total). Null values are ignored.

    ``parts=1`` skips value bucketing: only for groups of a known small size.
    A null group is a group. Without groups the measure totals are also written
    into ``totals_out`` (driver scalars).
    """
    groups, measures = list(groups), list(measures)
    parts = parts or default_parts(df)
    src = df.where(F.col(value).isNotNull())
    agg = src if pre_aggregated else src.groupBy(*groups, value).agg(
        *[F.sum(m).alias(m) for m in measures])
    cuts = value_cuts(agg, value, parts)
    b = agg.withColumn("_bkt", _bucket_of(F.col(value), cuts))
    w_local = (Window.partitionBy(*groups, "_bkt").orderBy(value)
               .rowsBetween(Window.unboundedPreceding, -1))
    local = b.select(*groups, value, "_bkt", *measures,
                     *[F.coalesce(F.sum(m).over(w_local), F.lit(0)).alias(f"_l_{m}") for m in measures])
    tot = b.groupBy(*groups, "_bkt").agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    if not groups:
        # at most `parts` rows: offsets become literals
        rows = sorted(tot.collect(), key=lambda r: r["_bkt"])
        offs = {m: {} for m in measures}
        totals = {}
        for m in measures:
            run = 0
            for r in rows:
                offs[m][r["_bkt"]] = run
                run += r[f"_t_{m}"] or 0
            totals[m] = run
        if totals_out is not None:
            totals_out.update(totals)
        out = local
        for m in measures:
            if offs[m]:
                by_place = F.array(*[F.lit(offs[m].get(k, 0)) for k in range(max(offs[m]) + 1)])
                off = F.get(by_place, F.col("_bkt"))
            else:
                off = F.lit(0)
            out = (out.withColumn(f"{m}_before", F.col(f"_l_{m}") + off)
                      .withColumn(f"{m}_total", F.lit(totals[m])))
    else:
        wg = Window.partitionBy(*groups).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
        wall = Window.partitionBy(*groups)
        offs = tot.select(*groups, "_bkt",
                          *[F.coalesce(F.sum(f"_t_{m}").over(wg), F.lit(0)).alias(f"_o_{m}") for m in measures],
                          *[F.sum(f"_t_{m}").over(wall).alias(f"{m}_total") for m in measures])
        out = null_safe_join(local, offs, [*groups, "_bkt"])
        for m in measures:
            out = out.withColumn(f"{m}_before", F.col(f"_l_{m}") + F.col(f"_o_{m}"))
    keep = [*groups, value, *measures, *[f"{m}_before" for m in measures], *[f"{m}_total" for m in measures]]
    return out.select(*keep)


def value_ranks(df: DataFrame, value: str, groups: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """Average rank (ties share the mean of their positions) per distinct value.

    Columns: groups..., value, cnt, rank, n.
    """
    pre = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("cnt"))
    pf = prefix_by_value(pre, value, ["cnt"], groups, parts, pre_aggregated=True)
    return pf.select(*groups, value, "cnt",
                     (F.col("cnt_before") + (F.col("cnt") + 1) / 2.0).alias("rank"),
                     F.col("cnt_total").alias("n"))


def attach_ranks(df: DataFrame, value: str, out_col: str, groups: Sequence[str] = (),
                 parts: int | None = None) -> DataFrame:
    """Row-level average rank: join each row to the rank of its value."""
    r = value_ranks(df, value, groups, parts).select(*groups, value, F.col("rank").alias(out_col))
    return df.join(r, [*groups, value], "left")


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], groups: Sequence[str] = (),
                    parts: int | None = None, weight: str | None = None) -> DataFrame:
    """Linear-interpolation quantiles (NumPy's default), exact and distributed.

    Position ``q*(n-1)`` is located in the cumulative count of distinct values;
    only the <= 2 bracketing values per (group, q) reach the final aggregate.
    Columns: groups..., q, <value>.
    """
    qs = [float(q) for q in qs]
    w = F.lit(1) if weight is None else F.col(weight)
    pre = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.sum(w).alias("cnt"))
    pf = prefix_by_value(pre, value, ["cnt"], groups, parts, pre_aggregated=True)
    n1 = F.col("cnt_total") - 1
    lo_hi = []
    for q in qs:
        pos = F.lit(q) * n1
        lo, hi = F.floor(pos), F.ceil(pos)
        inside = lambda j: (F.col("cnt_before") <= j) & (j < F.col("cnt_before") + F.col("cnt"))
        lo_hi.append(F.struct(F.lit(q).alias("q"), inside(lo).alias("is_lo"), inside(hi).alias("is_hi"),
                              (pos - lo).alias("frac")))
    hits = (pf.select(*groups, F.col(value).cast("double").alias("_v"),
                      F.explode(F.filter(F.array(*lo_hi), lambda s: s["is_lo"] | s["is_hi"])).alias("h"))
              .select(*groups, "_v", "h.*"))
    res = hits.groupBy(*groups, "q").agg(F.max(F.when(F.col("is_lo"), F.col("_v"))).alias("_lo"),
                                         F.max(F.when(F.col("is_hi"), F.col("_v"))).alias("_hi"),
                                         F.max("frac").alias("_f"))
    return res.select(*groups, "q", (F.col("_lo") + F.col("_f") * (F.col("_hi") - F.col("_lo"))).alias(value))


def quantile_values(df: DataFrame, value: str, qs: Sequence[float], parts: int | None = None) -> list[float]:
    """Driver-side list of global exact quantiles (fitted constants such as a cap).

    The distinct-value table feeds three small jobs (cut points, bucket
    totals, bracketing values), so it is computed once and cached for them.
    """
    pre = (df.where(F.col(value).isNotNull()).groupBy(value)
             .agg(F.count(F.lit(1)).alias("_n")).persist())
    try:
        q = exact_quantiles(pre, value, qs, (), parts, weight="_n")
        rows = {r["q"]: r[value] for r in q.collect()}
    finally:
        pre.unpersist()
    return [rows.get(float(q)) for q in qs]


def exact_median(df: DataFrame, value: str, groups: Sequence[str] = (), alias: str | None = None,
                 parts: int | None = None) -> DataFrame:
    """Per-group interpolated median. Columns: groups..., alias."""
    m = exact_quantiles(df, value, [0.5], groups, parts)
    return m.select(*groups, F.col(value).alias(alias or f"{value}_median"))

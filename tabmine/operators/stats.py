"""Rank statistics (T1 Spearman, T2 Kruskal-Wallis) on average ranks.

Both reduce to aggregates over the distinct-value rank table from
``ranks.value_ranks`` — no row-level sort on one task. Tail probabilities
are columns of the result (``tails``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmine.operators.ranks import value_ranks
from tabmine.operators.tails import chi2_tail, t_tail


def _scalar(tail, *args: float) -> float:
    row = SparkSession.active().range(1).select(tail(*[F.lit(float(a)) for a in args]).alias("p")).first()
    return float("nan") if row["p"] is None else row["p"]


def t_two_sided_p(t: float, dof: float) -> float:
    """Two-sided tail of Student's t; 0 for an infinite t, NaN without degrees of freedom."""
    return float("nan") if t is None or math.isnan(t) else _scalar(t_tail, t, dof)


def chi2_sf(x: float, k: float) -> float:
    """Upper tail of chi-square with k degrees of freedom."""
    return float("nan") if x is None or math.isnan(x) else _scalar(chi2_tail, x, k)


# ---- Spearman ----

def spearman(df: DataFrame, x: str, y: str, parts: int | None = None) -> DataFrame:
    """Spearman rho on rows where both are present (average ranks for
    ties). Columns: n, rho, t_stat, p (two-sided, t with n - 2 degrees of freedom).

    Rows collapse to distinct (x, y) pairs with a weight first, so a hot pair
    is one row; the pairs are joined to the two distinct-value rank tables and
    rho is the weighted correlation of the centred ranks (mean (n+1)/2). rho is
    null if a column is constant, t_stat if rho is null or 1 or -1; p is 0 for the latter, and null
    for a null rho or under 3 rows.
    """
    d = df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).where(
        F.col("_x").isNotNull() & F.col("_y").isNotNull())
    pairs = d.groupBy("_x", "_y").agg(F.count(F.lit(1)).alias("w"))
    rx = value_ranks(d, "_x", parts=parts).select("_x", (F.col("rank") - (F.col("n") + 1) / 2.0).alias("_rx"))
    ry = value_ranks(d, "_y", parts=parts).select("_y", (F.col("rank") - (F.col("n") + 1) / 2.0).alias("_ry"))
    j = pairs.join(rx, "_x").join(ry, "_y")
    a = j.agg(F.sum("w").cast("bigint").alias("n"),
              F.sum(F.col("w") * F.col("_rx") * F.col("_ry")).alias("sxy"),
              F.sum(F.col("w") * F.col("_rx") ** 2).alias("sxx"),
              F.sum(F.col("w") * F.col("_ry") ** 2).alias("syy"))
    rho = F.try_divide(F.col("sxy"), F.sqrt(F.col("sxx") * F.col("syy")))
    return a.select("n", rho.alias("rho")).select(
        "n", "rho", (F.col("rho") * F.sqrt(F.try_divide((F.col("n") - 2).cast("double"), 1 - F.col("rho") ** 2))).alias("t_stat")
    ).withColumn("p", F.when((F.abs("rho") >= 1) & (F.col("n") > 2), 0.0).otherwise(t_tail(F.col("t_stat"), F.col("n") - 2)))


def spearman_p(row) -> float:
    """Two-sided p-value for a ``spearman`` result row (t with n-2 dof)."""
    n, rho = row["n"], row["rho"]
    if rho is None or n < 3:
        return float("nan")
    if abs(rho) >= 1:
        return 0.0
    t = rho * math.sqrt((n - 2) / (1 - rho * rho))
    return t_two_sided_p(t, n - 2)


# ---- Kruskal-Wallis ----

def kruskal(df: DataFrame, group: str, value: str, groups_subset: Sequence | None = None,
            parts: int | None = None) -> DataFrame:
    """Tie-corrected Kruskal-Wallis H over the non-null groups.

    Ranks are pooled over the rows of the kept groups only. Work: one
    aggregate to (group, value) counts, ranks of the distinct values, one
    join on value, then per-group rank sums. Columns: k, n, h, dof, p; h and p are null
    if all values are equal or no row is left, p with one group too.
    """
    d = df.select(F.col(group).alias("_g"), F.col(value).alias("_v"))
    group, value = "_g", "_v"
    d = d.where(F.col(group).isNotNull() & F.col(value).isNotNull())
    if groups_subset is not None:
        d = d.where(F.col(group).isin(list(groups_subset)))
    gv = d.groupBy(group, value).agg(F.count(F.lit(1)).alias("c"))
    vr = _weighted_ranks(gv, value, "c", parts)
    per_g = gv.join(vr, value).groupBy(group).agg(F.sum(F.col("c") * F.col("rank")).alias("r"),
                                                  F.sum("c").alias("ng"))
    # rank-sum part and tie part stacked, then one global aggregate (no join)
    parts_df = per_g.select((F.col("r") ** 2 / F.col("ng")).alias("s"), F.lit(1).alias("k"),
                            F.lit(0.0).alias("tie"), F.lit(0).cast("bigint").alias("n")).unionByName(
        vr.select(F.lit(0.0).alias("s"), F.lit(0).alias("k"),
                  (F.col("cnt").cast("double") ** 3 - F.col("cnt")).alias("tie"), F.col("cnt").cast("bigint").alias("n")))
    both = parts_df.agg(F.sum("s").alias("s"), F.sum("k").alias("k"), F.sum("tie").alias("tie"),
                        F.sum("n").cast("double").alias("n"))
    n = F.col("n")
    raw_h = F.try_divide(F.lit(12.0), n * (n + 1)) * F.col("s") - 3 * (n + 1)
    corr = 1 - F.try_divide(F.col("tie"), n ** 3 - n)
    return both.select(F.col("k").cast("bigint").alias("k"), n.cast("bigint").alias("n"),
                       F.try_divide(raw_h, corr).alias("h"), (F.col("k") - 1).cast("bigint").alias("dof")
                       ).withColumn("p", chi2_tail(F.col("h"), F.col("dof")))


def _weighted_ranks(gv: DataFrame, value: str, w: str, parts: int | None) -> DataFrame:
    from tabmine.operators.ranks import prefix_by_value
    v = gv.groupBy(value).agg(F.sum(w).alias("cnt"))
    pf = prefix_by_value(v, value, ["cnt"], (), parts, pre_aggregated=True)
    return pf.select(value, "cnt", (F.col("cnt_before") + (F.col("cnt") + 1) / 2.0).alias("rank"))


def kruskal_p(row) -> float:
    return chi2_sf(row["h"], row["dof"]) if row["h"] is not None else float("nan")

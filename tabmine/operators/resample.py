"""Bootstrap confidence intervals (E15, E16) as one Spark job each.

``mode="exact"`` reproduces "B resamples of size n with replacement": draw
``i`` of replicate ``r`` picks row ``md5(r-i-seed) mod n`` of a dense row
index. Draws are generated with ``spark.range(B*n)``, packed, and counted by
blocks of rows (``draw_boot``): a row of a shuffle holds thousands of draws, or
one score's B counts.

``mode="poisson"`` (the scalable default for very large n) gives each
(row, rep) an independent Poisson(1) multiplicity from a hash — no draw
table and no join, each row is expanded to B weights locally.

The dense index comes from distributed ranks of the ids (no single-task
``row_number``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmine.functions.hashing import hash_int, hash_unit
from tabmine.operators.metrics import binary_metrics, roc_auc, score_cumulatives
from tabmine.operators.ranks import exact_quantiles, prefix_by_value
from tabmine.session import materialize


def dense_index(df: DataFrame, id_col: str = "row_id", parts: int | None = None) -> tuple[DataFrame, int]:
    """(id, idx 0..n-1) ordered by id, plus n (from the bucket totals)."""
    ids = df.select(id_col).distinct().withColumn("_one", F.lit(1))
    tot: dict = {}
    pf = prefix_by_value(ids, id_col, ["_one"], (), parts, pre_aggregated=True, totals_out=tot)
    return pf.select(id_col, F.col("_one_before").cast("bigint").alias("idx")), int(tot.get("_one", 0))


def _poisson1_inverse(u) -> F.Column:
    """Poisson(1) quantile of a uniform ``u`` (CDF thresholds up to k = 15)."""
    cdf, term, expr = 0.0, math.exp(-1.0), None
    for k in range(16):
        cdf += term
        term /= (k + 1)
        cond = u < F.lit(cdf)
        expr = F.when(cond, F.lit(k)) if expr is None else expr.when(cond, F.lit(k))
    return expr.otherwise(F.lit(16))


def replicate_weights(scores: DataFrame, B: int, seed: int = 42, id_col: str = "row_id",
                      mode: str = "exact") -> DataFrame:
    """scores + (rep, w): row multiplicity in each bootstrap replicate (w > 0)."""
    spark = scores.sparkSession
    if mode == "poisson":
        x = scores.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(B - 1))))
        x = x.withColumn("w", _poisson1_inverse(hash_unit(F.col("rep"), F.col(id_col), F.lit(seed))))
        return x.where(F.col("w") > 0)
    # the scores feed the index jobs and the final join: compute them once
    scores = materialize(scores, "boot-scores")
    idx, n = dense_index(scores, id_col)
    idx = materialize(idx, "boot-index")
    draws = (spark.range(B * n)
             .select(F.expr(f"id div {n}").alias("rep"), F.expr(f"id % {n}").alias("i"))
             .select("rep", (hash_int(F.col("rep"), F.col("i"), F.lit(seed)) % F.lit(n)).alias("idx"))
             .groupBy("rep", "idx").agg(F.count(F.lit(1)).alias("w")))
    rows = scores.join(idx, id_col)
    return rows.join(draws, "idx").drop("idx")


def replicate_metrics(scores: DataFrame, B: int, seed: int, model_col: str, id_col: str, mode: str) -> DataFrame:
    """(rep, model, roc_auc, f1) of each replicate."""
    if mode == "exact":
        from tabmine.operators.draw_boot import exact_replicates  # it builds on this module
        return materialize(exact_replicates(scores, B, seed, model_col, id_col), "boot-metrics")
    rw = replicate_weights(scores, B, seed, id_col, mode)
    g = ["rep", model_col]
    auc = roc_auc(rw, g, ndigits=None, cum=score_cumulatives(rw, g, weight="w"))
    return auc.join(binary_metrics(rw, g, ndigits=None, weight="w").select(*g, "f1"), g)


def _interval(vals: DataFrame, groups: Sequence[str], metric: str, alpha: float, ndigits: int) -> DataFrame:
    # B values per group: no value bucketing needed (parts=1)
    q = exact_quantiles(vals, metric, [alpha / 2, 1 - alpha / 2], groups, parts=1)
    q = q.groupBy(*groups).pivot("q", [alpha / 2, 1 - alpha / 2]).agg(F.first(metric))
    return q.toDF(*groups, "lo", "hi").select(*groups, F.round("lo", ndigits).alias("lo"),
                                              F.round("hi", ndigits).alias("hi"))


def bootstrap_ci(scores: DataFrame, B: int = 300, seed: int = 42, alpha: float = 0.05,
                 model_col: str = "model", id_col: str = "row_id", mode: str = "exact",
                 ndigits: int = 6) -> DataFrame:
    """Percentile intervals of AUC and F1 per model.

    Columns: model, metric, lo, hi.
    """
    g = ["rep", model_col]
    per_rep = replicate_metrics(scores, B, seed, model_col, id_col, mode).unpivot(g, ["roc_auc", "f1"], "metric", "value")
    return _interval(per_rep, [model_col, "metric"], "value", alpha, ndigits)


def bootstrap_paired(scores: DataFrame, model_a: str, model_b: str, B: int = 300, seed: int = 42,
                     alpha: float = 0.05, model_col: str = "model", id_col: str = "row_id",
                     mode: str = "exact", ndigits: int = 6) -> DataFrame:
    """Interval of AUC(a) - AUC(b) on the same resamples.

    Columns: model_a, model_b, lo, hi.
    """
    s = scores.where(F.col(model_col).isin(model_a, model_b))
    auc = replicate_metrics(s, B, seed, model_col, id_col, mode)
    diff = auc.groupBy("rep").agg(
        (F.max(F.when(F.col(model_col) == model_a, F.col("roc_auc")))
         - F.max(F.when(F.col(model_col) == model_b, F.col("roc_auc")))).alias("d"))
    diff = diff.withColumn("model_a", F.lit(model_a)).withColumn("model_b", F.lit(model_b))
    return _interval(diff, ["model_a", "model_b"], "d", alpha, ndigits)

"""Model evaluation on the long ``scores(groups..., y, p)`` table.

Every metric is computed for all groups (models, folds, bootstrap
replicates) in one pass: threshold metrics are conditional counts; ranking
metrics use per-score cumulative counts from ``prefix_by_value`` (no global
sort, a big group is spread over value buckets).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmine.operators.ranks import prefix_by_value


def _counts(scores: DataFrame, groups: Sequence[str], y: str, p: str, threshold: float,
            weight: str | None = None) -> DataFrame:
    pred = (F.col(p) >= F.lit(threshold))
    pos = F.col(y) == 1
    w = F.lit(1) if weight is None else F.col(weight)
    cnt = lambda cond: F.sum(F.when(cond, w).otherwise(0)).cast("bigint")
    return scores.groupBy(*groups).agg(
        cnt(pos & pred).alias("tp"), cnt(~pos & pred).alias("fp"),
        cnt(pos & ~pred).alias("fn"), cnt(~pos & ~pred).alias("tn"),
        (F.sum(w * (F.col(p) - F.col(y)) ** 2) / F.sum(w)).alias("brier"))


def binary_metrics(scores: DataFrame, groups: Sequence[str] = ("model",), y: str = "y", p: str = "p",
                   threshold: float = 0.5, ndigits: int | None = 6, weight: str | None = None) -> DataFrame:
    """Counts, accuracy, precision/recall/F1 (0 when undefined),
    MCC (0 when undefined) and Brier score at ``p >= threshold``."""
    c = _counts(scores, groups, y, p, threshold, weight)
    tp, fp, fn, tn = (F.col(k).cast("double") for k in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))
    mcc_den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    mcc = F.when(mcc_den > 0, (tp * tn - fp * fn) / mcc_den).otherwise(F.lit(0.0))
    r = (lambda e: F.round(e, ndigits)) if ndigits is not None else (lambda e: e)
    return c.select(*groups, "tp", "fp", "fn", "tn", r((tp + tn) / n).alias("accuracy"),
                    r(prec).alias("precision"), r(rec).alias("recall"), r(f1).alias("f1"),
                    r(mcc).alias("mcc"), r(F.col("brier")).alias("brier"))


def score_cumulatives(scores: DataFrame, groups: Sequence[str] = ("model",), y: str = "y", p: str = "p",
                      parts: int | None = None, weight: str | None = None) -> DataFrame:
    """Per (groups, distinct score): pos/neg at the score, before it (lower
    scores) and group totals — the table behind AUC, AP and both curves.
    ``weight`` counts a row that many times (bootstrap multiplicities)."""
    w = F.lit(1) if weight is None else F.col(weight)
    s = scores.select(*groups, F.col(p).alias("p"), (F.col(y) * w).cast("bigint").alias("pos"),
                      ((1 - F.col(y)) * w).cast("bigint").alias("neg"))
    return prefix_by_value(s, "p", ["pos", "neg"], groups, parts)


def roc_auc(scores: DataFrame, groups: Sequence[str] = ("model",), y: str = "y", p: str = "p",
            ndigits: int | None = 6, parts: int | None = None, cum: DataFrame | None = None) -> DataFrame:
    """ROC-AUC with ties counted half (Mann-Whitney); null with one class."""
    c = cum if cum is not None else score_cumulatives(scores, groups, y, p, parts)
    a = c.groupBy(*groups).agg(
        F.sum(F.col("pos") * (F.col("neg_before") + 0.5 * F.col("neg"))).alias("_u"),
        F.first("pos_total").alias("_P"), F.first("neg_total").alias("_N"))
    auc = F.try_divide(F.col("_u"), F.col("_P").cast("double") * F.col("_N"))
    return a.select(*groups, (F.round(auc, ndigits) if ndigits is not None else auc).alias("roc_auc"))


def average_precision(scores: DataFrame, groups: Sequence[str] = ("model",), y: str = "y", p: str = "p",
                      ndigits: int | None = 6, parts: int | None = None, cum: DataFrame | None = None) -> DataFrame:
    """Step-wise average precision: sum over thresholds of
    (recall gain) x (precision at that threshold)."""
    c = cum if cum is not None else score_cumulatives(scores, groups, y, p, parts)
    tp_at = F.col("pos_total") - F.col("pos_before")
    fp_at = F.col("neg_total") - F.col("neg_before")
    term = F.col("pos") / F.col("pos_total").cast("double") * (tp_at / (tp_at + fp_at).cast("double"))
    a = c.groupBy(*groups).agg(F.sum(F.when(F.col("pos_total") > 0, term)).alias("ap"))
    return a.select(*groups, (F.round("ap", ndigits) if ndigits is not None else F.col("ap")).alias("avg_precision"))


def curve_points(scores: DataFrame, groups: Sequence[str] = ("model",), y: str = "y", p: str = "p",
                 ndigits: int | None = 6, parts: int | None = None, cum: DataFrame | None = None) -> DataFrame:
    """One point per distinct threshold (predict positive at p >= t):
    tpr, fpr, precision and recall."""
    c = cum if cum is not None else score_cumulatives(scores, groups, y, p, parts)
    tp = (F.col("pos_total") - F.col("pos_before")).cast("double")
    fp = (F.col("neg_total") - F.col("neg_before")).cast("double")
    r = (lambda e: F.round(e, ndigits)) if ndigits is not None else (lambda e: e)
    return c.select(*groups, F.col("p").alias("threshold"),
                    r(F.try_divide(tp, F.col("pos_total").cast("double"))).alias("tpr"),
                    r(F.try_divide(fp, F.col("neg_total").cast("double"))).alias("fpr"),
                    r(tp / (tp + fp)).alias("precision"),
                    r(F.try_divide(tp, F.col("pos_total").cast("double"))).alias("recall"))


def operating_points(curve: DataFrame, groups: Sequence[str] = ("model",), max_fpr: float = 0.05,
                     recalls: Sequence[float] = (0.7, 0.8), ndigits: int = 6) -> DataFrame:
    """Best TPR with FPR <= max_fpr; best precision with recall >= r.

    ``curve`` comes from ``curve_points(..., ndigits=None)``: bounds hold for
    the unrounded rates, only the results are rounded.
    """
    best = lambda ok, c: F.round(F.max(F.when(ok, F.col(c))), ndigits)
    aggs = [best(F.col("fpr") <= F.lit(max_fpr), "tpr").alias("tpr_at_fpr")]
    for rc in recalls:
        tag = str(rc).replace("0.", "").replace(".", "")
        aggs.append(best(F.col("recall") >= F.lit(rc), "precision").alias(f"precision_at_recall_{tag}"))
    return curve.groupBy(*groups).agg(*aggs)


def confusion(scores: DataFrame, groups: Sequence[str] = ("model",), y: str = "y", p: str = "p",
              threshold: float = 0.5) -> DataFrame:
    """Dense 2x2 matrix in long form (groups..., y, pred, n)."""
    c = _counts(scores, groups, y, p, threshold)
    cells = F.inline(F.array(
        F.struct(F.lit(0).alias("y"), F.lit(0).alias("pred"), F.col("tn").alias("n")),
        F.struct(F.lit(0).alias("y"), F.lit(1).alias("pred"), F.col("fp").alias("n")),
        F.struct(F.lit(1).alias("y"), F.lit(0).alias("pred"), F.col("fn").alias("n")),
        F.struct(F.lit(1).alias("y"), F.lit(1).alias("pred"), F.col("tp").alias("n"))))
    return c.select(*groups, cells)


def calibration_edges(n_bins: int) -> list[float]:
    """Inner bin edges i * (1/n_bins), computed the way a uniform linspace is."""
    step = 1.0 / n_bins
    return [i * step for i in range(1, n_bins)]


def calibration(scores: DataFrame, groups: Sequence[str] = ("model",), y: str = "y", p: str = "p",
                n_bins: int = 10, ndigits: int = 6) -> DataFrame:
    """Uniform bins; a score on an edge goes to the lower bin; empty
    bins are absent. Columns: groups..., bin, n, mean_p, frac_pos."""
    b = sum((F.col(p) > F.lit(e)).cast("int") for e in calibration_edges(n_bins))
    return scores.groupBy(*groups, b.alias("bin")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.round(F.avg(p), ndigits).alias("mean_p"),
        F.round(F.avg(F.col(y).cast("double")), ndigits).alias("frac_pos"))


def leaderboard(scores: DataFrame, groups: Sequence[str] = ("model",), y: str = "y", p: str = "p",
                parts: int | None = None) -> DataFrame:
    """Every test metric per model (one cumulative table feeds AUC and AP)."""
    cum = score_cumulatives(scores, groups, y, p, parts)
    bm = binary_metrics(scores, groups, y, p).drop("tp", "fp", "fn", "tn")
    return (bm.join(roc_auc(scores, groups, cum=cum), list(groups))
              .join(average_precision(scores, groups, cum=cum), list(groups)))


def metric_deltas(board: DataFrame, pairs: Sequence[tuple[str, str]], metrics: Sequence[str],
                  key: str = "model", ndigits: int = 6) -> DataFrame:
    """Metric differences for named (a, b) model pairs.

    Each pair row meets exactly one row of each side (equi-joins on the model
    name), so no all-pairs product is formed.
    """
    spark = board.sparkSession
    pr = spark.createDataFrame(list(pairs), f"a string, b string")
    lg = board.select(key, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        [key], list(metrics), "metric", "value")
    a = lg.select(F.col(key).alias("a"), "metric", F.col("value").alias("va"))
    b = lg.select(F.col(key).alias("b"), "metric", F.col("value").alias("vb"))
    j = pr.join(a, "a").join(b, ["b", "metric"])
    return j.select("a", "b", "metric", F.round(F.col("va") - F.col("vb"), ndigits).alias("delta"))


def cv_test_gap(cv: DataFrame, test: DataFrame, metrics: Sequence[str], key: str = "model", ndigits: int = 6) -> DataFrame:
    """(model, metric, folds, cv_mean, test, gap): the folds' mean less the hold-out's value.

    ``cv`` has a row per model and fold, ``test`` one per model. A fold without
    the metric (one class only) does not count; a model that one side lacks has
    null there and in its gap.
    """
    long = lambda d: d.select(key, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        [key], list(metrics), "metric", "value")
    folds = long(cv).groupBy(key, "metric").agg(F.count("value").alias("folds"), F.round(F.avg("value"), ndigits).alias("cv_mean"))
    j = folds.join(long(test).withColumnRenamed("value", "test"), [key, "metric"], "full")
    return j.select(key, "metric", F.coalesce("folds", F.lit(0)).cast("bigint").alias("folds"), "cv_mean", "test",
                    F.round(F.col("cv_mean") - F.col("test"), ndigits).alias("gap"))

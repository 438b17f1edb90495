import pytest
from pyspark.sql import functions as F

from fixtures import scores_df
from tabmine.operators.metrics import (average_precision, binary_metrics, calibration, confusion, cv_test_gap,
                                       curve_points, roc_auc)
from tabmine.operators.resample import bootstrap_ci


def test_threshold_metrics(spark):
    r = binary_metrics(scores_df(spark), ndigits=None).first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (3, 1, 1, 3)
    assert r["accuracy"] == r["precision"] == r["recall"] == r["f1"] == pytest.approx(0.75)
    assert r["mcc"] == pytest.approx(0.5)
    assert r["brier"] == pytest.approx(0.1478125)


def test_ranking_metrics(spark):
    s = scores_df(spark)
    assert roc_auc(s).first()["roc_auc"] == pytest.approx(0.84375)
    assert average_precision(s).first()["avg_precision"] == pytest.approx(0.854167, abs=1e-6)


def test_auc_symmetry_and_constant_score(spark):
    s = scores_df(spark)
    flipped = s.withColumn("p", 1 - F.col("p"))
    assert roc_auc(flipped).first()["roc_auc"] == pytest.approx(1 - 0.84375)
    const = s.withColumn("p", F.lit(0.3))
    assert roc_auc(const).first()["roc_auc"] == pytest.approx(0.5)
    assert average_precision(const).first()["avg_precision"] == pytest.approx(0.5)


def test_curve_points(spark):
    pts = {r["threshold"]: r for r in curve_points(scores_df(spark)).collect()}
    exp = {0.9: (.25, 0, 1), 0.8: (.5, 0, 1), 0.5: (.75, .25, .75), 0.4: (.75, .5, .6),
           0.35: (1, .5, .666667), 0.2: (1, .75, .571429), 0.1: (1, 1, .5)}
    for t, (tpr, fpr, prec) in exp.items():
        r = pts[t]
        assert (r["tpr"], r["fpr"]) == (pytest.approx(tpr), pytest.approx(fpr))
        assert r["precision"] == pytest.approx(prec, abs=1e-6)


def test_confusion_and_calibration(spark):
    c = {(r["y"], r["pred"]): r["n"] for r in confusion(scores_df(spark)).collect()}
    assert c == {(0, 0): 3, (0, 1): 1, (1, 0): 1, (1, 1): 3}
    cal = {r["bin"]: (r["n"], r["frac_pos"]) for r in calibration(scores_df(spark)).collect()}
    assert cal == {0: (1, 0.0), 1: (1, 0.0), 3: (2, 0.5), 4: (2, 0.5), 7: (1, 1.0), 8: (1, 1.0)}


def test_bootstrap_interval_contains_estimate(spark):
    s = scores_df(spark)
    for mode in ("exact", "poisson"):
        ci = {r["metric"]: r for r in bootstrap_ci(s, B=60, seed=7, mode=mode).collect()}
        assert ci["roc_auc"]["lo"] <= 0.84375 <= ci["roc_auc"]["hi"]
        assert ci["f1"]["lo"] <= ci["f1"]["hi"]


def test_cv_test_gap_counts_folds_and_keeps_one_sided_models(spark):
    cv = spark.createDataFrame([("a", 0.5), ("a", 0.7), ("a", None), ("b", 0.9)], "model string, roc_auc double")
    test = spark.createDataFrame([("a", 0.55), ("c", 0.4)], "model string, roc_auc double")
    got = {r.model: (r.folds, r.cv_mean, r.test, r.gap) for r in cv_test_gap(cv, test, ["roc_auc"]).collect()}
    assert got == {"a": (2, 0.6, 0.55, 0.05), "b": (1, 0.9, None, None), "c": (0, None, 0.4, None)}

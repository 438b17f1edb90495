"""Nested stacking: inner folds, and a leak that would show."""

from pyspark.sql import functions as F

from tabmine.functions.hashing import hash_unit
from tabmine.operators.metrics import roc_auc
from tabmine.operators.models import Candidate, logistic, tree
from tabmine.operators.tune import best_params, grid_search, nested_folds, nested_stacking
from tabmine.spec import FeatureSpec

SPEC = FeatureSpec(num=("noise", "part"), bin=(), cat=(), text=None, target="y", id_col="row_id")


def noise(spark, n=160):
    """Labels without any relation to the features, but features that tell every row from every other."""
    df = spark.range(n).withColumnRenamed("id", "row_id")
    return df.select("row_id", hash_unit(F.col("row_id"), F.lit(1)).alias("noise"), hash_unit(F.col("row_id"), F.lit(5)).alias("part"),
                     (F.col("row_id") % 2).cast("int").alias("y"))


def test_inner_folds_leave_the_held_out_fold_alone(spark):
    rows = nested_folds(noise(spark, 203), "y", 4, 3).collect()
    for i in range(4):
        assert all((r["inner"][i] is None) == (r.fold == i) for r in rows)
        for y in (0, 1):  # stratified, and as even as can be
            sizes = [sum(r["inner"][i] == j and r.y == y for r in rows) for j in range(3)]
            assert max(sizes) - min(sizes) <= 1
    assert len({r.row_id for r in rows}) == 203


def test_a_memorising_base_gains_nothing(spark):
    """A deep tree knows its training rows by heart: were a held-out row in any fit, the AUC would be near 1."""
    bases = [Candidate("memory", "tree", tree(depth=12, min_leaf=1)), Candidate("lr", "linear", logistic(1.0, 50))]
    df = noise(spark)
    scores = nested_stacking(bases, df, SPEC, k=3, inner_k=2, min_freq=1)
    n = {r["model"]: r["n"] for r in scores.groupBy("model").agg(F.countDistinct("row_id").alias("n")).collect()}
    assert n == {"stacking": 160, "memory": 160, "lr": 160} and scores.count() == 480
    auc = {r["model"]: r["roc_auc"] for r in roc_auc(scores, ["model"]).collect()}
    assert all(0.3 < a < 0.7 for a in auc.values()), auc
    from tabmine.operators.models import fit_candidate
    inside = roc_auc(fit_candidate(bases[0], df, SPEC, 1).score(df), ["model"]).first()["roc_auc"]
    assert inside > 0.9  # what a leak would look like


def test_grid_has_one_best_point(spark):
    df = noise(spark).withColumn("noise", F.col("y") + F.col("noise"))
    grid = [{"depth": 1}, {"depth": 3}, {"depth": 3}]
    res = grid_search("t", lambda depth: Candidate("t", "tree", tree(depth=depth, min_leaf=1)), grid[:2], df, SPEC, 2, 1)
    rows = res.collect()
    assert sorted(r.params for r in rows) == ["depth=1", "depth=3"] and sum(r.best for r in rows) == 1
    top = max(rows, key=lambda r: r.cv_auc)
    assert best_params(res, grid[:2]) == {"depth": int([r for r in rows if r.best][0].params[-1])}
    assert [r for r in rows if r.best][0].cv_auc == top.cv_auc


def test_unread_texts_are_not_staged_with_the_folds(spark, monkeypatch):
    from dataclasses import replace

    from tabmine.operators import tune
    seen, own = [], tune.materialize
    monkeypatch.setattr(tune, "materialize", lambda df, name: (seen.extend(df.columns), own(df, name))[1])
    bases = [Candidate("lr", "linear", logistic(1.0, 5)), Candidate("tree", "tree", tree(depth=2, min_leaf=1))]
    df = noise(spark, 60).withColumn("words", F.lit("long text"))
    scores = nested_stacking(bases, df, replace(SPEC, text="words"), k=2, inner_k=2, min_freq=1)
    assert "words" not in seen and "noise" in seen and scores.count() == 180

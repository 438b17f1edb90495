"""Trained models, clustering and explanation: planted signals and brute force."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabmine.operators.cluster import as_vector, kmeans_best, pca_2d, silhouette_all, silhouette_sample, top_level
from tabmine.operators.explain import permutation_importance
from tabmine.operators.metrics import operating_points, roc_auc
from tabmine.operators.models import Candidate, fit_candidate, load_fitted, logistic
from tabmine.operators.tune import cross_validate
from tabmine.session import ensure_checkpoint_dir
from tabmine.spec import FeatureSpec

SPEC = FeatureSpec(num=("a", "b"), bin=("d",), cat=("c",), text="t", target="y", id_col="row_id")


@pytest.fixture(scope="module")
def planted(spark):
    """400 rows whose label follows ``a``; ``b``, ``c`` and ``d`` are noise."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        a, b = map(float, rng.normal(size=2))
        y = int(rng.random() < 1 / (1 + np.exp(-3 * a)))
        word = "ripe" if rng.random() < 0.2 + 0.6 * y else "thin"
        rows.append((i, a, None if i % 50 == 0 else b, i % 2, "uvw"[i % 3], f"{word} notes number {i % 7}", y))
    return spark.createDataFrame(rows, "row_id long, a double, b double, d int, c string, t string, y int").cache()


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(9)
    centres = np.array([[0, 0, 0], [6, 0, 1], [0, 7, 2]])
    v = np.concatenate([rng.normal(c, 1, (40, 3)) for c in centres] + [[[30.0, 30, 30]]])
    lab = [*np.repeat([0, 1, 2], 40).tolist(), 3]  # the last cluster has one point
    df = spark.createDataFrame([(i, x.tolist(), float(k)) for i, (x, k) in enumerate(zip(v, lab))],
                               "row_id long, v array<double>, k double")
    return as_vector(df, "v").cache(), v, np.array(lab)


def brute_silhouette(d, lab):
    out = []
    for i, own in enumerate(lab):
        same = (lab == own) & (np.arange(len(lab)) != i)
        if not same.any():
            out.append(0.0)
            continue
        a, b = d[i, same].mean(), min(d[i, lab == k].mean() for k in set(lab) - {own})
        out.append((b - a) / max(a, b))
    return np.mean(out)


def test_silhouettes_match_brute_force(points):
    df, v, lab = points
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    r = silhouette_sample(df, "v", "k").first()
    assert r["n"] == len(v) and r["silhouette"] == pytest.approx(brute_silhouette(d, lab), abs=1e-9)
    assert silhouette_all(df, "features", "k") == pytest.approx(brute_silhouette(d ** 2, lab), abs=1e-9)
    with pytest.raises(ValueError):
        silhouette_sample(df, "v", "k", max_rows=100)


def test_silhouette_by_blocks_is_that_of_one_block(spark, points):
    df, v, lab = points
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    for rows in (7, 64):
        got = silhouette_sample(df, "v", "k", block_rows=rows).first()
        assert got["n"] == len(v) and got["silhouette"] == pytest.approx(brute_silhouette(d, lab), abs=1e-9)
    empty = silhouette_sample(df.limit(0), "v", "k").first()
    assert empty["n"] == 0 and empty["silhouette"] is None


def test_kmeans_cost_falls_with_k_and_is_that_of_its_assignment(points):
    df, v, _ = points
    costs = []
    for k in (2, 3, 4):
        m = kmeans_best(df, k, 5)
        at = [r["cluster"] for r in m.transform(df).orderBy("row_id").collect()]
        costs.append(m.summary.trainingCost)
        assert costs[-1] == pytest.approx(((v - np.array(m.clusterCenters())[at]) ** 2).sum(), rel=1e-9)
    assert costs == sorted(costs, reverse=True)


def test_pca_projects_every_row(points):
    df, v, _ = points
    ev, proj = pca_2d(df, df)
    val, vec = np.linalg.eigh(np.cov(v.T))
    assert ev == pytest.approx((val[::-1] / val.sum())[:2])
    got = np.array([[r["pc1"], r["pc2"]] for r in proj.orderBy("row_id").collect()])
    assert np.abs(got) == pytest.approx(np.abs(v @ vec[:, ::-1][:, :2]), abs=1e-9)


def test_top_level_takes_the_smallest_on_ties_and_no_nulls(spark):
    df = spark.createDataFrame([(0, "b"), (0, "a"), (0, None), (0, None), (0, None), (1, "x"), (1, "x"), (1, "a")],
                               "g int, v string")
    assert {r["g"]: r["v"] for r in top_level(df, "g", "v", "v").collect()} == {0: "a", 1: "x"}


def test_logistic_finds_the_planted_signal_at_its_optimum(planted):
    m = fit_candidate(Candidate("lr", "linear", logistic(1.0, 1000)), planted, SPEC, 20)
    s = m.score(planted)
    assert roc_auc(s).first()["roc_auc"] > 0.85
    x = m.prep.transform(planted).join(s.select("row_id", "p"), "row_id")
    rows = x.select("y", "p", vector_to_array("features").alias("f")).collect()
    f, r = np.array([q["f"] for q in rows]), np.array([q["p"] - q["y"] for q in rows])
    grad = f.T @ r / len(rows) + m.model.coefficients.toArray() / len(rows)
    assert np.abs(grad).max() < 1e-3 and abs(r.mean()) < 1e-3


def test_every_row_is_held_out_once_and_beats_the_baseline(planted):
    scores, _ = cross_validate([Candidate("base", "baseline"), Candidate("lr", "linear", logistic(1.0, 200))],
                               planted, SPEC, 3, 20)
    n = scores.groupBy("model").agg(F.count("*").alias("n"), F.countDistinct("row_id").alias("ids"))
    assert {(r["n"], r["ids"]) for r in n.collect()} == {(400, 400)}
    auc = {r["model"]: r["roc_auc"] for r in roc_auc(scores).collect()}
    assert auc["base"] < 0.6 and auc["lr"] > 0.8


def test_importance_of_the_planted_column_only(planted):
    m = fit_candidate(Candidate("lr", "linear", logistic(1.0, 200)), planted, SPEC, 20)
    d = {r["feature"]: r["delta_auc"] for r in permutation_importance(m, planted, ["a", "b"], 2).collect()}
    assert d["a"] > 0.2 and abs(d["b"]) < 0.05


def test_text_model_scores_alike_after_reload(spark, planted):
    m = fit_candidate(Candidate("lr_text", "linear", logistic(1.0, 50), text=True), planted, SPEC, 20)
    path = m.save(ensure_checkpoint_dir(spark) + "/model-test")
    again = load_fitted(path)
    assert again.prep is not m.prep and again.name == m.name
    a, b = ({r["row_id"]: r["p"] for r in x.score(planted).collect()} for x in (m, again))
    assert a == b
    base = fit_candidate(Candidate("base", "baseline"), planted, SPEC)
    assert load_fitted(base.save(path + "-base")).const_p == base.const_p


def test_operating_points_hold_the_bound_unrounded(spark):
    curve = spark.createDataFrame([("m", 0.0499, 0.6, 0.9, 0.6), ("m", 0.05000001, 0.7, 0.8, 0.69999999)],
                                  "model string, fpr double, tpr double, precision double, recall double")
    r = operating_points(curve).first()
    assert r["tpr_at_fpr"] == 0.6 and r["precision_at_recall_7"] is None


def test_cv_compare_takes_every_tabular_candidate(monkeypatch):
    from tabmine.operators.models import default_candidates
    from tabmine.plans import model_q
    seen = []
    monkeypatch.setattr(model_q, "orders_split", lambda *a: (None, None))
    monkeypatch.setattr(model_q, "cross_validate", lambda cands, *a: (seen.extend(c.name for c in cands), None))
    monkeypatch.setattr(model_q, "cv_summary", lambda *a: None)
    model_q.cv_compare(None, None)
    assert seen == [c.name for c in default_candidates() if not c.text]

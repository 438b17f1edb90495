"""Bootstrap on score buckets: the draws' distribution, the areas against brute force, ties and hot scores."""

import random

import numpy as np

from tabmine.operators import bucket_boot as bb
from tabmine.operators.resample import bootstrap_ci, bootstrap_paired


def test_draws_are_poisson_and_independent():
    base, rep = np.arange(2000) * 7 + 3, np.arange(200)
    for m in (1, 3, 40, 64, 65, 500):
        w = bb.poisson(np.full(2000, m), base, rep, 0)
        assert abs(w.mean() / m - 1) < 0.01 and abs(w.var() / m - 1) < 0.02, m
    one, two = bb.poisson(np.full(2000, 1), base, rep, 0), bb.poisson(np.full(2000, 1), base, rep, 1)
    for a, b in ((one, two), (one[:-1], one[1:]), (one[:, :-1], one[:, 1:]), (one[:, ::2], two[:, 1::2])):
        assert abs(np.corrcoef(a.ravel(), b.ravel())[0, 1]) < 0.01
    assert abs(one.sum(axis=0).var() / 2000 - 1) < 0.3 and abs(one.sum(axis=1).var() / 200 - 1) < 0.15
    p = [np.mean(one == k) for k in range(4)]
    assert np.allclose(p, [0.3679, 0.3679, 0.1839, 0.0613], atol=0.005)


def table(spark, rows):
    return spark.createDataFrame(rows, "model string, row_id long, y int, p double")


def sample(n=1500, hot=0.4):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        y = rng.random() < 0.4
        a = 0.5 if rng.random() < hot else float(round(min(max(rng.gauss(0.45 + 0.2 * y, 0.2), 0), 1), 2))
        rows += [("a", i, int(y), a), ("b", i, int(y), rng.random())]
    return rows


def brute(rows, reps, joint=None):
    """AUC of each replicate by pairs of weights; ``joint``: the other model's rows, for shared buckets."""
    key = {}
    for _, i, y, p in rows:
        key.setdefault((p, joint[i]) if joint else p, []).append((i, y))
    out = []
    buckets = [(k, min(i for i, _ in v), sum(y for _, y in v), sum(1 - y for _, y in v)) for k, v in key.items()]
    base, pos, neg = (np.array([b[c] for b in buckets]) for c in (1, 2, 3))
    p = np.array([b[0][0] if joint else b[0] for b in buckets])
    wp, wn = bb.poisson(pos, base, np.arange(reps), 0), bb.poisson(neg, base, np.arange(reps), 1)
    for r in range(reps):
        above = (p[:, None] > p[None, :]) + 0.5 * (p[:, None] == p[None, :])
        out.append(wp[:, r] @ above @ wn[:, r] / (wp[:, r].sum() * wn[:, r].sum()))
    return np.array(out)


def test_areas_are_those_of_the_weights(spark):
    rows = sample(400)
    got = {(r["model"], r["metric"]): (r.lo, r.hi) for r in bb.bucket_ci(table(spark, rows).repartition(5), B=60).collect()}
    for m in "ab":
        want = np.quantile(brute([r for r in rows if r[0] == m], 60), [0.025, 0.975])
        assert np.allclose(got[m, "roc_auc"], want, atol=1e-6)
    a, b = ([r for r in rows if r[0] == m] for m in "ab")
    diff = brute(a, 60, {i: p for _, i, _, p in b}) - brute(b, 60, {i: p for _, i, _, p in a})
    r = bb.bucket_paired(table(spark, rows), "a", "b", B=60).first()
    assert np.allclose((r.lo, r.hi), np.quantile(diff, [0.025, 0.975]), atol=1e-6)


def test_agrees_with_resampling_of_rows(spark):
    df = table(spark, sample())
    new = {(r["model"], r["metric"]): (r.lo, r.hi) for r in bb.bucket_ci(df).collect()}
    old = {(r["model"], r["metric"]): (r.lo, r.hi) for r in bootstrap_ci(df, B=300).collect()}
    assert new.keys() == old.keys()
    assert all(np.allclose(new[k], old[k], atol=0.012) for k in new), (new, old)
    a, b = bb.bucket_paired(df, "a", "b").first(), bootstrap_paired(df, "a", "b", B=300).first()
    assert np.allclose((a.lo, a.hi), (b.lo, b.hi), atol=0.015)


def test_nulls_one_class_and_nothing(spark):
    rows = [("a", 1, 1, 0.3), ("a", 2, 1, 0.9), ("a", 3, None, 0.5), ("a", 4, 0, None)]
    got = {r["metric"] for r in bb.bucket_ci(table(spark, rows), B=10).collect()}
    assert got == {"f1"}  # no negatives: no area
    assert bb.bucket_ci(table(spark, rows).limit(0), B=10).count() == 0


def test_pieces_of_a_tie_add_up():
    rng = np.random.default_rng(0)
    p = np.sort(rng.integers(0, 6, 300)) / 6
    pos, neg = rng.integers(0, 3, (300, 4)).astype(float), rng.integers(0, 3, (300, 4)).astype(float)
    want = np.array([(pos[:, r][:, None] * neg[:, r][None, :] * ((p[:, None] > p) + 0.5 * (p[:, None] == p))).sum() for r in range(4)])
    for size in (1, 7, 300):
        area = bb._Area(4)
        for a in range(0, 300, size):
            area.add(p[a:a + size], pos[a:a + size], neg[a:a + size], 0.5)
        area.flush()
        assert np.allclose(area.total["conc"], want) and np.allclose(area.total["pos"], pos.sum(axis=0))
        assert np.allclose(area.total["tp"], pos[p >= 0.5].sum(axis=0))

"""Tail probabilities against tables and the session's own distributions, keyed permutations, digest dedup."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmine.operators import clean
from tabmine.operators.explain import importance, permutation_keys, permuted_index, permuted_rows
from tabmine.operators.stats import chi2_sf, kruskal, spearman, t_two_sided_p
from tabmine.operators.tails import chi2_tail, ln_gamma, t_tail


def test_tails(spark):
    dist = spark._jvm.org.apache.commons.math3.distribution
    rows = [(t, float(v)) for t in (0.01, 0.3, 1.0, 2.5, 9.0, 30.0) for v in (1, 2, 3, 7, 30, 500, 5000, 10 ** 5)]
    got = spark.createDataFrame(rows, "x double, v double").select(
        "x", "v", t_tail(F.col("x"), F.col("v")).alias("t"), chi2_tail(F.col("x") * F.col("v") / 3, F.col("v")).alias("c")).collect()
    for r in got:
        want = 2 * dist.TDistribution(r.v).cumulativeProbability(-r.x)
        assert r.t == pytest.approx(want, rel=1e-6, abs=1e-300), r
        if r.v < 10_000:  # two engines' rounding of the complement
            assert r.c == pytest.approx(1 - dist.ChiSquaredDistribution(r.v).cumulativeProbability(r.x * r.v / 3), rel=1e-7, abs=1e-11), r
    for t in (1e-6, 0.5, 6.0):  # the normal limit
        assert t_two_sided_p(t, 10 ** 9) == pytest.approx(math.erfc(t / 2 ** 0.5), rel=1e-6)
    # tabulated: 5 % and 1 % points
    for t, v, p in ((12.706, 1, 0.05), (2.228, 10, 0.05), (3.169, 10, 0.01), (1.960, 10 ** 7, 0.05)):
        assert t_two_sided_p(t, v) == pytest.approx(p, abs=3e-5)
    for x, k, p in ((3.841, 1, 0.05), (18.307, 10, 0.05), (23.209, 10, 0.01), (124.342, 100, 0.05)):
        assert chi2_sf(x, k) == pytest.approx(p, abs=3e-5)  # the points have three decimals
    assert t_two_sided_p(0.0, 5) == 1 and t_two_sided_p(math.inf, 5) == 0 and chi2_sf(0.0, 4) == 1
    assert math.isnan(t_two_sided_p(1.0, 0)) and math.isnan(chi2_sf(1.0, 0)) and math.isnan(chi2_sf(float("nan"), 2))
    g = spark.createDataFrame([(z,) for z in (0.5, 1.0, 7.25, 1e6)], "z double").select("z", ln_gamma(F.col("z")).alias("g")).collect()
    assert all(r.g == pytest.approx(math.lgamma(r.z), rel=1e-12, abs=1e-12) for r in g)


def test_p_columns_of_degenerate_tables(spark):
    def table(xs, ys):
        return spark.createDataFrame([(float(x), float(y), "g" + str(i % 2)) for i, (x, y) in enumerate(zip(xs, ys))], "x double, y double, g string")
    up = spearman(table(range(9), range(9)), "x", "y").first()
    down = spearman(table(range(9), range(9, 0, -1)), "x", "y").first()
    assert (up.rho, up.p, down.rho, down.p) == (1.0, 0.0, -1.0, 0.0)
    flat = spearman(table([1] * 9, range(9)), "x", "y").first()
    assert flat.rho is None and flat.p is None
    assert spearman(table([1, 2], [2, 1]), "x", "y").first().p is None
    assert spearman(table([], []), "x", "y").first().p is None
    same = kruskal(table([1] * 9, [3] * 9), "g", "y").first()
    assert same.h is None and same.p is None
    one = kruskal(table(range(5), range(5)).withColumn("g", F.lit("a")), "g", "y").first()
    assert one.dof == 0 and one.p is None


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 100, 961, 1023, 5000])
def test_permuted_index_is_a_permutation(spark, n):
    keys = [F.array(*[F.lit(k).cast("bigint") for k in permutation_keys(f, r, 1)]) for f, r in (("a", 0), ("a", 1))]
    rows = spark.range(n).select("id", *[permuted_index(F.col("id"), n, k).alias(f"p{i}") for i, k in enumerate(keys)]).collect()
    for c in ("p0", "p1"):
        assert sorted(r[c] for r in rows) == list(range(n))
    if n >= 961:
        a, b = (np.array([r[c] for r in rows]) for c in ("p0", "p1"))
        assert (a == b).mean() < 0.01 and abs(np.corrcoef(a, np.arange(n))[0, 1]) < 0.1
        assert abs(np.corrcoef(a, b)[0, 1]) < 0.1 and abs(np.corrcoef(a[1:], a[:-1])[0, 1]) < 0.1


def test_importance(spark):
    rng = random.Random(2)
    rows = [(10 * i, rng.random(), None if i % 9 == 0 else rng.random(), int(rng.random() < 0.5)) for i in range(600)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, y int").withColumn("y", (F.col("a") > 0.5).cast("int"))
    moved = permuted_rows(df, ["a", "b"], 3, 7, "row_id").collect()
    assert len(moved) == 600 * 6
    for f, other in (("a", "b"), ("b", "a")):
        for rep in range(3):
            part = {r.row_id: r for r in moved if r.feature == f and r.rep == rep}
            own = {r[0]: r for r in rows}
            i = 1 if f == "a" else 2
            assert sorted(map(repr, (r[f] for r in part.values()))) == sorted(repr(r[i]) for r in rows)   # the same values
            assert all(part[k][other] == own[k][3 - i] for k in own)                                        # nothing else moves
    got = {r.feature: r.delta_auc for r in importance(df, lambda d: d.withColumn("p", F.col("a")), ["a", "b"], 3, 7).collect()}
    assert got["b"] == 0 and 0.4 < got["a"] < 0.6


def test_dedup_tells_equal_digests_apart(spark, monkeypatch):
    rows = [(i, [None, "", "a", "ab", "x" * 30_000][i % 5], ["", "b", None][i % 3], i * 1.5) for i in range(60)] + [(99, "alone", "row", 0.0)]
    df = spark.createDataFrame(rows, "row_id long, t string, u string, v double").repartition(4)
    want = {}
    for r in rows:
        want.setdefault((r[1], r[2]), r)
    for short in (False, True):
        if short:  # a digest of two values
            monkeypatch.setattr(clean, "key_digest", lambda keys: F.when(F.length(F.coalesce(F.col(keys[0]), F.lit(""))) > 1, F.lit(b"1")).otherwise(F.lit(b"0")))
        got = clean.dedup_first(df, ["t", "u"])
        assert got.columns == df.columns and sorted(map(tuple, got.collect())) == sorted(want.values())
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "hashpartitioning" not in plan
    assert clean.dedup_first(df.limit(0), ["t", "u"]).count() == 0
    nums = spark.createDataFrame([(1, 1, 12), (2, 11, 2), (3, 1, 12)], "row_id long, a int, b int")
    assert {r.row_id for r in clean.dedup_first(nums, ["a", "b"]).collect()} == {1, 2}


def test_donors_are_joined_by_a_shuffle_however_small_their_files(spark):
    from tabmine.operators.explain import permuted_rows
    rows = spark.createDataFrame([(i, i % 3, i % 2) for i in range(50)], "row_id long, a int, y int")
    out = permuted_rows(rows, ["a"], 2, 42, "row_id")
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    for rep in range(2):
        part = out.where(f"rep = {rep}").collect()
        assert sorted(r.row_id for r in part) == list(range(50)) and sorted(r.a for r in part) == sorted(i % 3 for i in range(50))

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import reviews_df
from tabmine.operators.ranks import exact_quantiles, value_ranks
from tabmine.operators.stats import chi2_sf, kruskal, spearman, spearman_p, t_two_sided_p
from fixtures import SF_SMALL


def test_spearman_and_kruskal_fixture(spark):
    df = reviews_df(spark)
    r = spearman(df, "price", "points").first()
    assert r["n"] == 10 and r["rho"] == pytest.approx(0.8888888889, abs=1e-9)
    assert 0 <= spearman_p(r) < 0.01
    h = kruskal(df, "taster_name", "points").first()
    assert h["h"] == pytest.approx(2.7962264151, abs=1e-9)


def test_tail_probabilities():
    assert t_two_sided_p(2.0, 10) == pytest.approx(0.0733880, abs=1e-6)
    assert chi2_sf(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert chi2_sf(18.307038, 10) == pytest.approx(0.05, abs=1e-6)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_rank_sum_and_quantiles_on_lineitem(spark, parts):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    r = value_ranks(li, "l_extendedprice", parts=parts)
    tot = r.agg(F.sum(F.col("rank") * F.col("cnt")).alias("s"), F.sum("cnt").alias("n")).first()
    n = tot["n"]
    assert tot["s"] == pytest.approx(n * (n + 1) / 2)
    vals = np.array([x[0] for x in li.select("l_extendedprice").collect()])
    qs = [0.0, 0.1, 0.5, 0.999, 1.0]
    got = {r["q"]: r["l_extendedprice"] for r in exact_quantiles(li, "l_extendedprice", qs, parts=parts).collect()}
    for q in qs:
        assert got[q] == pytest.approx(float(np.quantile(vals, q)), rel=1e-12)


def test_grouped_quantiles_invariant_under_repartition(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    a = exact_quantiles(li, "l_quantity", [0.25, 0.5], ["l_returnflag"]).collect()
    b = exact_quantiles(li.repartition(7), "l_quantity", [0.25, 0.5], ["l_returnflag"]).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_perfect_and_constant_columns(spark):
    df = spark.createDataFrame([(float(i), float(2 * i), 1.0, "ab"[i % 2]) for i in range(6)], "c double, cnt double, n double, w string")
    r = spearman(df, "c", "cnt").first()
    assert r["rho"] == pytest.approx(1.0) and spearman_p(r) == pytest.approx(0.0, abs=1e-12)
    assert spearman(df, "c", "n").first()["rho"] is None
    assert kruskal(df, "w", "n").first()["h"] is None
    assert kruskal(df, "w", "c").first()["k"] == 2 and kruskal(df.limit(1), "w", "c").first()["h"] is None


def test_null_groups_and_labels_stay(spark):
    from tabmine.operators.split import holdout_split, kfold_assign
    df = spark.range(50).select(F.col("id").alias("row_id"), F.when(F.col("id") % 5 > 0, F.col("id") % 2).alias("y"), (F.col("id") * 1.0).alias("v"))
    assert holdout_split(df, "y").count() == 50 and kfold_assign(df, "y").count() == 50
    got = {r["y"]: r["v"] for r in exact_quantiles(df, "v", [0.5], ["y"]).collect()}
    assert got[None] == pytest.approx(22.5) and len(got) == 3

"""Level tables against a plain version: pooling, codes, unseen values, shuffled and hashed forms."""

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabmine.operators import levels as L
from tabmine.operators.prep import TabularPrep
from tabmine.operators.tfidf import TfidfText
from tabmine.spec import FeatureSpec


def pooled_codes(values, least):
    """Level to code by hand, and the code of everything else."""
    seen = [L.MISSING if v is None else v for v in values]
    kept = {v for v in seen if seen.count(v) >= least}
    names = kept | ({L.INFREQUENT} if kept != set(seen) else set())
    order = {v: i for i, v in enumerate(sorted(names, key=lambda v: v.encode()))}
    return order, order.get(L.INFREQUENT, len(order))


@pytest.fixture(scope="module")
def values():
    rng = random.Random(3)
    return [rng.choice(["é", "Z", "a", "b", "_x", None, f"rare{i}"]) for i in range(300)]


@pytest.mark.parametrize("bound", [32 << 20, -1])
def test_codes_match_by_hand_broadcast_or_not(spark, values, monkeypatch, bound):
    monkeypatch.setattr(L, "BROADCAST_BYTES", bound)
    train = spark.createDataFrame([(v, "same") for v in values], "a string, b string").repartition(7)
    fitted = L.fit_levels(train, ["a", "b"], 20)
    order, other = pooled_codes(values, 20)
    new = spark.createDataFrame([(v, v) for v in {*values, "never", "same"}], "a string, b string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # Spark's own choice off: the hint alone counts
    plan = fitted.attach(new)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert ("BroadcastHashJoin" in plan) == (bound > 0)
    for r in fitted.attach(new, level="_lv").collect():
        v = L.MISSING if r.a is None else r.a
        assert r.a_ix == order.get(v, other) and r.a_lv == (v if v in order else L.INFREQUENT)
        assert (r.b_ix, r.b_lv) == ((0.0, "same") if r.b == "same" else (1.0, L.UNSEEN))  # nothing was rare in b
    assert fitted.width("a") == len(order) and fitted.width("b") == 2
    assert fitted == L.fit_levels(train.repartition(3), ["a", "b"], 20)
    assert fitted != L.fit_levels(train.withColumn("a", F.lit("q")), ["a", "b"], 20)


def test_many_levels_are_coded_by_hash_and_empty_training_has_none(spark, values):
    train = spark.createDataFrame([(v,) for v in values], "a string")
    hashed = L.fit_levels(train, ["a"], 1, slots=16)
    got = hashed.attach(train).collect()
    assert hashed.width("a") == 16 and {r.a_ix for r in got} <= set(map(float, range(16))) and len(got) == 300
    empty = L.fit_levels(train.limit(0), ["a"], 1)
    assert {r.a_ix for r in empty.attach(train).collect()} == {0.0} and empty.width("a") == 1


def test_product_vector_holds_the_codes(spark, values):
    d = spark.createDataFrame([(i, float(i % 7), 1, v, i % 2) for i, v in enumerate(values)],
                              "row_id long, x double, f int, a string, y int")
    order, other = pooled_codes(values, 20)
    for onehot in (True, False):
        prep = TabularPrep(FeatureSpec(num=("x",), bin=("f",), cat=("a",), text=None, target="y"), 20, onehot).fit(d)
        for r in prep.transform(d).select("a", vector_to_array("features").alias("v")).collect():
            code = order.get(L.MISSING if r.a is None else r.a, other)
            assert list(r.v[2:]) == ([float(i == code) for i in range(len(order))] if onehot else [code])


def test_text_vectors_need_no_python_worker(spark):
    d = spark.createDataFrame([(0, "alpha beta alpha"), (1, "beta gamma"), (2, ""), (3, None)], "row_id long, description string")
    m = TfidfText(min_df=1).fit(d.where("description IS NOT NULL"))
    out = m.transform(d.where("description IS NOT NULL"))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    by_term = dict(zip(m.vocabulary, vector_to_array_of(out, 0)))
    ratio = by_term["alpha"] / by_term["alpha beta"]  # both in one document; tf 2 against 1
    assert ratio == pytest.approx(1.6931471805599453)
    assert not any(vector_to_array_of(out, 2))


def vector_to_array_of(out, row):
    return out.where(F.col("row_id") == row).select(vector_to_array("txt")).first()[0]

import pytest
from pyspark.sql import functions as F

from tabmine.operators.prep import TabularPrep, fit_medians
from tabmine.operators.split import holdout_split, kfold_assign, order_key, sample_n
from tabmine.sources.views import orders_review
from tabmine.spec import FeatureSpec
from fixtures import SF_SMALL


def _labelled(spark):
    return orders_review(spark, SF_SMALL).select("row_id", "price", "country",
                                                 (F.col("points") >= 90).cast("int").alias("y"))


def test_holdout_is_disjoint_exhaustive_and_stratified(spark):
    d = holdout_split(_labelled(spark), "y", 0.2, 42)
    per = {(r["y"], r["split"]): r["n"] for r in d.groupBy("y", "split").agg(F.count("*").alias("n")).collect()}
    for y in (0, 1):
        n = per[(y, "test")] + per[(y, "train")]
        assert per[(y, "test")] == -(-n // 5)    # ceil(0.2 n) per class
    assert d.select("row_id").distinct().count() == d.count() == _labelled(spark).count()


def test_kfold_covers_each_row_once(spark):
    f = kfold_assign(_labelled(spark), "y", 5, 42)
    sizes = [r["n"] for r in f.groupBy("fold").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 2
    assert f.select("row_id").distinct().count() == f.count()


def test_sample_is_deterministic(spark):
    a = [r[0] for r in sample_n(_labelled(spark), 50, 42).select("row_id").collect()]
    b = [r[0] for r in sample_n(_labelled(spark).repartition(5), 50, 42).select("row_id").collect()]
    assert a == b and len(set(a)) == 50


def test_median_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert fit_medians(df, ["x"])["x"] == pytest.approx(2.5)


def test_prep_constants_ignore_test_rows(spark):
    spec = FeatureSpec(num=("price",), bin=(), cat=("country",), text=None, target="y")
    d = holdout_split(_labelled(spark), "y", 0.2, 42)
    test = F.col("split") == "test"
    changed = d.withColumns({"price": F.when(test, 1e9).otherwise(F.col("price")),
                             "country": F.when(test, "Atlantis").otherwise(F.col("country"))})
    a, b = (TabularPrep(spec, 20).fit(x.where(~test)) for x in (d, changed))
    assert a.medians == b.medians and a.scaler == b.scaler and a.levels == b.levels
    everything = TabularPrep(spec, 20).fit(changed)  # what a leak would look like
    assert everything.scaler != a.scaler and everything.levels != a.levels
    assert a.transform(changed.where(test)).select("features").count() == d.where(test).count()


def test_sample_takes_the_smallest_hashes_of_a_large_table(spark):
    big = spark.range(20_000).withColumnRenamed("id", "row_id")
    got = {r[0] for r in sample_n(big, 50, 7).collect()}
    want = {r[0] for r in big.orderBy(order_key("row_id", 7), "row_id").limit(50).collect()}
    assert got == want
    same = big.withColumn("row_id", F.lit(1))  # one hash: the cut can't work
    assert sample_n(same, 50, 7).count() == 50


def test_holdout_cut_is_the_place_in_hash_order(spark, monkeypatch):
    """Against a sort of each class, refined to the last bin, with null classes, and ids that share a hash."""
    from tabmine.operators import split
    rows = [(i, None if i % 5 == 0 else int(i % 3 == 0), "text" * 50) for i in range(700)] + [(9_999, 7, "alone")]
    df = spark.createDataFrame(rows, "row_id long, y int, text string")

    def want(key):
        out = set()
        for c in {r[1] for r in rows}:
            own = sorted((key[i], i) for i, y, _ in rows if y == c)
            out |= {i for _, i in own[:-(-len(own) // 5)]}
        return out
    keys = {r.row_id: r.h for r in df.select("row_id", order_key("row_id", 42).alias("h")).collect()}
    for few, share_hash in ((1 << 16, False), (0, False), (0, True)):
        monkeypatch.setattr(split, "FEW", few)
        if share_hash:
            monkeypatch.setattr(split, "order_key", lambda c, s: (F.col(c) % 4).cast("bigint"))
            keys = {i: i % 4 for i in keys}
        d = split.holdout_split(df, "y", 0.2, 42)
        assert d.columns == [*df.columns, "split"]
        assert {r.row_id for r in d.where("split = 'test'").collect()} == want(keys)
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan  # the texts stay where they are
    assert split.holdout_split(df.limit(0), "y").count() == 0


def test_holdout_of_nothing_and_of_all(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(20)], "row_id long, y int")
    assert holdout_split(df, "y", 0.0).where("split = 'test'").count() == 0
    assert holdout_split(df, "y", 1.0).where("split = 'train'").count() == 0

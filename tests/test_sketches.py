import math

import pytest
from pyspark.sql import functions as F

from tabmine.operators.sketches import merge_sketches, sketch_parts, sketch_profile

N = 40_000


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    return spark.range(N).select(
        (F.crc32(i.cast("string")) % 150).alias("day"), (i % 3).cast("int").alias("shop"), (F.crc32(i.cast("string")) % 9000).alias("buyer"),
        F.when(i % 10 != 0, F.pow(F.lit(1.001), i % 5000)).alias("price"), F.lit(None).cast("double").alias("none"),
        F.concat(F.lit("w"), i % 700).alias("word"))


def test_merged_sketches_keep_their_error_bounds(rows):
    stored = sketch_parts(rows, ["shop", "day"], ["buyer", "price", "none", "word"])
    assert stored.count() > 4 * 150  # many more parts than one heap takes
    for keys in ([], ["shop"]):
        got = {(*[r[k] for k in keys], r["column"]): r for r in sketch_profile(merge_sketches(stored, keys, 16)).collect()}
        groups = rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.count("price").alias("price_n"), F.countDistinct("buyer").alias("buyer"),
            F.countDistinct("word").alias("word"), F.countDistinct("price").alias("price")).collect()
        for g in groups:
            key = tuple(g[k] for k in keys)
            for c in ("buyer", "word", "price"):
                assert abs(got[(*key, c)]["n_distinct"] - g[c]) <= 4 * 1.04 / math.sqrt(2 ** 12) * g[c] + 1
                assert got[(*key, c)]["n_rows"] == g["n"]
            r = got[(*key, "price")]
            assert r["n_null"] == g["n"] - g["price_n"]
            own = rows.where(" and ".join(f"{k} = {g[k]}" for k in keys) or "true")
            for p in (25, 50, 75):
                q = r[f"q{p}"]
                lo, hi = own.agg(F.count(F.when(F.col("price") < q, 1)), F.count(F.when(F.col("price") <= q, 1))).first()
                assert lo / g["price_n"] - 0.02 <= p / 100 <= hi / g["price_n"] + 0.02
            assert got[(*key, "none")]["q50"] is None and got[(*key, "none")]["n_distinct"] == 0
            assert got[(*key, "none")]["n_null"] == g["n"] and got[(*key, "word")]["q50"] is None


def test_empty_table_and_null_parts(rows, spark):
    assert merge_sketches(sketch_parts(rows.limit(0), ["day"], ["price"])).count() == 0
    one = spark.createDataFrame([(None, 1.0), (None, float("nan")), (1, 3.0)], "part int, v double")
    r = sketch_profile(merge_sketches(sketch_parts(one, ["part"], ["v"])), [0.5]).first()
    assert (r["n_rows"], r["n_null"], r["n_distinct"]) == (3, 0, 3) and r["q50"] in (1.0, 3.0)

import math

import pytest
from pyspark.sql import functions as F

from fixtures import reviews_df
from tabmine.operators.clean import clean_reviews, dedup_first, dup_count
from tabmine.operators.ranks import quantile_values
from tabmine.spec import WINE


def test_duplicates_and_raw_share(spark):
    df = reviews_df(spark)
    assert dup_count(df, ["description", "title"]).first()["duplicates"] == 1
    share = df.agg(F.avg((F.col("points") >= 90).cast("double"))).first()[0]
    assert share == pytest.approx(0.5)
    assert quantile_values(df, "price", [0.999])[0] == pytest.approx(3271.38)


def test_dedup_keeps_first_and_is_idempotent(spark):
    df = reviews_df(spark)
    d = dedup_first(df, ["description", "title"])
    ids = sorted(r["row_id"] for r in d.collect())
    assert ids == [0, 1, 2, 4, 5, 6, 7, 8, 9, 10, 11]   # row 3 repeats row 2; 4 and 5 differ before cleanup
    assert dedup_first(d, ["description", "title"]).count() == d.count()


def test_clean_table_matches_hand_computed_rows(spark):
    c = clean_reviews(reviews_df(spark), WINE)
    assert c.cap == pytest.approx(3274.56)
    rows = {r["row_id"]: r for r in c.table.collect()}
    assert len(rows) == 11
    exp = {  # row: (country, age, log_price, chars, words, high_quality)
        0: ("Italy", 4.0, None, 30, 4, 0), 1: ("Portugal", 6.0, 2.772589, 24, 5, 1),
        2: ("US", 4.0, 2.708050, 16, 3, 0), 4: ("US", 12.0, 4.795791, 23, 4, 1),
        5: ("US", 12.0, 4.795791, 23, 4, 1), 6: ("Unknown", None, 2.302585, 17, 3, 0),
        7: ("France", None, 8.094244, 26, 3, 1), 8: ("Spain", 0.0, 2.772589, 13, 2, 0),
        9: ("US", None, 4.110874, 21, 5, 1), 10: ("Italy", 7.0, 4.110874, 5, 1, 0),
        11: ("France", 5.0, None, 37, 6, 1)}
    for rid, (country, age, lp, chars, words, hq) in exp.items():
        r = rows[rid]
        assert r["country"] == country
        assert r["age"] == age
        assert (r["log_price"] is None) if lp is None else r["log_price"] == pytest.approx(lp, abs=1e-6)
        assert (r["desc_len_chars"], r["desc_words"], r["high_quality"]) == (chars, words, hq)
    a = c.audit().first()
    assert a["price_capped_rows"] == 1 and a["duplicates_removed"] == 1
    assert a["share_high_quality"] == pytest.approx(0.545455, abs=1e-6)


def test_vintage_is_last_match_without_fallback(spark):
    c = clean_reviews(reviews_df(spark), WINE).table
    years = {r["row_id"]: r["age"] for r in c.select("row_id", "age").collect()}
    assert years[4] == 12.0        # 1999 ... 2005 -> 2005
    assert years[7] is None        # 2016 ... 2018 -> 2018 > 2017 -> null, no fallback
    assert years[9] is None        # 1945 out of range


def test_unicode_whitespace_switch(spark):
    from tabmine.functions.text import collapse_ws, word_count
    df = spark.createDataFrame([("a  b ",), ("",), ("  ",)], "t string")
    u = [r[0] for r in df.select(word_count("t", True)).collect()]
    a = [r[0] for r in df.select(word_count("t", False)).collect()]
    assert u == [2, 0, 0] and a[1:] == [0, 0]
    assert df.select(collapse_ws("t", True)).first()[0] == "a b"

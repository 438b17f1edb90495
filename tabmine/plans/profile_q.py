"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabmine.operators.clean import clean_reviews
from tabmine.operators.profile import (box_stats, describe_numeric, distinct_counts, group_medians,
                                       group_stats, hexbin_counts, histogram, keep_top,
                                       missing_profile, schema_profile, value_counts)
from tabmine.operators.ranks import exact_quantiles
from tabmine.operators.sketches import merge_sketches, sketch_parts, sketch_profile
from tabmine.plans import sql
from tabmine.plans.registry import query
from tabmine.session import materialize
from tabmine.sources.views import docs_review, orders_review, table
from tabmine.spec import ORDERS

ORDER_COLS = ("row_id", "customer_id", "country", "description", "designation", "points", "price",
              "province", "region_1", "region_2", "taster_name", "taster_twitter_handle", "title",
              "variety", "winery")


def _unpivot_sql(cols, expr, alias):
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {expr.format(c=c)} AS {alias} FROM orders_review"
                              for c in cols)


@query("missing_profile", sql.orders() + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count, "
    f"round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 6) AS missing_pct FROM orders_review"
    for c in ORDER_COLS) + ")")
def missing_profile_q(spark, sf_dir):
    return missing_profile(orders_review(spark, sf_dir))


# Spark's simple type names of the docs_review view, as the oracle states them.
DOC_TYPES = {"row_id": "bigint", "description": "string", "title": "string", "lang": "string",
             "source": "string", "desc_len_chars": "int", "quality": "int", "toxic": "int"}


@query("schema_profile", sql.docs() + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS dtype, CAST(count({c}) AS BIGINT) AS non_null, "
    f"CAST(count(*) AS BIGINT) AS n_rows FROM docs_review" for c, t in DOC_TYPES.items()) + ")")
def schema_profile_q(spark, sf_dir):
    return schema_profile(docs_review(spark, sf_dir))


DISTINCT_COLS = ("country", "variety", "province", "taster_name")


@query("distinct_counts", sql.orders() + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM orders_review"
    for c in DISTINCT_COLS) + ")")
def distinct_counts_q(spark, sf_dir):
    return distinct_counts(orders_review(spark, sf_dir), DISTINCT_COLS)


@query("describe_numeric", sql.orders() + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, "
    f"round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, "
    f"round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM orders_review"
    for c in ("points", "price")) + ")")
def describe_numeric_q(spark, sf_dir):
    return describe_numeric(orders_review(spark, sf_dir), ["points", "price"])


QS = (0.5, 0.9, 0.99, 0.999)


@query("quantiles", sql.orders() + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT CAST({q} AS DOUBLE) AS q, round(quantile_cont(price, {q}), 6) AS price FROM orders_review" for q in QS) + ")")
def quantiles_q(spark, sf_dir):
    q = exact_quantiles(orders_review(spark, sf_dir), "price", QS)
    return q.select("q", F.round("price", 6).alias("price"))


@query("share_positive", sql.orders() + """
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(CAST(points >= 90 AS DOUBLE)), 6) AS share_high FROM orders_review""")
def share_positive(spark, sf_dir):
    r = orders_review(spark, sf_dir)
    return r.agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                 F.round(F.avg((F.col("points") >= ORDERS.threshold).cast("double")), 6).alias("share_high"))


@query("top_countries", sql.orders() + """
SELECT country, CAST(count(*) AS BIGINT) AS n,
       round(count(*) / (SELECT CAST(count(country) AS DOUBLE) FROM orders_review), 6) AS share
FROM orders_review WHERE country IS NOT NULL GROUP BY country ORDER BY n DESC, country LIMIT 10""")
def top_countries(spark, sf_dir):
    return value_counts(orders_review(spark, sf_dir), "country", top=10)


@query("class_balance", sql.orders() + """
SELECT CAST(points >= 90 AS INTEGER) AS high_quality, CAST(count(*) AS BIGINT) AS n,
       round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM orders_review), 6) AS share
FROM orders_review GROUP BY 1""")
def class_balance(spark, sf_dir):
    r = orders_review(spark, sf_dir).select((F.col("points") >= ORDERS.threshold).cast("int").alias("high_quality"))
    return value_counts(r, "high_quality")


@query("points_count", sql.orders() + """
SELECT points, CAST(count(*) AS BIGINT) AS n,
       round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM orders_review), 6) AS share
FROM orders_review GROUP BY points""")
def points_count(spark, sf_dir):
    return value_counts(orders_review(spark, sf_dir), "points")


@query("first_rows", sql.orders() + """
SELECT row_id, title, points, price FROM orders_review ORDER BY row_id LIMIT 5""")
def first_rows(spark, sf_dir):
    return orders_review(spark, sf_dir).select("row_id", "title", "points", "price").orderBy("row_id").limit(5)


@query("taster_mean_count", sql.orders() + """
SELECT taster_name, round(avg(points), 6) AS mean, CAST(count(points) AS BIGINT) AS count,
       round(quantile_cont(points, 0.5), 6) AS median
FROM orders_review WHERE taster_name IS NOT NULL GROUP BY taster_name""")
def taster_mean_count(spark, sf_dir):
    return group_stats(orders_review(spark, sf_dir), "taster_name", "points")


@query("median_by_class", sql.orders(sql.CLEAN_SQL) + """
SELECT * FROM (
  SELECT high_quality, 'desc_words' AS "column", round(quantile_cont(desc_words, 0.5), 6) AS median FROM clean GROUP BY 1
  UNION ALL
  SELECT high_quality, 'desc_len_chars', round(quantile_cont(desc_len_chars, 0.5), 6) FROM clean GROUP BY 1
  UNION ALL
  SELECT high_quality, 'price', round(quantile_cont(price, 0.5), 6) FROM clean GROUP BY 1)""")
def median_by_class(spark, sf_dir):
    t = clean_reviews(orders_review(spark, sf_dir), ORDERS).table
    return group_medians(t, ["high_quality"], ["desc_words", "desc_len_chars", "price"])


@query("box_stats_top10", sql.orders() + """
, top AS (SELECT country FROM orders_review WHERE country IS NOT NULL GROUP BY country
          ORDER BY count(*) DESC, country LIMIT 10),
d AS (SELECT country, CAST(points AS DOUBLE) AS v FROM orders_review WHERE country IN (SELECT country FROM top)),
q AS (SELECT country, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) AS q3
      FROM d GROUP BY country)
SELECT d.country, CAST(count(*) AS BIGINT) AS n, round(any_value(q1), 6) AS q1, round(any_value(med), 6) AS median,
       round(any_value(q3), 6) AS q3,
       round(min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_lo,
       round(max(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
       CAST(count(*) FILTER (WHERE NOT (v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1))) AS BIGINT)
         AS n_outliers
FROM d JOIN q ON d.country = q.country GROUP BY d.country""")
def box_stats_top10(spark, sf_dir):
    r = orders_review(spark, sf_dir).select("country", "points")
    return box_stats(keep_top(r, "country", 10), "country", "points")


def _hist_sql(expr_x, bins, src, where="TRUE", lo=None, hi=None):
    bounds = (f"SELECT min(x) AS lo, max(x) AS hi FROM b0" if lo is None
              else f"SELECT CAST({lo} AS DOUBLE) AS lo, CAST({hi} AS DOUBLE) AS hi")
    return f"""
, b0 AS (SELECT CAST({expr_x} AS DOUBLE) AS x FROM {src} WHERE {where} AND {expr_x} IS NOT NULL),
bb AS ({bounds}),
b1 AS (SELECT CAST(least(floor((x - lo) * {float(bins)} / (hi - lo)), {bins - 1}) AS INTEGER) AS bin, lo, hi
       FROM b0, bb WHERE x >= lo AND x <= hi)
SELECT bin, round(any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / {bins}), 6) AS bin_lo,
       round(any_value(lo) + (bin + 1) * ((any_value(hi) - any_value(lo)) / {bins}), 6) AS bin_hi,
       CAST(count(*) AS BIGINT) AS n
FROM b1 GROUP BY bin"""


@query("hist_log_price", sql.orders() + _hist_sql("log10(price)", 50, "orders_review", "price > 0"))
def hist_log_price(spark, sf_dir):
    r = orders_review(spark, sf_dir).where(F.col("price") > 0)
    return histogram(r, F.log10("price"), 50)


@query("hist_log1p_price", sql.orders(sql.CLEAN_SQL) + _hist_sql("log_price", 50, "clean"))
def hist_log1p_price(spark, sf_dir):
    return histogram(clean_reviews(orders_review(spark, sf_dir), ORDERS).table, "log_price", 50)


@query("hist_price_clip", sql.orders() + _hist_sql(
    "CASE WHEN price > 300000.0 THEN 300000.0 ELSE price END", 50, "orders_review"))
def hist_price_clip(spark, sf_dir):
    """Raw price clipped at an upper value (null stays null, unlike ``least``)."""
    clip = F.when(F.col("price") > 300000.0, F.lit(300000.0)).otherwise(F.col("price"))
    return histogram(orders_review(spark, sf_dir), clip, 50)


@query("hist_age", sql.orders(sql.CLEAN_SQL) + _hist_sql("age", 39, "clean", lo=0, hi=39))
def hist_age(spark, sf_dir):
    return histogram(clean_reviews(orders_review(spark, sf_dir), ORDERS).table, "age", 39, 0.0, 39.0)


@query("density2d", sql.orders() + """
, d AS (SELECT log10(price) AS x, CAST(points AS DOUBLE) AS y FROM orders_review WHERE price > 0),
m0 AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM d),
m AS (SELECT x0 - 1e-9 * (x1 - x0) AS x0, x1 + 1e-9 * (x1 - x0) AS x1, y0, y1 FROM m0),
s AS (SELECT x0, y0, (x1 - x0) / 40 AS sx, (y1 - y0) / 23 AS sy FROM m),
f AS (SELECT (x - x0) / sx AS fx, (y - y0) / sy AS fy, x0, y0, sx, sy FROM d, s),
c AS (SELECT *, CAST(round_even(fx, 0) AS INTEGER) AS ix1, CAST(round_even(fy, 0) AS INTEGER) AS iy1,
             CAST(floor(fx) AS INTEGER) AS ix2, CAST(floor(fy) AS INTEGER) AS iy2 FROM f),
k AS (SELECT *, ((fx - ix1) ^ 2 + 3.0 * (fy - iy1) ^ 2) < ((fx - ix2 - 0.5) ^ 2 + 3.0 * (fy - iy2 - 0.5) ^ 2) AS first
      FROM c),
g AS (SELECT CASE WHEN first THEN 1 ELSE 2 END AS lattice, CASE WHEN first THEN ix1 ELSE ix2 END AS ix,
             CASE WHEN first THEN iy1 ELSE iy2 END AS iy, x0, y0, sx, sy FROM k)
SELECT lattice, ix, iy, CAST(count(*) AS BIGINT) AS n, round(log10(count(*)), 6) AS log10_n,
       round(any_value(x0) + (ix + CASE WHEN lattice = 2 THEN 0.5 ELSE 0.0 END) * any_value(sx), 6) AS x_center,
       round(any_value(y0) + (iy + CASE WHEN lattice = 2 THEN 0.5 ELSE 0.0 END) * any_value(sy), 6) AS y_center
FROM g GROUP BY lattice, ix, iy""")
def density2d(spark, sf_dir):
    r = orders_review(spark, sf_dir).where(F.col("price") > 0)
    return hexbin_counts(r.select(F.log10("price").alias("lp"), "points"), "lp", "points", 40)


SKETCHED = ("o_custkey", "o_totalprice", "o_orderpriority")


def _monthly_sketches(orders):
    parts = orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    return materialize(sketch_parts(parts, ["month"], SKETCHED), "monthly-sketches")


@query("sketch_profile")
def sketch_profile_q(spark, sf_dir):
    """A2 + A6 from stored sketches: distinct counts and quartiles of every year, and of all years
    (year null) from the years' sketches; the orders are read once."""
    stored = _monthly_sketches(table(spark, sf_dir, "orders"))
    yearly = materialize(merge_sketches(stored.withColumn("year", F.substring("month", 1, 4)), ["year"]), "yearly-sketches")
    total = merge_sketches(yearly).select(F.lit(None).cast("string").alias("year"), "*")
    return sketch_profile(yearly.unionByName(total))


@query("sketch_errors", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) - count({c}) AS BIGINT) AS n_null, "
    f"CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct, TRUE AS distinct_within, "
    f"{'TRUE' if c == 'o_totalprice' else 'CAST(NULL AS BOOLEAN)'} AS quartiles_within FROM orders" for c in SKETCHED) + ")")
def sketch_errors(spark, sf_dir):
    """A2 + A6: exact distinct counts, and whether the merged monthly sketches are within their stated
    errors of the exact figures (distinct: 4 standard errors; quartiles: 2 % of the ranks)."""
    o = table(spark, sf_dir, "orders")
    est = materialize(sketch_profile(merge_sketches(_monthly_sketches(o))), "sketch-figures")
    price = est.where(F.col("column") == "o_totalprice").select(*[F.col(q).alias(f"_{q}") for q in ("q25", "q50", "q75")])
    counts = [F.countDistinct(c).alias(c) for c in SKETCHED]
    below = [F.avg((F.col("o_totalprice") <= F.col(f"_q{p}")).cast("double")).alias(f"p{p}") for p in (25, 50, 75)]
    ranks = o.select("o_totalprice").join(F.broadcast(price)).agg(*below)  # one row of three quartiles
    exact = o.agg(*counts).join(F.broadcast(ranks)).select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(c).alias("exact"),
        (F.greatest(*[F.abs(F.col(f"p{p}") - p / 100) for p in (25, 50, 75)]) <= 0.02 if c == "o_totalprice"
         else F.lit(None).cast("boolean")).alias("quartiles_within")) for c in SKETCHED])))
    return est.join(exact, "column").select(
        "column", "n_rows", "n_null", F.col("exact").alias("n_distinct"),
        (F.abs(F.col("n_distinct") - F.col("exact")) <= 4 * 1.04 / 64 * F.col("exact") + 1).alias("distinct_within"),
        "quartiles_within")

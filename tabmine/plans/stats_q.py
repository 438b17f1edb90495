"""Statistics, splitting and sampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabmine.operators.profile import top_keys
from tabmine.operators.ranks import value_ranks
from tabmine.operators.split import holdout_split, kfold_assign, sample_n
from tabmine.operators.stats import kruskal, spearman
from tabmine.plans import sql
from tabmine.plans.registry import query
from tabmine.sources.views import docs_review, orders_review


def _spearman_sql(xexpr):
    return sql.orders() + f"""
, d AS (SELECT CAST({xexpr} AS DOUBLE) AS x, CAST(points AS DOUBLE) AS y FROM orders_review
        WHERE price IS NOT NULL AND points IS NOT NULL),
r AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM d),
c AS (SELECT count(*) AS n, corr(rx, ry) AS rho FROM r)
SELECT CAST(n AS BIGINT) AS n, round(rho, 6) AS rho, round(rho * sqrt((n - 2) / (1 - rho * rho)), 6) AS t_stat FROM c"""


def _round_sp(df):
    return df.select("n", F.round("rho", 6).alias("rho"), F.round("t_stat", 6).alias("t_stat"))


@query("spearman", _spearman_sql("price"))
def spearman_q(spark, sf_dir):
    return _round_sp(spearman(orders_review(spark, sf_dir), "price", "points"))


@query("spearman_log_price", _spearman_sql("ln(price)"))
def spearman_log_price(spark, sf_dir):
    r = orders_review(spark, sf_dir).withColumn("ln_price", F.log("price"))
    return _round_sp(spearman(r, "ln_price", "points"))


@query("avg_rank", sql.orders() + """
, d AS (SELECT CAST(price AS DOUBLE) AS price FROM orders_review WHERE price IS NOT NULL),
g AS (SELECT price, count(*) AS cnt FROM d GROUP BY price)
SELECT price, CAST(cnt AS BIGINT) AS cnt,
       coalesce(sum(cnt) OVER (ORDER BY price ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         + (cnt + 1) / 2.0 AS rank,
       CAST(sum(cnt) OVER () AS BIGINT) AS n
FROM g""")
def avg_rank(spark, sf_dir):
    r = value_ranks(orders_review(spark, sf_dir), "price")
    return r.select("price", F.col("cnt").cast("bigint").alias("cnt"), "rank", F.col("n").cast("bigint").alias("n"))


def _kruskal_sql(src):
    return f"""
, r AS (SELECT g, v, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rk FROM {src}),
gs AS (SELECT g, sum(rk) AS rs, count(*) AS ng FROM r GROUP BY g),
t AS (SELECT sum(c * c * c - c) AS tie, sum(c) AS n FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM {src} GROUP BY v)),
s AS (SELECT count(*) AS k, sum(rs * rs / ng) AS s FROM gs)
SELECT CAST(k AS BIGINT) AS k, CAST(n AS BIGINT) AS n,
       round((12.0 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - tie / (n * n * n - n)), 6) AS h,
       CAST(k - 1 AS BIGINT) AS dof
FROM s, t"""


def _round_kw(df):
    return df.select("k", "n", F.round("h", 6).alias("h"), "dof")


@query("kruskal_country_top10", sql.orders() + """
, top AS (SELECT country FROM orders_review WHERE country IS NOT NULL GROUP BY country
          ORDER BY count(*) DESC, country LIMIT 10),
kd AS (SELECT country AS g, CAST(points AS DOUBLE) AS v FROM orders_review
       WHERE country IN (SELECT country FROM top) AND points IS NOT NULL)""" + _kruskal_sql("kd"))
def kruskal_country_top10(spark, sf_dir):
    r = orders_review(spark, sf_dir).select("country", F.col("points").cast("double").alias("points"))
    kept = r.join(F.broadcast(top_keys(r, "country", 10)), "country", "left_semi")
    return _round_kw(kruskal(kept, "country", "points"))


@query("kruskal_taster", sql.orders() + """
, kd AS (SELECT taster_name AS g, CAST(points AS DOUBLE) AS v FROM orders_review
         WHERE taster_name IS NOT NULL AND points IS NOT NULL)""" + _kruskal_sql("kd"))
def kruskal_taster(spark, sf_dir):
    r = orders_review(spark, sf_dir).select("taster_name", F.col("points").cast("double").alias("points"))
    return _round_kw(kruskal(r, "taster_name", "points"))


#: A tail by Simpson's rule over the density, 20 000 strips.
SIMPSON = "list_sum(list_transform(range(0, 20001), lambda i: (CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * {f})) * {to} / 60000"
T_SQL = SIMPSON.format(to="abs(t)", f="exp(lgamma((v + 1) / 2) - lgamma(v / 2) - ln(v * pi()) / 2 - (v + 1) / 2 * ln(1 + (i * t / 20000) ** 2 / v))")
CHI_SQL = SIMPSON.format(to="h", f="(CASE WHEN i = 0 THEN 0 ELSE exp((dof / 2.0 - 1) * ln(i * h / 20000) - i * h / 40000 - dof / 2.0 * ln(2) - lgamma(dof / 2.0)) END)")


@query("spearman_test", sql.orders() + f"""
, d AS (SELECT CAST(price AS DOUBLE) AS x, CAST(row_id % 97 AS DOUBLE) AS y FROM orders_review
        WHERE price IS NOT NULL),
r AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM d),
c AS (SELECT CAST(count(*) AS DOUBLE) AS n, corr(rx, ry) AS rho FROM r),
s AS (SELECT n, rho, n - 2 AS v, rho * sqrt((n - 2) / (1 - rho * rho)) AS t FROM c)
SELECT CAST(n AS BIGINT) AS n, round(rho, 6) AS rho, round(t, 6) AS t_stat, round(1 - 2 * {T_SQL}, 6) AS p FROM s""")
def spearman_test(spark, sf_dir):
    """T1 with its p: price against a number unrelated to it."""
    r = orders_review(spark, sf_dir).withColumn("other", F.col("row_id") % 97)
    return spearman(r, "price", "other").select("n", *[F.round(c, 6).alias(c) for c in ("rho", "t_stat", "p")])


@query("kruskal_test", sql.orders() + """
, kd AS (SELECT taster_name AS g, CAST(row_id % 97 AS DOUBLE) AS v FROM orders_review WHERE taster_name IS NOT NULL)"""
       + _kruskal_sql("kd").replace("SELECT CAST(k AS BIGINT) AS k", ", res AS (SELECT CAST(k AS BIGINT) AS k").replace(
           "round((12.0", "((12.0").replace("(n * n * n - n)), 6) AS h", "(n * n * n - n))) AS h") + f""")
SELECT k, n, round(h, 6) AS h, dof, round(1 - {CHI_SQL}, 6) AS p FROM res""")
def kruskal_test(spark, sf_dir):
    """T2 with its p: a number unrelated to the taster, by taster."""
    r = orders_review(spark, sf_dir).select("taster_name", (F.col("row_id") % 97).cast("double").alias("other"))
    return kruskal(r, "taster_name", "other").select("k", "n", F.round("h", 6).alias("h"), "dof", F.round("p", 6).alias("p"))


HASH_ORDER = "substr(md5(concat_ws('-', row_id, 42)), 1, 13)"


@query("holdout_split", sql.orders() + f"""
, h AS (SELECT row_id, CAST(points >= 90 AS INTEGER) AS y, {HASH_ORDER} AS hk FROM orders_review),
p AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY hk, row_id) AS pos,
             count(*) OVER (PARTITION BY y) AS nc FROM h)
SELECT row_id, y, CASE WHEN pos <= ceil(0.2 * nc) THEN 'test' ELSE 'train' END AS split FROM p""")
def holdout_split_q(spark, sf_dir):
    r = orders_review(spark, sf_dir).select("row_id", (F.col("points") >= 90).cast("int").alias("y"))
    return holdout_split(r, "y", 0.2, 42).select("row_id", "y", "split")


@query("kfold_assign", sql.docs() + f"""
, h AS (SELECT row_id, quality AS y, {HASH_ORDER} AS hk FROM docs_review WHERE quality IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY hk, row_id) AS pos FROM h)
SELECT row_id, y, CAST((pos - 1) % 5 AS INTEGER) AS fold FROM p""")
def kfold_assign_q(spark, sf_dir):
    d = docs_review(spark, sf_dir).where(F.col("quality").isNotNull()).select(
        "row_id", F.col("quality").alias("y"))
    return kfold_assign(d, "y", 5, 42).select("row_id", "y", "fold")


@query("sample_n", sql.orders() + f"""
SELECT row_id, points, price FROM orders_review ORDER BY {HASH_ORDER}, row_id LIMIT 1500""")
def sample_n_q(spark, sf_dir):
    return sample_n(orders_review(spark, sf_dir).select("row_id", "points", "price"), 1500, 42)

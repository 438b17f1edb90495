"""Clustering queries (K1-K6, A8-A10) on the cleaned orders table and the
embeddings table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabmine.operators.clean import clean_reviews
from tabmine.operators.cluster import (as_vector, assign_fixed, kmeans_best, label_centres, pca_2d,
                                       segment_profiles, silhouette_all, silhouette_sample, standardized_matrix,
                                       sweep)
from tabmine.operators.split import sample_n
from tabmine.plans import sql
from tabmine.plans.registry import query
from tabmine.session import materialize
from tabmine.sources.views import orders_review, table
from tabmine.spec import ORDERS

K_FEATS = ["points", "log_price", "age", "desc_words"]
SEED = ORDERS.seed
#: Rows of the sampled silhouettes.
SAMPLE = EMB_SAMPLE = 15000

EMB_SQL = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""


def _matrix(spark, sf_dir):
    t = clean_reviews(orders_review(spark, sf_dir), ORDERS).table
    return materialize(standardized_matrix(t, K_FEATS), "kmatrix")


@query("kmeans_sweep")
def kmeans_sweep(spark, sf_dir):
    """K3: inertia per k = 2..8 (best of 10 restarts) and silhouette on a
    15 000-row sample."""
    x = _matrix(spark, sf_dir)
    return sweep(x, range(2, 9), 10, SEED, sample_n(x, SAMPLE, SEED))


@query("kmeans_profiles")
def kmeans_profiles(spark, sf_dir):
    """K2 + K5: k = 4, best of 20 restarts, profile per segment."""
    x = _matrix(spark, sf_dir)
    m = kmeans_best(x, 4, 20, SEED)
    return segment_profiles(m.transform(x))


#: Given centres of three segments in (points, desc_words).
CENTRES = [(0, [83.0, 4.0]), (1, [89.0, 6.0]), (2, [96.0, 5.0])]
_D2 = [f"(points - {x}) * (points - {x}) + (desc_words - {y}) * (desc_words - {y})" for _, (x, y) in CENTRES]
_TOPS = "".join(f""",
n_{c} AS (SELECT cluster, {c} AS top, count(*) AS n FROM seg WHERE {c} IS NOT NULL GROUP BY ALL),
t_{c} AS (SELECT cluster, top AS {c}_top FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, top) AS rn
          FROM n_{c}) WHERE rn = 1)""" for c in ("country", "variety"))


@query("segment_profiles_fixed", sql.orders(sql.CLEAN_SQL) + f"""
, d AS (SELECT *, {", ".join(f"{d} AS d{i}" for i, d in enumerate(_D2))} FROM clean),
seg AS (SELECT *, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS cluster FROM d){_TOPS},
m AS (SELECT cluster, CAST(count(*) AS BIGINT) AS n, round(avg(points), 6) AS points, round(avg(age), 6) AS age,
             round(avg(desc_words), 6) AS desc_words, round(avg(high_quality), 6) AS high_quality,
             round(100.0 * count(*) / (SELECT count(*) FROM seg), 1) AS share_pct,
             round(quantile_cont(price, 0.5), 6) AS price_median FROM seg GROUP BY cluster)
SELECT * FROM m LEFT JOIN t_country USING (cluster) LEFT JOIN t_variety USING (cluster)""")
def segment_profiles_fixed(spark, sf_dir):
    """K5, A8-A10 on segments anybody can repeat: the nearest of given centres (ties: the first)."""
    t = clean_reviews(orders_review(spark, sf_dir), ORDERS).table
    seg = assign_fixed(t.withColumn("_at", F.array(*[F.col(c).cast("double") for c in ("points", "desc_words")])), "_at", CENTRES)
    return segment_profiles(materialize(seg, "segments"), ndigits=6)


@query("pca_2d")
def pca_2d_q(spark, sf_dir):
    """K6: explained-variance ratio of two components and the spread of all
    projected rows along each."""
    x = _matrix(spark, sf_dir)
    ev, proj = pca_2d(x, x)
    stats = proj.agg(*[F.avg(f"pc{i}").alias(f"m{i}") for i in (1, 2)],
                     *[F.stddev_pop(f"pc{i}").alias(f"s{i}") for i in (1, 2)], F.count(F.lit(1)).alias("n")).first()
    rows = [(f"pc{i}", float(ev[i - 1]), float(stats[f"s{i}"]), int(stats["n"])) for i in (1, 2)]
    return spark.createDataFrame(rows, "component string, explained_variance double, sample_std double, n bigint")


def _emb(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")


@query("kmeans_assign_fixed", EMB_SQL + """,
u AS (SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM e)
      GROUP BY label, i),
c AS (SELECT label AS cid, list(m ORDER BY i) AS centre FROM u GROUP BY label),
dd AS (SELECT e.vec_id, e.label, c.cid,
              list_sum(list_transform(list_zip(e.v, c.centre), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d2
       FROM e, c),
best AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cid) AS rn FROM dd)
SELECT vec_id, label, CAST(cid AS INTEGER) AS cluster, round(d2, 6) AS d2 FROM best WHERE rn = 1""")
def kmeans_assign_fixed(spark, sf_dir):
    """Nearest of given centres (the per-label mean vectors): labels and
    squared distances (inertia terms)."""
    e = _emb(spark, sf_dir)
    cents = [(int(r["label"]), list(r["centre"])) for r in label_centres(e, "embedding", "label").collect()]
    a = assign_fixed(e, "embedding", sorted(cents))
    return a.select("vec_id", "label", F.col("cluster").cast("int").alias("cluster"), F.round("d2", 6).alias("d2"))


def _silhouette_sql(rows: str, distance: str) -> str:
    """Mean silhouette of ``rows`` by label, ``distance`` an expression over the squared distance d2."""
    return EMB_SQL + f""",
s AS ({rows}),
sq AS (SELECT a.vec_id, a.label AS la, b.label AS lb,
              list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d2
       FROM s a JOIN s b ON a.vec_id <> b.vec_id),
per AS (SELECT vec_id, la, lb, avg({distance}) AS md FROM sq GROUP BY ALL),
ab AS (SELECT vec_id, max(md) FILTER (WHERE la = lb) AS a, min(md) FILTER (WHERE la <> lb) AS b FROM per GROUP BY vec_id)
SELECT CAST(count(*) AS BIGINT) AS n,
       round(avg(CASE WHEN a IS NULL OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
FROM ab"""


@query("silhouette_sample", _silhouette_sql(f"""SELECT * FROM e
    ORDER BY substr(md5(concat_ws('-', vec_id, {SEED})), 1, 13), vec_id LIMIT {EMB_SAMPLE}""", "sqrt(d2)"))
def silhouette_sample_q(spark, sf_dir):
    """K4: exact silhouette with the label as cluster, on the K1 sample of
    15 000 embeddings (both sides draw the same rows; all, where there are fewer)."""
    e = sample_n(_emb(spark, sf_dir).withColumnRenamed("vec_id", "row_id"), EMB_SAMPLE, SEED)
    s = silhouette_sample(e, "embedding", "label")
    return s.select("n", F.round("silhouette", 6).alias("silhouette"))


@query("silhouette_all", _silhouette_sql("SELECT * FROM e", "d2"))
def silhouette_all_q(spark, sf_dir):
    """K4 on every row: squared-Euclidean silhouette, the label as cluster."""
    e = as_vector(_emb(spark, sf_dir), "embedding").withColumn("label", F.col("label").cast("double"))
    value = silhouette_all(e, "features", "label")
    return e.agg(F.count(F.lit(1)).cast("bigint").alias("n")).withColumn("silhouette", F.round(F.lit(value), 6))


@query("pca_points")
def pca_points(spark, sf_dir):
    """K6: every row's first two components and its segment (k = 4)."""
    x = _matrix(spark, sf_dir)
    p = kmeans_best(x, 4, 10, SEED).transform(x).select("row_id", "features", "cluster")
    return pca_2d(x, p)[1]


@query("kmeans_embeddings")
def kmeans_embeddings(spark, sf_dir):
    """K2 on embeddings: k = number of labels, profile of cluster sizes and
    the best training cost."""
    e = as_vector(_emb(spark, sf_dir), "embedding")
    k = e.select("label").distinct().count()
    m = kmeans_best(e, k, 10, SEED)
    p = m.transform(e)
    return p.groupBy("cluster").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                    F.countDistinct("label").cast("bigint").alias("labels")).withColumn(
        "cost", F.lit(float(m.summary.trainingCost)))

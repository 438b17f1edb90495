"""Segmentation (K2-K6): K-Means with restarts, k sweep, exact silhouette,
segment profiles, PCA.

* K-Means is Spark ML's (k-means|| init); "best of R restarts" fits R seeds
  and keeps the lowest training cost (Spark has no n_init).
* Exact Euclidean silhouette by blocks of points: every pair of blocks is one
  group, whose distances NumPy adds up per point and cluster — no pair rows,
  nothing of the points on the driver. Work is quadratic in the rows, so give it
  a sample (K1); ``silhouette_all`` is the linear alternative (Spark's
  evaluator, squared Euclidean).
* Assignment to given centres (``assign_fixed``) is pure column arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmine.operators.prep import fit_medians, fit_scaler, impute, standardize
from tabmine.operators.ranks import exact_quantiles
from tabmine.session import materialize


def standardized_matrix(df: DataFrame, cols: Sequence[str], id_col: str = "row_id",
                        out: str = "features") -> DataFrame:
    """Median-impute, standardise (population std), assemble (K input)."""
    med = fit_medians(df, cols)
    d = impute(df, med)
    d = standardize(d, fit_scaler(d, cols), "_z")
    return VectorAssembler(inputCols=[f"{c}_z" for c in cols], outputCol=out).transform(d)


def kmeans_best(x: DataFrame, k: int, restarts: int = 10, seed: int = 42, max_iter: int = 300,
                tol: float = 1e-4, features: str = "features", parallelism: int = 5):
    """K2: lowest-cost model over ``restarts`` seeds, of equals the first seed's.

    Up to ``parallelism`` seeds are fitted at a time from driver threads: an iteration is one short
    job over as many tasks as ``x`` has partitions, which alone leaves most cores idle.
    """

    def fit(r: int):
        return KMeans(k=k, seed=seed + r, maxIter=max_iter, tol=tol, featuresCol=features, predictionCol="cluster").fit(x)

    with ThreadPoolExecutor(max_workers=max(1, min(restarts, parallelism))) as ex:
        return min(ex.map(fit, range(restarts)), key=lambda m: m.summary.trainingCost)


def silhouettes(own: np.ndarray, sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Silhouette per point from its cluster's place and its distance sums to every cluster."""
    at = np.arange(len(own))
    n = sizes[own]
    a = sums[at, own] / np.maximum(n - 1, 1)
    other = sums / sizes
    other[at, own] = np.inf
    b = other.min(axis=1)
    top = np.maximum(a, b)
    ok = (n > 1) & (top > 0) & np.isfinite(top)
    return np.where(ok, b - a, 0.0) / np.where(ok, top, 1.0)


def _pair_sums(k: int):
    """A pair of blocks to each point's distance sums to the k clusters' points in the other block."""

    def sums(g):
        import pandas as pd
        out = []
        for x, y in (("lb", "rb"), ("rb", "lb")) if g["lb"].iat[0] != g["rb"].iat[0] else (("lb", "rb"),):
            p, q = g[g["b"] == g[x].iat[0]], g[g["b"] == g[y].iat[0]]
            if not len(p) or not len(q):
                continue
            m, v_all = np.stack(q["v"].to_numpy()), np.stack(p["v"].to_numpy())
            member = (q["c"].to_numpy()[:, None] == np.arange(k)).astype(np.float64)
            ids, mm = q["p"].to_numpy(), (m * m).sum(1)
            for lo in range(0, len(v_all), 256):  # at most 256 x block doubles at a time
                v, at = v_all[lo:lo + 256], p["p"].to_numpy()[lo:lo + 256]
                d2 = (v * v).sum(1)[:, None] + mm[None, :] - 2.0 * (v @ m.T)
                d2[at[:, None] == ids[None, :]] = 0.0
                part = pd.DataFrame(np.sqrt(np.maximum(d2, 0.0)) @ member, columns=[f"s{j}" for j in range(k)])
                part.insert(0, "c", p["c"].to_numpy()[lo:lo + 256])
                part.insert(0, "p", at)
                out.append(part)
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ["p", "c", *[f"s{j}" for j in range(k)]]})

    return sums


def silhouette_sample(df: DataFrame, features_array: str, label: str, id_col: str = "row_id",
                      max_rows: int | None = None, block_rows: int = 2048) -> DataFrame:
    """K4: exact mean silhouette (Euclidean) of the rows of ``df``. Columns: n, silhouette.

    Points are dealt at random into blocks of about ``block_rows``. A point goes
    once to each block it meets, every pair of blocks is a group of its own that
    serves both sides, and the sums of a point's groups are added by Spark. The
    driver knows the clusters and their sizes only. There is no bound on rows
    unless ``max_rows`` sets one (more are an error). Singleton clusters score 0;
    rows without a vector or label don't count; without rows the mean is null.
    """
    pts = df.where(F.col(features_array).isNotNull() & F.col(label).isNotNull()).select(
        F.col(features_array).cast("array<double>").alias("v"), F.col(label).alias("name"))
    pts = materialize(pts.withColumns({"r": F.rand(7), "p": F.monotonically_increasing_id()}), "silhouette-points")
    size = {r["name"]: r["n"] for r in pts.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}
    n, names = sum(size.values()), sorted(size)
    if max_rows is not None and n > max_rows:
        raise ValueError(f"more than {max_rows} rows: sample them, or use silhouette_all")
    k, blocks = max(1, len(names)), max(1, -(-n // block_rows))
    codes = df.sparkSession.createDataFrame([(x, i) for i, x in enumerate(names)], pts.select("name").schema.add("c", "integer"))
    at = (pts.join(F.broadcast(codes), "name").withColumn("b", F.floor(F.col("r") * blocks).cast("int"))
          .withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    pairs = at.select("p", "v", "c", "b", F.least("b", "o").alias("lb"), F.greatest("b", "o").alias("rb"))
    cols = [f"s{j}" for j in range(k)]
    schema = ", ".join(["p long", "c int", *[f"{c} double" for c in cols]])
    # as many partitions as pairs (or the session's, if more), or small groups would share a few tasks
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(blocks * (blocks + 1) // 2, 20_000))
    per = pairs.repartition(tasks, "lb", "rb").groupBy("lb", "rb").applyInPandas(_pair_sums(k), schema)
    per = per.groupBy("p", "c").agg(*[F.sum(c).alias(c) for c in cols])
    sizes = np.array([size[x] for x in names])

    def score(batches):
        import pandas as pd
        for b in batches:
            yield pd.DataFrame({"s": silhouettes(b["c"].to_numpy(), b[cols].to_numpy(), sizes) if len(b) else []})

    s = per.mapInPandas(score, "s double")
    return s.agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.avg("s").alias("silhouette"))


def silhouette_all(pred: DataFrame, features: str = "features", cluster: str = "cluster") -> float:
    """Scalable silhouette over every row (squared Euclidean, Spark ML)."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=cluster,
                               distanceMeasure="squaredEuclidean").evaluate(pred)


def sweep(x: DataFrame, ks: Sequence[int], restarts: int, seed: int, sample: DataFrame | None,
          id_col: str = "row_id") -> DataFrame:
    """K3: inertia (training cost) per k and silhouette on the sample."""
    spark = x.sparkSession
    rows = []
    for k in ks:
        m = kmeans_best(x, k, restarts, seed)
        sil = None
        if sample is not None:
            p = m.transform(sample).withColumn("_arr", vector_to_array("features"))
            sil = silhouette_sample(p, "_arr", "cluster", id_col).first()["silhouette"]
        rows.append((int(k), float(m.summary.trainingCost), sil))
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")


def top_level(df: DataFrame, group: str, col: str, out: str) -> DataFrame:
    """(group, out): the most frequent value per group, the smallest on ties; nulls don't count.

    Counts come first, so no task holds a group's whole value map.
    """
    n = df.where(F.col(col).isNotNull()).groupBy(group, F.col(col).alias(out)).agg(F.count(F.lit(1)).alias("_top_n"))
    return n.groupBy(group).agg(F.min_by(out, F.struct(-F.col("_top_n"), F.col(out))).alias(out))


def segment_profiles(pred: DataFrame, cluster: str = "cluster", ndigits: int = 2) -> DataFrame:
    """K5 (A8-A10): size, means, exact median price, top country/variety
    (deterministic mode: smallest value on ties), share %, by mean points."""
    total = pred.count()
    prof = pred.groupBy(cluster).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.round(F.avg("points"), ndigits).alias("points"),
        F.round(F.avg("age"), ndigits).alias("age"),
        F.round(F.avg("desc_words"), ndigits).alias("desc_words"),
        F.round(F.avg(F.col("high_quality").cast("double")), ndigits).alias("high_quality"),
        F.round(100.0 * F.count(F.lit(1)) / F.lit(total), 1).alias("share_pct"))
    med = exact_quantiles(pred, "price", [0.5], [cluster]).select(
        cluster, F.round("price", ndigits).alias("price_median"))
    tops = [top_level(pred, cluster, c, f"{c}_top") for c in ("country", "variety")]
    for part in (*tops, med):
        prof = prof.join(part, cluster, "left")
    return prof.orderBy(F.desc("points"))


def pca_2d(x: DataFrame, sample: DataFrame, features: str = "features", k: int = 2):
    """K6: explained-variance ratios and the projected sample."""
    m = PCA(k=k, inputCol=features, outputCol="pc").fit(x)
    proj = m.transform(sample).withColumn("_pc", vector_to_array("pc"))
    return list(m.explainedVariance.toArray()), proj.select(
        *[c for c in sample.columns if c != features],
        *[F.col("_pc")[i].alias(f"pc{i + 1}") for i in range(k)])


def label_centres(df: DataFrame, vec: str, label: str) -> DataFrame:
    """Per-label mean vector (fixed centres) via a summed array aggregate."""
    dim = len(df.select(vec).first()[0])
    agg = df.groupBy(label).agg(
        *[F.avg(F.col(vec)[i].cast("double")).alias(f"c{i}") for i in range(dim)])
    return agg.select(label, F.array(*[F.col(f"c{i}") for i in range(dim)]).alias("centre"))


def assign_fixed(df: DataFrame, vec: str, centres: list[tuple[int, list[float]]]) -> DataFrame:
    """Nearest given centre (k is small: one distance expression per centre)."""
    v = F.col(vec).cast("array<double>")
    dists = []
    for cid, c in centres:
        lit = F.array(*[F.lit(float(x)) for x in c])
        d2 = F.aggregate(F.zip_with(v, lit, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
        dists.append(F.struct(d2.alias("d2"), F.lit(cid).alias("cid")))
    best = F.array_min(F.array(*dists))
    return df.withColumn("_best", best).withColumn("cluster", F.col("_best.cid")).withColumn(
        "d2", F.col("_best.d2")).drop("_best")


def as_vector(df: DataFrame, arr: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(arr).cast("array<double>")))

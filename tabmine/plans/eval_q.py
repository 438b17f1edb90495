"""Evaluation queries on the fixed-weight ``scored`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabmine.operators.metrics import (average_precision, binary_metrics, calibration,
                                       calibration_edges, confusion, curve_points, cv_test_gap, leaderboard,
                                       metric_deltas, operating_points, roc_auc)
from tabmine.operators.bucket_boot import bucket_ci, bucket_paired
from tabmine.operators.explain import importance, permutation_keys
from tabmine.operators.resample import bootstrap_ci, bootstrap_paired
from tabmine.operators.slices import boundary_error_share, error_by, error_by_band, error_when
from tabmine.operators.split import holdout_split, kfold_assign
from tabmine.plans import sql
from tabmine.plans.registry import query
from tabmine.session import materialize
from tabmine.sources.views import orders_review, scored
from tabmine.spec import ORDERS

COUNTS_SQL = """
, k AS (SELECT model,
               CAST(count(*) FILTER (WHERE y = 1 AND p >= 0.5) AS DOUBLE) AS tp,
               CAST(count(*) FILTER (WHERE y = 0 AND p >= 0.5) AS DOUBLE) AS fp,
               CAST(count(*) FILTER (WHERE y = 1 AND p < 0.5) AS DOUBLE) AS fn,
               CAST(count(*) FILTER (WHERE y = 0 AND p < 0.5) AS DOUBLE) AS tn,
               avg((p - y) ^ 2) AS brier
        FROM scored GROUP BY model),
bm AS (SELECT model, tp, fp, fn, tn,
              round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
              round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
              round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
              round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
              round(CASE WHEN (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) > 0
                         THEN (tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
                         ELSE 0 END, 6) AS mcc,
              round(brier, 6) AS brier
       FROM k)"""

CUM_SQL = """
, sa AS (SELECT model, p, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM scored GROUP BY model, p),
cum AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before,
               coalesce(sum(pos) OVER (PARTITION BY model ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_before,
               sum(pos) OVER (PARTITION BY model) AS pos_total, sum(neg) OVER (PARTITION BY model) AS neg_total
        FROM sa),
auc AS (SELECT model, round(sum(pos * (neg_before + 0.5 * neg)) / (any_value(pos_total) * any_value(neg_total)), 6) AS roc_auc
        FROM cum GROUP BY model),
ap AS (SELECT model, round(sum(pos / pos_total * (pos_total - pos_before)
                                / ((pos_total - pos_before) + (neg_total - neg_before))), 6) AS avg_precision
       FROM cum GROUP BY model),
cp AS (SELECT model, p AS threshold,
              round((pos_total - pos_before) / pos_total, 6) AS tpr,
              round((neg_total - neg_before) / neg_total, 6) AS fpr,
              round((pos_total - pos_before) / ((pos_total - pos_before) + (neg_total - neg_before)), 6) AS precision,
              round((pos_total - pos_before) / pos_total, 6) AS recall
       FROM cum)"""


def _bm(df):
    return df.select("model", *[F.col(c).cast("double").alias(c) for c in ("tp", "fp", "fn", "tn")],
                     "accuracy", "precision", "recall", "f1", "mcc", "brier")


@query("binary_metrics", sql.scores() + COUNTS_SQL + " SELECT * FROM bm")
def binary_metrics_q(spark, sf_dir):
    return _bm(binary_metrics(scored(spark, sf_dir)))


@query("roc_auc", sql.scores() + CUM_SQL + " SELECT * FROM auc")
def roc_auc_q(spark, sf_dir):
    return roc_auc(scored(spark, sf_dir))


@query("avg_precision", sql.scores() + CUM_SQL + " SELECT * FROM ap")
def avg_precision_q(spark, sf_dir):
    return average_precision(scored(spark, sf_dir))


@query("roc_points", sql.scores() + CUM_SQL + " SELECT model, threshold, tpr, fpr FROM cp")
def roc_points(spark, sf_dir):
    return curve_points(scored(spark, sf_dir)).select("model", "threshold", "tpr", "fpr")


@query("pr_points", sql.scores() + CUM_SQL + " SELECT model, threshold, precision, recall FROM cp")
def pr_points(spark, sf_dir):
    return curve_points(scored(spark, sf_dir)).select("model", "threshold", "precision", "recall")


@query("operating_points", sql.scores() + CUM_SQL + """
, op AS (SELECT model, (pos_total - pos_before) / pos_total AS recall, (neg_total - neg_before) / neg_total AS fpr,
                (pos_total - pos_before) / ((pos_total - pos_before) + (neg_total - neg_before)) AS precision FROM cum)
SELECT model, round(max(recall) FILTER (WHERE fpr <= 0.05), 6) AS tpr_at_fpr,
       round(max(precision) FILTER (WHERE recall >= 0.7), 6) AS precision_at_recall_7,
       round(max(precision) FILTER (WHERE recall >= 0.8), 6) AS precision_at_recall_8
FROM op GROUP BY model""")
def operating_points_q(spark, sf_dir):
    return operating_points(curve_points(scored(spark, sf_dir), ndigits=None))


@query("leaderboard", sql.scores() + COUNTS_SQL + CUM_SQL + """
SELECT bm.model, accuracy, precision, recall, f1, mcc, brier, roc_auc, avg_precision
FROM bm JOIN auc USING (model) JOIN ap USING (model) ORDER BY roc_auc DESC""")
def leaderboard_q(spark, sf_dir):
    return leaderboard(scored(spark, sf_dir)).orderBy(F.desc("roc_auc"))


@query("metric_deltas", sql.scores() + COUNTS_SQL + CUM_SQL + """
, lb AS (SELECT bm.model, accuracy, f1, roc_auc FROM bm JOIN auc USING (model)),
lg AS (UNPIVOT lb ON accuracy, f1, roc_auc INTO NAME metric VALUE value)
SELECT a.model AS a, b.model AS b, a.metric, round(a.value - b.value, 6) AS delta
FROM lg a JOIN lg b ON a.metric = b.metric WHERE a.model = 'mixed' AND b.model = 'price_only'""")
def metric_deltas_q(spark, sf_dir):
    lb = leaderboard(scored(spark, sf_dir))
    return metric_deltas(lb, [("mixed", "price_only")], ["accuracy", "f1", "roc_auc"])


GAP_METRICS = ["accuracy", "brier", "roc_auc"]


@query("cv_test_gap", sql.scores() + """
, hs AS (SELECT row_id, y, substr(md5(concat_ws('-', row_id, 42)), 1, 13) AS h,
                row_number() OVER (PARTITION BY y ORDER BY substr(md5(concat_ws('-', row_id, 42)), 1, 13), row_id) AS pos,
                count(*) OVER (PARTITION BY y) AS nc FROM scored WHERE model = 'mixed'),
parts AS (SELECT row_id, 'test' AS part FROM hs WHERE pos <= ceil(0.2 * nc) UNION ALL
          SELECT row_id, CAST((row_number() OVER (PARTITION BY y ORDER BY h, row_id) - 1) % 5 AS VARCHAR) AS part
          FROM hs WHERE pos > ceil(0.2 * nc)),
g AS (SELECT s.model, part, y, p FROM scored s JOIN parts USING (row_id)),
sa AS (SELECT model, part, p, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM g GROUP BY ALL),
cum AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model, part ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM sa),
au AS (SELECT model, part, round(sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM cum GROUP BY ALL),
ot AS (SELECT model, part, round(avg(CAST((p >= 0.5) = (y = 1) AS DOUBLE)), 6) AS accuracy,
              round(avg((p - y) * (p - y)), 6) AS brier FROM g GROUP BY ALL),
lg AS (UNPIVOT (SELECT * FROM ot JOIN au USING (model, part)) ON accuracy, brier, roc_auc INTO NAME metric VALUE value),
f AS (SELECT model, metric, CAST(count(*) AS BIGINT) AS folds, round(avg(value), 6) AS cv_mean
      FROM lg WHERE part <> 'test' GROUP BY ALL)
SELECT model, metric, folds, cv_mean, value AS test, round(cv_mean - value, 6) AS gap
FROM f JOIN (SELECT model, metric, value FROM lg WHERE part = 'test') USING (model, metric)""")
def cv_test_gap_q(spark, sf_dir):
    """Five folds of the training rows against the hold-out, per model and metric."""
    s = scored(spark, sf_dir).select("model", "row_id", "y", "p")
    split = materialize(holdout_split(s.where("model = 'mixed'").select("row_id", "y"), "y", 0.2, ORDERS.seed), "gap-split")
    folds = kfold_assign(split.where("split = 'train'").select("row_id", "y"), "y", 5, ORDERS.seed)
    part = split.where("split = 'test'").select("row_id", "split").unionAll(folds.select("row_id", F.col("fold").cast("string")))
    board = materialize(leaderboard(s.join(part.withColumnRenamed("split", "part"), "row_id"), ("model", "part")), "gap-board")
    return cv_test_gap(board.where("part <> 'test'"), board.where("part = 'test'"), GAP_METRICS)


@query("confusion", sql.scores() + COUNTS_SQL + """
SELECT model, y, pred, CAST(n AS BIGINT) AS n FROM (
  SELECT model, 0 AS y, 0 AS pred, tn AS n FROM k UNION ALL SELECT model, 0, 1, fp FROM k
  UNION ALL SELECT model, 1, 0, fn FROM k UNION ALL SELECT model, 1, 1, tp FROM k)""")
def confusion_q(spark, sf_dir):
    return confusion(scored(spark, sf_dir))


CAL_CASE = " + ".join(f"CAST(p > {e!r} AS INTEGER)" for e in calibration_edges(10))


@query("calibration", sql.scores() + f"""
SELECT model, {CAL_CASE} AS bin, CAST(count(*) AS BIGINT) AS n, round(avg(p), 6) AS mean_p,
       round(avg(CAST(y AS DOUBLE)), 6) AS frac_pos
FROM scored GROUP BY ALL""")
def calibration_q(spark, sf_dir):
    return calibration(scored(spark, sf_dir))


BOOT_B = 300


def _boot_sql(models_filter: str, select_tail: str) -> str:
    return sql.scores() + f"""
, sc AS (SELECT * FROM scored WHERE {models_filter}),
ids AS (SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS idx FROM (SELECT DISTINCT row_id FROM sc)),
nn AS (SELECT count(*) AS n FROM ids),
dr AS (SELECT k // n AS rep, k % n AS i, n FROM (SELECT unnest(range(0, {BOOT_B} * n)) AS k, n FROM nn)),
draws AS (SELECT rep, CAST(('0x' || substr(md5(concat_ws('-', rep, i, 42)), 1, 8)) AS BIGINT) % n AS idx,
                 count(*) AS w FROM dr GROUP BY ALL),
rw AS (SELECT d.rep, s.model, s.y, s.p, d.w FROM sc s JOIN ids USING (row_id) JOIN draws d ON d.idx = ids.idx),
ra AS (SELECT rep, model, p, CAST(sum(w * y) AS DOUBLE) AS pos, CAST(sum(w * (1 - y)) AS DOUBLE) AS neg
       FROM rw GROUP BY ALL),
rc AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY rep, model ORDER BY p
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb,
              sum(pos) OVER (PARTITION BY rep, model) AS pt, sum(neg) OVER (PARTITION BY rep, model) AS nt FROM ra),
rauc AS (SELECT rep, model, sum(pos * (nb + 0.5 * neg)) / (any_value(pt) * any_value(nt)) AS v FROM rc GROUP BY ALL),
rk AS (SELECT rep, model, CAST(sum(w) FILTER (WHERE y = 1 AND p >= 0.5) AS DOUBLE) AS tp,
              CAST(coalesce(sum(w) FILTER (WHERE y = 0 AND p >= 0.5), 0) AS DOUBLE) AS fp,
              CAST(coalesce(sum(w) FILTER (WHERE y = 1 AND p < 0.5), 0) AS DOUBLE) AS fn
       FROM rw GROUP BY ALL),
rf1 AS (SELECT rep, model, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS v FROM rk)
{select_tail}"""


@query("bootstrap_ci", _boot_sql("TRUE", """
, vals AS (SELECT model, 'roc_auc' AS metric, v FROM rauc UNION ALL SELECT model, 'f1', v FROM rf1)
SELECT model, metric, round(quantile_cont(v, 0.025), 6) AS lo, round(quantile_cont(v, 0.975), 6) AS hi
FROM vals GROUP BY model, metric"""))
def bootstrap_ci_q(spark, sf_dir):
    return bootstrap_ci(scored(spark, sf_dir), B=BOOT_B, seed=42)


@query("bootstrap_paired", _boot_sql("model IN ('mixed', 'price_only')", """
, d AS (SELECT rep, max(v) FILTER (WHERE model = 'mixed') - max(v) FILTER (WHERE model = 'price_only') AS d
        FROM rauc GROUP BY rep)
SELECT 'mixed' AS model_a, 'price_only' AS model_b, round(quantile_cont(d, 0.025), 6) AS lo,
       round(quantile_cont(d, 0.975), 6) AS hi FROM d"""))
def bootstrap_paired_q(spark, sf_dir):
    return bootstrap_paired(scored(spark, sf_dir), "mixed", "price_only", B=BOOT_B, seed=42)


def _bucket_sql(buckets: str, tail: str) -> str:
    """The hashed Poisson draws of ``bucket_boot`` over ``buckets`` (model, p, base, pos, neg)."""
    def draw(n, stream):
        # the second half of the list is the second uniform, for counts without a table
        u = [f"((x{s} * 48271 + 11) % 2147483647 + 0.5) / 2147483647" for s in (stream, stream + 2)]
        z = f"(sqrt(-2 * ln({u[0]})) * cos(2 * pi() * {u[1]}))"
        return (f"CASE WHEN {n} = 0 THEN 0 WHEN {n} <= 64 THEN len(list_filter(c{stream}.cdf, lambda t: t < {u[0]})) "
                f"ELSE greatest(floor({n} + sqrt({n}) * {z} + ({z} * {z} - 1) / 6 + 0.5), 0) END")
    first = ", ".join(f"(b * 48271 % 2147483647 + (rep * 4 + {s + 1}) * 69621) % 2147483647 AS a{s}" for s in range(4))
    second = ", ".join(f"(a{s} * a{s} % 2147483647 + (b % 65536 + 1) * 40692) % 2147483647 AS a{s}" for s in range(4))
    third = ", ".join(f"a{s} * a{s} % 2147483647 AS x{s}" for s in range(4))
    return sql.scores().replace("WITH ", "WITH RECURSIVE ", 1) + f"""
, {buckets},
pois AS (SELECT CAST(m AS BIGINT) AS m, 0 AS k, exp(CAST(-m AS DOUBLE)) AS t, exp(CAST(-m AS DOUBLE)) AS c FROM range(1, 65) r(m)
         UNION ALL SELECT m, k + 1, t * m / (k + 1), c + t * m / (k + 1) FROM pois WHERE k + 1 < CAST(floor(m + 12 * sqrt(m) + 20) AS INT)),
cdfs AS (SELECT m, list(c ORDER BY k) AS cdf FROM pois GROUP BY m),
h1 AS (SELECT model, p, pos, neg, b, rep, {first} FROM (SELECT *, base % 2147483647 AS b FROM buckets), range({BOOT_B}) r(rep)),
h2 AS (SELECT model, p, pos, neg, rep, {second} FROM h1),
h3 AS (SELECT model, p, pos, neg, rep, {third} FROM h2),
w AS (SELECT model, p, rep, {draw("pos", 0)} AS pos, {draw("neg", 1)} AS neg
      FROM h3 LEFT JOIN cdfs c0 ON c0.m = h3.pos LEFT JOIN cdfs c1 ON c1.m = h3.neg),
g AS (SELECT model, p, rep, CAST(sum(pos) AS DOUBLE) AS pos, CAST(sum(neg) AS DOUBLE) AS neg FROM w GROUP BY ALL),
cum AS (SELECT *, sum(neg) OVER (PARTITION BY model, rep ORDER BY p) - neg AS nb FROM g),
reps AS (SELECT model, rep, sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc,
                2 * coalesce(sum(pos) FILTER (WHERE p >= 0.5), 0)
                  / (coalesce(sum(pos) FILTER (WHERE p >= 0.5), 0) + coalesce(sum(neg) FILTER (WHERE p >= 0.5), 0) + sum(pos)) AS f1
         FROM cum GROUP BY model, rep)
{tail}"""


@query("bootstrap_buckets", _bucket_sql("""
buckets AS (SELECT model, p, min(row_id) AS base, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg
            FROM scored GROUP BY model, p)""", """
SELECT model, metric, round(quantile_cont(v, 0.025), 6) AS lo, round(quantile_cont(v, 0.975), 6) AS hi
FROM (SELECT model, 'roc_auc' AS metric, auc AS v FROM reps UNION ALL SELECT model, 'f1', f1 FROM reps) GROUP BY model, metric"""))
def bootstrap_buckets(spark, sf_dir):
    """E15 on score buckets: the rows shuffled do not grow with the replicates."""
    return bucket_ci(scored(spark, sf_dir), B=BOOT_B)


@query("bootstrap_buckets_paired", _bucket_sql("""
joint AS (SELECT a, b, min(row_id) AS base, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg FROM (
            SELECT row_id, y, max(p) FILTER (WHERE model = 'mixed') AS a, max(p) FILTER (WHERE model = 'price_only') AS b
            FROM scored GROUP BY row_id, y) GROUP BY a, b),
buckets AS (SELECT 'mixed' AS model, a AS p, base, pos, neg FROM joint UNION ALL SELECT 'price_only', b, base, pos, neg FROM joint)""", """
, d AS (SELECT rep, max(auc) FILTER (WHERE model = 'mixed') - max(auc) FILTER (WHERE model = 'price_only') AS d FROM reps GROUP BY rep)
SELECT 'mixed' AS model_a, 'price_only' AS model_b, round(quantile_cont(d, 0.025), 6) AS lo, round(quantile_cont(d, 0.975), 6) AS hi FROM d"""))
def bootstrap_buckets_paired(spark, sf_dir):
    """E16 on joint score buckets."""
    return bucket_paired(scored(spark, sf_dir), "mixed", "price_only", B=BOOT_B)


PERM_FEATURES = ("price", "customer_id")


def _perm_sql() -> str:
    keys = " UNION ALL ".join(f"SELECT '{f}' AS feature, {r} AS rep, {permutation_keys(f, r, 42)} AS keys"
                              for f in PERM_FEATURES for r in range(5))
    once = """list_reduce(list_concat([{x}], keys), lambda s, k: (s % a) * a + ((s // a)
      + (((s % a) * 48271 + k) % 2147483647 * (((s % a) * 48271 + k) % 2147483647) % 2147483647 * 69621 + 11) % 2147483647) % a)"""
    score = "round(1.0 / (1.0 + exp(-(({c} % 13 - 6) / 2.5 + (coalesce({p}, 150000.0) / 70000 - 3) / 1.5))), 4)"
    auc = """(SELECT feature, rep, sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc FROM (
       SELECT *, sum(neg) OVER (PARTITION BY feature, rep ORDER BY p) - neg AS nb FROM (
         SELECT feature, rep, p, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM {t} GROUP BY ALL)) GROUP BY ALL)"""
    return sql.orders().replace("WITH ", "WITH RECURSIVE ", 1) + f"""
, x AS (SELECT row_number() OVER (ORDER BY row_id) - 1 AS i, count(*) OVER () AS n, price, customer_id,
               CAST(points >= 90 AS INTEGER) AS y FROM orders_review),
keyed AS (SELECT x.*, greatest(2, CAST(ceil(sqrt(n)) AS BIGINT)) AS a, feature, rep, keys FROM x, ({keys})),
walk AS (SELECT i, n, a, feature, rep, keys, {once.format(x="i")} AS spot FROM keyed
         UNION ALL SELECT i, n, a, feature, rep, keys, {once.format(x="spot")} FROM walk WHERE spot >= n),
moved AS (SELECT feature, rep, r.y, {score.format(
    c="(CASE WHEN feature = 'customer_id' THEN d.customer_id ELSE r.customer_id END)",
    p="(CASE WHEN feature = 'price' THEN d.price ELSE r.price END)")} AS p
          FROM walk JOIN x r ON r.i = walk.i JOIN x d ON d.i = walk.spot WHERE walk.spot < walk.n),
plain AS (SELECT '' AS feature, 0 AS rep, y, {score.format(c="customer_id", p="price")} AS p FROM x)
SELECT m.feature, round(any_value(b.auc) - avg(m.auc), 6) AS delta_auc
FROM {auc.format(t="moved")} m, {auc.format(t="plain")} b GROUP BY m.feature"""


@query("perm_importance_fixed", _perm_sql())
def perm_importance_fixed(spark, sf_dir):
    """E13 on a fixed-weight score over all rows."""
    rows = orders_review(spark, sf_dir).select("row_id", "price", "customer_id", (F.col("points") >= 90).cast("int").alias("y"))
    z = (F.col("customer_id") % 13 - 6) / 2.5 + (F.coalesce("price", F.lit(150000.0)) / 70000 - 3) / 1.5
    return importance(rows, lambda d: d.withColumn("p", F.round(1 / (1 + F.exp(-z)), 4)), PERM_FEATURES, 5, 42)


BAND = sql.band_case("price", ORDERS.band_edges, ORDERS.band_labels)
ERR = "CAST(y <> CAST(p >= 0.5 AS INTEGER) AS DOUBLE)"


@query("error_by_band", sql.scores() + f"""
SELECT model, band, CAST(count(*) AS BIGINT) AS n, round(avg(e), 6) AS error_rate
FROM (SELECT model, {BAND} AS band, {ERR} AS e FROM scored) WHERE band IS NOT NULL GROUP BY ALL""")
def error_by_band_q(spark, sf_dir):
    return error_by_band(scored(spark, sf_dir), "price", ORDERS.band_edges, ORDERS.band_labels)


@query("error_by_taster", sql.scores() + f"""
SELECT model, taster_name, CAST(count(*) AS BIGINT) AS n, round(avg({ERR}), 6) AS error_rate
FROM scored WHERE taster_name IS NOT NULL GROUP BY ALL""")
def error_by_taster(spark, sf_dir):
    return error_by(scored(spark, sf_dir), "taster_name")


@query("error_price_missing", sql.scores() + f"""
SELECT model, CAST(count(*) AS BIGINT) AS n, round(avg({ERR}), 6) AS error_rate
FROM scored WHERE price_missing = 1 GROUP BY model""")
def error_price_missing(spark, sf_dir):
    return error_when(scored(spark, sf_dir), F.col("price_missing") == 1)


@query("error_by_points", sql.scores() + f"""
SELECT model, points, CAST(count(*) AS BIGINT) AS n, round(avg({ERR}), 6) AS error_rate
FROM scored GROUP BY ALL""")
def error_by_points(spark, sf_dir):
    return error_by(scored(spark, sf_dir), "points")


@query("error_boundary_share", sql.scores() + f"""
SELECT model, CAST(sum({ERR}) AS BIGINT) AS errors,
       round(sum({ERR}) FILTER (WHERE points BETWEEN 89 AND 91) / nullif(sum({ERR}), 0), 6) AS share_near_boundary
FROM scored GROUP BY model""")
def error_boundary_share(spark, sf_dir):
    return boundary_error_share(scored(spark, sf_dir), "points", 89, 91)

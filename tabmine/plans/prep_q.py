"""Feature-preparation queries (F1-F8) on the cleaned orders table split by M1,
and TF-IDF (F6) on the documents."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabmine.operators.clean import clean_reviews
from tabmine.operators.levels import INFREQUENT, MISSING, fit_levels
from tabmine.operators.prep import TabularPrep, fit_medians, fit_scaler, impute
from tabmine.operators.split import holdout_split
from tabmine.operators.tfidf import doc_terms, english_stop_words, relational_tfidf, vocabulary
from tabmine.plans import sql
from tabmine.plans.registry import query
from tabmine.session import materialize
from tabmine.sources.views import docs_review, orders_review
from tabmine.spec import ORDERS

NUM = list(ORDERS.spec.num)
MIN_FREQ = ORDERS.min_freq


def split_clean(spark, sf_dir):
    """Cleaned orders table + stratified 80/20 split (exact mode)."""
    t = clean_reviews(orders_review(spark, sf_dir), ORDERS).table
    return materialize(holdout_split(t, "high_quality", 0.2, ORDERS.seed), "split")


def train_rows(spark, sf_dir):
    return split_clean(spark, sf_dir).where(F.col("split") == "train")


SPLIT_SQL = sql.orders(sql.CLEAN_SQL) + """
, hs AS (SELECT *, row_number() OVER (PARTITION BY high_quality
                                       ORDER BY substr(md5(concat_ws('-', row_id, 42)), 1, 13), row_id) AS pos,
                count(*) OVER (PARTITION BY high_quality) AS nc FROM clean),
train AS (SELECT * EXCLUDE (pos, nc) FROM hs WHERE pos > ceil(0.2 * nc)),
test AS (SELECT * EXCLUDE (pos, nc) FROM hs WHERE pos <= ceil(0.2 * nc))"""


@query("impute_median", SPLIT_SQL + " SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(quantile_cont({c}, 0.5), 6) AS median FROM train" for c in NUM) + ")")
def impute_median(spark, sf_dir):
    med = fit_medians(train_rows(spark, sf_dir), NUM)
    return spark.createDataFrame([(c, round(v, 6)) for c, v in med.items()], "column string, median double")


@query("standardize", SPLIT_SQL + ", med AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.5) AS m_{c}" for c in NUM) + " FROM train) SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg(coalesce({c}, m_{c})), 6) AS mean, "
    f"round(stddev_pop(coalesce({c}, m_{c})), 6) AS std FROM train, med" for c in NUM) + ")")
def standardize_q(spark, sf_dir):
    tr = train_rows(spark, sf_dir)
    st = fit_scaler(impute(tr, fit_medians(tr, NUM)), NUM)
    return spark.createDataFrame([(c, round(m, 6), round(s, 6)) for c, (m, s) in st.items()],
                                 "column string, mean double, std double")


LEVEL_COLS = ("country", "taster_name", "winery")


def _level_rows(spark, sf_dir):
    """Training rows with the columns whose levels are learned."""
    t = clean_reviews(orders_review(spark, sf_dir), ORDERS).table
    t = t.join(orders_review(spark, sf_dir).select("row_id", "winery"), "row_id")
    return holdout_split(t, "high_quality", 0.2, ORDERS.seed).where(F.col("split") == "train").select(*LEVEL_COLS)


LEVELS_SQL = SPLIT_SQL.replace("FROM clean),", "FROM clean JOIN (SELECT row_id, winery FROM orders_review) USING (row_id)),") + """
, lv AS (SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", coalesce(CAST({c} AS VARCHAR), '{MISSING}') AS level FROM train"
    for c in LEVEL_COLS) + f""")),
g AS (SELECT "column", level, CAST(count(*) AS BIGINT) AS n FROM lv GROUP BY ALL),
pooled AS (SELECT *, CASE WHEN n >= {MIN_FREQ} THEN level ELSE '{INFREQUENT}' END AS pooled FROM g)"""


@query("rare_onehot", LEVELS_SQL + " SELECT * FROM pooled")
def rare_onehot(spark, sf_dir):
    """Training counts per level and the pooled level the fitted table gives it."""
    tr = _level_rows(spark, sf_dir)
    d = fit_levels(tr, LEVEL_COLS, MIN_FREQ).attach(tr, level="_lv")
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(c, F.lit(MISSING)).alias("level"),
                                         F.col(f"{c}_lv").alias("pooled")) for c in LEVEL_COLS]))
    return d.select(pairs.alias("x")).groupBy("x.column", "x.level", "x.pooled").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


@query("rare_ordinal", LEVELS_SQL + """
SELECT "column", pooled, CAST(dense_rank() OVER (PARTITION BY "column" ORDER BY pooled) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT "column", pooled FROM pooled)""")
def rare_ordinal(spark, sf_dir):
    """Ordinal code of each pooled level: the fitted table itself."""
    t = fit_levels(_level_rows(spark, sf_dir), LEVEL_COLS, MIN_FREQ).table
    return t.select("column", F.col("level").alias("pooled"), F.col("code").cast("int").alias("code"))


CAT = list(ORDERS.spec.cat)


@query("encoded_rows", SPLIT_SQL + "".join(f"""
, n_{c} AS (SELECT coalesce(CAST({c} AS VARCHAR), '{MISSING}') AS lv, count(*) AS n FROM train GROUP BY 1),
k_{c} AS (SELECT lv, CAST(dense_rank() OVER (ORDER BY lv) - 1 AS BIGINT) AS code
          FROM (SELECT DISTINCT CASE WHEN n >= {MIN_FREQ} THEN lv ELSE '{INFREQUENT}' END AS lv FROM n_{c})),
o_{c} AS (SELECT coalesce(max(CASE WHEN lv = '{INFREQUENT}' THEN code END), count(*)) AS other FROM k_{c})""" for c in CAT) + """
SELECT h.row_id, """ + ", ".join(f"coalesce(k_{c}.code, o_{c}.other) AS {c}" for c in CAT) + """,
       CAST(""" + " + ".join(f"h.{b}" for b in ORDERS.spec.bin) + """ AS BIGINT) AS flags
FROM hs h""" + "".join(f" LEFT JOIN k_{c} ON coalesce(CAST(h.{c} AS VARCHAR), '{MISSING}') = k_{c}.lv"
                       for c in CAT) + "".join(f" CROSS JOIN o_{c}" for c in CAT))
def encoded_rows(spark, sf_dir):
    """every row's codes and flags read back from the product's own one-hot vector."""
    d = split_clean(spark, sf_dir)
    fp = TabularPrep(ORDERS.spec, MIN_FREQ, onehot=True).fit(d.where(F.col("split") == "train"))
    v = fp.transform(d).select("row_id", vector_to_array("features").alias("v"))
    at = len(NUM)
    flags = F.aggregate(F.slice("v", at + 1, len(ORDERS.spec.bin)), F.lit(0.0), lambda s, x: s + x)
    at += len(ORDERS.spec.bin)
    codes = []
    for c in CAT:
        w = fp.levels.width(c)
        codes.append((F.array_position(F.slice("v", at + 1, w), 1.0) - 1).alias(c))
        at += w
    return v.select("row_id", *codes, flags.cast("bigint").alias("flags"))


@query("assemble_features")
def assemble_features(spark, sf_dir):
    """Prep fitted on train, applied to all rows; vector width and
    non-zeros per row (rows-only check; the constants are checked above)."""
    d = split_clean(spark, sf_dir)
    fp = TabularPrep(ORDERS.spec, MIN_FREQ, onehot=True).fit(d.where(F.col("split") == "train"))
    v = fp.transform(d)
    arr = vector_to_array("features")
    return v.select("row_id", "split", F.size(arr).alias("width"),
                    F.size(F.filter(arr, lambda x: x != 0)).alias("nnz"))


STOP = english_stop_words()
STOP_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP)
TERMS_SQL = sql.docs() + f"""
, dt AS (SELECT row_id, description FROM docs_review),
tok AS (SELECT row_id, list_filter(regexp_extract_all(lower(description), '[a-z0-9_]{{2,}}'),
                                   lambda w: w NOT IN ({STOP_SQL})) AS t FROM dt),
grams AS (SELECT row_id, CASE WHEN len(t) >= 2
                              THEN list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))
                              ELSE t END AS g FROM tok),
terms AS (SELECT row_id, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT row_id, unnest(g) AS term FROM grams)
          GROUP BY ALL),
vocab AS (SELECT term, CAST(count(*) AS BIGINT) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM terms GROUP BY term
          HAVING count(*) >= 5 ORDER BY cf DESC, term LIMIT 20000)"""


def _texts(spark, sf_dir):
    return docs_review(spark, sf_dir).select("row_id", "description")


@query("tfidf_vocab", TERMS_SQL + " SELECT * FROM vocab")
def tfidf_vocab(spark, sf_dir):
    return vocabulary(doc_terms(_texts(spark, sf_dir), "row_id", "description"), "row_id", 5, 20000)


@query("tfidf_terms", TERMS_SQL + """
, nd AS (SELECT count(*) AS n FROM dt),
w AS (SELECT terms.row_id, terms.term, terms.tf,
             (1 + ln(terms.tf)) * (ln((1.0 + n) / (1 + df)) + 1) AS w
      FROM terms JOIN vocab USING (term), nd),
nrm AS (SELECT row_id, sqrt(sum(w * w)) AS nrm FROM w GROUP BY row_id)
SELECT row_id, term, tf, round(w / nrm, 6) AS weight FROM w JOIN nrm USING (row_id)""")
def tfidf_terms(spark, sf_dir):
    t = relational_tfidf(_texts(spark, sf_dir), "row_id", "description", 5, 20000)
    return t.withColumn("weight", F.round("weight", 6))

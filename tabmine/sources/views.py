"""Review-shaped views derived from the driver tables.

The driver tables have no nulls and no vintage tokens, so missingness and
years are derived from the keys with arithmetic that Spark and DuckDB compute
identically. Each view exists twice: as a DataFrame plan (what the library
runs) and as a SQL CTE (what the DuckDB oracle runs); ``tests/`` checks that
both give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders ⋈ customer ⋈ nation ⋈ region shaped like the review table.

    The three dimension tables are bounded by the customer count and joined
    by key; Spark picks broadcast vs shuffle from their size at run time.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                             "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(n, c.c_nationkey == n.n_nationkey)
          .join(r, n.n_regionkey == r.r_regionkey))
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    s = lambda x: x.cast("string")
    return j.select(
        k.alias("row_id"),
        ck.alias("customer_id"),
        F.when(k % 211 != 0, F.col("n_name")).alias("country"),
        F.concat(F.lit(" "), F.col("o_orderstatus"), F.lit("  "), F.col("o_orderpriority"),
                 F.lit(" order ")).alias("description"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("designation"),
        (F.lit(80) + (k * 7 + ck) % 13 + F.floor(F.col("o_totalprice") / 70000)).cast("int").alias("points"),
        F.when(k % 14 != 0, F.col("o_totalprice")).alias("price"),
        F.col("r_name").alias("province"),
        F.when(ck % 3 != 0, F.col("c_name")).alias("region_1"),
        F.when(ck % 2 == 0, F.col("r_name")).alias("region_2"),
        F.when(ck % 5 != 0, F.concat(F.lit("T"), s(ck % 19))).alias("taster_name"),
        F.when(ck % 5 != 0, F.concat(F.lit("@t"), s(ck % 19))).alias("taster_twitter_handle"),
        F.concat(F.lit("Lot "), s(k % 977), F.lit(" "), s(F.year("o_orderdate"))).alias("title"),
        F.col("c_mktsegment").alias("variety"),
        F.col("c_name").alias("winery"),
    )


ORDERS_REVIEW_SQL = """
orders_review AS (
  SELECT o.o_orderkey AS row_id,
         o.o_custkey AS customer_id,
         CASE WHEN o.o_orderkey % 211 <> 0 THEN n.n_name END AS country,
         concat(' ', o.o_orderstatus, '  ', o.o_orderpriority, ' order ') AS description,
         CASE WHEN o.o_orderpriority <> '4-NOT SPECIFIED' THEN o.o_orderpriority END AS designation,
         CAST(80 + (o.o_orderkey * 7 + o.o_custkey) % 13 + floor(o.o_totalprice / 70000) AS INTEGER) AS points,
         CASE WHEN o.o_orderkey % 14 <> 0 THEN o.o_totalprice END AS price,
         r.r_name AS province,
         CASE WHEN o.o_custkey % 3 <> 0 THEN c.c_name END AS region_1,
         CASE WHEN o.o_custkey % 2 = 0 THEN r.r_name END AS region_2,
         CASE WHEN o.o_custkey % 5 <> 0 THEN concat('T', CAST(o.o_custkey % 19 AS VARCHAR)) END AS taster_name,
         CASE WHEN o.o_custkey % 5 <> 0 THEN concat('@t', CAST(o.o_custkey % 19 AS VARCHAR)) END AS taster_twitter_handle,
         concat('Lot ', CAST(o.o_orderkey % 977 AS VARCHAR), ' ', CAST(year(o.o_orderdate) AS VARCHAR)) AS title,
         c.c_mktsegment AS variety,
         c.c_name AS winery
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""


def docs_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents LEFT JOIN labels: free text + an optional binary target."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return (d.join(lab, "doc_id", "left")
             .select(F.col("doc_id").alias("row_id"),
                     F.col("text").alias("description"),
                     F.col("lang").alias("title"),
                     "lang", "source",
                     F.col("n_chars").cast("int").alias("desc_len_chars"),
                     F.col("quality").cast("int").alias("quality"),
                     F.col("toxic").cast("int").alias("toxic")))


DOCS_REVIEW_SQL = """
docs_review AS (
  SELECT d.doc_id AS row_id, d.text AS description, d.lang AS title, d.lang, d.source,
         CAST(d.n_chars AS INTEGER) AS desc_len_chars,
         CAST(l.quality AS INTEGER) AS quality, CAST(l.toxic AS INTEGER) AS toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""


def _score_a(price):
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.coalesce(price, F.lit(150000.0)) / 70000 - 3))), 4)


def _score_b(price, row_id, cust):
    z = ((row_id * 7 + cust) % 13 - 6) / 2.5 + (F.coalesce(price, F.lit(150000.0)) / 70000 - 3) / 1.5
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 4)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long ``scores`` table of two fixed-weight logistic "models".

    Columns: model, row_id, y, p, price, price_missing, taster_name, points.
    Rounding p to 4 decimals creates ties across classes on purpose.
    """
    r = orders_review(spark, sf_dir)
    base = r.select("row_id", "customer_id", "price", "taster_name", "points",
                    (F.col("points") >= 90).cast("int").alias("y"),
                    F.col("price").isNull().cast("int").alias("price_missing"))
    # one scan and one join chain emit both models' rows (no union of two plans)
    both = F.inline(F.array(
        F.struct(F.lit("price_only").alias("model"), _score_a(F.col("price")).alias("p")),
        F.struct(F.lit("mixed").alias("model"),
                 _score_b(F.col("price"), F.col("row_id"), F.col("customer_id")).alias("p"))))
    return base.select("row_id", "y", "price", "price_missing", "taster_name", "points", both).select(
        "model", "row_id", "y", "p", "price", "price_missing", "taster_name", "points")


SCORED_SQL = ORDERS_REVIEW_SQL + """,
scored AS (
  SELECT 'price_only' AS model, row_id, CAST(points >= 90 AS INTEGER) AS y,
         round(1.0 / (1.0 + exp(-(coalesce(price, 150000.0) / 70000 - 3))), 4) AS p,
         price, CAST(price IS NULL AS INTEGER) AS price_missing, taster_name, points
  FROM orders_review
  UNION ALL
  SELECT 'mixed' AS model, row_id, CAST(points >= 90 AS INTEGER) AS y,
         round(1.0 / (1.0 + exp(-(((row_id * 7 + customer_id) % 13 - 6) / 2.5
                                  + (coalesce(price, 150000.0) / 70000 - 3) / 1.5))), 4) AS p,
         price, CAST(price IS NULL AS INTEGER) AS price_missing, taster_name, points
  FROM orders_review
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"

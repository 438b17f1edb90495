"""Cleaning / dedup queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabmine.functions.text import (char_count, collapse_ws, right_closed_band, strip_ws,
                                    word_count)
from tabmine.operators.clean import (clean_reviews, dedup_first, dup_count, fill_constant,
                                     label_leak_scan, missing_flags, vintage_year, winsorize_upper)
from tabmine.operators.ranks import exact_median, quantile_values
from tabmine.plans import sql
from tabmine.plans.registry import query
from tabmine.session import ensure_checkpoint_dir
from tabmine.sources.csv_records import read_csv
from tabmine.sources.io import read_doc, read_table, to_doc, write_doc, write_table
from tabmine.sources.views import docs_review, orders_review
from tabmine.spec import ORDERS

P = ORDERS
BAND_SQL = sql.band_case("pc", P.band_edges, P.band_labels)


def band_quality_df(spark, sf_dir):
    """Flagship: after dedup + cleaning, per right-closed price band (on the
    capped raw price): rows, share of high-scoring rows, median price."""
    c = clean_reviews(orders_review(spark, sf_dir), P)
    t = (c.table.select(winsorize_upper("price", c.cap).alias("pc"), "high_quality")
         .withColumn("band", right_closed_band(F.col("pc"), P.band_edges, P.band_labels))
         .where(F.col("band").isNotNull()))
    agg = t.groupBy("band").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                F.round(F.avg(F.col("high_quality").cast("double")), 6).alias("share_high"))
    med = exact_median(t, "pc", ["band"], "median_price")
    return agg.join(med, "band").select("band", "n", "share_high",
                                        F.round("median_price", 4).alias("median_price"))


query("band_quality", sql.orders(sql.CLEAN_SQL) + f"""
, t AS (SELECT CASE WHEN price > cap THEN cap ELSE price END AS pc, high_quality FROM clean)
SELECT band, CAST(count(*) AS BIGINT) AS n, round(avg(high_quality), 6) AS share_high,
       round(quantile_cont(pc, 0.5), 4) AS median_price
FROM (SELECT *, {BAND_SQL} AS band FROM t) WHERE band IS NOT NULL GROUP BY band
""")(band_quality_df)


@query("clean_table", sql.orders(sql.CLEAN_SQL) + """
SELECT row_id, title, description, points, high_quality, price, round(log_price, 6) AS log_price, age,
       desc_len_chars, desc_words, price_missing, age_missing, has_designation, has_region,
       country, province, variety, taster_name
FROM clean""")
def clean_table(spark, sf_dir):
    t = clean_reviews(orders_review(spark, sf_dir), P).table
    return t.withColumn("log_price", F.round("log_price", 6))


@query("clean_audit", sql.orders(sql.CLEAN_SQL) + """
SELECT CAST((SELECT count(*) FROM orders_review) AS BIGINT) AS rows_raw,
       CAST(count(*) AS BIGINT) AS rows_after_dedup,
       CAST((SELECT count(*) FROM orders_review) - count(*) AS BIGINT) AS duplicates_removed,
       round(max(cap), 6) AS price_cap,
       CAST(count(*) FILTER (WHERE price > cap) AS BIGINT) AS price_capped_rows,
       CAST(count(*) AS BIGINT) AS rows_final,
       round(avg(high_quality), 6) AS share_high_quality,
       round(avg(CAST(log_price IS NULL AS DOUBLE)), 6) AS missing_log_price,
       round(avg(CAST(age IS NULL AS DOUBLE)), 6) AS missing_age,
       min(age) AS age_min, max(age) AS age_max,
       round(avg(desc_words), 6) AS desc_words_mean,
       round(100 * (1 - avg(age_missing)), 6) AS year_extracted_pct
FROM clean""")
def clean_audit(spark, sf_dir):
    return clean_reviews(orders_review(spark, sf_dir), P).audit()


@query("dup_count", sql.docs() + """
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates, CAST(sum(n) AS BIGINT) AS rows,
       CAST(count(*) AS BIGINT) AS distinct_keys
FROM (SELECT description, title, count(*) AS n FROM docs_review GROUP BY description, title)""")
def dup_count_q(spark, sf_dir):
    return dup_count(docs_review(spark, sf_dir), ["description", "title"])


@query("dedup_first", sql.docs() + """
SELECT row_id, title, lang, source, desc_len_chars, quality FROM (
  SELECT *, row_number() OVER (PARTITION BY description, title ORDER BY row_id) AS rn FROM docs_review)
WHERE rn = 1""")
def dedup_first_q(spark, sf_dir):
    d = dedup_first(docs_review(spark, sf_dir), ["description", "title"])
    return d.select("row_id", "title", "lang", "source", "desc_len_chars", "quality")


@query("clean_text", sql.docs() + r"""
SELECT row_id,
       CAST(length(regexp_replace(description, '^\s+|\s+$', '', 'g')) AS INTEGER) AS chars_stripped,
       md5(regexp_replace(regexp_replace(description, '\s+', ' ', 'g'), '^ | $', '', 'g')) AS collapsed_md5,
       CAST(length(regexp_replace(regexp_replace(description, '\s+', ' ', 'g'), '^ | $', '', 'g')) AS INTEGER)
         AS chars_collapsed
FROM docs_review""")
def clean_text(spark, sf_dir):
    d = docs_review(spark, sf_dir)
    col = collapse_ws("description", unicode=False)
    return d.select("row_id", char_count(strip_ws("description", unicode=False)).alias("chars_stripped"),
                    F.md5(col).alias("collapsed_md5"), char_count(col).alias("chars_collapsed"))


@query("text_lengths", sql.docs() + r"""
SELECT row_id, CAST(length(description) AS INTEGER) AS chars,
       CAST(len(regexp_extract_all(description, '\S+')) AS INTEGER) AS words,
       desc_len_chars
FROM docs_review""")
def text_lengths(spark, sf_dir):
    d = docs_review(spark, sf_dir)
    return d.select("row_id", char_count("description").alias("chars"),
                    word_count("description", unicode=False).alias("words"), "desc_len_chars")


@query("fill_unknown", sql.orders() + """
SELECT row_id, coalesce(country, 'Unknown') AS country, coalesce(province, 'Unknown') AS province,
       coalesce(taster_name, 'Unknown') AS taster_name FROM orders_review""")
def fill_unknown(spark, sf_dir):
    r = orders_review(spark, sf_dir).select("row_id", "country", "province", "taster_name")
    return fill_constant(r, ["country", "province", "taster_name"], "Unknown")


@query("missing_flags", sql.orders() + """
SELECT row_id, CAST(price IS NULL AS INTEGER) AS price_missing,
       CAST(designation IS NOT NULL AS INTEGER) AS has_designation,
       CAST(region_1 IS NOT NULL AS INTEGER) AS has_region,
       CAST(taster_name IS NULL AS INTEGER) AS taster_name_missing FROM orders_review""")
def missing_flags_q(spark, sf_dir):
    r = orders_review(spark, sf_dir)
    r = missing_flags(r, ["price", "taster_name"])
    r = missing_flags(r, ["designation", "region_1"], present=True, suffix="_present")
    return r.select("row_id", "price_missing", F.col("designation_present").alias("has_designation"),
                    F.col("region_1_present").alias("has_region"), "taster_name_missing")


@query("drop_cols", sql.orders() + """
SELECT * EXCLUDE (taster_twitter_handle, region_2) FROM orders_review""")
def drop_cols(spark, sf_dir):
    return orders_review(spark, sf_dir).drop("taster_twitter_handle", "region_2")


@query("drop_null_rows", sql.orders() + """
SELECT row_id, price, points FROM orders_review WHERE price IS NOT NULL""")
def drop_null_rows(spark, sf_dir):
    return orders_review(spark, sf_dir).select("row_id", "price", "points").na.drop(subset=["price"])


@query("cap_log_price", sql.orders() + """
, capv AS (SELECT quantile_cont(price, 0.999) AS cap FROM orders_review)
SELECT row_id, CAST(price > cap AS INTEGER) AS capped,
       round(ln(1 + CASE WHEN price > cap THEN cap ELSE price END), 6) AS log_price,
       round(log10(price), 6) AS log10_price, round(ln(price), 6) AS ln_price,
       round(exp(ln(1 + CASE WHEN price > cap THEN cap ELSE price END)) - 1, 4) AS price_back
FROM orders_review, capv""")
def cap_log_price(spark, sf_dir):
    r = orders_review(spark, sf_dir).select("row_id", "price")
    cap = quantile_values(r, "price", [P.cap_q])[0]
    lp = F.log1p(winsorize_upper("price", cap))
    return r.select("row_id", (F.col("price") > F.lit(cap)).cast("int").alias("capped"),
                    F.round(lp, 6).alias("log_price"), F.round(F.log10("price"), 6).alias("log10_price"),
                    F.round(F.log("price"), 6).alias("ln_price"), F.round(F.expm1(lp), 4).alias("price_back"))


@query("vintage_age", sql.orders() + r"""
, y AS (SELECT row_id, title,
               CAST(regexp_extract_all(title, '\b(19[5-9]\d|20[01]\d)\b', 1)[-1] AS INTEGER) AS y0
        FROM orders_review)
SELECT row_id, title, CASE WHEN y0 <= 2000 THEN y0 END AS year,
       CAST(2000 - CASE WHEN y0 <= 2000 THEN y0 END AS DOUBLE) AS age FROM y""")
def vintage_age(spark, sf_dir):
    r = orders_review(spark, sf_dir).select("row_id", "title")
    y = vintage_year("title", P)
    return r.select("row_id", "title", y.alias("year"), (F.lit(P.ref_year) - y).cast("double").alias("age"))


@query("price_bands", sql.orders() + f"""
SELECT band, CAST(count(*) AS BIGINT) AS n
FROM (SELECT {BAND_SQL} AS band FROM (SELECT price AS pc FROM orders_review))
WHERE band IS NOT NULL GROUP BY band""")
def price_bands(spark, sf_dir):
    r = orders_review(spark, sf_dir)
    b = right_closed_band(F.col("price"), P.band_edges, P.band_labels).alias("band")
    return r.select(b).where(F.col("band").isNotNull()).groupBy("band").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


@query("target_flag", sql.orders() + """
SELECT CAST(points >= 90 AS INTEGER) AS high_quality, CAST(count(*) AS BIGINT) AS n,
       min(points) AS min_points, max(points) AS max_points
FROM orders_review GROUP BY 1""")
def target_flag(spark, sf_dir):
    r = orders_review(spark, sf_dir)
    return (r.withColumn("high_quality", (F.col("points") >= F.lit(P.threshold)).cast("int"))
             .groupBy("high_quality").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                          F.min("points").alias("min_points"),
                                          F.max("points").alias("max_points")))


# Short labels of the segment codes, and the code left out.
SEGMENT_LABELS = {"AUTOMOBILE": "auto", "BUILDING": "build", "FURNITURE": "furn", "MACHINERY": "mach"}
SKIP_SEGMENTS = ("HOUSEHOLD",)


@query("relabel", sql.orders() + """
SELECT CASE variety WHEN 'AUTOMOBILE' THEN 'auto' WHEN 'BUILDING' THEN 'build'
                    WHEN 'FURNITURE' THEN 'furn' WHEN 'MACHINERY' THEN 'mach' END AS label,
       CAST(count(*) AS BIGINT) AS n
FROM orders_review WHERE variety NOT IN ('HOUSEHOLD') GROUP BY 1""")
def relabel(spark, sf_dir):
    """Relabel codes through a small literal map, skip listed codes."""
    m = F.create_map(*[F.lit(x) for kv in SEGMENT_LABELS.items() for x in kv])
    r = orders_review(spark, sf_dir).where(~F.col("variety").isin(*SKIP_SEGMENTS))
    return r.select(m[F.col("variety")].alias("label")).groupBy("label").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


@query("label_leak_scan", sql.docs() + r"""
, t AS (SELECT regexp_extract_all(description, '\b(8\d|9\d|100)\b', 1) AS nums,
               80 + desc_len_chars % 21 AS score FROM docs_review)
SELECT CAST(count(*) AS BIGINT) AS rows,
       CAST(sum(CAST(len(nums) > 0 AS INTEGER)) AS BIGINT) AS with_number,
       round(avg(CAST(len(nums) > 0 AS DOUBLE)), 6) AS share_with_number,
       round(sum(CAST(len(nums) > 0 AND list_contains(list_transform(nums, lambda x: CAST(x AS INTEGER)), score)
                      AS DOUBLE)) / nullif(sum(CAST(len(nums) > 0 AS DOUBLE)), 0), 6) AS share_equal_score
FROM t""")
def label_leak_scan_q(spark, sf_dir):
    d = docs_review(spark, sf_dir).withColumn("score", F.lit(80) + F.col("desc_len_chars") % 21)
    return label_leak_scan(d, "description", "score")


@query("roundtrip_io", sql.orders(sql.CLEAN_SQL) + """
SELECT 'clean' AS section, CAST(count(*) AS BIGINT) AS rows, CAST(sum(row_id) AS BIGINT) AS sum_row_id,
       CAST(sum(high_quality) AS BIGINT) AS n_high, CAST(sum(desc_words) AS BIGINT) AS sum_words
FROM clean""")
def roundtrip_io(spark, sf_dir):
    """Write the clean table and its audit document, read both back."""
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/roundtrip-{uuid.uuid4().hex}"
    c = clean_reviews(orders_review(spark, sf_dir), P)
    write_table(c.table, f"{base}/clean")
    write_doc(to_doc(c.audit(), "preprocess", None, ["rows_final"]), f"{base}/doc")
    back = read_table(spark, f"{base}/clean")
    doc = read_doc(spark, f"{base}/doc").where(F.col("key") == "rows_final")
    rows = back.agg(F.lit("clean").alias("section"), F.count(F.lit(1)).cast("bigint").alias("rows"),
                    F.sum("row_id").cast("bigint").alias("sum_row_id"),
                    F.sum("high_quality").cast("bigint").alias("n_high"),
                    F.sum("desc_words").cast("bigint").alias("sum_words"))
    # the document must agree with the table it describes
    return rows.join(doc.select(F.col("value").cast("bigint").alias("rows")), "rows", "left_semi")


@query("csv_roundtrip", """
SELECT doc_id, lang, source, n_chars, sha256(nullif(text, '')) AS text_sha256, length(nullif(text, '')) AS text_chars
FROM documents""")
def csv_roundtrip(spark, sf_dir):
    """All documents written as quoted CSV and read back by blocks; empty texts come back as null."""
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/csv-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    back = read_csv(spark, write_table(docs, base, "csv"))
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "source",
                       F.col("n_chars").cast("bigint").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"),
                       F.char_length("text").cast("bigint").alias("text_chars"))

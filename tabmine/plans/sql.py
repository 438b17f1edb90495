"""DuckDB CTEs shared by the oracle queries (mirrors of the Spark plans)."""

from tabmine.sources.views import DOCS_REVIEW_SQL, ORDERS_REVIEW_SQL, SCORED_SQL, with_ctes  # noqa: F401

# keep-first dedup on the raw (description, title)
DEDUP_SQL = r"""
dd AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY description, title ORDER BY row_id) AS rn
    FROM orders_review) WHERE rn = 1
)"""

CLEAN_SQL = DEDUP_SQL + r""",
capv AS (SELECT quantile_cont(price, 0.999) AS cap FROM dd),
cl0 AS (
  SELECT dd.*, capv.cap,
         regexp_replace(regexp_replace(description, '\s+', ' ', 'g'), '^ | $', '', 'g') AS desc_c,
         CAST(regexp_extract_all(title, '\b(19[5-9]\d|20[01]\d)\b', 1)[-1] AS INTEGER) AS yr0
  FROM dd, capv
),
clean AS (
  SELECT row_id, title, desc_c AS description, points,
         CAST(points >= 90 AS INTEGER) AS high_quality, price,
         ln(1 + CASE WHEN price > cap THEN cap ELSE price END) AS log_price,
         CAST(2000 - CASE WHEN yr0 <= 2000 THEN yr0 END AS DOUBLE) AS age,
         CAST(length(desc_c) AS INTEGER) AS desc_len_chars,
         CAST(len(regexp_extract_all(desc_c, '\S+')) AS INTEGER) AS desc_words,
         CAST(price IS NULL AS INTEGER) AS price_missing,
         CAST(CASE WHEN yr0 <= 2000 THEN yr0 END IS NULL AS INTEGER) AS age_missing,
         CAST(regexp_replace(designation, '^\s+|\s+$', '', 'g') IS NOT NULL AS INTEGER) AS has_designation,
         CAST(regexp_replace(region_1, '^\s+|\s+$', '', 'g') IS NOT NULL AS INTEGER) AS has_region,
         coalesce(regexp_replace(country, '^\s+|\s+$', '', 'g'), 'Unknown') AS country,
         coalesce(regexp_replace(province, '^\s+|\s+$', '', 'g'), 'Unknown') AS province,
         regexp_replace(variety, '^\s+|\s+$', '', 'g') AS variety,
         coalesce(regexp_replace(taster_name, '^\s+|\s+$', '', 'g'), 'Unknown') AS taster_name,
         cap
  FROM cl0
)"""


def band_case(col: str, edges, labels) -> str:
    parts = [f"WHEN {col} > {lo!r} AND {col} <= {hi!r} THEN '{lab}'"
             for lo, hi, lab in zip(edges[:-1], edges[1:], labels)]
    return "CASE " + " ".join(parts) + " END"


def orders(*extra: str) -> str:
    return with_ctes(ORDERS_REVIEW_SQL, *extra)


def docs(*extra: str) -> str:
    return with_ctes(DOCS_REVIEW_SQL, *extra)


def scores(*extra: str) -> str:
    return with_ctes(SCORED_SQL, *extra)

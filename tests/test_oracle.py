"""Spark queries vs their DuckDB oracle SQL on sf0.001 (a fast subset; the
full set runs through tools/oracle_check.py)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from fixtures import SF_SMALL
from tabmine.sources.views import TABLES

FAST = ["band_quality", "dup_count", "clean_text", "vintage_age", "missing_profile", "describe_numeric",
        "top_countries", "box_stats_top10", "hist_log_price", "density2d", "spearman", "kruskal_taster",
        "holdout_split", "roc_auc", "avg_precision", "leaderboard", "calibration", "error_by_band",
        "tfidf_terms", "kmeans_assign_fixed", "silhouette_sample", "silhouette_all",
        "baseline_majority", "operating_points", "model_roundtrip"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return float(v) if isinstance(v, float) else v


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    order = sorted(dcols)
    s_rows = sorted(tuple(repr(_canon(r[c])) for c in order) for r in sdf.collect())
    idx = [dcols.index(c) for c in order]
    d_rows = sorted(tuple(repr(_canon(r[i])) for i in idx) for r in res.fetchall())
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["band", "n", "share_high", "median_price"]
    assert df.count() >= 0

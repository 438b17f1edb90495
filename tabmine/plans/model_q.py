"""Modelling queries.

Tabular models run on the cleaned orders table (the review-shaped view) split
80/20 by M1; text models on the labelled documents. Trained-model outputs are
checked rows-only plus property tests; the majority baseline has an oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabmine.functions.text import char_count, word_count
from tabmine.operators.explain import permutation_importance, top_text_terms
from tabmine.operators.metrics import binary_metrics, leaderboard, roc_auc
from tabmine.operators.models import Candidate, boosting, default_candidates, fit_candidate, load_fitted, text_logistic
from tabmine.operators.split import holdout_split
from tabmine.operators.tune import (cross_validate, cv_summary, grid_search, nested_folds, nested_stacking,
                                     stacking_fit)
from tabmine.plans.prep_q import SPLIT_SQL, split_clean
from tabmine.plans.registry import query
from tabmine.session import ensure_checkpoint_dir, materialize
from tabmine.sources.views import docs_review
from tabmine.spec import ORDERS, FeatureSpec

SPEC = ORDERS.spec
MIN_FREQ = ORDERS.min_freq
SEED = ORDERS.seed
FOREST_DEPTH = 15

DOCS_SPEC = FeatureSpec(num=("desc_len_chars", "desc_words", "n_lines"), bin=("has_digit",),
                        cat=("lang", "source"), text="description", target="quality", id_col="row_id")
DOCS_MIN_FREQ = 20


def _by_name(*names):
    cands = {c.name: c for c in default_candidates(SEED, FOREST_DEPTH)}
    return [cands[n] for n in names]


def orders_split(spark, sf_dir):
    d = split_clean(spark, sf_dir)
    return d.where(F.col("split") == "train"), d.where(F.col("split") == "test")


def docs_split(spark, sf_dir):
    d = docs_review(spark, sf_dir).where(F.col("quality").isNotNull())
    d = d.select("row_id", "description", "lang", "source", "desc_len_chars",
                 word_count("description").alias("desc_words"),
                 F.size(F.split(F.col("description"), "\n")).cast("int").alias("n_lines"),
                 F.col("description").rlike("[0-9]").cast("int").alias("has_digit"), "quality")
    d = materialize(holdout_split(d, "quality", 0.2, SEED), "docs-split")
    return d.where(F.col("split") == "train"), d.where(F.col("split") == "test")


@query("baseline_majority", SPLIT_SQL + """
, maj AS (SELECT high_quality AS m FROM train GROUP BY high_quality ORDER BY count(*) DESC, high_quality LIMIT 1),
k AS (SELECT CAST(count(*) FILTER (WHERE high_quality = 1 AND m = 1) AS DOUBLE) AS tp,
             CAST(count(*) FILTER (WHERE high_quality = 0 AND m = 1) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (WHERE high_quality = 1 AND m = 0) AS DOUBLE) AS fn,
             CAST(count(*) FILTER (WHERE high_quality = 0 AND m = 0) AS DOUBLE) AS tn,
             avg((m - high_quality) ^ 2) AS brier FROM test, maj)
SELECT 'baseline' AS model, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
       CAST(0.0 AS DOUBLE) AS mcc, round(brier, 6) AS brier, CAST(0.5 AS DOUBLE) AS roc_auc FROM k""")
def baseline_majority(spark, sf_dir):
    """M3: most frequent training class as a constant score, evaluated on test."""
    tr, te = orders_split(spark, sf_dir)
    m = fit_candidate(Candidate("baseline", "baseline"), tr, SPEC)
    s = m.score(te.select("row_id", "high_quality"))
    bm = binary_metrics(s).select("model", "accuracy", "precision", "recall", "f1", "mcc", "brier")
    return bm.join(roc_auc(s), "model")


@query("cv_compare")
def cv_compare(spark, sf_dir):
    """M9: 5-fold CV (mean, population std) of the tabular candidates."""
    tr, _ = orders_split(spark, sf_dir)
    scores, fit_s = cross_validate(_by_name("baseline", "lr_tabular", "tree", "forest", "boosting"), tr, SPEC, 5,
                                   MIN_FREQ, SEED)
    return cv_summary(scores, fit_s)


@query("cv_text")
def cv_text(spark, sf_dir):
    """M8/M9: 5-fold CV of the text model against tabular LR on documents."""
    tr, _ = docs_split(spark, sf_dir)
    scores, fit_s = cross_validate(_by_name("baseline", "lr_tabular", "lr_text"), tr, DOCS_SPEC, 5,
                                   DOCS_MIN_FREQ, SEED)
    return cv_summary(scores, fit_s)


def _boost_candidate(learning_rate, leaves):
    return Candidate("boosting", "tree", boosting(learning_rate, leaves, 300, SEED),
                     params={"learning_rate": learning_rate, "leaves": leaves})


#: The boosting has no L2 term, so the grid has no such axis.
BOOST_GRID = [{"learning_rate": lr, "leaves": lv} for lr in (0.05, 0.1) for lv in (15, 31, 63)]
TEXT_GRID = [{"C": c} for c in (0.25, 1.0, 4.0)]


@query("grid_search_boosting")
def grid_search_boosting(spark, sf_dir):
    """3-fold grid over learning rate x leaves, best by mean AUC."""
    tr, _ = orders_split(spark, sf_dir)
    return grid_search("boosting", _boost_candidate, BOOST_GRID, tr, SPEC, 3, MIN_FREQ, SEED)


def _text_candidate(C):
    c = Candidate("lr_text", "linear", text_logistic(C, 2000), text=True)
    c.params = {"C": C}
    return c


@query("grid_search_text")
def grid_search_text(spark, sf_dir):
    """3-fold grid over C for LR + TF-IDF."""
    tr, _ = docs_split(spark, sf_dir)
    return grid_search("lr_text", _text_candidate, TEXT_GRID, tr, DOCS_SPEC, 3, DOCS_MIN_FREQ, SEED)


@query("ablation")
def ablation(spark, sf_dir):
    """Boosting with and without the taster column (5-fold CV)."""
    tr, _ = orders_split(spark, sf_dir)
    full = Candidate("boosting", "tree", boosting(0.1, 31, 300, SEED))
    drop = Candidate("boosting_no_taster", "tree", boosting(0.1, 31, 300, SEED), spec=SPEC.without("taster_name"))
    scores, fit_s = cross_validate([full, drop], tr, SPEC, 5, MIN_FREQ, SEED)
    return cv_summary(scores, fit_s)


@query("stacking")
def stacking(spark, sf_dir):
    """OOF(text LR, tabular boosting) -> logistic meta-model; test leaderboard."""
    tr, te = docs_split(spark, sf_dir)
    bases = [Candidate("lr_text", "linear", text_logistic(1.0, 2000), text=True),
             Candidate("boosting", "tree", boosting(0.1, 31, 300, SEED))]
    score, finals, _ = stacking_fit(bases, tr, DOCS_SPEC, 5, DOCS_MIN_FREQ, SEED)
    parts = [score(te)] + [m.score(te) for m in finals]
    s = parts[0]
    for p in parts[1:]:
        s = s.unionByName(p)
    return leaderboard(materialize(s, "stack-scores"))


@query("cv_stacking")
def cv_stacking(spark, sf_dir):
    """M9 + M12: 5-fold CV of two tabular models and of their stack, whose own 5 folds lie inside the others'."""
    tr, _ = docs_split(spark, sf_dir)
    return cv_summary(nested_stacking(_by_name("lr_tabular", "tree"), tr, DOCS_SPEC, 5, 5, DOCS_MIN_FREQ, SEED))


@query("nested_folds", SPLIT_SQL + """
, pos AS (SELECT row_id, high_quality, row_number() OVER (PARTITION BY high_quality
            ORDER BY substr(md5(concat_ws('-', row_id, 42)), 1, 13), row_id) - 1 AS q FROM train),
outer_ AS (SELECT *, CAST(q % 5 AS INTEGER) AS fold FROM pos),
o AS (SELECT unnest(range(5)) AS held)
SELECT CAST(held AS INTEGER) AS held_out, fold, row_id,
       CAST((row_number() OVER (PARTITION BY held, high_quality ORDER BY q) - 1) % 5 AS INTEGER) AS inner_fold
FROM outer_, o WHERE fold <> held""")
def nested_folds_q(spark, sf_dir):
    """Which inner fold each training row is in while an outer fold is held out."""
    tr, _ = orders_split(spark, sf_dir)
    f = nested_folds(tr.select("row_id", "high_quality"), "high_quality", 5, 5, SEED)
    return f.select("fold", "row_id", F.posexplode("inner").alias("held_out", "inner_fold")).where("fold <> held_out")


@query("score_test")
def score_test(spark, sf_dir):
    """M13 + E6: refit every tabular candidate on all training rows, score the
    test rows, one leaderboard."""
    tr, te = orders_split(spark, sf_dir)
    cands = _by_name("baseline", "lr_tabular", "tree", "forest", "boosting")
    s = None
    for c in cands:
        part = fit_candidate(c, tr, SPEC, MIN_FREQ, SEED).score(te)
        s = part if s is None else s.unionByName(part)
    return leaderboard(materialize(s, "test-scores")).orderBy(F.desc("roc_auc"))


@query("model_roundtrip", SPLIT_SQL + """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS differing FROM test""")
def model_roundtrip(spark, sf_dir):
    """Test rows scored by the fitted model, and by one reloaded whole
    (constants, prep, classifier) into a new object; rows that differ."""
    import uuid
    tr, te = orders_split(spark, sf_dir)
    m = fit_candidate(_by_name("lr_tabular")[0], tr, SPEC, MIN_FREQ, SEED)
    before = materialize(m.score(te), "scored-before").select("row_id", "p")
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/models-{uuid.uuid4().hex}"
    again = load_fitted(m.save(base)).score(te).select("row_id", F.col("p").alias("p2"))
    both = before.join(again, "row_id", "full")
    return both.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.count(F.when(~F.col("p").eqNullSafe(F.col("p2")), 1)).alias("differing"))


@query("perm_importance")
def perm_importance(spark, sf_dir):
    """AUC drop per feature, 5 shuffles of all test rows."""
    tr, te = orders_split(spark, sf_dir)
    m = fit_candidate(_by_name("boosting")[0], tr, SPEC, MIN_FREQ, SEED)
    return permutation_importance(m, te, list(SPEC.tabular), 5, SEED)


@query("text_terms")
def text_terms(spark, sf_dir):
    """Top +/- 15 TF-IDF terms of the text model."""
    tr, _ = docs_split(spark, sf_dir)
    m = fit_candidate(_by_name("lr_text")[0], tr, DOCS_SPEC, DOCS_MIN_FREQ, SEED)
    return top_text_terms(m, 15)

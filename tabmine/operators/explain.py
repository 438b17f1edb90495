"""Model explanation (E13 permutation importance, E14 text terms)."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmine.operators.metrics import roc_auc
from tabmine.operators.models import FittedModel
from tabmine.operators.resample import dense_index
from tabmine.session import materialize


#: Fixed values of the permutation's arithmetic, below 2^62 throughout.
PRIME, A1, A2, ADD = 2147483647, 48271, 69621, 11
ROUNDS = 4


def permutation_keys(feature: str, rep: int, seed: int) -> list[int]:
    """The round keys of one permutation."""
    import hashlib
    return [int(hashlib.md5(f"{feature}-{rep}-{r}-{seed}".encode()).hexdigest()[:7], 16) for r in range(ROUNDS)]


def permuted_index(i: Column, n: int, keys: Column) -> Column:
    """The image of 0 <= i < n under a keyed permutation of 0..n-1, by arithmetic alone.

    A Feistel network over pairs of digits base ceil(sqrt(n)) permutes a little more than n
    numbers; what falls outside is permuted again until it falls inside, which comes to a permutation
    of those inside. The number of times has a bound that is certain for small n and
    exceeded with probability below 2^-200 for large n (then the query fails: no donor is found).
    """
    base = max(2, math.isqrt(max(n, 1) - 1) + 1)

    def mix(s, k):
        r = s % base
        x = (r * A1 + k) % PRIME
        return r * base + (F.floor(s / base) + (x * x % PRIME * A2 + ADD) % PRIME) % base

    def once(x):
        return F.aggregate(keys, x, mix)
    walks = 2 * base + 2 if base < 32 else math.ceil(200 / (math.log2(base) - 1))
    return F.aggregate(F.sequence(F.lit(1), F.lit(walks)), once(i), lambda x, _: F.when(x < n, x).otherwise(once(x)))


def permuted_rows(rows: DataFrame, features: Sequence[str], repeats: int, seed: int, id_col: str) -> DataFrame:
    """``rows`` once for each feature and repeat (columns feature, rep), that feature's values permuted among them.

    Ids are unique. One join on the dense index serves all features and repeats: each receiver knows its
    donor by arithmetic, nothing is sorted, and rows are dealt evenly whatever the values.
    """
    rows = materialize(rows, "perm-rows")
    idx, n = dense_index(rows, id_col)
    rows = materialize(rows.join(idx.withColumnRenamed("idx", "_i"), id_col), "perm-index")
    copies = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(r).alias("rep"),
                                F.array(*[F.lit(k).cast("bigint") for k in permutation_keys(f, r, seed)]).alias("_keys"))
                       for f in features for r in range(repeats)])
    every = rows.select("*", F.inline(copies)).withColumn("_donor", permuted_index(F.col("_i"), n, F.col("_keys")))
    given = rows.select(F.col("_i").alias("_donor"), F.struct(*features).alias("_v"))
    moved = {f: F.when(F.col("feature") == f, F.col(f"_v.{f}")).otherwise(F.col(f)) for f in features}
    # a row for each row: a table this long is never sent through the driver, small as its files may be
    return every.join(given.hint("merge"), "_donor").withColumns(moved).drop("_donor", "_i", "_keys", "_v")


def importance(rows: DataFrame, score: Callable[[DataFrame], DataFrame], features: Sequence[str], repeats: int = 5,
               seed: int = 42, id_col: str = "row_id", ndigits: int = 6) -> DataFrame:
    """Mean AUC drop when one feature's values are permuted among all rows (feature, delta_auc).

    ``score`` adds y and p to rows and keeps their feature and rep. All copies are scored by one plan,
    and every AUC comes from one grouped pass.
    """
    rows = materialize(rows, "importance-rows")
    whole = materialize(roc_auc(score(rows.withColumns({"feature": F.lit(""), "rep": F.lit(0)})), ["feature", "rep"], ndigits=None),
                        "importance-base").first()
    aucs = roc_auc(score(permuted_rows(rows, features, repeats, seed, id_col)).select("feature", "rep", "y", "p"),
                   ["feature", "rep"], ndigits=None)
    base = whole["roc_auc"] if whole else None
    return aucs.groupBy("feature").agg(F.round(F.lit(base) - F.avg("roc_auc"), ndigits).alias("delta_auc"))


def permutation_importance(model: FittedModel, sample: DataFrame, features: Sequence[str],
                           repeats: int = 5, seed: int = 42, ndigits: int = 6) -> DataFrame:
    """``importance`` of a fitted model's features."""
    def score(df):
        return model.model.transform(model.prep.transform(df)).select(
            "feature", "rep", F.col(model.target).cast("int").alias("y"), vector_to_array("probability")[1].alias("p"))
    return importance(sample, score, features, repeats, seed, model.id_col, ndigits)


def top_text_terms(model: FittedModel, n: int = 15, ndigits: int = 4) -> DataFrame:
    """The n most positive and n most negative TF-IDF coefficients of a
    linear text model (vocabulary joined to coefficients by index; both are
    model parameters bounded by the vocabulary size)."""
    vocab = model.prep.text_model.vocabulary
    coef = model.model.coefficients.toArray()
    off = len(coef) - len(vocab)
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    df = s.createDataFrame([(t, float(coef[off + i])) for i, t in enumerate(vocab)], "term string, coef double")
    pos = df.orderBy(F.desc("coef"), F.asc("term")).limit(n).withColumn("side", F.lit("pos"))
    neg = df.orderBy(F.asc("coef"), F.asc("term")).limit(n).withColumn("side", F.lit("neg"))
    return pos.unionByName(neg).select("side", "term", F.round("coef", ndigits).alias("coef"))

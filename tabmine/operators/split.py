"""Seeded sampling, stratified hold-out and k-fold assignment (K1, M1, M2).

Row order is a hash of ``row_id`` and the seed (partition-independent and
reproducible in SQL). The hold-out needs one place in that order for each class, the
last test row: ``class_cuts`` finds it from narrow (class, hash, id) rows by
refining a histogram, and the rows themselves are only compared with it, so wide
rows are never shuffled. Folds need each row's position inside its class, which
comes from ``prefix_by_value`` over the 52-bit hash prefix (distributed), with a
``row_number`` only inside groups of equal hash (ties: practically single rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabmine.functions.hashing import md5_key
from tabmine.operators.ranks import null_safe_join, prefix_by_value
from tabmine.session import materialize


def order_key(id_col: str, seed: int):
    """52-bit prefix of md5(id-seed) as a bigint (exact in double)."""
    return F.conv(F.substring(md5_key(F.col(id_col), F.lit(seed)), 1, 13), 16, 10).cast("bigint")


def class_positions(df: DataFrame, label: str, id_col: str = "row_id", seed: int = 42,
                    parts: int | None = None) -> DataFrame:
    """df + _pos (1-based position in hash order within its class) + _ncls. Null is a class."""
    h = df.withColumn("_h", order_key(id_col, seed))
    cnt = h.groupBy(label, "_h").agg(F.count(F.lit(1)).alias("_c"))
    pf = prefix_by_value(cnt, "_h", ["_c"], [label], parts, pre_aggregated=True)
    tie = F.row_number().over(Window.partitionBy(label, "_h").orderBy(id_col))
    j = null_safe_join(h, pf.select(label, "_h", "_c_before", F.col("_c_total").alias("_ncls")), [label, "_h"])
    return j.withColumn("_pos", F.col("_c_before") + tie).drop("_c_before")


HASH_BITS, STEP_BITS = 52, 13
#: So many rows left in all classes' bins are sorted as they are.
FEW = 1 << 16


def class_cuts(keys: DataFrame, label: str, share: float, id_col: str = "row_id") -> DataFrame:
    """(label, _cut_h, _cut_id): the ceil(share * n)-th smallest (hash, id) of each class of ``keys`` (label, _h, id).

    Each pass counts the rows of the bin that holds the place sought, in 2 ** 13 finer
    bins (one row a class and bin is shuffled, whatever the classes' sizes), and goes on with
    the bin that the running count says. Hashes are even, so a pass leaves about one row in
    8 192; when few are left, or the hash is used up, they are sorted by (hash, id). Only a hash
    that a great many rows share leaves more, and those lie in one group of equal hash.
    """
    sizes = keys.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    want = materialize(sizes.select(label, F.ceil(F.lit(share) * F.col("_n")).cast("bigint").alias("_want"),
                                    F.lit(0).cast("bigint").alias("_bin")).where("_want > 0"), "split-want")
    left, shift = keys, HASH_BITS
    while shift:
        shift -= STEP_BITS
        left = null_safe_join(left, want, [label]) if shift + STEP_BITS == HASH_BITS else null_safe_join(
            left.drop("_want", "_bin"), want, [label]).where(F.shiftright("_h", shift + STEP_BITS) == F.col("_bin"))
        bins = left.groupBy(label, "_want", F.shiftright("_h", shift).alias("_b")).agg(F.count(F.lit(1)).alias("_c"))
        upto = F.sum("_c").over(Window.partitionBy(label, "_want").orderBy("_b"))
        hit = bins.withColumn("_upto", upto).where("_upto >= _want AND _upto - _c < _want")
        hit = materialize(hit, "split-bins")
        want = hit.select(label, (F.col("_want") - F.col("_upto") + F.col("_c")).alias("_want"), F.col("_b").alias("_bin"))
        if (hit.agg(F.sum("_c")).first()[0] or 0) <= FEW:
            break
    left = null_safe_join(left.drop("_want", "_bin"), want, [label]).where(F.shiftright("_h", shift) == F.col("_bin"))
    place = F.row_number().over(Window.partitionBy(label).orderBy("_h", id_col))
    return left.withColumn("_at", place).where("_at = _want").select(
        label, F.col("_h").alias("_cut_h"), F.col(id_col).alias("_cut_id"))


def holdout_split(df: DataFrame, label: str, test_frac: float = 0.2, seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """M1: df + ``split`` ('train'/'test'): per class, the first ceil(test_frac * n_class) rows in hash order are test.

    Null is a class. Ids are unique; rows that share one stay together, on the test side if the cut
    falls among them. Only (class, hash, id) are shuffled, in a few passes; the rows are
    compared with their class's cut in place (a table of one row a class, broadcast by
    Spark's own size check). Input columns named like a helper (``_h``, ``_cut_h``, ``_cut_id``) are not allowed.
    """
    keys = materialize(df.select(label, order_key(id_col, seed).alias("_h"), id_col), "split-keys")
    cuts = materialize(class_cuts(keys, label, test_frac, id_col), "split-cuts")
    h = order_key(id_col, seed)
    test = (h < F.col("_cut_h")) | ((h == F.col("_cut_h")) & (F.col(id_col) <= F.col("_cut_id")))
    return null_safe_join(df, cuts, [label], "left").withColumn(
        "split", F.when(test, "test").otherwise("train")).drop("_cut_h", "_cut_id")


def kfold_assign(df: DataFrame, label: str, k: int = 5, seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """M2: stratified folds — fold = (position in class - 1) mod k."""
    p = class_positions(df, label, id_col, seed)
    return p.withColumn("fold", ((F.col("_pos") - 1) % k).cast("int")).drop("_h", "_pos", "_ncls")


def sample_n(df: DataFrame, n: int, seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """K1: n rows without replacement — the n smallest hashes.

    Hashes are even, so a cut a little above n / rows leaves little more than
    n rows to order, whatever the number of partitions. If hashes are few and
    repeated and the cut leaves less than n, all rows are ordered.
    """
    h = df.withColumn("_h", order_key(id_col, seed))
    key = df.select(order_key(id_col, seed).alias("_h"))
    total = key.count()
    if total > 2 * n:
        cut = int((n + 8 * n ** 0.5 + 16) / total * 2 ** 52)
        if cut < 2 ** 52 and key.where(F.col("_h") < cut).count() >= n:
            h = h.where(F.col("_h") < cut)
    return h.orderBy("_h", id_col).limit(n).drop("_h")

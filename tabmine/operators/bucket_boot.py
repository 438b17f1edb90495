"""Bootstrap on score buckets (E15, E16): one draw a bucket and replicate, whatever the rows.

In a bootstrap with Poisson weights each row counts Poisson(1) times, so m rows with
one score and one label together count Poisson(m) times. Rows are thus first added up
to buckets, and each bucket draws its B counts from a hash where it stands. One range
shuffle sorts the buckets by score; every partition then works out its part of
all B areas under the curve with array sums, and only its B totals are left to be
put together with those of the partitions before it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabmine.operators.resample import _interval
from tabmine.session import materialize

#: Fixed values of the draw: all arithmetic is below 2^62, so that any engine's 64-bit integers repeat it.
PRIME, ADD, A1, A2, A3 = 2147483647, 11, 48271, 69621, 40692
#: Counts up to this have a table of the distribution; above, a normal quantile with its skewness term.
TABLE = 64
TOTALS = ("pos", "neg", "conc", "tp", "fp")


def uniform(base: np.ndarray, rep: np.ndarray, stream: int) -> np.ndarray:
    """Uniform numbers in (0, 1), a row for each base and a column for each replicate."""
    base = base.astype(np.int64)[:, None] % PRIME
    x = base * A1 % PRIME
    x = (x + (rep.astype(np.int64)[None, :] * 4 + stream + 1) * A2) % PRIME
    x = x * x % PRIME
    x = (x + (base % 65536 + 1) * A3) % PRIME
    x = x * x % PRIME
    x = (x * A1 + ADD) % PRIME
    return (x + 0.5) / PRIME


def cdf(m: int) -> np.ndarray:
    """The Poisson(m) distribution function at 0, 1, ... as far as doubles tell it from 1."""
    t = c = math.exp(-m)
    out = [c]
    for k in range(1, int(m + 12 * math.sqrt(m) + 20)):
        t = t * m / k
        c = c + t
        out.append(c)
    return np.array(out)


CDFS = [np.array([1.0])] + [cdf(m) for m in range(1, TABLE + 1)]


def poisson(m: np.ndarray, base: np.ndarray, rep: np.ndarray, stream: int) -> np.ndarray:
    """Poisson(m) counts for each base and replicate."""
    u = uniform(base, rep, stream)
    out = np.zeros(u.shape)
    for k in np.unique(m[(m > 0) & (m <= TABLE)]).tolist():
        rows = m == k
        out[rows] = np.searchsorted(CDFS[k], u[rows], side="left")
    rows = m > TABLE
    if rows.any():
        z = np.sqrt(-2 * np.log(u[rows])) * np.cos(2 * math.pi * uniform(base[rows], rep, stream + 2))
        big = m[rows].astype(float)[:, None]
        out[rows] = np.maximum(np.floor(big + np.sqrt(big) * z + (z * z - 1) / 6 + 0.5), 0)
    return out


class _Area:
    """Sums over the buckets of one model in one partition, ascending by score; ties may come in several pieces."""

    def __init__(self, reps: int):
        self.tie, self.tie_pos, self.tie_neg = None, np.zeros(reps), np.zeros(reps)
        self.total = {k: np.zeros(reps) for k in TOTALS}

    def flush(self) -> None:
        t = self.total
        t["conc"] += self.tie_pos * (t["neg"] + 0.5 * self.tie_neg)
        t["pos"] += self.tie_pos
        t["neg"] += self.tie_neg
        self.tie_pos, self.tie_neg = np.zeros_like(self.tie_pos), np.zeros_like(self.tie_neg)

    def add(self, p: np.ndarray, pos: np.ndarray, neg: np.ndarray, threshold: float) -> None:
        at = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        gp, gn = np.add.reduceat(pos, at), np.add.reduceat(neg, at)
        over = p >= threshold
        self.total["tp"] += pos[over].sum(axis=0)
        self.total["fp"] += neg[over].sum(axis=0)
        if p[0] != self.tie:
            self.flush()
        self.tie_pos, self.tie_neg = self.tie_pos + gp[0], self.tie_neg + gn[0]
        if len(at) > 1:  # the last score may go on in the next piece
            self.flush()
            before = self.total["neg"] + np.cumsum(gn[1:], axis=0) - gn[1:]
            self.total["conc"] += (gp[1:-1] * (before[:-1] + 0.5 * gn[1:-1])).sum(axis=0)
            self.total["pos"] += gp[1:-1].sum(axis=0)
            self.total["neg"] += gn[1:-1].sum(axis=0)
            self.tie_pos, self.tie_neg = gp[-1], gn[-1]
        self.tie = p[-1]


def replicate_totals(buckets: DataFrame, reps: int, seed: int, threshold: float = 0.5) -> DataFrame:
    """(model, part, rep, pos, neg, conc, tp, fp) of ``buckets`` (model, p, base, pos, neg) in ranges of the score."""
    kind = buckets.schema["model"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rep, areas = TaskContext.get().partitionId(), np.arange(reps) + seed * reps, {}
        for batch in batches:
            model = batch.column("model").to_pylist()
            p, base, pos, neg = (batch.column(c).to_numpy() for c in ("p", "base", "pos", "neg"))
            cuts = {0, len(p), *range(0, len(p), 512), *(i for i in range(1, len(p)) if model[i] != model[i - 1])}
            for a, b in zip(sorted(cuts), sorted(cuts)[1:]):
                area = areas.setdefault(model[a], _Area(reps))
                area.add(p[a:b], poisson(pos[a:b], base[a:b], rep, 0), poisson(neg[a:b], base[a:b], rep, 1), threshold)
        for m, area in areas.items():
            area.flush()
            yield pa.RecordBatch.from_pydict({"model": [m] * reps, "part": [part] * reps, "rep": list(range(reps)),
                                              **{k: area.total[k].tolist() for k in TOTALS}})
    by_score = buckets.repartitionByRange("model", "p").sortWithinPartitions("model", "p")
    return by_score.select("model", "p", "base", "pos", "neg").mapInArrow(
        run, f"model {kind}, part long, rep long, " + ", ".join(f"{k} double" for k in TOTALS))


def _per_replicate(buckets: DataFrame, reps: int, seed: int, threshold: float) -> DataFrame:
    """(model, rep, roc_auc, f1): replicates without positives or negatives have no area."""
    parts = materialize(replicate_totals(buckets, reps, seed, threshold), "boot-parts")
    before = F.sum("neg").over(Window.partitionBy("model", "rep").orderBy("part")) - F.col("neg")
    t = parts.withColumn("conc", F.col("conc") + F.col("pos") * before).groupBy("model", "rep").agg(
        *[F.sum(k).alias(k) for k in TOTALS])
    return t.select("model", "rep", F.try_divide("conc", F.col("pos") * F.col("neg")).alias("roc_auc"),
                    F.coalesce(F.try_divide(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("pos")), F.lit(0.0)).alias("f1"))


def _counted(rows: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Buckets of ``keys``: base (the smallest id), pos and neg."""
    return rows.groupBy(*keys).agg(F.min(id_col).cast("bigint").alias("base"), F.sum("y").cast("bigint").alias("pos"),
                                   F.sum(1 - F.col("y")).cast("bigint").alias("neg"))


def bucket_ci(scores: DataFrame, B: int = 300, seed: int = 0, alpha: float = 0.05, model_col: str = "model",
              id_col: str = "row_id", threshold: float = 0.5, ndigits: int = 6) -> DataFrame:
    """Percentile intervals of AUC and F1 per model (model, metric, lo, hi).

    A score that a third of the rows share is one bucket, added up before the shuffle.
    Rows without y or p are left out; an empty table gives an empty result. Ids are
    integers not below 0: a bucket's smallest one is what its draws are hashed from.
    """
    rows = scores.select(F.col(model_col).alias("model"), id_col, "y", F.col("p").cast("double").alias("p")).dropna()
    per = _per_replicate(_counted(rows, ["model", "p"], id_col), B, seed, threshold)
    vals = per.unpivot(["model", "rep"], ["roc_auc", "f1"], "metric", "value").dropna()
    return _interval(vals, ["model", "metric"], "value", alpha, ndigits).withColumnRenamed("model", model_col)


def bucket_paired(scores: DataFrame, model_a: str, model_b: str, B: int = 300, seed: int = 0, alpha: float = 0.05,
                  model_col: str = "model", id_col: str = "row_id", threshold: float = 0.5, ndigits: int = 6) -> DataFrame:
    """Interval of AUC(a) - AUC(b) on the same replicates (model_a, model_b, lo, hi).

    Rows are counted by both scores, and each such bucket counts alike for both models.
    A row that lacks one of the scores is left out.
    """
    a, b = (F.max(F.when(F.col(model_col) == m, F.col("p").cast("double"))) for m in (model_a, model_b))
    wide = scores.where(F.col(model_col).isin(model_a, model_b)).groupBy(id_col, "y").agg(a.alias("a"), b.alias("b")).dropna()
    joint = _counted(wide, ["a", "b"], id_col)
    each = joint.select(F.inline(F.array(F.struct(F.lit(model_a).alias("model"), F.col("a").alias("p")),
                                         F.struct(F.lit(model_b).alias("model"), F.col("b").alias("p")))), "base", "pos", "neg")
    per = _per_replicate(each, B, seed, threshold)
    at = F.when(F.col("model") == model_a, F.col("roc_auc"))
    diff = per.groupBy("rep").agg((F.max(at) - F.max(F.when(F.col("model") == model_b, F.col("roc_auc")))).alias("d")).dropna()
    diff = diff.withColumn("model_a", F.lit(model_a)).withColumn("model_b", F.lit(model_b))
    return _interval(diff, ["model_a", "model_b"], "d", alpha, ndigits)

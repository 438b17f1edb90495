"""Error analysis slices (A12, E17, E18) on a scores table with attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmine.functions.text import right_closed_band


def with_errors(scores: DataFrame, y: str = "y", p: str = "p", threshold: float = 0.5) -> DataFrame:
    pred = (F.col(p) >= F.lit(threshold)).cast("int")
    return scores.withColumn("pred", pred).withColumn("err", (F.col(y) != F.col("pred")).cast("int"))


def error_by(scores: DataFrame, key, groups: Sequence[str] = ("model",), ndigits: int = 6,
             alias: str | None = None) -> DataFrame:
    """Error rate per observed slice value (null slices dropped)."""
    k = F.col(key) if isinstance(key, str) else key
    name = alias or (key if isinstance(key, str) else "slice")
    e = with_errors(scores).withColumn(name, k).where(F.col(name).isNotNull())
    return e.groupBy(*groups, name).agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                        F.round(F.avg(F.col("err").cast("double")), ndigits).alias("error_rate"))


def error_by_band(scores: DataFrame, price: str, edges, labels, groups: Sequence[str] = ("model",)) -> DataFrame:
    """Error rate per right-closed price band."""
    return error_by(scores, right_closed_band(F.col(price), edges, labels), groups, alias="band")


def error_when(scores: DataFrame, cond: Column, groups: Sequence[str] = ("model",), ndigits: int = 6) -> DataFrame:
    """Error rate on the rows matching ``cond`` (e.g. missing price)."""
    e = with_errors(scores).where(cond)
    return e.groupBy(*groups).agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                  F.round(F.avg(F.col("err").cast("double")), ndigits).alias("error_rate"))


def boundary_error_share(scores: DataFrame, score_col: str, lo: int, hi: int,
                         groups: Sequence[str] = ("model",), ndigits: int = 6) -> DataFrame:
    """Share of all errors whose true score lies in [lo, hi]."""
    e = with_errors(scores)
    near = F.col(score_col).between(lo, hi)
    return e.groupBy(*groups).agg(
        F.sum("err").cast("bigint").alias("errors"),
        F.round(F.try_divide(F.sum(F.when(near, F.col("err")).otherwise(0)).cast("double"),
                             F.sum("err").cast("double")), ndigits).alias("share_near_boundary"))

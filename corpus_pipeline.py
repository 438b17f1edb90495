"""A training-corpus pipeline over ``documents``: one corpus operator per stage.

Each stage takes what its predecessor kept and returns the columns of
documents; the last adds each document's place in the mixture.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabmine.llm import bagminhash, decontam, line_dedup, pfair_mix, quality
from tabmine.llm.common import stage


def of_documents(docs: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that ``step`` returns, with the columns of ``docs``.

    Columns that the operators don't read go by other names meanwhile, so one that is
    named like a result column keeps its values.
    """
    away = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "source")}
    out = step(docs.withColumnsRenamed(away)).select(*[away.get(c, c) for c in docs.columns])
    return out.withColumnsRenamed({new: c for c, new in away.items()})


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return of_documents(docs, lambda d: quality.score_quality(d, labels).filter("predicted = 1"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat across documents."""
    return of_documents(docs, line_dedup.dedup_lines)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return of_documents(docs, lambda d: bagminhash.near_duplicates(d).filter("kept"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not carry benchmark passages."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return of_documents(docs, lambda d: decontam.contaminate(d, bench).filter("NOT contaminated"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their slot, block and place in the mixture."""
    return pfair_mix.mix(docs)


STAGES = [("quality", keep_quality), ("line dedup", drop_lines), ("near dedup", drop_near_copies),
          ("decontamination", drop_contaminated), ("mixing", mix_sources)]

#: Two stages (trained network, signatures) have no SQL form; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``documents`` after all stages, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""URL filter: host and path rules, else logistic regression on hashed character n-grams.

The model is Spark ML's logistic regression over character n-grams of host and
path, each hashed into a fixed number of slots, trained on a small table of
labelled URLs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmine.llm.common import ascii_lower, text_of


@dataclass(frozen=True)
class Rule:
    """Allow or block ``host`` and its subdomains where the path starts with ``path``."""
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    rest = F.split(url, "://", 2)[1]
    return F.when(F.contains(url, F.lit("://")), ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.split(url, "://", 2)[1]
    return F.when(F.contains(url, F.lit("://")), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_of(host: Column, path: Column, rules: list[Rule], field: str) -> Column:
    """``field`` (name or verdict) of the longest rule that fits, null if none does.

    Rules of one length are taken in the order given. The list is a literal of
    the query: a few hundred rules at most.
    """
    out = F.lit(None).cast("string")
    for r in reversed(sorted(rules, key=lambda r: -len(r.name))):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, getattr(r, field)).otherwise(out)
    return out


def grams(host: Column, path: Column, sizes=(2, 3, 4, 5)) -> Column:
    """Character n-grams of the host and of the path, told apart by a leading mark."""
    def cut(mark, s):
        s = F.concat(F.lit("^"), s, F.lit("$"))
        return [F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(s) - (n - 1), F.lit(1))),
                            lambda i: F.concat(F.lit(mark), F.substring(s, i, F.lit(n)))) for n in sizes]
    return F.concat(*cut("h", host), *cut("p", path))


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "label", slots: int = 1 << 14,
          reg: float = 0.01) -> PipelineModel:
    """Fit on a small table of URLs labelled 1 (block) or 0; rows without a label are left out."""
    url = text_of(url_col)
    data = (labelled.filter(F.col(label_col).isNotNull())
            .select(F.col(label_col).cast("double").alias("label"), grams(host_of(url), path_of(url)).alias("grams")))
    return Pipeline(stages=[
        HashingTF(numFeatures=slots, binary=True, inputCol="grams", outputCol="features"),
        LogisticRegression(regParam=reg, maxIter=200, standardization=False)]).fit(data)


def judge(pages: DataFrame, model: PipelineModel, rules: list[Rule], url_col: str = "url",
          threshold: float = 0.5) -> DataFrame:
    """Rows of ``pages`` plus host, path, rule, p_block (double) and verdict (allow or block).

    The longest rule that fits decides, else the model: block from ``threshold``
    on. A null url, or one without ``://``, has an empty host and path and is
    judged by the model as such. Input columns named like a result column are
    replaced. Every row is judged alone, nothing is shuffled.
    """
    own = ["host", "path", "rule", "p_block", "verdict"]
    rows = pages.drop(*own).withColumn("__u", text_of(url_col))
    rows = rows.withColumn("host", host_of(F.col("__u"))).withColumn("path", path_of(F.col("__u")))
    scored = model.transform(rows.withColumn("grams", grams(F.col("host"), F.col("path"))).select(
        F.struct(*[c for c in rows.columns]).alias("__row"), "grams"))
    scored = scored.select("__row.*", vector_to_array("probability")[1].alias("p_block"))
    host, path = F.col("host"), F.col("path")
    return (scored.withColumn("rule", rule_of(host, path, rules, "name"))
            .withColumn("verdict", F.coalesce(rule_of(host, path, rules, "verdict"), F.when(
                F.col("p_block") >= threshold, "block").otherwise("allow"))).drop("__u"))

"""Feature preparation fitted on training rows only.

``TabularPrep.fit(train)`` learns, in a few distributed aggregates:
  * exact interpolated medians of the numeric columns (F1),
  * mean and population std of the imputed columns (F2; std 0 -> 1),
  * per categorical column the levels seen at least ``min_freq`` times
    (F3/F4; null is a level of its own; rarer levels pool into one bucket),
    as a table with codes (``operators.levels``).
Medians and scales reach the driver, levels do not. The fitted prep rewrites
columns with built-in expressions and joins, and assembles vectors with Spark
ML stages, so test rows never influence any constant (F8).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmine.operators.levels import Levels, fit_levels
from tabmine.operators.profile import to_long
from tabmine.operators.ranks import exact_quantiles
from tabmine.spec import FeatureSpec


def fit_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """exact medians of several columns in one distributed pass."""
    if not cols:
        return {}
    m = exact_quantiles(to_long(df, cols), "value", [0.5], ["column"]).collect()
    out = {r["column"]: r["value"] for r in m}
    return {c: (out.get(c) if out.get(c) is not None else 0.0) for c in cols}


def impute(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(v))) for c, v in medians.items()})


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """mean and population std per column (one aggregate)."""
    if not cols:
        return {}
    r = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return {c: (r[f"m_{c}"] or 0.0, (r[f"s_{c}"] or 0.0) or 1.0) for c in cols}


def standardize(df: DataFrame, stats: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()})


@dataclass
class FittedPrep:
    spec: FeatureSpec
    medians: dict
    scaler: dict
    levels: Levels
    onehot: bool
    model: PipelineModel | None = None
    text_model: object | None = None
    extra: dict = field(default_factory=dict)

    def columns(self, df: DataFrame) -> DataFrame:
        d = impute(df, self.medians)
        if self.onehot:
            d = standardize(d, self.scaler, "_z")
        return self.levels.attach(d)

    def transform(self, df: DataFrame) -> DataFrame:
        d = self.columns(df)
        if self.text_model is not None:
            d = self.text_model.transform(d)
        return self.model.transform(d)

    @property
    def max_levels(self) -> int:
        return max([self.levels.width(c) + 1 for c in self.levels.columns] + [2])


class TabularPrep:
    """numeric (imputed [+ standardised]) + binary + categorical
    (one-hot for linear models, ordinal for trees) [+ TF-IDF text]."""

    def __init__(self, spec: FeatureSpec, min_freq: int = 200, onehot: bool = True, text=None,
                 features_col: str = "features"):
        self.spec, self.min_freq, self.onehot, self.text = spec, min_freq, onehot, text
        self.features_col = features_col

    def fit(self, train: DataFrame) -> FittedPrep:
        s = self.spec
        med = fit_medians(train, s.num)
        scaler = fit_scaler(impute(train, med), s.num) if self.onehot else {}
        levels = fit_levels(train, s.cat, self.min_freq)
        fp = FittedPrep(s, med, scaler, levels, self.onehot)
        d = fp.columns(train)
        stages, inputs = [], []
        inputs += [f"{c}_z" for c in s.num] if self.onehot else list(s.num)
        inputs += list(s.bin)
        codes = [f"{c}_ix" for c in s.cat]
        if self.onehot and codes:
            hot = [f"{c}_oh" for c in s.cat]
            stages.append(OneHotEncoder(inputCols=codes, outputCols=hot, dropLast=False))
            inputs += hot
        else:
            inputs += codes
        if self.text is not None:
            fp.text_model = self.text.fit(d)
            d = fp.text_model.transform(d)
            inputs.append(self.text.output_col)
        stages.append(VectorAssembler(inputCols=inputs, outputCol=self.features_col, handleInvalid="keep"))
        fp.model = Pipeline(stages=stages).fit(d)
        return fp

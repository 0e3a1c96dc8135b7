"""Origin confidence: features, imputation, pluggable scorer, labels."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .context import CONTIG


class Scorer(Protocol):
    """Something that gives the probability of viral origin for rows of features."""

    features: list[str]
    thresholds: dict[str, float]

    def probability(self, rows: pd.DataFrame) -> pd.Series: ...


@dataclass(frozen=True)
class RuleScorer:
    """A logistic rule as a column expression, for use without a trained model, where it is asked for.

    The default weights are an example and not fitted to anything.  Weights are per unit of the feature; null features count as 0.
    """

    weights: dict[str, float] = field(default_factory=lambda: {"window_avg_kegg_vl_score": 0.5, "window_avg_pfam_vl_score": 0.5, "window_avg_phrog_vl_score": 0.5, "circular_contig": 0.8})
    bias: float = -2.0
    thresholds: dict[str, float] = field(default_factory=lambda: {"high": 0.8, "medium": 0.5})

    @property
    def features(self) -> list[str]:
        return list(self.weights)

    def column(self) -> Column:
        total = F.lit(self.bias)
        for name, weight in self.weights.items():
            total = total + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * weight
        return 1 / (1 + F.exp(-total))


@dataclass(frozen=True)
class NoScorer:
    """Where no trained model is given and no rule is asked for: nothing is said about the origin."""

    features: list[str] = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)


@dataclass(frozen=True)
class ModelScorer:
    """A trained classifier with ``predict_proba``, its ordered features and thresholds; sent to the workers once."""

    model: object
    features: list[str]
    thresholds: dict[str, float]

    def probability(self, rows: pd.DataFrame) -> pd.Series:
        return pd.Series(self.model.predict_proba(rows)[:, 1])


def load_scorer(model: str, features: str, thresholds: str) -> ModelScorer:
    """A scorer from three pickled artefacts: model, feature names, thresholds by label.

    ``joblib`` reads them if it is installed, else ``pickle``; only load files you trust.
    """
    try:
        from joblib import load
    except ImportError:
        import pickle

        def load(path: str):
            with open(path, "rb") as f:
                return pickle.load(f)

    bounds = {k: v["threshold"] if isinstance(v, dict) else v for k, v in dict(load(thresholds)).items()}
    return ModelScorer(load(model), list(load(features)), bounds)


def by_mode(name: str) -> bool:
    """Flags are imputed by the mode, numbers by the median."""
    return "flank" in name or "circular" in name


def imputed(genes: DataFrame, features: list[str], contig: tuple[str, ...] = CONTIG) -> DataFrame:
    """Adds ``_f_<feature>`` as doubles: absent columns 0; null the contig's median, of flags the mode (ties: the smallest; none: 0)."""
    whole = Window.partitionBy(*contig)
    out = {}
    kinds = dict(genes.dtypes)
    for name in features:
        if name not in kinds:
            out[f"_f_{name}"] = F.lit(0.0)
            continue
        value = F.col(name).cast("double")
        if by_mode(name) or kinds[name] == "boolean":
            fill = F.coalesce(F.mode(value, True).over(whole), F.lit(0.0))
        else:
            fill = F.median(value).over(whole)
        out[f"_f_{name}"] = F.coalesce(value, fill)
    return genes.withColumns(out)


def confidence(probability: Column, thresholds: dict[str, float]) -> Column:
    """``high``, ``medium`` or ``low``, bounds included."""
    return F.when(probability >= thresholds["high"], "high").when(probability >= thresholds["medium"], "medium").otherwise("low")


def scored(genes: DataFrame, scorer: Scorer | RuleScorer | NoScorer, contig: tuple[str, ...] = CONTIG) -> DataFrame:
    """Adds ``viral_prob`` and ``viral_origin_confidence``, both null without a scorer."""
    if isinstance(scorer, NoScorer):
        return genes.withColumns({"viral_prob": F.lit(None).cast("double"), "viral_origin_confidence": F.lit(None).cast("string")})
    if isinstance(scorer, RuleScorer):
        present = RuleScorer({k: w for k, w in scorer.weights.items() if k in genes.columns}, scorer.bias, scorer.thresholds)
        out = genes.withColumn("viral_prob", present.column())
    else:
        rows = imputed(genes, scorer.features, contig)
        names = [f"_f_{f}" for f in scorer.features]

        @F.pandas_udf("double")
        def probability(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in parts:
                yield scorer.probability(pd.concat(columns, axis=1, keys=scorer.features))

        out = rows.withColumn("viral_prob", probability(*names)).drop(*names)
    return out.withColumn("viral_origin_confidence", confidence(F.col("viral_prob"), scorer.thresholds))

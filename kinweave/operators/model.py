"""Model-based matching: pair features, a logistic regression and a probability threshold.

Candidate pairs come from the similarity join under loose thresholds, so they stay few.
Training is Spark ML; scoring is a plain column expression of the fitted weights, so it
runs in the same generated code as the join that made the pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions.values import similarity


@dataclass(frozen=True)
class Matcher:
    """Fitted weights of the pair features."""

    fields: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float
    converged: bool = True

    def probability(self) -> Column:
        terms = [F.col(f) * F.lit(w) for f, w in zip(feature_names(self.fields), self.weights)]
        return 1 / (1 + F.exp(-reduce(Column.__add__, terms, F.lit(self.intercept))))


def feature_names(fields: Sequence[str]) -> list[str]:
    return [f"{kind}_{name}" for name in fields for kind in ("sim", "missing")]


def pair_features(pairs: DataFrame, df: DataFrame, id_col: str, fields: Sequence[str]) -> DataFrame:
    """Per pair and field: similarity (0 when a value is missing) and a missing flag."""
    values = F.struct(*fields)
    a = df.select(F.col(id_col).alias("id_a"), values.alias("a"))
    b = df.select(F.col(id_col).alias("id_b"), values.alias("b"))
    joined = pairs.select("id_a", "id_b").join(a, "id_a").join(b, "id_b")

    def feature(name: str) -> list[Column]:
        x, y = F.col(f"a.{name}"), F.col(f"b.{name}")
        return [
            F.coalesce(similarity(x, y), F.lit(0.0)).alias(f"sim_{name}"),
            (x.isNull() | y.isNull()).cast("double").alias(f"missing_{name}"),
        ]

    cols = [c for name in fields for c in feature(name)]
    return joined.select("id_a", "id_b", *cols)


def train_matcher(features: DataFrame, truth: DataFrame, fields: Sequence[str], max_iter: int = 50) -> Matcher:
    """Fit on candidate pairs; `truth` holds the (id_a, id_b) that are matches.

    `converged` tells whether the fit settled before `max_iter` iterations.
    """
    known = truth.select("id_a", "id_b").distinct().withColumn("label", F.lit(1.0))
    labelled = features.join(known, ["id_a", "id_b"], "left").na.fill({"label": 0.0})
    vectors = VectorAssembler(inputCols=feature_names(fields), outputCol="features").transform(labelled)
    fitted = LogisticRegression(maxIter=max_iter, regParam=0.001).fit(vectors.select("features", "label"))
    return Matcher(tuple(fields), tuple(float(w) for w in fitted.coefficients), float(fitted.intercept),
                   fitted.summary.totalIterations < max_iter)


def model_links(features: DataFrame, matcher: Matcher, threshold: float) -> DataFrame:
    """(id_a, id_b, score): pairs whose match probability reaches the threshold."""
    scored = features.select("id_a", "id_b", F.round(matcher.probability(), 6).alias("score"))
    return scored.where(F.col("score") >= F.lit(threshold))

"""Classifier over pair features: fit on the training pairs, evaluate on the test pairs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from mergewright.operators.compare import FEATURES, pair_features
from mergewright.operators.metrics import confusion, pair_metrics
from mergewright.operators.models import fit_matcher, predict, weights


@dataclass(frozen=True)
class Evaluation:
    predictions: DataFrame
    confusion: DataFrame
    metrics: DataFrame


def classify(train: DataFrame, test: DataFrame, c: float = 1.0) -> Evaluation:
    """Fit on labelled pairs and predict others; both tables hold flat pairs."""
    by_feature, intercept = weights(fit_matcher(pair_features(train, "label"), FEATURES, c=c))
    predictions = predict(pair_features(test, "label"), by_feature, intercept)
    return Evaluation(predictions, confusion(predictions), pair_metrics(predictions))

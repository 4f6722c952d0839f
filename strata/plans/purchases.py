"""Train, evaluate and score purchase prediction."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.learning import (
    EVALUATION_RANGE, LABEL, SCORING_RANGE, TRAIN_RANGE, LogisticModel, best_prediction,
    binary_metrics, in_range, positive_probability, predict, session_features, train,
)
from strata.operators.quality import Expect, gate

METRIC_GATE = {
    "precision": Expect(at_least=0.0, at_most=1.0),
    "recall": Expect(at_least=0.0, at_most=1.0),
    "roc_auc": Expect(above=0.5),
}


@dataclass(frozen=True)
class Trained:
    model: LogisticModel
    judged: DataFrame
    predictions: DataFrame

    def metrics(self) -> DataFrame:
        return binary_metrics(self.judged, LABEL, "score")


def run(
    sessions: DataFrame,
    train_range: tuple[str, str] = TRAIN_RANGE,
    evaluation_range: tuple[str, str] = EVALUATION_RANGE,
    scoring_range: tuple[str, str] = SCORING_RANGE,
) -> Trained:
    """Three disjoint date ranges: learn, judge, and predict the best per visitor."""
    features = session_features(sessions)
    model = train(in_range(features, train_range))
    judged = predict(model, in_range(features, evaluation_range)).withColumn(
        "score", positive_probability()
    )
    scored = predict(model, in_range(features, scoring_range))
    best = best_prediction(scored, "visitor_id", "suffix").select(
        "visitor_id",
        F.col("predicted_label").alias("predicted_transaction"),
        "transaction_probability",
    )
    return Trained(model, judged, best)


def verify(trained: Trained) -> DataFrame:
    """Gate rows for the metrics, and that there are predictions."""
    some = trained.predictions.agg(F.count(F.lit(1)).alias("predictions"))
    return gate(trained.metrics(), METRIC_GATE).unionByName(
        gate(some, {"predictions": Expect(at_least=1)})
    )

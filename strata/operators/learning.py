"""Purchase prediction: features, split, training, scoring, evaluation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.nested import element_where
from strata.operators.ordering import best_per_key, with_running_totals
from strata.session import cut_lineage

# Feature and label names, and the three date ranges.
NUMERIC = ("bounces", "time_on_site", "pageviews")
CATEGORICAL = ("traffic_source", "traffic_medium", "device_category", "country")
NO_CATEGORY = "(none)"
HASHED = 32  # positions for category values; a Newton step adds up that many columns squared
NEWTON_STEPS, RIDGE, SETTLED = 8, 1.0, 1e-9
LABEL = "will_buy_on_return_visit"
MONTH = "month"  # partition column of session tables kept by month
TRAIN_RANGE = ("20160801", "20170430")
EVALUATION_RANGE = ("20170501", "20170630")
SCORING_RANGE = ("20170701", "20170731")


def session_features(sessions: DataFrame) -> DataFrame:
    """Flat features of nested sessions; missing counts are 0, the label is binary."""
    return sessions.select(
        *[c for c in sessions.columns if c == MONTH],
        F.col("fullVisitorId").alias("visitor_id"),
        "suffix",
        F.coalesce("totals.bounces", F.lit(0)).alias("bounces"),
        F.coalesce("totals.timeOnSite", F.lit(0)).alias("time_on_site"),
        F.coalesce("totals.pageviews", F.lit(0)).alias("pageviews"),
        F.col("trafficSource.source").alias("traffic_source"),
        F.col("trafficSource.medium").alias("traffic_medium"),
        F.col("device.deviceCategory").alias("device_category"),
        F.col("geoNetwork.country").alias("country"),
        F.when(F.col("totals.transactions") > 0, 1).otherwise(0).alias(LABEL),
    )


def in_range(df: DataFrame, bounds: tuple[str, str], suffix: str = "suffix") -> DataFrame:
    """Rows of an inclusive suffix range; of a table by month only these months are read."""
    first, last = bounds
    if MONTH in df.columns:
        df = df.filter(F.col(MONTH).between(first[:6], last[:6]))
    return df.filter(F.col(suffix).between(first, last))


def labelled_ranges(
    df: DataFrame, ranges: dict[str, tuple[str, str]], suffix: str = "suffix", name: str = "part"
) -> DataFrame:
    """Rows of disjoint suffix ranges with the name of theirs, in one pass; others are left out."""
    part = F.lit(None).cast("string")
    for label, bounds in ranges.items():
        part = F.when(F.col(suffix).between(*bounds), F.lit(label)).otherwise(part)
    return df.withColumn(name, part).filter(F.col(name).isNotNull())


def with_class_weights(df: DataFrame, label: str = LABEL, weight: str = "weight") -> DataFrame:
    """Weight rows by ``n / (2 * n of their class)``, so both classes count alike."""
    totals = df.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.sum(label).alias("ones")).alias("t")
    ).scalar()
    own = F.when(F.col(label) == 1, totals["ones"]).otherwise(totals["n"] - totals["ones"])
    return df.withColumn(weight, totals["n"].cast("double") / (F.lit(2.0) * own))


def category_position(column: str, positions: int) -> Column:
    """Which of ``positions`` a category value marks, from the digest of its column and value."""
    named = F.concat(F.lit(f"{column}="), F.when(F.col(column) != "", F.col(column)).otherwise(NO_CATEGORY))
    digits = F.conv(F.substring(F.md5(F.coalesce(named, F.lit(f"{column}={NO_CATEGORY}"))), 1, 7), 16, 10)
    return (digits.cast("bigint") % positions).cast("int")


@dataclass(frozen=True)
class LogisticModel:
    """Weights of one, the scaled numbers and the category positions, in this order."""

    weights: np.ndarray
    means: tuple[float, ...]
    deviations: tuple[float, ...]
    positions: int = HASHED

    def inputs(self) -> tuple[Column, Column]:
        """Scaled numbers and marked positions of a row, as two arrays."""
        scaled = [(F.col(c).cast("double") - m) / d for c, m, d in zip(NUMERIC, self.means, self.deviations)]
        return F.array(*scaled), F.array(*[category_position(c, self.positions) for c in CATEGORICAL])

    def probability(self) -> Column:
        """The chance of class 1, as one expression over the features."""
        numbers, marked = self.inputs()
        first = 1 + len(NUMERIC)
        weights = F.array(*[F.lit(float(w)) for w in self.weights[first:]])
        sums = F.lit(float(self.weights[0]))
        for i, w in enumerate(self.weights[1:first]):
            sums = sums + F.get(numbers, F.lit(i)) * float(w)
        for i in range(len(CATEGORICAL)):
            sums = sums + F.get(weights, F.get(marked, F.lit(i)))
        return 1 / (1 + F.exp(-sums))


def _rows_of(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """The rows of a batch as a matrix with a column of ones, numbers and position counts."""
    out = np.zeros((batch.num_rows, size))
    out[:, 0] = 1
    numbers = batch.column("numbers").flatten().to_numpy().reshape(batch.num_rows, -1)
    out[:, 1: 1 + numbers.shape[1]] = numbers
    marked = batch.column("marked").flatten().to_numpy().reshape(batch.num_rows, -1) + 1 + numbers.shape[1]
    np.add.at(out, (np.arange(batch.num_rows)[:, None], marked), 1)
    return out


def newton_sums(rows: DataFrame, weights: np.ndarray) -> np.ndarray:
    """``X'WX`` and below it ``X'We`` of the weighted rows (``numbers, marked, y, weight``).

    Every task adds up its own rows; Spark adds the tasks' matrices position by position.
    """
    size = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size))
        for batch in batches:
            x, y = _rows_of(batch, size), batch.column("y").to_numpy()
            weight = batch.column("weight").to_numpy()
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -700, 700)))
            total[:size] += x.T @ ((weight * p * (1 - p))[:, None] * x)
            total[size] += (weight * (y - p)) @ x
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(total.ravel()[k])], ["k", "v"])

    out = np.zeros((size + 1) * size)
    summed = rows.select("numbers", "marked", "y", "weight").mapInArrow(run, "k int, v double")
    for r in summed.groupBy("k").agg(F.sum("v").alias("v")).collect():  # size * (size + 1) numbers
        out[r["k"]] = r["v"]
    return out.reshape(size + 1, size)


def train(
    features: DataFrame, label: str = LABEL, positions: int = HASHED, steps: int = NEWTON_STEPS, ridge: float = RIDGE
) -> LogisticModel:
    """Logistic regression with class weights, by ``steps`` Newton steps or until they settle.

    Numbers are scaled to mean 0 and deviation 1; each category value marks one of
    ``positions`` by its digest, so the model's size does not depend on how many values
    there are, and no list of them passes the driver. A step is iteratively reweighted
    least squares: two sums over all rows and the solution of a system of the model's size.
    ``ridge`` holds all weights but the first one small. Without rows, or with rows of one
    class only, the weights stay finite.
    """
    hit = (F.col(label) == 1).cast("int")
    aggregates = [F.count(F.lit(1)).alias("n"), F.sum(hit).alias("ones")]
    for c in NUMERIC:
        aggregates += [F.avg(c).alias(f"mean_{c}"), F.stddev_samp(c).alias(f"deviation_{c}")]
    facts = features.filter(F.col(label).isNotNull()).agg(*aggregates).first()
    means = tuple(facts[f"mean_{c}"] or 0.0 for c in NUMERIC)
    deviations = tuple(facts[f"deviation_{c}"] or 1.0 for c in NUMERIC)
    model = LogisticModel(np.zeros(1 + len(NUMERIC) + positions), means, deviations, positions)
    numbers, marked = model.inputs()
    n, ones = facts["n"], facts["ones"] or 0
    weight = F.when(hit == 1, n / (2 * max(ones, 1))).otherwise(n / (2 * max(n - ones, 1)))
    rows = cut_lineage(features.filter(F.col(label).isNotNull()).select(
        numbers.alias("numbers"), marked.alias("marked"), hit.cast("double").alias("y"), weight.alias("weight")),
        "training-rows")
    held = ridge * np.append(0.0, np.ones(len(model.weights) - 1))
    weights = model.weights
    for _ in range(steps):
        sums = newton_sums(rows, weights)
        curve = sums[:-1] + np.diag(held)
        curve[0, 0] += 1e-12  # no rows: nothing to learn
        change = np.linalg.solve(curve, sums[-1] - held * weights)
        weights = weights + change
        if np.abs(change).max() < SETTLED:
            break  # the next step would change nothing that a double shows
    return LogisticModel(weights, means, deviations, positions)


def predict(model: LogisticModel, features: DataFrame) -> DataFrame:
    """Features plus ``predicted_label`` and ``probs array<struct<label, prob>>``."""
    one = F.col("__one")
    scored = features.withColumn("__one", model.probability())
    probs = F.array(*[
        F.struct(F.lit(i).alias("label"), prob.alias("prob")) for i, prob in ((1, one), (0, 1 - one))
    ])
    return scored.select(*features.columns, (one > 0.5).cast("int").alias("predicted_label"), probs.alias("probs"))


def positive_probability(probs: str = "probs"):
    """The probability of class 1 out of an array of (label, prob)."""
    return element_where(probs, "label", 1, "prob")


def best_prediction(predictions: DataFrame, key: str, tie: str) -> DataFrame:
    """Per key the prediction with the highest probability of class 1."""
    scored = predictions.withColumn("transaction_probability", positive_probability())
    return best_per_key(scored, [key], [F.desc("transaction_probability"), F.col(tie)])


def binary_metrics(scored: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """One row: precision, recall, accuracy, f1, log loss and exact ROC AUC.

    Rows first shrink to counts per distinct score. The AUC adds, over the scores
    in order, the negatives ranked below (ties count half); the running count is
    built range by range, so no task needs all scores.
    """
    hit = F.col(label) == 1
    per_score = (
        scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg"))
    )
    ordered = with_running_totals(per_score, ["score"], {"neg": "neg_below"})
    chosen = F.col("score") >= threshold
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    safe = F.least(F.greatest(F.col("score"), F.lit(1e-15)), F.lit(1 - 1e-15))
    sums = ordered.agg(
        F.sum(pos).alias("p"),
        F.sum(neg).alias("n"),
        F.sum(F.when(chosen, pos).otherwise(0.0)).alias("tp"),
        F.sum(F.when(chosen, neg).otherwise(0.0)).alias("fp"),
        F.sum(-(pos * F.log(safe) + neg * F.log(1 - safe))).alias("loss"),
        F.sum(pos * (F.col("neg_below") + neg / 2)).alias("wins"),
    )
    p, n, tp, fp = (F.col(c) for c in ("p", "n", "tp", "fp"))
    precision = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    recall = F.coalesce(F.try_divide(tp, p), F.lit(0.0))
    return sums.select(
        precision.alias("precision"),
        recall.alias("recall"),
        F.try_divide(tp + n - fp, p + n).alias("accuracy"),
        F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)).alias(
            "f1_score"
        ),
        F.try_divide(F.col("loss"), p + n).alias("log_loss"),
        F.try_divide(F.col("wins"), p * n).alias("roc_auc"),
    )

"""Two-head classification and parameter search with ``pyspark.ml``.

The reference trains a neural network on one machine; here the same inputs and
labels go to Spark's distributed estimators, one per head. The model family
differs, so metric values are not comparable; the outputs have the same shape.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthframe.operators.evaluation import HEADS, accuracy, brier
from depthframe.operators.features import quote_features
from depthframe.operators.labels import class_weights, with_class_weight
from depthframe.operators.splits import decay_weights
from depthframe.operators.window import block_window, halo, run_extremes
from depthframe.params import BookParams
from depthframe.session import stage

WINDOW_FEATURES = ("mid_change", "range_pct", "mean_spread_pct", "mean_imbalance", "last_imbalance")


def window_summary(line: DataFrame, p: BookParams) -> DataFrame:
    """Look-back window of each anchor as a few numbers instead of T vectors."""
    t = p.window_steps
    blocks = halo(quote_features(line), "snap_idx", t, 0, p.block_rows).repartition("asset", "_block")
    cells = run_extremes(blocks, "snap_idx", "mid", t)  # all windows share the one shuffle
    w = block_window("snap_idx")
    mid = F.col("mid")
    imbalance = F.coalesce("volume_imbalance", F.lit(0.0))

    def mean(value: Column) -> Column:
        """Trailing mean as the difference of two running sums."""
        upto = F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0))
        older = F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -t))
        return (upto - F.coalesce(older, F.lit(0.0))) / t

    high = F.greatest("_head_hi", F.lag("_rest_hi", t - 1).over(w))
    low = F.least("_head_lo", F.lag("_rest_lo", t - 1).over(w))
    out = cells.withColumns(
        {
            "mid_change": mid / F.lag("mid", t - 1).over(w) - 1.0,
            "range_pct": (high - low) / mid * 100.0,
            "mean_spread_pct": mean(F.col("bid_ask_spread") / mid * 100.0),
            "mean_imbalance": mean(imbalance),
            "last_imbalance": imbalance,
        }
    )
    full = out.where(F.col("_own") & (F.col("snap_idx") >= t - 1))
    return full.select("asset", "snap_idx", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in WINDOW_FEATURES])


def training_weights(samples: DataFrame, num_classes: int, half_lives: Mapping[str, float], assets: Sequence[str] | None) -> DataFrame:
    """``samples`` with weight_up and weight_down: balanced class weight of the head's label times the mean age decay.

    Class shares come from the rows with split 'train'; a label that none of them has gets weight 0. Ages count from the newest row of the asset.
    """
    aged = decay_weights(samples, half_lives, assets).drop(*half_lives)
    for head in HEADS:
        label = f"label_{head}"
        shares = class_weights(samples.where(F.col("split") == "train"), label, num_classes)
        aged = with_class_weight(aged, shares, label, num_classes, assets)
        aged = aged.withColumn(f"weight_{head}", F.coalesce("class_weight", F.lit(0.0)) * F.col("weight_mean")).drop("class_weight")
    return aged.select(*samples.columns, *[f"weight_{head}" for head in HEADS])


def _estimator(kind: str, label: str, num_features: int, num_classes: int, settings: Mapping[str, Any]):
    if kind == "logistic":
        return LogisticRegression(featuresCol="scaled", labelCol=label, probabilityCol=f"probability_{label}", rawPredictionCol=f"raw_{label}", predictionCol=f"prediction_{label}", family="multinomial", **settings)
    if kind == "perceptron":
        hidden = settings.get("hidden", 16)
        rest = {k: v for k, v in settings.items() if k != "hidden"}
        return MultilayerPerceptronClassifier(featuresCol="scaled", labelCol=label, probabilityCol=f"probability_{label}", rawPredictionCol=f"raw_{label}", predictionCol=f"prediction_{label}", layers=[num_features, hidden, num_classes], seed=42, **rest)
    raise ValueError("kind must be 'logistic' or 'perceptron'")


def fit_two_head(
    train: DataFrame, features: Sequence[str], num_classes: int, kind: str = "logistic", weighted: bool = False, **settings: Any
) -> dict[str, PipelineModel]:
    """One fitted model per head from a staged training table.

    With ``weighted`` a row counts with its weight_up or weight_down (``training_weights``); the perceptron takes no weights.
    """
    if weighted and kind == "perceptron":
        raise ValueError("the perceptron takes no weights")
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)
    models = {}
    for head in HEADS:
        estimator = _estimator(kind, f"label_{head}", len(features), num_classes, settings)
        if weighted:
            estimator = estimator.setWeightCol(f"weight_{head}")
        models[head] = Pipeline(stages=[assembler, scaler, estimator]).fit(train)
    return models


def predict_two_head(models: Mapping[str, PipelineModel], rows: DataFrame, num_classes: int) -> DataFrame:
    """(asset, sample_idx, head, y_true, probs) for both heads.

    A class that never occurred in training gets probability 0.
    """
    out = None
    for head, model in models.items():
        label = f"label_{head}"
        scored = model.transform(rows).withColumn("_p", vector_to_array(f"probability_{label}"))
        probs = F.transform(
            F.sequence(F.lit(0), F.lit(num_classes - 1)),
            lambda i: F.coalesce(F.try_element_at("_p", i + 1), F.lit(0.0)),
        )
        part = scored.select(
            "asset", "sample_idx", F.lit(head).alias("head"), F.col(label).cast("int").alias("y_true"), probs.alias("probs")
        )
        out = part if out is None else out.unionByName(part)
    return out


def objective(predictions: DataFrame, metric: str) -> float:
    """Mean over heads, or one head's value for ``val_<head>_intensity_accuracy``."""
    if metric == "brier_score":
        return brier(predictions).agg(F.avg("brier_score")).first()[0]
    table = accuracy(predictions)
    if metric.startswith("val_"):
        table = table.where(F.col("head") == metric.split("_")[1])
    elif metric != "accuracy":
        raise ValueError(f"unknown metric {metric!r}")
    return table.agg(F.avg("accuracy")).first()[0]


def draw(space: Mapping[str, Sequence[float]], trials: int, seed: int) -> list[dict[str, float]]:
    """Seeded parameter draws; each entry of the space lists its choices."""
    source = random.Random(seed)
    return [{name: source.choice(list(choices)) for name, choices in space.items()} for _ in range(trials)]


def search(
    samples: DataFrame,
    features: Sequence[str],
    num_classes: int,
    space: Mapping[str, Sequence[float]],
    trials: int,
    seed: int,
    metric: str,
    direction: str,
    kind: str = "logistic",
) -> DataFrame:
    """Parameter search over (fold, role) samples: (trial, params, value, best).

    Each fit and score is a distributed job on the staged folds; only one number
    per trial comes back to the driver.
    """
    if direction not in ("maximize", "minimize"):
        raise ValueError("direction must be 'maximize' or 'minimize'")
    staged = stage(samples, "folds")
    folds = sorted(r["fold"] for r in staged.select("fold").distinct().collect())
    results = []
    for trial, settings in enumerate(draw(space, trials, seed)):
        values = []
        for fold in folds:
            of_fold = staged.where(F.col("fold") == fold)
            models = fit_two_head(of_fold.where(F.col("role") == "train"), features, num_classes, kind, **settings)
            scored = predict_two_head(models, of_fold.where(F.col("role") == "validation"), num_classes)
            value = objective(scored, metric)
            if value is not None:
                values.append(value)
        mean = sum(values) / len(values) if values else None
        results.append((trial, {k: float(v) for k, v in settings.items()}, mean))
    scored_trials = [r for r in results if r[2] is not None]
    pick = (max if direction == "maximize" else min)(scored_trials, key=lambda r: r[2])[0] if scored_trials else None
    rows = [(t, s, v, t == pick) for t, s, v in results]
    return samples.sparkSession.createDataFrame(rows, "trial int, params map<string,double>, value double, best boolean")

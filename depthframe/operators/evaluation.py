"""Classification and calibration metrics of two-head predictions.

Input rows are (sample_idx, head, y_true, probs), with an asset where several are
scored. Every metric starts from one aggregation with map-side partial results;
what follows works on at most heads x K x K or heads x bins rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depthframe.functions.bins import unit_bin, unit_edges
from depthframe.functions.probs import argmax, entropy, squared_error, temper, true_rank

HEADS = ("up", "down")


def with_prediction(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("y_pred", argmax("probs"))


def shape_report(predictions: DataFrame, num_classes: int) -> DataFrame:
    """Per head: rows, rows with a wrong number of probabilities, labels outside 0..K-1."""
    y = F.col("y_true")
    return predictions.groupBy("head").agg(
        F.count("*").alias("n"),
        F.count_if(F.coalesce(F.size("probs") != num_classes, F.lit(True))).alias("wrong_size"),
        F.count_if((y < 0) | (y >= num_classes)).alias("label_outside"),
    )


def check_shapes(predictions: DataFrame, num_classes: int, num_bins: int) -> None:
    """Raise unless there are two heads of equal length with K probabilities per row."""
    if num_bins <= 0:
        raise ValueError("num_bins must be positive")
    found = {r["head"]: r for r in shape_report(predictions, num_classes).take(len(HEADS) + 1)}
    if set(found) != set(HEADS):
        raise ValueError(f"expected heads {HEADS}, found {sorted(found)}")
    if found["up"]["n"] != found["down"]["n"]:
        raise ValueError("both heads must have the same number of rows")
    for head, row in found.items():
        if row["wrong_size"] or row["label_outside"]:
            raise ValueError(f"head {head}: {row.asDict()}")


def sample_keys(rows: DataFrame) -> list[str]:
    """What names a sample: sample_idx restarts with every asset, so the asset belongs to it."""
    return [c for c in ("asset", "sample_idx") if c in rows.columns]


def match_truth(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """Attach the true class to predictions by (asset, sample_idx, head)."""
    keys = [*sample_keys(predictions), "head"]
    return predictions.join(truth.select(*keys, "y_true"), keys)


def accuracy(predictions: DataFrame, by: Sequence[str] = ("head",)) -> DataFrame:
    hit = (argmax("probs") == F.col("y_true")).cast("double")
    return predictions.groupBy(*by).agg(F.avg(hit).alias("accuracy"), F.count("*").alias("n"))


def confusion(predictions: DataFrame, num_classes: int, by: Sequence[str] = ("head",)) -> DataFrame:
    """Dense K x K counts per group; pairs outside 0..K-1 are not counted.

    The rows are counted once per cell; the at most K*K counts of a group then
    become columns, so empty cells need no join.
    """
    return dense_matrix(with_prediction(predictions).groupBy(*by, "y_true", "y_pred").agg(F.count("*").alias("n")), num_classes, by)


def dense_matrix(counts: DataFrame, num_classes: int, by: Sequence[str] = ("head",)) -> DataFrame:
    """K x K cells of every group from the counts (y_true, y_pred, n) that occur."""

    def cell(t: int, c: int) -> Column:
        here = (F.col("y_true") == t) & (F.col("y_pred") == c)
        return F.sum(F.when(here, F.col("n")).otherwise(0)).alias(f"_{t}_{c}")

    wide = counts.groupBy(*by).agg(*[cell(t, c) for t in range(num_classes) for c in range(num_classes)])
    cells = [
        F.struct(F.lit(t).alias("y_true"), F.lit(c).alias("y_pred"), F.col(f"_{t}_{c}").alias("n"))
        for t in range(num_classes)
        for c in range(num_classes)
    ]
    return wide.select(*by, F.explode(F.array(*cells)).alias("c")).select(*by, "c.*")


def per_class(matrix: DataFrame, by: Sequence[str] = ("head",)) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where undefined."""
    t, c, n = F.col("y_true"), F.col("y_pred"), F.col("n")
    sides = matrix.select(
        *by, "y_true", "y_pred", "n", F.explode(F.array_distinct(F.array("y_true", "y_pred"))).alias("class")
    )
    k = F.col("class")
    sums = sides.groupBy(*by, "class").agg(
        F.sum(F.when((t == k) & (c == k), n).otherwise(0)).alias("tp"),
        F.sum(F.when((t != k) & (c == k), n).otherwise(0)).alias("fp"),
        F.sum(F.when((t == k) & (c != k), n).otherwise(0)).alias("fn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    rates = sums.select(
        *by,
        "class",
        F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0).alias("precision"),
        F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0).alias("recall"),
        (tp + fn).alias("support"),
    )
    pr = F.col("precision") + F.col("recall")
    f1 = F.when(pr > 0, 2.0 * F.col("precision") * F.col("recall") / pr).otherwise(0.0)
    return rates.withColumn("f1", f1)


def macro(classes: DataFrame, by: Sequence[str] = ("head",)) -> DataFrame:
    """Averages over all classes, absent ones counted as 0."""
    return classes.groupBy(*by).agg(
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
    )


def weighted_f1(classes: DataFrame, min_support: int, by: Sequence[str] = ("head",)) -> DataFrame:
    """Support-weighted F1 and the number of classes below the support limit."""
    total = F.sum("support")
    return classes.groupBy(*by).agg(
        F.when(total > 0, F.sum(F.col("f1") * F.col("support")) / total).otherwise(0.0).alias("weighted_f1"),
        total.alias("support"),
        F.count_if(F.col("support") < min_support).alias("low_support_classes"),
    )


def brier(predictions: DataFrame, by: Sequence[str] = ("head",)) -> DataFrame:
    error = squared_error(F.col("probs"), F.col("y_true"))
    return predictions.groupBy(*by).agg(F.avg(error).alias("brier_score"))


def reliability(predictions: DataFrame, num_bins: int, by: Sequence[str] = ("head",), per_label: bool = False) -> DataFrame:
    """Reliability bins over all class probabilities; empty bins are zero rows.

    With ``per_label`` there is one curve per class.
    """
    if num_bins <= 0:
        raise ValueError("num_bins must be positive")
    flat = predictions.select(*by, "y_true", F.posexplode("probs").alias("class", "p"))
    flat = flat.withColumns(
        {"bin": unit_bin(F.col("p"), num_bins), "hit": (F.col("class") == F.col("y_true")).cast("double")}
    )
    keys = [*by, "class"] if per_label else list(by)
    sums = flat.groupBy(*keys, "bin").agg(
        F.avg("p").alias("bin_confidence"), F.avg("hit").alias("bin_accuracy"), F.count("*").alias("bin_count")
    )
    edges = unit_edges(num_bins)
    cells = [
        F.struct(F.lit(i).alias("bin"), F.lit(edges[i]).alias("left_edge"), F.lit(edges[i + 1]).alias("right_edge"))
        for i in range(num_bins)
    ]
    bound = sums.select(*keys).distinct().select(*keys, F.explode(F.array(*cells)).alias("b")).select(*keys, "b.*")
    joined = bound.join(sums.where(F.col("bin").isNotNull()), [*keys, "bin"], "left")
    return joined.select(
        *keys,
        "bin",
        "left_edge",
        "right_edge",
        F.coalesce("bin_confidence", F.lit(0.0)).alias("bin_confidence"),
        F.coalesce("bin_accuracy", F.lit(0.0)).alias("bin_accuracy"),
        F.coalesce("bin_count", F.lit(0)).cast("long").alias("bin_count"),
    )


def calibration_error(curve: DataFrame, by: Sequence[str] = ("head",)) -> DataFrame:
    """Expected and maximum calibration error of a reliability curve."""
    gap = F.abs(F.col("bin_confidence") - F.col("bin_accuracy"))
    total = F.sum("bin_count")
    return curve.groupBy(*by).agg(
        F.when(total > 0, F.sum(gap * F.col("bin_count")) / total).otherwise(0.0).alias("ece"),
        F.coalesce(F.max(F.when(F.col("bin_count") > 0, gap)), F.lit(0.0)).alias("mce"),
    )


def evaluate(predictions: DataFrame, num_classes: int, num_bins: int) -> DataFrame:
    """All metrics in long form: (metric, value), named eval_{head}_{metric}[_class_k].

    The rows are checked first: labels outside 0..K-1 or a wrong number of
    probabilities are an error. They are then read twice, once for the counts and
    squared errors of each (true, predicted) pair, once for the reliability bins.
    """
    check_shapes(predictions, num_classes, num_bins)
    error = squared_error(F.col("probs"), F.col("y_true"))
    pairs = with_prediction(predictions).groupBy("head", "y_true", "y_pred").agg(F.count("*").alias("n"), F.sum(error).alias("error"))
    classes = per_class(dense_matrix(pairs, num_classes))
    prefix = F.concat(F.lit("eval_"), F.col("head"), F.lit("_"))

    def long(table: DataFrame, names: Sequence[str], suffix: Column | None = None) -> DataFrame:
        cells = []
        for n in names:
            parts = [prefix, F.lit(n)] + ([suffix] if suffix is not None else [])
            cells.append(F.struct(F.concat(*parts).alias("metric"), F.col(n).cast("double").alias("value")))
        return table.select(F.explode(F.array(*cells)).alias("m")).select("m.*")

    hits = F.when(F.col("y_pred") == F.col("y_true"), F.col("n")).otherwise(0)
    scores = pairs.groupBy("head").agg(
        (F.sum(hits) / F.sum("n")).alias("accuracy"),
        (F.sum("error") / F.sum("n")).alias("brier_score"),
    )
    class_suffix = F.concat(F.lit("_class_"), F.col("class").cast("string"))
    return (
        long(scores, ["accuracy", "brier_score"])
        .unionByName(long(macro(classes), ["macro_precision", "macro_recall", "macro_f1"]))
        .unionByName(long(classes, ["precision", "recall", "f1"], class_suffix))
        .unionByName(long(calibration_error(reliability(predictions, num_bins)), ["ece"]))
    )


def top_k_accuracy(predictions: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Share of rows whose true class is among the k most probable, and mean entropy."""
    rank = true_rank(F.col("probs"), F.col("y_true"))
    aggs = [F.avg((rank <= k).cast("double")).alias(f"top_{k}_accuracy") for k in ks]
    return predictions.groupBy("head").agg(*aggs, F.avg(entropy(F.col("probs"))).alias("mean_entropy"))


def confidence_histogram(predictions: DataFrame, num_bins: int) -> DataFrame:
    """Counts of the largest probability per head and equal-width bin."""
    confidence = F.array_max("probs")
    counts = predictions.groupBy("head", unit_bin(confidence, num_bins).alias("bin")).agg(F.count("*").alias("n"))
    wide = counts.groupBy("head").agg(
        *[F.sum(F.when(F.col("bin") == i, F.col("n")).otherwise(0)).alias(f"_{i}") for i in range(num_bins)]
    )
    cells = [F.struct(F.lit(i).alias("bin"), F.col(f"_{i}").alias("n")) for i in range(num_bins)]
    return wide.select("head", F.explode(F.array(*cells)).alias("c")).select("head", "c.*")


def directional_accuracy(predictions: DataFrame, moves: DataFrame) -> DataFrame:
    """Share of samples whose predicted direction matches the dominant move.

    The predicted direction is up if the expected class of the up head is at
    least that of the down head. ``moves`` is (asset, sample_idx, price_change), the
    asset where the predictions have one.
    """
    index = F.transform(F.col("probs"), lambda p, i: p * i)
    expected = F.aggregate(index, F.lit(0.0), lambda a, v: a + v)
    up = F.sum(F.when(F.col("head") == "up", expected))
    down = F.sum(F.when(F.col("head") == "down", expected))
    keys = sample_keys(predictions)
    side = predictions.groupBy(*keys).agg((up >= down).alias("predicted_up"))
    hit = (F.col("predicted_up") == (F.col("price_change") >= 0)).cast("double")
    return side.join(moves.select(*keys, "price_change"), keys).agg(F.avg(hit).alias("directional_accuracy"), F.count("*").alias("n"))


def temperature_losses(holdout: DataFrame, temperatures: Sequence[float]) -> DataFrame:
    """Mean negative log-likelihood per head and temperature, in one aggregation."""
    grid = F.array(*[F.lit(float(t)) for t in temperatures])
    spread = holdout.select("head", "y_true", "probs", F.explode(grid).alias("temperature"))
    own = F.element_at(temper(F.col("probs"), F.col("temperature")), F.col("y_true") + 1)
    return spread.groupBy("head", "temperature").agg(F.avg(-F.log(own)).alias("nll"))


def fit_temperature(holdout: DataFrame, temperatures: Sequence[float]) -> DataFrame:
    """Temperature with the lowest loss per head; the lowest temperature wins a tie."""
    losses = temperature_losses(holdout, temperatures)
    return losses.groupBy("head").agg(
        F.min(F.struct("nll", "temperature")).alias("b")
    ).select("head", F.col("b.temperature").alias("temperature"), F.col("b.nll").alias("nll"))


def apply_temperature(predictions: DataFrame, fitted: DataFrame) -> DataFrame:
    """Tempered probabilities; the fitted table has one row per head, so two rows."""
    small = F.broadcast(fitted.where(F.col("head").isin(*HEADS)).select("head", "temperature"))
    joined = predictions.join(small, "head")
    return joined.withColumn("probs", temper(F.col("probs"), F.col("temperature"))).drop("temperature")

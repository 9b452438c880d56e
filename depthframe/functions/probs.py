"""Column expressions on a class-probability array."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def argmax(probs: Column | str) -> Column:
    """Index of the largest probability; the lowest index wins a tie."""
    p = F.col(probs) if isinstance(probs, str) else probs
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def squared_error(probs: Column, label: Column) -> Column:
    """Sum over classes of (p - onehot)^2."""
    errors = F.transform(probs, lambda p, i: F.pow(p - F.when(i == label, 1.0).otherwise(0.0), 2.0))
    return F.aggregate(errors, F.lit(0.0), lambda a, e: a + e)


def entropy(probs: Column) -> Column:
    """Natural-log entropy; a zero probability adds nothing."""
    terms = F.transform(probs, lambda p: F.when(p > 0, -p * F.log(p)).otherwise(0.0))
    return F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)


def true_rank(probs: Column, label: Column) -> Column:
    """1 + number of classes with a larger probability than the true class."""
    own = F.element_at(probs, label + 1)
    return (F.size(F.filter(probs, lambda p: p > own)) + 1).cast("int")


def temper(probs: Column, temperature: Column, floor: float = 1e-12) -> Column:
    """softmax(log p / T); probabilities are floored at 1e-12 first."""
    scaled = F.transform(probs, lambda p: F.exp(F.log(F.greatest(p, F.lit(floor))) / temperature))
    total = F.aggregate(scaled, F.lit(0.0), lambda a, e: a + e)
    return F.transform(scaled, lambda e: e / total)

"""Column expressions that turn future moves into classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def magnitude_bin(value: Column, boundaries: Sequence[float] | Sequence[Column]) -> Column:
    """Index of the first boundary that is >= value; past the last one, their count."""
    out: Column | None = None
    for i, b in enumerate(boundaries):
        edge = b if isinstance(b, Column) else F.lit(float(b))
        out = F.when(value <= edge, i) if out is None else out.when(value <= edge, i)
    return out.otherwise(len(boundaries)).cast("int")


def dominant_move(up: Column, down: Column) -> Column:
    """The larger move by size; a tie goes to the upward one."""
    return F.when(F.abs(up) >= F.abs(down), up).otherwise(down)


def signed_class(change: Column, boundaries: Sequence[float]) -> Column:
    """Single-head class: centre for small moves, outward by magnitude bin."""
    centre = len(boundaries)
    size = magnitude_bin(F.abs(change), boundaries)
    return (
        F.when((size == 0) | (change == 0), centre)
        .when(change > 0, centre + size)
        .otherwise(centre - size)
        .cast("int")
    )


def intensity_classes(up: Column, down: Column, boundaries: Sequence[float]) -> tuple[Column, Column]:
    """Two-head classes: bins of the upward and of the downward move, floored at zero."""
    return (
        magnitude_bin(F.greatest(up, F.lit(0.0)), boundaries),
        magnitude_bin(F.greatest(-down, F.lit(0.0)), boundaries),
    )


def signed_percentage_class(change: Column, boundaries: Sequence[Column] | Sequence[float]) -> Column:
    """2(B+1) signed classes, from the largest fall (0) to the largest rise (2B+1)."""
    size = magnitude_bin(F.abs(change), boundaries)
    half = len(boundaries) + 1
    return F.when(change >= 0, half + size).otherwise(half - 1 - size).cast("int")


def one_hot(label: Column | str, num_classes: int) -> Column:
    k = F.col(label) if isinstance(label, str) else label
    return F.array(*[F.when(k == i, 1.0).otherwise(0.0) for i in range(num_classes)])

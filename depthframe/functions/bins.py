"""Equal-width bins whose edges follow ``lo + i * width``, last bin closed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def equal_width_bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """0-based bin of ``x``; NULL outside [lo, hi] or for an empty range.

    The arithmetic guess is corrected against the edges, so a value that equals
    an edge always opens the bin on its right.
    """
    width = (hi - lo) / bins
    guess = F.least(F.floor((x - lo) / width), F.lit(bins - 1)).cast("long")
    moved = (
        F.when(x < lo + guess * width, guess - 1)
        .when((guess < bins - 1) & (x >= lo + (guess + 1) * width), guess + 1)
        .otherwise(guess)
    )
    return F.when((hi > lo) & (x >= lo) & (x <= hi), moved).cast("int")


def unit_edges(bins: int) -> list[float]:
    """``bins + 1`` edges of [0, 1], each a multiple of the bin width."""
    width = 1.0 / bins
    return [i * width for i in range(bins)] + [1.0]


def unit_bin(p: Column, bins: int) -> Column:
    """Bin of a probability against literal edges; NULL outside [0, 1]."""
    edges = unit_edges(bins)
    out = None
    for i in range(bins):
        upper = p <= edges[i + 1] if i == bins - 1 else p < edges[i + 1]
        test = (p >= edges[i]) & upper
        out = F.when(test, i) if out is None else out.when(test, i)
    return out.cast("int")

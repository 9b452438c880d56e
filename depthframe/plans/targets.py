"""Tall rows to a repaired time line to labelled samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthframe.operators.labels import sample_counts, samples
from depthframe.operators.snapshot import snapshots
from depthframe.operators.splits import chronological_split
from depthframe.operators.timeline import check_gaps, fill_gaps, index_snapshots
from depthframe.params import BookParams

BUCKET_STEPS = 4096


def build_line(book: DataFrame, p: BookParams, on_gap: str = "report") -> DataFrame:
    """Gap-repaired snapshot time line.

    A plan only: nothing is written, and no job runs unless ``on_gap="fail"`` asks
    for a stop on a long gap before the repair. Configured assets restrict the
    book here, and nowhere later.
    """
    if p.assets is not None:
        book = book.where(F.col("asset").isin(*p.assets))
    indexed = index_snapshots(snapshots(book), p.cadence_seconds * BUCKET_STEPS)
    if on_gap == "fail":
        check_gaps(indexed, p, "fail")
    return fill_gaps(indexed, p)


def build_targets(book: DataFrame, p: BookParams, on_gap: str = "report") -> DataFrame:
    """Labelled samples with their chronological split."""
    line = build_line(book, p, on_gap)
    return chronological_split(samples(line, p), sample_counts(line, p), p)

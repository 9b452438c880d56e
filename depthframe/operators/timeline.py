"""Time line of snapshots: order, gap checks, gap repair, gap statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depthframe.functions.quotes import FEATURES
from depthframe.operators.window import BEFORE, block_window, dense_index, epoch_seconds, halo, prefix_offsets
from depthframe.params import BookParams

CARRIED = (*FEATURES, "mid")


def index_snapshots(snaps: DataFrame, bucket_seconds: int = 4096) -> DataFrame:
    """Snapshots with a dense ``snap_idx`` per asset in time order; one task numbers ``bucket_seconds`` of an asset."""
    return dense_index(snaps, "snap_idx", bucket_seconds)


def gap_intervals(line: DataFrame, block_rows: int) -> DataFrame:
    """Whole-second differences of consecutive snapshots: (asset, gap_seconds, n)."""
    second = epoch_seconds("ts")
    cells = halo(line.select("asset", "snap_idx", second.alias("_sec")), "snap_idx", 1, 0, block_rows)
    step = F.col("_sec") - F.lag("_sec").over(block_window("snap_idx"))
    steps = cells.select("asset", "_own", step.alias("gap_seconds")).where(F.col("_own") & F.col("gap_seconds").isNotNull())
    return steps.groupBy("asset", "gap_seconds").agg(F.count("*").alias("n"))


def gap_report(line: DataFrame, p: BookParams) -> DataFrame:
    """One row per asset: largest and smallest step and whether the limit holds."""
    return gap_intervals(line, p.block_rows).groupBy("asset").agg(
        F.max("gap_seconds").alias("max_gap_seconds"),
        F.min("gap_seconds").alias("min_gap_seconds"),
        (F.max("gap_seconds") <= p.max_gap_seconds).alias("within_limit"),
    )


def check_gaps(line: DataFrame, p: BookParams, mode: str) -> DataFrame:
    """Gap report of an indexed line; ``mode="fail"`` raises for an asset over the limit."""
    report = gap_report(line, p)
    if mode == "fail":
        bad = report.where(~F.col("within_limit")).take(1)
        if bad:
            raise ValueError(
                f"snapshot gap of {bad[0]['max_gap_seconds']} s for asset {bad[0]['asset']} "
                f"exceeds {p.max_gap_seconds} s"
            )
    elif mode != "report":
        raise ValueError("mode must be 'fail' or 'report'")
    return report


def source_order_report(book: DataFrame, rows_per_group: int = 65536) -> DataFrame:
    """Does ``ts`` rise with ``row_id``? Per asset: smallest step in whole seconds.

    Rows are compared inside ranges of ``row_id``; the border between two ranges
    is checked on the range table, so no task sees a whole asset.
    """
    second = epoch_seconds("ts")
    rows = book.groupBy("asset", "row_id").agg(F.min(second).alias("_lo"), F.max(second).alias("_hi"))
    rows = rows.withColumn("_range", F.floor(F.col("row_id") / rows_per_group))
    inside_w = Window.partitionBy("asset", "_range").orderBy("row_id")
    inside = rows.select("asset", (F.col("_lo") - F.lag("_hi").over(inside_w)).alias("step"))
    ends = rows.groupBy("asset", "_range").agg(
        F.min_by("_lo", "row_id").alias("_first"), F.max_by("_hi", "row_id").alias("_last")
    )
    ends = ends.withColumn("_super", F.floor(F.col("_range") / rows_per_group))
    border_w = Window.partitionBy("asset", "_super").orderBy("_range")
    border = ends.select("asset", (F.col("_first") - F.lag("_last").over(border_w)).alias("step"))
    supers = ends.groupBy("asset", "_super").agg(
        F.min_by("_first", "_range").alias("_first"), F.max_by("_last", "_range").alias("_last")
    )
    top_w = Window.partitionBy("asset").orderBy("_super")
    top = supers.select("asset", (F.col("_first") - F.lag("_last").over(top_w)).alias("step"))
    steps = inside.unionByName(border).unionByName(top)
    return steps.groupBy("asset").agg(
        F.min("step").alias("min_step_seconds"),
        F.coalesce(F.min("step") >= 0, F.lit(True)).alias("monotonic"),
    )


def fill_gaps(indexed: DataFrame, p: BookParams) -> DataFrame:
    """Gap-repaired time line with whole-second timestamps and a new dense index.

    A gap is repaired only if ``cadence < gap <= max_gap``; it then gets
    ``gap // cadence - 1`` rows at multiples of the cadence after its left row.
    Interpolation weights count steps, not seconds. ``skip`` adds no row. The
    rows of a gap are bounded by ``max_gap // cadence``, so the explode is too.
    """
    start = epoch_seconds("ts")
    whole = F.timestamp_seconds(start).cast("timestamp_ntz")
    if p.gap_mode == "skip":
        return indexed.select("asset", "snap_idx", whole.alias("ts"), *CARRIED, F.lit(False).alias("is_filled"))
    cells = halo(indexed, "snap_idx", 0, 1, p.block_rows)
    blended = p.gap_mode == "interpolate"
    ahead = F.struct(start.alias("sec"), *(CARRIED if blended else ()))
    pairs = cells.withColumn("_next", F.lead(ahead).over(block_window("snap_idx"))).where("_own")
    gap, cadence = F.col("_next.sec") - start, F.lit(p.cadence_seconds)
    repairable = (gap > cadence) & (gap <= p.max_gap_seconds)
    missing = F.when(repairable, F.floor(gap / cadence) - 1).otherwise(0).cast("long")
    rows = pairs.withColumn("_missing", missing)
    # a row moves by the rows inserted before it: those of earlier blocks, and those of its own block so far
    inserted = rows.groupBy("asset", "_block").agg(F.sum("_missing").alias("_n"))
    so_far = F.coalesce(F.sum("_missing").over(block_window("snap_idx").rowsBetween(*BEFORE)), F.lit(0))
    rows = rows.withColumn("_moved", so_far).join(prefix_offsets(inserted, "_block", {"_before": "_n"}), ["asset", "_block"])
    rows = rows.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_missing"))))
    k = F.col("_k")
    values = [F.col(c) for c in CARRIED]
    if blended:
        weight = k / (F.col("_missing") + 1).cast("double")
        values = [
            F.when(k == 0, F.col(c)).otherwise((1.0 - weight) * F.col(c) + weight * F.col(f"_next.{c}")).alias(c)
            for c in CARRIED
        ]
    return rows.select(
        "asset",
        (F.col("snap_idx") + F.col("_before") + F.col("_moved") + k).alias("snap_idx"),
        F.timestamp_seconds(start + k * cadence).cast("timestamp_ntz").alias("ts"),
        *values,
        (k > 0).alias("is_filled"),
    )


def gap_statistics(line: DataFrame, p: BookParams, large_multiplier: float, very_large_multiplier: float) -> DataFrame:
    """Largest gap and share of steps above two multiples of the cadence, per asset."""
    n = F.sum("n")

    def share(multiplier: float):
        over = F.when(F.col("gap_seconds") > multiplier * p.cadence_seconds, F.col("n")).otherwise(0)
        return F.sum(over) / n

    return gap_intervals(line, p.block_rows).groupBy("asset").agg(
        F.max("gap_seconds").cast("double").alias("diag_gap_max_seconds"),
        share(large_multiplier).alias("diag_gap_fraction_large"),
        share(very_large_multiplier).alias("diag_gap_fraction_very_large"),
    )

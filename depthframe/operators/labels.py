"""Future moves and class labels of anchors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depthframe.functions.moves import (
    dominant_move,
    intensity_classes,
    magnitude_bin,
    signed_class,
    signed_percentage_class,
)
from depthframe.operators.window import block_window, bounded_broadcast, halo, run_extremes
from depthframe.params import BookParams


def forward_extremes(line: DataFrame, p: BookParams) -> DataFrame:
    """Highest and lowest mid of the next H snapshots, for rows that have H of them.

    One shuffle, and constant work per row for any horizon (see ``run_extremes``).
    """
    h = p.horizon_steps
    blocks = halo(line, "snap_idx", 0, h, p.block_rows).repartition("asset", "_block")
    runs = run_extremes(blocks, "snap_idx", "mid", h)
    w = block_window("snap_idx")
    ahead = runs.withColumns(
        {
            "_h1": F.lead("_rest_hi", 1).over(w),
            "_h2": F.lead("_head_hi", h).over(w),
            "_l1": F.lead("_rest_lo", 1).over(w),
            "_l2": F.lead("_head_lo", h).over(w),
        }
    )
    full = ahead.where(F.col("_own") & F.col("_h2").isNotNull())
    return full.select(
        *line.columns,
        F.greatest("_h1", "_h2").alias("future_high"),
        F.least("_l1", "_l2").alias("future_low"),
    )


def eligible(line: DataFrame, p: BookParams) -> DataFrame:
    """Anchors with a full look-back window and a full horizon, with future moves."""
    t = p.window_steps
    anchors = forward_extremes(line, p).where(F.col("snap_idx") >= t - 1)
    mid = F.col("mid")
    return anchors.select(
        *line.columns,
        (F.col("snap_idx") - (t - 1)).alias("sample_idx"),
        ((F.col("future_high") - mid) / mid * 100.0).alias("max_up_move_pct"),
        ((F.col("future_low") - mid) / mid * 100.0).alias("max_down_move_pct"),
    )


def label(anchors: DataFrame, boundaries: Sequence[float]) -> DataFrame:
    """Dominant move, single-head class and two intensity classes."""
    up, down = F.col("max_up_move_pct"), F.col("max_down_move_pct")
    labelled = anchors.withColumn("price_change", dominant_move(up, down))
    label_up, label_down = intensity_classes(up, down, boundaries)
    return labelled.withColumns(
        {
            "label": signed_class(F.col("price_change"), boundaries),
            "label_up": label_up,
            "label_down": label_down,
        }
    )


def samples(line: DataFrame, p: BookParams) -> DataFrame:
    """Labelled samples of a gap-repaired time line."""
    labelled = label(eligible(line, p), p.boundaries)
    return labelled.withColumn("horizon_seconds", F.lit(p.horizon_seconds).cast("long"))


def sample_counts(line: DataFrame, p: BookParams) -> DataFrame:
    """Number of samples per asset, from the length of the time line alone."""
    spare = p.horizon_steps + p.window_steps - 1
    n = F.greatest(F.max("snap_idx") + 1 - spare, F.lit(0))
    return line.groupBy("asset").agg(n.cast("long").alias("num_samples"))


def class_distribution(samples_: DataFrame, by_split: bool) -> DataFrame:
    """Sample counts per class and head (and split), with a subtotal per head."""
    heads = samples_.select(
        *(["split"] if by_split else []),
        F.explode(
            F.array(
                F.struct(F.lit("up").alias("head"), F.col("label_up").alias("class")),
                F.struct(F.lit("down").alias("head"), F.col("label_down").alias("class")),
            )
        ).alias("h"),
    ).select(*(["split"] if by_split else []), "h.head", "h.class")
    keys = (["split"] if by_split else []) + ["head", "class"]
    return heads.groupBy(*keys).agg(F.count("*").alias("n"))


def class_distribution_rollup(samples_: DataFrame) -> DataFrame:
    """Counts rolled up over (split, head, class); NULL marks a total."""
    counts = class_distribution(samples_, by_split=True)
    return counts.rollup("split", "head", "class").agg(F.sum("n").alias("n"))


def class_weights(train: DataFrame, label_column: str, num_classes: int) -> DataFrame:
    """Balanced weight n / (K * n_c) per asset and class; NULL for an absent class."""
    k = F.col(label_column)
    per_class = [F.count_if(k == i).alias(f"_n{i}") for i in range(num_classes)]
    wide = train.groupBy("asset").agg(F.count("*").alias("_n"), *per_class)
    cells = [F.struct(F.lit(i).alias("class"), F.col(f"_n{i}").alias("n")) for i in range(num_classes)]
    long = wide.select("asset", "_n", F.explode(F.array(*cells)).alias("c"))
    weight = F.when(F.col("c.n") > 0, F.col("_n") / (num_classes * F.col("c.n")).cast("double"))
    return long.select("asset", "c.class", "c.n", weight.alias("weight"))


def with_class_weight(
    samples_: DataFrame, weights: DataFrame, label_column: str, num_classes: int, assets: Sequence[str] | None
) -> DataFrame:
    """Attach the weight of each sample's class (the table has K rows per asset)."""
    table = weights.select("asset", F.col("class").alias(label_column), F.col("weight").alias("class_weight"))
    return samples_.join(bounded_broadcast(table, assets, num_classes), ["asset", label_column], "left")


def signed_percentage_labels(
    samples_: DataFrame, bounds: DataFrame, num_boundaries: int, assets: Sequence[str] | None
) -> DataFrame:
    """Signed 2(B+1)-class label with boundaries per asset.

    ``bounds`` has one row per asset: (asset, boundaries array<double>).
    """
    table = bounded_broadcast(bounds.select("asset", F.col("boundaries").alias("_b")), assets)
    joined = samples_.join(table, "asset")
    edges = [F.col("_b")[i] for i in range(num_boundaries)]
    return joined.withColumn("label_signed", signed_percentage_class(F.col("price_change"), edges)).drop("_b")


def absolute_labels(line: DataFrame, p: BookParams, boundaries: Sequence[float]) -> DataFrame:
    """Two-head classes of price differences (not percent) over the horizon."""
    anchors = forward_extremes(line, p).where(F.col("snap_idx") >= p.window_steps - 1)
    up = F.col("future_high") - F.col("mid")
    down = F.col("future_low") - F.col("mid")
    label_up, label_down = intensity_classes(up, down, boundaries)
    return anchors.select("asset", "snap_idx", up.alias("up"), down.alias("down"), label_up.alias("label_up"), label_down.alias("label_down"))


def adaptive_labels(samples_: DataFrame, volatility: DataFrame, boundaries: Sequence[float], floor: float) -> DataFrame:
    """Two-head classes with boundaries scaled by each snapshot's volatility.

    ``volatility`` is (asset, snap_idx, vol_norm); the scale is
    ``floor + vol_norm``, with ``floor`` alone where it is not defined.
    """
    scale: Column = F.lit(float(floor)) + F.coalesce(F.col("vol_norm"), F.lit(0.0))
    joined = samples_.join(volatility.select("asset", "snap_idx", "vol_norm"), ["asset", "snap_idx"], "left")
    edges = [scale * float(b) for b in boundaries]
    up = F.greatest(F.col("max_up_move_pct"), F.lit(0.0))
    down = F.greatest(-F.col("max_down_move_pct"), F.lit(0.0))
    return joined.withColumns(
        {"label_up_adaptive": magnitude_bin(up, edges), "label_down_adaptive": magnitude_bin(down, edges)}
    )

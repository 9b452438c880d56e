"""Data-quality profile of training snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthframe.functions.bins import equal_width_bin
from depthframe.functions.quotes import (
    FEATURES,
    FLAGS,
    anomaly_type,
    any_severe,
    both_prices_positive,
    boundary_levels,
    clip,
    mid_price,
    pct_change,
    quality_flags,
    relative_spread,
    spread_pct,
)
from depthframe.operators.splits import random_sample, uniform_sample
from depthframe.operators.timeline import gap_statistics
from depthframe.operators.window import bounded_broadcast, epoch_micros, epoch_seconds, with_scalars
from depthframe.params import BookParams, ProfileParams

RECORD_COLUMNS = (
    "sample_idx",
    "ts",
    "label",
    "bid_price",
    "ask_price",
    "bid_quantity",
    "ask_quantity",
    "mid_price",
    "spread_pct",
)


def sample_rows(train: DataFrame, counts: DataFrame, q: ProfileParams, assets: Sequence[str] | None) -> DataFrame:
    """All training rows, or a sample where one is asked for; ``counts`` is (asset, n) of the training split."""
    if q.num_samples is None:
        return train
    if q.sample_method == "uniform":
        return uniform_sample(train, counts, "sample_idx", q.num_samples, assets)
    return random_sample(train, "sample_idx", q.num_samples, q.seed, assets)


def records(rows: DataFrame, q: ProfileParams) -> DataFrame:
    """Mid, spread and eight quality flags of each row."""
    valid = both_prices_positive()
    return rows.withColumns(
        {
            "mid_price": F.when(valid, mid_price()),
            "spread_pct": spread_pct(),
            "valid_spread": valid,
            **quality_flags(q.high_spread_pct),
        }
    )


def _share(test: Column) -> Column:
    return F.avg(test.cast("double"))


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


# The metric names below are the report's contract.
def _quote_metrics() -> dict[str, Column]:
    out = {}
    for c in FEATURES:
        out[f"diag_{c}_min"] = F.min(c)
        out[f"diag_{c}_max"] = F.max(c)
        out[f"diag_{c}_mean"] = F.avg(c)
        out[f"diag_{c}_std"] = F.stddev_pop(c)
    return out


def _spread_metrics(q: ProfileParams) -> dict[str, Column]:
    s = F.col("spread_pct")
    return {
        "diag_spread_mean_pct": _or_zero(F.avg(s)),
        "diag_spread_std_pct": _or_zero(F.stddev_pop(s)),
        "diag_spread_max_pct": _or_zero(F.max(s)),
        "diag_spread_fraction_gt_threshold": _or_zero(_share(s > q.suspicious_pct)),
        "diag_spread_fraction_high": _or_zero(_share(s > q.high_spread_pct)),
        "diag_spread_high_allowed_fraction": F.max(F.lit(q.max_high_spread_fraction)),
    }


def _mid_metrics() -> dict[str, Column]:
    ok = F.col("valid_spread")
    points = _or_zero(F.avg(F.when(ok, mid_price())))
    means = _or_zero(0.5 * (F.avg(F.when(ok, F.col("bid_price"))) + F.avg(F.when(ok, F.col("ask_price")))))
    return {
        "diag_mid_mean_price": points,
        "diag_mid_mean_vs_bidask_means_rel_diff": F.when(points != 0, F.abs(points - means) / F.abs(points)).otherwise(0.0),
    }


def _per_asset(recs: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    return recs.groupBy("asset").agg(*[value.alias(name) for name, value in metrics.items()])


def describe(recs: DataFrame) -> DataFrame:
    """Minimum, maximum, mean and population deviation of the four quote columns, per asset."""
    return _per_asset(recs, _quote_metrics())


def spread_statistics(recs: DataFrame, q: ProfileParams) -> DataFrame:
    """Spread mean, deviation, maximum and shares above two thresholds; 0 without valid spreads."""
    return _per_asset(recs, _spread_metrics(q))


def mid_consistency(recs: DataFrame) -> DataFrame:
    """Mean of mids against the mid of the mean prices, over rows with a valid spread."""
    return _per_asset(recs, _mid_metrics())


def outlier_percent(recs: DataFrame, q: ProfileParams, assets: Sequence[str] | None) -> DataFrame:
    """Percent of positive prices beyond the z-score threshold, per side.

    0 with fewer than ``min_points`` positive prices or without deviation.
    """
    sides = ("bid_price", "ask_price")
    positive = {c: F.when(F.col(c) > 0, F.col(c)) for c in sides}
    stats = recs.groupBy("asset").agg(
        *[f for c in sides for f in (
            F.count(positive[c]).alias(f"_n_{c}"),
            F.avg(positive[c]).alias(f"_m_{c}"),
            F.stddev_pop(positive[c]).alias(f"_s_{c}"),
        )]
    )
    joined = with_scalars(recs.select("asset", *sides), stats, assets)
    aggs = []
    for c in sides:
        usable = (F.col(c) > 0) & (F.col(f"_n_{c}") >= q.min_points) & (F.col(f"_s_{c}") > 0)
        z = F.when(usable, F.abs((F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")))
        aggs.append(_or_zero(_share(z > q.z_threshold) * 100.0).alias(f"diag_{c}_outliers_percent"))
    return joined.groupBy("asset").agg(*aggs)


def flag_fractions(recs: DataFrame) -> DataFrame:
    """Share of records with each quality flag, per asset."""
    return recs.groupBy("asset").agg(*[_share(F.col(f)).alias(f"diag_{f}_fraction") for f in FLAGS])


def nonzero_counts(recs: DataFrame) -> DataFrame:
    return recs.groupBy("asset").agg(
        *[F.count_if(F.col(c) > 0).alias(f"diag_{c}_nonzero_count") for c in ("bid_price", "ask_price")]
    )


def _long(wide: DataFrame) -> DataFrame:
    names = [c for c in wide.columns if c != "asset"]
    cells = [F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]
    return wide.select("asset", F.explode(F.array(*cells)).alias("m")).select("asset", "m.*")


def profile(recs: DataFrame, line: DataFrame, p: BookParams, q: ProfileParams) -> DataFrame:
    """All profile metrics in long form: (asset, metric, value).

    The single-pass metrics share one aggregation; only outliers (two passes)
    and gap statistics (another input) are separate.
    """
    aggs = {**_quote_metrics(), **_spread_metrics(q), **_mid_metrics()}
    for c in ("bid_price", "ask_price"):
        aggs[f"diag_{c}_nonzero_count"] = F.count_if(F.col(c) > 0).cast("double")
    wanted = ["inverted_spread", "high_spread"]
    if q.negative_checks:
        wanted += ["negative_price", "negative_quantity"]
    if q.zero_stats:
        wanted += [f for f in FLAGS if f.startswith("zero_")]
    for f in wanted:
        aggs[f"diag_{f}_fraction"] = _share(F.col(f))
    report = _long(_per_asset(recs, aggs))
    if q.outlier_checks:
        report = report.unionByName(_long(outlier_percent(recs, q, p.assets)))
    if q.gap_checks:
        gaps = gap_statistics(line, p, q.large_gap_multiplier, q.very_large_gap_multiplier)
        report = report.unionByName(_long(gaps))
    return report


def clip_limits(recs: DataFrame, sigmas: float) -> DataFrame:
    """Per-asset clip range mean +- sigmas * deviation; NULL without deviation."""
    mean, deviation = F.avg("spread_pct"), F.stddev_pop("spread_pct")
    return recs.groupBy("asset").agg(
        F.when(deviation > 0, mean - sigmas * deviation).alias("clip_low"),
        F.when(deviation > 0, mean + sigmas * deviation).alias("clip_high"),
    )


def plot_series(recs: DataFrame, sigmas: float, assets: Sequence[str] | None) -> DataFrame:
    """Time-series view: seconds since the first record, clipped and relative spread, price change vs mean mid."""
    base = recs.groupBy("asset").agg(
        F.min("ts").alias("_base"), F.avg(F.when(F.col("valid_spread"), F.col("mid_price"))).alias("_ref")
    )
    joined = with_scalars(recs, base.join(clip_limits(recs, sigmas), "asset"), assets)
    clipped = clip("spread_pct", F.col("clip_low"), F.col("clip_high"))
    elapsed = F.floor((epoch_micros("ts") - epoch_micros("_base")) / 1_000_000)
    return joined.select(
        *recs.columns,
        elapsed.cast("long").alias("elapsed_seconds"),
        clipped.alias("spread_clipped"),
        relative_spread(clipped).alias("relative_spread"),
        F.when(F.col("_ref") > 0, pct_change("mid_price", F.col("_ref"))).alias("mid_change_pct"),
    )


def price_histogram(recs: DataFrame, bins: int, assets: Sequence[str] | None) -> DataFrame:
    """Equal-width histogram of positive bid and ask prices per asset, zero bins included."""
    sides = recs.select(
        "asset",
        F.explode(
            F.array(
                F.struct(F.lit("bid").alias("side"), F.col("bid_price").alias("price")),
                F.struct(F.lit("ask").alias("side"), F.col("ask_price").alias("price")),
            )
        ).alias("q"),
    ).select("asset", "q.side", "q.price").where(F.col("price") > 0)
    # a side with one distinct price gets the range price +- 0.5
    lo, hi = F.min("price"), F.max("price")
    spans = sides.groupBy("asset", "side").agg(
        F.when(lo == hi, lo - 0.5).otherwise(lo).alias("lo"), F.when(lo == hi, hi + 0.5).otherwise(hi).alias("hi")
    )
    joined = sides.join(bounded_broadcast(spans, assets, 2), ["asset", "side"])
    binned = joined.withColumn("bin", equal_width_bin(F.col("price"), F.col("lo"), F.col("hi"), bins))
    counts = binned.groupBy("asset", "side", "bin").agg(F.count("*").alias("n"))
    grid = spans.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counts, ["asset", "side", "bin"], "left").select(
        "asset",
        "side",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("left_edge"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def _spread_range(series: DataFrame) -> DataFrame:
    return series.groupBy("asset").agg(
        F.min("elapsed_seconds").cast("double").alias("t_lo"),
        F.max("elapsed_seconds").cast("double").alias("t_hi"),
        F.min("spread_clipped").alias("s_lo"),
        F.max("spread_clipped").alias("s_hi"),
    )


def spread_time_histogram(series: DataFrame, time_bins: int, spread_bins: int, assets: Sequence[str] | None) -> DataFrame:
    """Counts over time x clipped spread; only for assets where both ranges are positive."""
    valid = series.where(F.col("spread_clipped").isNotNull())
    spans = _spread_range(valid).where((F.col("t_hi") > F.col("t_lo")) & (F.col("s_hi") > F.col("s_lo")))
    joined = valid.select("asset", "elapsed_seconds", "spread_clipped").join(bounded_broadcast(spans, assets), "asset")
    t = equal_width_bin(F.col("elapsed_seconds").cast("double"), F.col("t_lo"), F.col("t_hi"), time_bins)
    s = equal_width_bin(F.col("spread_clipped"), F.col("s_lo"), F.col("s_hi"), spread_bins)
    return joined.groupBy("asset", t.alias("time_bin"), s.alias("spread_bin")).agg(F.count("*").alias("n"))


def spread_label_histogram(series: DataFrame, label_bins: int, spread_bins: int, assets: Sequence[str] | None) -> DataFrame:
    """Counts over label x clipped spread; labels outside 0..label_bins-1 are not counted."""
    valid = series.where(F.col("spread_clipped").isNotNull())
    spans = _spread_range(valid).where(F.col("s_hi") > F.col("s_lo")).select("asset", "s_lo", "s_hi")
    joined = valid.select("asset", "label", "spread_clipped").join(bounded_broadcast(spans, assets), "asset")
    s = equal_width_bin(F.col("spread_clipped"), F.col("s_lo"), F.col("s_hi"), spread_bins)
    inside = joined.where(F.col("label").between(0, label_bins - 1))
    return inside.groupBy("asset", "label", s.alias("spread_bin")).agg(F.count("*").alias("n"))


def depth_quotes(book: DataFrame, series: DataFrame, per_asset: int | None, assets: Sequence[str] | None) -> DataFrame:
    """Bid and ask quotes at the times of the series: (asset, elapsed_seconds, price, quantity).

    The book is tall. A series of at most ``per_asset`` sampled rows per asset is
    broadcast where that is small, so the book is filtered where it is read;
    a whole series (None) meets it in a plain join.
    """
    second = epoch_seconds("ts")
    times = series.select("asset", F.col("ts").alias("_ts"), "elapsed_seconds").distinct()
    rows = book.where(F.col("ts") == F.timestamp_seconds(second).cast("timestamp_ntz"))
    times = times.withColumnRenamed("_ts", "ts")
    hits = rows.join(times if per_asset is None else bounded_broadcast(times, assets, per_asset), ["asset", "ts"])
    sides = F.array(
        F.struct(F.col("bid_price").alias("price"), F.col("bid_quantity").alias("quantity")),
        F.struct(F.col("ask_price").alias("price"), F.col("ask_quantity").alias("quantity")),
    )
    quotes = hits.select("asset", "elapsed_seconds", F.explode(sides).alias("q"))
    return quotes.select("asset", "elapsed_seconds", "q.price", "q.quantity").where(
        (F.col("price") > 0) & (F.col("quantity") > 0)
    )


def depth_heatmap(
    book: DataFrame, series: DataFrame, per_asset: int | None, time_bins: int, price_bins: int, assets: Sequence[str] | None
) -> DataFrame:
    """Quoted quantity over time x price at the times of the series."""
    quotes = depth_quotes(book, series, per_asset, assets)
    points = quotes.groupBy("asset", "elapsed_seconds", "price").agg(F.sum("quantity").alias("quantity"))
    spans = points.groupBy("asset").agg(
        F.min("elapsed_seconds").cast("double").alias("t_lo"),
        F.max("elapsed_seconds").cast("double").alias("t_hi"),
        F.min("price").alias("p_lo"),
        F.max("price").alias("p_hi"),
    )
    spans = spans.where((F.col("t_hi") > F.col("t_lo")) & (F.col("p_hi") > F.col("p_lo")))
    joined = points.join(bounded_broadcast(spans, assets), "asset")
    t = equal_width_bin(F.col("elapsed_seconds").cast("double"), F.col("t_lo"), F.col("t_hi"), time_bins)
    b = equal_width_bin(F.col("price"), F.col("p_lo"), F.col("p_hi"), price_bins)
    return joined.groupBy("asset", t.alias("time_bin"), b.alias("price_bin")).agg(F.sum("quantity").alias("volume"))


def anomalies(recs: DataFrame, limit: int | None = None) -> DataFrame:
    """Records with a severe flag; with a ``limit``, the first of each asset in sample order.

    The rank is cut at the limit, which Spark also applies before the shuffle.
    """
    bad = recs.where(any_severe()).withColumn("anomaly_type", anomaly_type())
    if limit is None:
        return bad.select("asset", *RECORD_COLUMNS, "anomaly_type")
    rank = F.row_number().over(Window.partitionBy("asset").orderBy("sample_idx"))
    first = bad.withColumn("_rank", rank).where(F.col("_rank") <= limit)
    return first.select("asset", *RECORD_COLUMNS, "anomaly_type")


def label_check_anchors(train: DataFrame, line_lengths: DataFrame, p: BookParams, q: ProfileParams) -> DataFrame:
    """Seeded pick of anchors with T rows before and H rows after; ``line_lengths`` is (asset, n_line)."""
    joined = with_scalars(train, line_lengths, p.assets)
    i = F.col("snap_idx")
    ok = (i >= p.window_steps) & (i + p.horizon_steps < F.col("n_line")) & (F.col("mid") > 0)
    valid = joined.where(ok).select(*train.columns)
    return random_sample(valid, "sample_idx", q.label_examples, q.seed, p.assets)


def neighbourhood(
    line: DataFrame, anchors: DataFrame, per_asset: int, before: int, after: int, assets: Sequence[str] | None
) -> DataFrame:
    """Mid path of ``before`` rows back to ``after`` rows ahead of each anchor.

    Each anchor (at most ``per_asset`` per asset) lists its before + after + 1
    positions, which meet the line in an equi join.
    """
    spots = anchors.select(
        "asset",
        F.col("snap_idx").alias("anchor_idx"),
        F.col("ts").alias("anchor_ts"),
        F.col("mid").alias("anchor_mid"),
        F.explode(F.sequence(F.col("snap_idx") - before, F.col("snap_idx") + after)).alias("snap_idx"),
    )
    spots = bounded_broadcast(spots, assets, per_asset * (before + after + 1))
    hits = line.select("asset", "snap_idx", "ts", "mid").join(spots, ["asset", "snap_idx"])
    offset = (epoch_micros("ts") - epoch_micros("anchor_ts")) / 1e6
    return hits.select(
        "asset", "anchor_idx", "snap_idx", offset.alias("offset_seconds"), "mid", pct_change("mid", "anchor_mid").alias("change_pct")
    )


def label_check_levels(anchors: DataFrame, p: BookParams) -> DataFrame:
    """Boundary price levels and the time box of each anchor."""
    levels = anchors.select(
        "asset",
        F.col("snap_idx").alias("anchor_idx"),
        F.posexplode(boundary_levels("mid", p.boundaries)).alias("boundary", "level"),
    )
    return levels.withColumns({"box_start": F.lit(0.0), "box_end": F.lit(float(p.horizon_seconds))})


def label_range(samples: DataFrame, num_classes: int) -> DataFrame:
    """Smallest and largest label per head and the number outside 0..K-1."""
    aggs = []
    for head in ("up", "down"):
        c = F.col(f"label_{head}")
        aggs += [
            F.min(c).alias(f"{head}_min"),
            F.max(c).alias(f"{head}_max"),
            F.count_if((c < 0) | (c >= num_classes)).alias(f"{head}_outside"),
        ]
    return samples.agg(*aggs)


def check_labels(samples: DataFrame, num_classes: int) -> None:
    """Raise if a label lies outside 0..K-1."""
    row = label_range(samples, num_classes).first()
    if row["up_outside"] or row["down_outside"]:
        raise ValueError(f"labels outside 0..{num_classes - 1}: {row.asDict()}")


def quality_filter(rows: DataFrame, checks: Sequence[str], high_spread_pct: float) -> DataFrame:
    """Drop snapshots that fail any named quality flag."""
    flags = quality_flags(high_spread_pct)
    unknown = [c for c in checks if c not in flags]
    if unknown:
        raise ValueError(f"unknown checks {unknown}")
    keep = F.lit(True)
    for c in checks:
        keep = keep & ~flags[c]
    return rows.where(keep)


def price_sanity_filter(rows: DataFrame, z_threshold: float, assets: Sequence[str] | None) -> DataFrame:
    """Drop snapshots whose mid lies beyond the z-score threshold of its asset."""
    stats = rows.groupBy("asset").agg(F.avg("mid").alias("_m"), F.stddev_pop("mid").alias("_s"))
    joined = with_scalars(rows, stats, assets)
    far = F.abs(F.col("mid") - F.col("_m")) > z_threshold * F.col("_s")
    return joined.where(~far).drop("_m", "_s")

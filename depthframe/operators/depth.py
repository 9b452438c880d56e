"""Price levels below the top of the book: ranks, cumulative depth, compression, grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depthframe.functions.quotes import imbalance, valid_ask, valid_bid
from depthframe.operators.window import banded_sums

SIDE_KEYS = ["asset", "ts", "side"]
LEVEL_FEATURES = ("price", "quantity", "price_delta_mid", "cumulative_qty", "relative_depth")


def price_levels(book: DataFrame) -> DataFrame:
    """Distinct valid prices per (asset, ts, side) with their summed quantity.

    Rows that share a price are one level; the sum is pre-aggregated before the
    shuffle, so repeated rows of a hot snapshot never travel.
    """
    sides = F.array(
        F.when(valid_bid(), F.struct(F.lit("bid").alias("side"), F.col("bid_price").alias("price"), F.col("bid_quantity").alias("quantity"))),
        F.when(valid_ask(), F.struct(F.lit("ask").alias("side"), F.col("ask_price").alias("price"), F.col("ask_quantity").alias("quantity"))),
    )
    quotes = book.select("asset", "ts", F.explode(sides).alias("q")).where(F.col("q").isNotNull())
    quotes = quotes.select("asset", "ts", "q.side", "q.price", "q.quantity")
    return quotes.groupBy("ts", "asset", "side", "price").agg(F.sum("quantity").alias("quantity"))


def ranked_levels(levels: DataFrame) -> DataFrame:
    """Level rank (1 = best), cumulative quantity up to and including the level, side total.

    Ranks run through price bands of the snapshot side, so a snapshot with very
    many prices is spread over its bands.
    """
    keyed = levels.withColumn("_o", F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price")))
    outs = {"_rank": None, "_before": F.col("quantity")}
    ranked = banded_sums(keyed, SIDE_KEYS, "_o", outs, {"_before": "side_total"})
    return ranked.select(
        *SIDE_KEYS,
        "price",
        "quantity",
        (F.col("_rank") + 1).alias("level"),
        (F.col("_before") + F.col("quantity")).alias("cumulative_qty"),
        "side_total",
    )


def relative_depth(ranked: DataFrame) -> DataFrame:
    """Cumulative quantity as a share of the side's total."""
    share = F.when(F.col("side_total") != 0, F.col("cumulative_qty") / F.col("side_total"))
    return ranked.withColumn("relative_depth", share).drop("side_total")


def level_features(ranked: DataFrame) -> DataFrame:
    """Per-level price, quantity, distance to mid, cumulative quantity and relative depth."""
    best = ranked.groupBy("asset", "ts").agg(
        F.max(F.when(F.col("side") == "bid", F.col("price"))).alias("_bid"),
        F.min(F.when(F.col("side") == "ask", F.col("price"))).alias("_ask"),
    )
    mids = best.select("asset", "ts", (F.lit(0.5) * (F.col("_bid") + F.col("_ask"))).alias("_mid"))
    mids = mids.where(F.col("_mid").isNotNull())
    joined = relative_depth(ranked).join(mids, ["asset", "ts"])
    return joined.withColumn("price_delta_mid", F.col("price") - F.col("_mid")).drop("_mid")


def useful_levels(ranked: DataFrame, min_nonzero: int) -> DataFrame:
    """Levels with at least ``min_nonzero`` observations of a positive quantity."""
    counts = ranked.groupBy("asset", "side", "level").agg(F.count_if(F.col("quantity") > 0).alias("nonzero"))
    return counts.where(F.col("nonzero") >= min_nonzero)


def adaptive_depth(ranked: DataFrame, min_nonzero: int) -> DataFrame:
    """Drop levels that are rarely used."""
    keep = useful_levels(ranked, min_nonzero).select("asset", "side", "level")
    return ranked.join(keep, ["asset", "side", "level"], "left_semi")


def depth_bin(near: int, bins: int, width: int) -> Column:
    """Own bin for the ``near`` best levels, then ``bins`` bins of ``width`` levels; the last takes the rest."""
    deep = F.ceil((F.col("level") - near) / width)
    return F.when(F.col("level") <= near, F.col("level")).otherwise(near + F.least(deep, F.lit(bins))).cast("long")


def compress_depth(ranked: DataFrame, near: int, bins: int, width: int) -> DataFrame:
    """Full resolution near the market, aggregated bins below it.

    A bin has the summed quantity and the quantity-weighted price (the plain
    mean where the quantity is zero).
    """
    binned = ranked.withColumn("bin", depth_bin(near, bins, width))
    sums = binned.groupBy(*SIDE_KEYS, "bin").agg(
        F.sum("quantity").alias("quantity"),
        F.sum(F.col("price") * F.col("quantity")).alias("_pq"),
        F.avg("price").alias("_p"),
        F.count("*").alias("levels"),
    )
    price = F.when(F.col("quantity") > 0, F.col("_pq") / F.col("quantity")).otherwise(F.col("_p"))
    return sums.select(*SIDE_KEYS, "bin", price.alias("price"), "quantity", "levels")


def compression_report(ranked: DataFrame, near: int, bins: int, width: int) -> DataFrame:
    """Levels before and after compression and their ratio, per asset.

    Both counts come from one aggregation of the levels.
    """
    compressed = compress_depth(ranked, near, bins, width)
    counts = compressed.groupBy("asset").agg(F.sum("levels").alias("levels_before"), F.count("*").alias("levels_after"))
    return counts.withColumn("ratio", F.col("levels_before") / F.col("levels_after"))


def depth_imbalance(ranked: DataFrame, max_level: int) -> DataFrame:
    """Imbalance of the summed quantities of the best ``max_level`` levels per side."""
    top = ranked.where(F.col("level") <= max_level)
    sums = top.groupBy("asset", "ts").agg(
        F.sum(F.when(F.col("side") == "bid", F.col("quantity")).otherwise(0.0)).alias("bid_depth"),
        F.sum(F.when(F.col("side") == "ask", F.col("quantity")).otherwise(0.0)).alias("ask_depth"),
    )
    return sums.withColumn("depth_imbalance", imbalance("bid_depth", "ask_depth"))


def feature_grid(
    features: DataFrame, levels: int, chosen: Sequence[str], min_height: int, min_width: int
) -> DataFrame:
    """Flat levels x (side x feature) grid per snapshot, row by row, zero where missing.

    Each row of the grid is one level: the chosen bid features, then the ask
    features. The grid grows with zeros to the minimum height and width.
    """
    unknown = [c for c in chosen if c not in LEVEL_FEATURES]
    if unknown:
        raise ValueError(f"unknown level features {unknown}")
    height, width = max(levels, min_height), max(2 * len(chosen), min_width)
    top = features.where(F.col("level") <= levels)
    aggs = []
    for level in range(1, levels + 1):
        for side in ("bid", "ask"):
            here = (F.col("level") == level) & (F.col("side") == side)
            aggs += [F.max(F.when(here, F.col(c))).alias(f"_{level}_{side}_{c}") for c in chosen]
    wide = top.groupBy("asset", "ts").agg(*aggs)
    cells = []
    for level in range(1, height + 1):
        row = [f"_{level}_{side}_{c}" for side in ("bid", "ask") for c in chosen] if level <= levels else []
        cells += [F.coalesce(F.col(c), F.lit(0.0)) for c in row] + [F.lit(0.0)] * (width - len(row))
    return wide.select("asset", "ts", F.array(*cells).alias("grid"))


def depth_profile(features: DataFrame) -> DataFrame:
    """Mean quantity, cumulative quantity and relative depth per (asset, side, level)."""
    return features.groupBy("asset", "side", "level").agg(
        F.count("*").alias("n"),
        F.avg("quantity").alias("mean_quantity"),
        F.avg("cumulative_qty").alias("mean_cumulative_qty"),
        F.avg("relative_depth").alias("mean_relative_depth"),
    )

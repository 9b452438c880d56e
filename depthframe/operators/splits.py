"""Splits, samples and sample weights."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthframe.operators.window import with_scalars
from depthframe.params import BookParams

SPLITS = ("train", "validation", "test")


def split_sizes(counts: DataFrame, p: BookParams) -> DataFrame:
    """Ends of the train and validation ranges per asset; sizes truncate, test takes the rest."""
    n = F.col("num_samples")
    train = (n * F.lit(p.train_ratio)).cast("long")
    validation = (n * F.lit(p.validation_ratio)).cast("long")
    return counts.select(
        "asset",
        "num_samples",
        train.alias("train_end"),
        F.least(train + validation, n).alias("validation_end"),
    )


def chronological_split(samples: DataFrame, counts: DataFrame, p: BookParams) -> DataFrame:
    """Add ``split`` and the position inside it (``split_idx``)."""
    joined = with_scalars(samples, split_sizes(counts, p), p.assets)
    i = F.col("sample_idx")
    in_train, in_validation = i < F.col("train_end"), i < F.col("validation_end")
    start = F.when(in_train, 0).when(in_validation, F.col("train_end")).otherwise(F.col("validation_end"))
    name = F.when(in_train, SPLITS[0]).when(in_validation, SPLITS[1]).otherwise(SPLITS[2])
    return joined.select(*samples.columns, name.alias("split"), (i - start).cast("long").alias("split_idx"))


def head_cap(rows: DataFrame, cap: int) -> DataFrame:
    """First ``cap`` training rows, by position: a documented bound on what a classifier is fitted to.

    Validation and test rows all stay.
    """
    return rows.where((F.col("split") != SPLITS[0]) | (F.col("split_idx") < cap))


def uniform_sample(rows: DataFrame, counts: DataFrame, index: str, m: int, assets: Sequence[str] | None) -> DataFrame:
    """``m`` evenly spaced rows per asset by dense ``index``, both ends included.

    ``counts`` is (asset, n). Position k is floor(k * (n-1)/(m-1)), the last one
    n-1; all rows are kept when m >= n. Each row tests by arithmetic whether it
    is one of the positions, so the sample is a narrow filter.
    """
    joined = with_scalars(rows, counts.select("asset", F.col("n").alias("_n")), assets)
    i, n = F.col(index), F.col("_n")
    if m == 1:
        chosen = i == 0
    else:
        step = (n - 1) / F.lit(float(m - 1))
        near = F.ceil(i / step)
        chosen = i == n - 1
        for k in (near - 1, near, near + 1):
            chosen = chosen | (k.between(0, m - 2) & (F.floor(k * step) == i))
    # the step is only evaluated for assets with more than m rows, where it exceeds 1
    return joined.where(F.when(n <= m, F.lit(True)).otherwise(chosen)).drop("_n")


def digest(seed: int, index: Column) -> Column:
    """Reproducible pseudo-random order of rows, another one for each asset."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), "asset", index.cast("string")).cast("binary"))


def digest_fraction(seed: int, index: Column) -> Column:
    """Digest as a number in [0, 1) (first 8 hex digits)."""
    return F.conv(F.substring(digest(seed, index), 1, 8), 16, 10).cast("double") / 4294967296.0


def random_sample(rows: DataFrame, index: str, m: int, seed: int, assets: Sequence[str] | None) -> DataFrame:
    """``m`` rows per asset without replacement: the smallest digests of (seed, asset, index).

    A count per digest prefix (pre-aggregated, at most 65,536 per asset) gives
    the prefix at which m rows are reached; only rows up to it are ranked, about
    m plus 1/65,536 of the asset.
    """
    prefixed = rows.withColumn("_digest", digest(seed, F.col(index))).withColumn("_prefix", F.substring("_digest", 1, 4))
    per_prefix = prefixed.groupBy("asset", "_prefix").agg(F.count("*").alias("_n"))
    running = F.sum("_n").over(Window.partitionBy("asset").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1))
    needed = per_prefix.withColumn("_seen", F.coalesce(running, F.lit(0))).where(F.col("_seen") < m)
    cut = needed.groupBy("asset").agg(F.max("_prefix").alias("_cut"))
    near = with_scalars(prefixed, cut, assets).where(F.col("_prefix") <= F.col("_cut"))
    rank = F.row_number().over(Window.partitionBy("asset").orderBy("_digest", index))
    return near.withColumn("_rank", rank).where(F.col("_rank") <= m).select(*rows.columns)


def hash_fraction_sample(rows: DataFrame, index: str, fraction: float, seed: int) -> DataFrame:
    """Rows whose digest falls below ``fraction``: a narrow filter, stable across runs."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie in [0, 1]")
    return rows.where(digest_fraction(seed, F.col(index)) < fraction)


def rebalance(
    rows: DataFrame, class_column: str, factors: Mapping[int, float], index: str, seed: int
) -> DataFrame:
    """Repeat or thin the rows of each class by its factor; adds ``copy``.

    A factor f gives floor(f) copies of a row and one more for the share
    ``f - floor(f)`` of rows with the smallest digests. Classes without a factor
    are kept once.
    """
    factor = F.lit(1.0)
    for k, f in factors.items():
        if f < 0:
            raise ValueError("factors must not be negative")
        factor = F.when(F.col(class_column) == k, float(f)).otherwise(factor)
    whole = F.floor(factor)
    extra = F.when(digest_fraction(seed, F.col(index)) < factor - whole, 1).otherwise(0)
    copies = (whole + extra).cast("int")
    return rows.withColumn("_copies", copies).where(F.col("_copies") > 0).select(
        *rows.columns, F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy")
    )


def balance_factors(distribution: Mapping[int, int], method: str) -> dict[int, float]:
    """Factors that bring every class to the smallest or the largest class size."""
    present = {k: n for k, n in distribution.items() if n > 0}
    if method == "undersampling":
        goal = min(present.values())
    elif method == "oversampling":
        goal = max(present.values())
    else:
        raise ValueError("method must be 'undersampling' or 'oversampling'")
    return {k: goal / n for k, n in present.items()}


def expanding_folds(samples: DataFrame, initial_days: int, validation_days: int, folds: int, assets: Sequence[str] | None) -> DataFrame:
    """(fold, role) per sample: train from the start, validate on the next span.

    Fold f trains on the first ``initial_days + f * validation_days`` days of an
    asset and validates on the following ``validation_days``. The fold list is a
    parameter, so each row makes its own at most ``folds`` assignments.
    """
    start = samples.groupBy("asset").agg(F.min("ts").cast("date").alias("_start"))
    joined = with_scalars(samples, start, assets)
    day = F.datediff(F.col("ts").cast("date"), F.col("_start"))
    roles = []
    for f in range(folds):
        train_end = initial_days + f * validation_days
        role = F.when(day < train_end, "train").when(day < train_end + validation_days, "validation")
        roles.append(F.struct(F.lit(f).alias("fold"), role.alias("role")))
    assigned = joined.withColumn("_f", F.explode(F.array(*roles))).where(F.col("_f.role").isNotNull())
    return assigned.select(*samples.columns, "_f.fold", "_f.role")


def age_bands(rows: DataFrame, bands: Sequence[tuple[str, int, int]], assets: Sequence[str] | None) -> DataFrame:
    """Add ``band``: the band (name, from_days, to_days) of the age before the last row.

    Ages are in whole days before the asset's newest row; from is inclusive, to
    is exclusive; rows outside all bands are left out.
    """
    newest = rows.groupBy("asset").agg(F.max("ts").cast("date").alias("_newest"))
    joined = with_scalars(rows, newest, assets)
    age = F.datediff(F.col("_newest"), F.col("ts").cast("date"))
    band = None
    for name, low, high in bands:
        test = (age >= low) & (age < high)
        band = F.when(test, name) if band is None else band.when(test, name)
    return joined.withColumn("band", band).where(F.col("band").isNotNull()).select(*rows.columns, "band")


def decay_weights(rows: DataFrame, half_lives: Mapping[str, float], assets: Sequence[str] | None) -> DataFrame:
    """Weight exp(-age_days * ln 2 / half_life) per named half-life and their mean."""
    newest = rows.groupBy("asset").agg(F.max("ts").cast("date").alias("_newest"))
    joined = with_scalars(rows, newest, assets)
    age = F.datediff(F.col("_newest"), F.col("ts").cast("date"))
    weights = {name: F.exp(-age * F.log(F.lit(2.0)) / float(days)) for name, days in half_lives.items()}
    weighted = joined.withColumns(weights)
    total = F.lit(0.0)
    for name in half_lives:
        total = total + F.col(name)
    return weighted.withColumn("weight_mean", total / len(half_lives)).drop("_newest")

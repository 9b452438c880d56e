"""Several assets on one uniform grid, and as-of joins of other series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthframe.functions.quotes import FEATURES
from depthframe.operators.window import block_window, epoch_micros, epoch_seconds, halo

CARRIED = (*FEATURES, "mid")


def uniform_grid(line: DataFrame, reference: str, cadence_seconds: int) -> DataFrame:
    """Grid (grid_idx, ts) from the first to the last snapshot of the reference asset.

    Points are multiples of the cadence. The two ends give one row per day,
    which is spread over tasks before the points of a day are generated.
    """
    c = cadence_seconds
    ends = line.where(F.col("asset") == reference).agg(
        F.floor(F.min(epoch_seconds("ts")) / c).alias("lo"), F.floor(F.max(epoch_seconds("ts")) / c).alias("hi")
    )
    ends = ends.where(F.col("lo").isNotNull())
    per_day = max(86400 // c, 1)
    days = ends.select("lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / per_day), F.floor(F.col("hi") / per_day))).alias("day"))
    days = days.repartition("day")
    first = F.greatest(F.col("lo"), F.col("day") * per_day)
    last = F.least(F.col("hi"), F.col("day") * per_day + (per_day - 1))
    points = days.select(F.explode(F.sequence(first, last)).alias("grid_idx"))
    return points.select(F.col("grid_idx").cast("long"), F.timestamp_seconds(F.col("grid_idx") * c).cast("timestamp_ntz").alias("ts"))


def align_to_grid(snaps: DataFrame, cadence_seconds: int, tolerance_ms: int) -> DataFrame:
    """Nearest snapshot within the tolerance per asset and grid point.

    Every snapshot belongs to its nearest point (the later one when half-way);
    the closest one wins, then the earliest. One pre-aggregated aggregation.
    """
    step = cadence_seconds * 1_000_000
    micros = epoch_micros("ts")
    spot = F.floor((micros + step // 2) / step).cast("long")
    error = micros - spot * step
    near = snaps.select("asset", spot.alias("grid_idx"), F.struct(F.abs(error).alias("size"), error.alias("error"), *CARRIED).alias("s"))
    near = near.where(F.col("s.size") <= tolerance_ms * 1000)
    best = near.groupBy("grid_idx", "asset").agg(F.min("s").alias("s"), F.count("*").alias("candidates"))
    return best.select("asset", "grid_idx", (F.col("s.error") / 1000.0).alias("error_ms"), "candidates", *[f"s.{c}" for c in CARRIED])


def resample(
    grid: DataFrame, aligned: DataFrame, assets: Sequence[str], method: str, cadence_seconds: int, max_gap_seconds: int, block_rows: int
) -> DataFrame:
    """Every asset at every grid point: own value, else filled within the gap limit, else NULL.

    ``forward_fill`` carries the last value up to ``max_gap_seconds`` old;
    ``linear`` blends both neighbours by time when they are at most that far
    apart. The grid index is dense, so blocks with a halo of the gap limit hold
    every value a point may need.
    """
    if method not in ("forward_fill", "linear"):
        raise ValueError("method must be 'forward_fill' or 'linear'")
    reach = max(max_gap_seconds // cadence_seconds, 1)
    points = grid.withColumn("asset", F.explode(F.array(*[F.lit(a) for a in assets])))
    joined = points.join(aligned.select("asset", "grid_idx", *CARRIED), ["asset", "grid_idx"], "left")
    cells = halo(joined, "grid_idx", reach, reach, block_rows)
    seen = F.when(F.col("mid").isNotNull(), F.struct("grid_idx", *CARRIED))
    back = block_window("grid_idx").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("asset", "_block").orderBy(F.desc("grid_idx")).rowsBetween(Window.unboundedPreceding, 0)
    near = cells.withColumn("_l", F.last(seen, ignorenulls=True).over(back))
    i = F.col("grid_idx")
    if method == "forward_fill":
        usable = (i - F.col("_l.grid_idx")) * cadence_seconds <= max_gap_seconds
        values = {c: F.when(usable, F.col(f"_l.{c}")) for c in CARRIED}
    else:
        near = near.withColumn("_r", F.last(seen, ignorenulls=True).over(ahead))
        span = F.col("_r.grid_idx") - F.col("_l.grid_idx")
        weight = F.when(span > 0, (i - F.col("_l.grid_idx")) / span).otherwise(0.0)
        usable = span * cadence_seconds <= max_gap_seconds
        values = {
            c: F.when(usable, (1.0 - weight) * F.col(f"_l.{c}") + weight * F.col(f"_r.{c}")) for c in CARRIED
        }
    out = near.where("_own")
    return out.select(
        "asset", "grid_idx", "ts", *[v.alias(c) for c, v in values.items()], F.col("mid").isNull().alias("is_filled")
    )


def completeness(
    resampled: DataFrame, min_assets: int, num_assets: int, window_steps: int, max_missing_share: float, block_rows: int
) -> DataFrame:
    """Per grid point: assets present, share of missing cells over the window, and whether it is kept."""
    per_point = resampled.groupBy("grid_idx", "ts").agg(F.count("mid").alias("assets_present"))
    cells = halo(per_point.withColumn("asset", F.lit("all")), "grid_idx", window_steps, 0, block_rows)
    ordered = block_window("grid_idx")
    missing = num_assets - F.col("assets_present")
    upto = F.sum(missing).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    older = F.coalesce(F.sum(missing).over(ordered.rowsBetween(Window.unboundedPreceding, -window_steps)), F.lit(0))
    share = (upto - older) / F.lit(float(window_steps * num_assets))
    out = cells.withColumn("missing_share", share).where("_own")
    keep = (F.col("assets_present") >= min_assets) & (F.col("missing_share") <= max_missing_share)
    return out.select("grid_idx", "ts", "assets_present", "missing_share", keep.alias("kept"))


def complete_samples(resampled: DataFrame, report: DataFrame) -> DataFrame:
    """Rows of the grid points that the completeness report keeps."""
    return resampled.join(report.where("kept").select("grid_idx"), "grid_idx", "left_semi")


def stack_assets(resampled: DataFrame, assets: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per grid point with the columns of every asset side by side.

    One aggregation instead of one join per asset.
    """
    aggs = [
        F.max(F.when(F.col("asset") == a, F.col(c))).alias(f"{c}_{a.lower()}") for a in assets for c in columns
    ]
    return resampled.groupBy("grid_idx", "ts").agg(*aggs)


def alignment_quality(snaps: DataFrame, aligned: DataFrame) -> DataFrame:
    """Share of snapshots not used by the grid and the size of the alignment error, per asset."""
    total = snaps.groupBy("asset").agg(F.count("*").alias("snapshots"))
    used = aligned.groupBy("asset").agg(
        F.count("*").alias("aligned"),
        F.avg(F.abs("error_ms")).alias("mean_abs_error_ms"),
        F.max(F.abs("error_ms")).alias("max_abs_error_ms"),
    )
    joined = total.join(used, "asset", "left")
    aligned_n = F.coalesce("aligned", F.lit(0))
    return joined.select(
        "asset",
        "snapshots",
        aligned_n.alias("aligned"),
        ((F.col("snapshots") - aligned_n) / F.col("snapshots")).alias("discarded_share"),
        "mean_abs_error_ms",
        "max_abs_error_ms",
    )


def asof_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], tolerance_seconds: int, direction: str = "backward"
) -> DataFrame:
    """Attach the latest earlier right row (same ``ts`` included) within the tolerance.

    ``nearest`` also looks ahead and takes the closer one, the earlier on a tie.
    Adds ``matched_ts`` and ``values``; they are NULL without a match. Several
    right rows of one (keys, ts) give the greatest values.

    One frame holds the distinct times of both sides, made by one aggregation with map-side partial
    results, so repeated rows of one (keys, ts) never meet in a task. It is dealt by single seconds (at most
    10^6 times each) and scanned once for either direction; the last and the first right row of each second
    are carried over groups of at most three tolerance spans of seconds. No task sees a whole key.
    A null key or ``ts`` has no match.
    """
    if direction not in ("backward", "nearest"):
        raise ValueError("direction must be 'backward' or 'nearest'")
    found = _matches(left, right, keys, values, tolerance_seconds, direction == "nearest")
    joined = left.withColumn("_t", epoch_micros("ts")).join(found, [*keys, "_t"], "left")
    matched = F.timestamp_micros(F.col("_m._rt")).cast("timestamp_ntz")
    return joined.select(*left.columns, matched.alias("matched_ts"), *[F.col(f"_m.{v}").alias(v) for v in values])


def _matches(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], tolerance: int, look_ahead: bool) -> DataFrame:
    """(keys, _t, _m): per distinct left time the right row within the tolerance, null without one."""
    t = epoch_micros("ts").alias("_t")
    rights = right.select(*keys, t, F.lit(False).alias("_left"), F.struct(*values).alias("_v"))
    lefts = left.select(*keys, t, F.lit(True).alias("_left"), F.lit(None).cast(rights.schema["_v"].dataType).alias("_v"))
    times = lefts.unionByName(rights).groupBy(*keys, "_t").agg(F.max("_left").alias("_left"), F.max("_v").alias("_v"))
    times = times.withColumn("_sec", F.floor(F.col("_t") / 1_000_000))
    for name in (*keys, "_sec"):  # with equal filters both branches below read one exchange
        times = times.where(F.col(name).isNotNull())
    times = times.repartition(*keys, "_sec")
    row = F.when(F.col("_v").isNotNull(), F.struct(F.col("_t").alias("_rt"), *[F.col(f"_v.{v}").alias(v) for v in values]))
    times = times.select(*keys, "_sec", "_t", "_left", row.alias("_r"))

    size = tolerance + 1
    seconds = times.groupBy(*keys, "_sec").agg(F.max("_left").alias("_asked"), F.max("_r").alias("_last"), F.min("_r").alias("_first"))
    home = F.floor(F.col("_sec") / size)
    reach = [home - 1, home, home + 1] if look_ahead else [home, home + 1]
    copies = seconds.withColumn("_bucket", F.explode(F.array(*reach)))

    def last_before(value: str, group: str, order: Column, end: int) -> Column:
        frame = Window.partitionBy(*keys, group).orderBy(order).rowsBetween(Window.unboundedPreceding, end)
        return F.last(value, ignorenulls=True).over(frame)

    inner = [last_before("_r", "_sec", F.col("_t"), 0).alias("_back")]
    carried = [last_before("_last", "_bucket", F.col("_sec"), -1).alias("_before")]
    if look_ahead:
        inner.append(last_before("_r", "_sec", F.desc("_t"), 0).alias("_ahead"))
        carried.append(last_before("_first", "_bucket", F.desc("_sec"), -1).alias("_after"))
    carries = copies.select("*", *carried).where(F.col("_asked") & (F.col("_bucket") == home)).drop("_asked", "_last", "_first", "_bucket")
    joined = times.select("*", *inner).where("_left").join(carries, [*keys, "_sec"])

    match = F.coalesce("_back", "_before")
    if look_ahead:
        later = F.coalesce("_ahead", "_after")
        closer = match.isNull() | (later["_rt"] - F.col("_t") < F.col("_t") - match["_rt"])
        match = F.when(later.isNotNull() & closer, later).otherwise(match)
    near = F.abs(F.col("_t") - match["_rt"]) <= tolerance * 1_000_000
    return joined.select(*keys, "_t", F.when(near, match).alias("_m"))

"""Look-back windows, time features, derived features and scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthframe.functions.clock import cyclical, day_of_week, hour_of_day, market_session, minute_of_hour
from depthframe.functions.quotes import FEATURES, imbalance, weighted_mid
from depthframe.operators.window import (
    banded_sums,
    block_window,
    epoch_seconds,
    halo,
    with_scalars,
)
from depthframe.params import BookParams

LOCAL_FEATURES = {
    "hour_of_day": (("hour_sin", "hour_cos"), hour_of_day, 24),
    "day_of_week": (("dow_sin", "dow_cos"), day_of_week, 7),
    "minute_of_hour": (("minute_sin", "minute_cos"), minute_of_hour, 60),
}
GLOBAL_FEATURES = ("days_since_start", "market_session", "trend")


def temporal_columns(local: Sequence[str], global_: Sequence[str]) -> list[str]:
    out = [c for name in local for c in LOCAL_FEATURES[name][0]]
    return out + [g for g in global_]


def add_temporal_features(
    samples: DataFrame, local: Sequence[str], global_: Sequence[str], assets: Sequence[str] | None
) -> DataFrame:
    """Cyclical clock features and day offsets, chosen by name.

    ``trend`` is the elapsed share of the asset's sample time span, in [0, 1].
    """
    for name in local:
        if name not in LOCAL_FEATURES:
            raise ValueError(f"unknown local temporal feature {name!r}")
    for name in global_:
        if name not in GLOBAL_FEATURES:
            raise ValueError(f"unknown global temporal feature {name!r}")
    ts = F.col("ts")
    columns: dict[str, Column] = {}
    for name in local:
        (sin_name, cos_name), part, period = LOCAL_FEATURES[name]
        columns[sin_name], columns[cos_name] = cyclical(part(ts), period)
    out = samples
    if "days_since_start" in global_ or "trend" in global_:
        span = samples.groupBy("asset").agg(F.min("ts").alias("_first"), F.max("ts").alias("_last"))
        out = with_scalars(out, span, assets)
    if "days_since_start" in global_:
        columns["days_since_start"] = F.datediff(ts.cast("date"), F.col("_first").cast("date")).cast("double")
    if "trend" in global_:
        length = epoch_seconds("_last") - epoch_seconds("_first")
        columns["trend"] = F.when(length > 0, (epoch_seconds("ts") - epoch_seconds("_first")) / length).otherwise(0.0)
    if "market_session" in global_:
        columns["market_session"] = market_session(ts)
    return out.withColumns(columns).drop("_first", "_last")


def lookback_windows(line: DataFrame, p: BookParams) -> DataFrame:
    """Arrays of the T feature vectors that end at each row, oldest first.

    Rows without T predecessors (themselves included) are left out. The output
    is T times its input, so it belongs right before a sink.
    """
    t = p.window_steps
    cells = halo(line, "snap_idx", t - 1, 0, p.block_rows)
    frame = block_window("snap_idx").rowsBetween(-(t - 1), 0)
    step = F.struct(*FEATURES)
    filled = cells.withColumn("window", F.collect_list(step).over(frame))
    full = filled.where(F.col("_own") & (F.col("snap_idx") >= t - 1))
    return full.select("asset", (F.col("snap_idx") - (t - 1)).alias("sample_idx"), "snap_idx", "ts", "window")


def grid_patch(window: Column, height: int, width: int) -> Column:
    """Flat H x W grid per time step, row by row: quotes in the top-left 2 x 2 cells.

    The ask row needs height > 1 and the quantities need width > 1.
    """
    if height < 1 or width < 1:
        raise ValueError("height and width must be positive")

    def cells(s: Column) -> Column:
        values = []
        for r in range(height):
            for c in range(width):
                if r == 0 and c < 2:
                    values.append(s["bid_price"] if c == 0 else s["bid_quantity"])
                elif r == 1 and c < 2:
                    values.append(s["ask_price"] if c == 0 else s["ask_quantity"])
                else:
                    values.append(F.lit(0.0))
        return F.array(*values)

    return F.transform(window, cells)


def concat_temporal(steps: Column, temporal: Sequence[Column]) -> Column:
    """Append a sample's time features to the values of each of its time steps."""
    return F.transform(steps, lambda s: F.concat(s, F.array(*[t.cast("double") for t in temporal])))


def require_snapshots(line: DataFrame, mode: str) -> DataFrame:
    """Missing-snapshot policy: ``fail`` raises on an empty line, ``skip`` passes it on."""
    if mode == "fail":
        if not line.take(1):
            raise ValueError("no snapshots available for feature construction")
    elif mode != "skip":
        raise ValueError("mode must be 'fail' or 'skip'")
    return line


def quote_features(line: DataFrame) -> DataFrame:
    """Bid-ask spread, volume imbalance and quantity-weighted mid price."""
    return line.withColumns(
        {
            "bid_ask_spread": F.col("ask_price") - F.col("bid_price"),
            "volume_imbalance": imbalance("bid_quantity", "ask_quantity"),
            "weighted_mid_price": weighted_mid(),
        }
    )


def momentum(line: DataFrame, steps: int, p: BookParams) -> DataFrame:
    """Relative mid change and best-quantity change against ``steps`` rows earlier."""
    cells = halo(line, "snap_idx", steps, 0, p.block_rows)
    w = block_window("snap_idx")
    quantity = F.col("bid_quantity") + F.col("ask_quantity")
    out = cells.withColumns(
        {
            "price_momentum": F.col("mid") / F.lag("mid", steps).over(w) - 1.0,
            "volume_momentum": quantity - F.lag(quantity, steps).over(w),
        }
    )
    return out.where("_own").select(*line.columns, "price_momentum", "volume_momentum")


def log_returns(line: DataFrame, p: BookParams) -> DataFrame:
    cells = halo(line, "snap_idx", 1, 0, p.block_rows)
    previous = F.lag("mid").over(block_window("snap_idx"))
    out = cells.withColumn("log_return", F.log(F.col("mid") / previous))
    return out.where("_own").select(*line.columns, "log_return")


def rolling_volatility(line: DataFrame, seconds: int, p: BookParams) -> DataFrame:
    """Population deviation of log returns over the trailing ``seconds`` and its share of the maximum.

    Returns are summed per second to (n, sum, sum of squares). A window is the
    difference of two running sums, so it costs the same for any length. Seconds
    are grouped by buckets of one window length with a copy for the next bucket:
    a group holds at most two window lengths of seconds.
    """
    per_second = log_returns(line, p).groupBy("asset", epoch_seconds("ts").alias("_sec")).agg(
        F.count("log_return").alias("_n"),
        F.coalesce(F.sum("log_return"), F.lit(0.0)).alias("_s"),
        F.coalesce(F.sum(F.col("log_return") * F.col("log_return")), F.lit(0.0)).alias("_q"),
    )
    home = F.floor(F.col("_sec") / (seconds + 1)).cast("long")
    cells = per_second.withColumn("_home", home).withColumn(
        "_bucket", F.explode(F.array(F.col("_home"), F.col("_home") + 1))
    )
    ordered = Window.partitionBy("asset", "_bucket").orderBy("_sec")
    to_row = ordered.rangeBetween(Window.unboundedPreceding, 0)
    to_window = ordered.rangeBetween(Window.unboundedPreceding, -(seconds + 1))

    def trailing(c: str) -> Column:
        return F.sum(c).over(to_row) - F.coalesce(F.sum(c).over(to_window), F.lit(0))

    sums = cells.withColumns({"_wn": trailing("_n"), "_ws": trailing("_s"), "_wq": trailing("_q")})
    mean = F.col("_ws") / F.col("_wn")
    deviation = F.sqrt(F.greatest(F.col("_wq") / F.col("_wn") - mean * mean, F.lit(0.0)))
    per_sec = sums.where(F.col("_bucket") == F.col("_home")).select(
        "asset", "_sec", F.when(F.col("_wn") > 0, deviation).alias("vol")
    )
    peak = per_sec.groupBy("asset").agg(F.max("vol").alias("_peak"))
    normal = with_scalars(per_sec, peak, p.assets).select(
        "asset", "_sec", "vol", F.when(F.col("_peak") > 0, F.col("vol") / F.col("_peak")).alias("vol_norm")
    )
    return line.withColumn("_sec", epoch_seconds("ts")).join(normal, ["asset", "_sec"]).drop("_sec")


def volume_percentile(line: DataFrame) -> DataFrame:
    """Rank share of a snapshot's best quantity within its asset and day, in [0, 1].

    Equal to ``percent_rank``: rows with a smaller quantity over (rows - 1). The
    distinct quantities of a day are counted first and ranked through buckets of
    the quantity, then joined back.
    """
    day = F.col("ts").cast("date")
    quantity = F.col("bid_quantity") + F.col("ask_quantity")
    rows = line.withColumns({"day": day, "quantity": quantity})
    counts = rows.groupBy("asset", "day", "quantity").agg(F.count("*").alias("_n"))
    below = banded_sums(counts, ["asset", "day"], "quantity", {"_below": F.col("_n")}, {"_below": "_total"})
    ranked = below.select(
        "asset",
        "day",
        "quantity",
        F.when(F.col("_total") > 1, F.col("_below") / (F.col("_total") - 1)).otherwise(0.0).alias("volume_percentile"),
    )
    return rows.join(ranked, ["asset", "day", "quantity"]).select(*line.columns, "volume_percentile")


def exact_quantiles(rows: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles per asset and feature: (asset, feature, probability, value).

    Distinct values are counted, ranked through value buckets, and only the
    values at the wanted ranks are kept, so no task holds all values of a group.
    NULLs are left out.
    """
    values = rows.select(
        "asset",
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in columns])).alias("v"),
    ).select("asset", "v.feature", "v.x").where(F.col("x").isNotNull())
    counts = values.groupBy("asset", "feature", "x").agg(F.count("*").alias("_n"))
    keys = ["asset", "feature"]
    ranked = banded_sums(counts, keys, "x", {"_below": F.col("_n")}, {"_below": "_total"})
    hits = ranked.withColumn("probability", F.explode(F.array(*[F.lit(float(q)) for q in probabilities])))
    hits = hits.withColumn("_pos", (F.col("_total") - 1) * F.col("probability"))
    first, end = F.col("_below"), F.col("_below") + F.col("_n")
    lo, hi = F.floor("_pos"), F.ceil("_pos")
    at_lo, at_hi = (lo >= first) & (lo < end), (hi >= first) & (hi < end)
    found = hits.where(at_lo | at_hi).groupBy(*keys, "probability", "_pos").agg(
        F.max(F.when(at_lo, F.col("x"))).alias("_lo"), F.max(F.when(at_hi, F.col("x"))).alias("_hi")
    )
    value = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_pos") - F.floor("_pos"))
    return found.select(*keys, "probability", value.alias("value"))


def approximate_quantiles(rows: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Sketch-based quantiles in one pass: (asset, feature, probability, value)."""
    wide = rows.groupBy("asset").agg(*[F.percentile_approx(c, list(probabilities)).alias(c) for c in columns])
    cells = [
        F.struct(F.lit(c).alias("feature"), F.lit(float(q)).alias("probability"), F.col(c)[i].alias("value"))
        for c in columns
        for i, q in enumerate(probabilities)
    ]
    return wide.select("asset", F.explode(F.array(*cells)).alias("c")).select("asset", "c.*")


SCALERS = ("min_max", "standard", "robust", "robust_approx", "none")


def fit_scaler(train: DataFrame, columns: Sequence[str], method: str) -> DataFrame:
    """Per-asset (shift, scale) of each column, from training rows only."""
    if method not in SCALERS:
        raise ValueError(f"method must be one of {SCALERS}")
    if method.startswith("robust"):
        find = exact_quantiles if method == "robust" else approximate_quantiles
        found = find(train, columns, [0.25, 0.5, 0.75])

        def at(c: str, q: float) -> Column:
            return F.max(F.when((F.col("feature") == c) & (F.col("probability") == q), F.col("value")))

        pairs = {c: (at(c, 0.5), at(c, 0.75) - at(c, 0.25)) for c in columns}
        source = found
    else:
        pairs = {}
        for c in columns:
            if method == "min_max":
                pairs[c] = (F.min(c), F.max(c) - F.min(c))
            elif method == "standard":
                pairs[c] = (F.avg(c), F.stddev_pop(c))
            else:
                pairs[c] = (F.max(F.lit(0.0)), F.max(F.lit(1.0)))
        source = train
    aggs = []
    for c, (shift, scale) in pairs.items():
        aggs += [shift.alias(f"{c}__shift"), scale.alias(f"{c}__scale")]
    return source.groupBy("asset").agg(*aggs)


def apply_scaler(rows: DataFrame, scaler: DataFrame, columns: Sequence[str], assets: Sequence[str] | None) -> DataFrame:
    """(x - shift) / scale with stored statistics; a zero scale gives 0."""
    joined = with_scalars(rows, scaler, assets)
    scaled = {}
    for c in columns:
        width = F.col(f"{c}__scale")
        scaled[c] = F.when(width != 0, (F.col(c) - F.col(f"{c}__shift")) / width).when(width == 0, 0.0)
    return joined.withColumns(scaled).select(*rows.columns)

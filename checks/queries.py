"""Registered queries: every one runs an operator over whole supplied tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.adapters import (
    EVENT_ASSETS,
    EVENT_PARAMS,
    LINEITEM_ASSETS,
    LINEITEM_PARAMS,
    book_events,
    book_lineitem,
    events_book,
    predictions,
    table,
)
from depthframe.functions.moves import magnitude_bin, one_hot
from depthframe.functions.quotes import FEATURES, FLAGS, any_severe, anomaly_type, quality_flags, spread_pct
from depthframe.operators import align, calibration, depth, diagnostics, evaluation, features, labels, longterm, ml, splits, timeline
from depthframe.operators.snapshot import snapshots, top_of_book
from depthframe.operators.window import block_window, epoch_micros, epoch_seconds, halo
from depthframe.params import BookParams, ProfileParams
from depthframe.plans.targets import build_line, build_targets
from depthframe.session import stage, stage_dir
from depthframe.sources import readers, writers
from depthframe.streaming.book import run_to_end, stream_top_of_book

FIRST, LAST = "1990-01-01", "2099-12-31"
PROFILE = ProfileParams()
K = EVENT_PARAMS.num_classes
BINS = 10
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(c: Column | str) -> Column:
    """Six decimals, by the same arithmetic in both engines; no negative zero.

    The small offset keeps exact halves (9.4 / 128) away from the rounding edge,
    where the summation order of either engine would decide the last digit.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * 1e6 + 1e-4, 0) / 1e6 + 0.0


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})


# ---- inputs -----------------------------------------------------------------


def e_book(spark: SparkSession, sf: str) -> DataFrame:
    return readers.book_rows(book_events(spark, sf), FIRST, LAST, EVENT_ASSETS)


def l_book(spark: SparkSession, sf: str) -> DataFrame:
    return readers.book_rows(book_lineitem(spark, sf), FIRST, LAST, LINEITEM_ASSETS)


def e_line(spark: SparkSession, sf: str, p: BookParams = EVENT_PARAMS) -> DataFrame:
    return build_line(e_book(spark, sf), p)


def l_line(spark: SparkSession, sf: str, p: BookParams = LINEITEM_PARAMS) -> DataFrame:
    return build_line(l_book(spark, sf), p)


def e_samples(spark: SparkSession, sf: str) -> DataFrame:
    return build_targets(e_book(spark, sf), EVENT_PARAMS)


def l_samples(spark: SparkSession, sf: str) -> DataFrame:
    return build_targets(l_book(spark, sf), LINEITEM_PARAMS)


def split_counts(line: DataFrame, p: BookParams) -> DataFrame:
    sizes = splits.split_sizes(labels.sample_counts(line, p), p)
    return sizes.select("asset", F.col("train_end").alias("n"))


def train_and_records(line: DataFrame, p: BookParams, q: ProfileParams = PROFILE) -> DataFrame:
    """Profile records of the training rows."""
    counts = labels.sample_counts(line, p)
    rows = splits.chronological_split(labels.samples(line, p), counts, p)
    train = rows.where(F.col("split") == "train")
    return diagnostics.records(diagnostics.sample_rows(train, split_counts(line, p), q, p.assets), q)


def e_records(spark: SparkSession, sf: str, q: ProfileParams = PROFILE) -> DataFrame:
    return train_and_records(e_line(spark, sf), EVENT_PARAMS, q)


def l_records(spark: SparkSession, sf: str, q: ProfileParams = PROFILE) -> DataFrame:
    return train_and_records(l_line(spark, sf), LINEITEM_PARAMS, q)


# ---- A: sources and sinks ---------------------------------------------------


@query
def a1_scan_book(spark, sf):
    return e_book(spark, sf)


@query
def a2_route_assets(spark, sf):
    whole = book_events(spark, sf).drop("asset")
    source = book_events(spark, sf)
    parts = {readers.asset_table("", a.upper()): source.where(F.col("asset") == a).select(*whole.columns) for a in EVENT_ASSETS}
    book = readers.route_assets(parts)
    return book.groupBy("asset").agg(
        F.count("*").alias("n"), F.min("row_id").alias("first_row"), F.max("row_id").alias("last_row")
    )


def folder(spark, name):
    return f"{stage_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query
def a3_missing_source(spark, sf):
    root = folder(spark, "tables")
    book = stage(e_book(spark, sf), "book")
    for a in EVENT_ASSETS:
        book.where(F.col("asset") == a).drop("asset").write.parquet(f"{root}/{readers.asset_table('orderbook_', a.upper())}")
    symbols = [a.upper() for a in (*EVENT_ASSETS, "absent")]
    return readers.row_counts(readers.scan_asset_tables(spark, root, "orderbook_", symbols, FIRST, LAST, "empty"))


@query
def a4_row_counts(spark, sf):
    return readers.row_counts(l_book(spark, sf))


@query
def a5_typed_rows(spark, sf):
    raw = book_events(spark, sf)
    text = F.when(F.col("row_id") % 97 == 0, "n/a").otherwise(F.col("bid_quantity").cast("string"))
    raw = raw.withColumn("bid_quantity", text)
    good = readers.typed_rows(raw, "quarantine").groupBy("asset").agg(F.count("*").alias("good"), F.max("bid_quantity").alias("max_bid_quantity"))
    bad = readers.rejected_rows(raw).groupBy("asset").agg(F.count("*").alias("bad"))
    return good.join(bad, "asset", "left").na.fill(0, ["bad"])


@query
def a6_training_set(spark, sf):
    line = stage(e_line(spark, sf), "line")  # several branches read it
    p = EVENT_PARAMS
    rows = splits.chronological_split(labels.samples(line, p), labels.sample_counts(line, p), p)
    heads = rows.select("asset", "sample_idx", "label_up", "label_down", "split")
    windows = features.lookback_windows(line, p).join(heads, ["asset", "sample_idx"])
    path = writers.write_training_set(windows, folder(spark, "training"), "v1")
    stored = spark.read.parquet(path)
    first = F.col("window")[0]["bid_price"]
    return stored.groupBy("asset", "split").agg(
        F.count("*").alias("n"), F.min(F.size("window")).alias("steps"), r6(F.max(first)).alias("max_first_bid")
    )


@query
def a8_record_csv(spark, sf):
    path = folder(spark, "records")
    writers.write_record_csv(e_records(spark, sf, ProfileParams(num_samples=500)), path)
    schema = "sample_idx long, ts timestamp_ntz, label int, bid_price double, ask_price double, bid_quantity double, ask_quantity double, mid_price double, spread_pct double, asset string"
    stored = spark.read.schema(schema).option("header", True).csv(path)
    return rounded(stored.select("asset", "sample_idx", "label", "mid_price", "spread_pct"), "mid_price", "spread_pct")


@query
def a9_anomaly_csv(spark, sf):
    path = folder(spark, "anomalies")
    q = ProfileParams(high_spread_pct=0.5)
    writers.write_anomaly_csv(diagnostics.anomalies(e_records(spark, sf, q), q.anomaly_limit), path)
    stored = spark.read.option("header", True).csv(path)
    return stored.groupBy("asset", "anomaly_type").agg(F.count("*").alias("n"), F.max(F.col("sample_idx").cast("long")).alias("last_sample"))


@query
def a7_fingerprint(spark, sf):
    return writers.fingerprint(snapshots(l_book(spark, sf)))


@query
def a10_confusion_wide(spark, sf):
    path = folder(spark, "confusion")
    writers.write_confusion_csv(evaluation.confusion(predictions(spark, sf), K), path, K)
    cells = ", ".join(f"pred_{k} bigint" for k in range(K))
    stored = spark.read.schema(f"{cells}, head string").csv(path).withColumn("at", F.monotonically_increasing_id())
    nth = F.row_number().over(Window.partitionBy("head").orderBy("at")) - 1  # a file of K rows for each head
    return stored.select("head", nth.alias("y_true"), *[f"pred_{k}" for k in range(K)])


@query
def a11_calibration_curve(spark, sf):
    path = folder(spark, "curve")
    writers.write_curve_csv(evaluation.reliability(predictions(spark, sf), BINS), path)
    columns = ", ".join(f"{c} double" for c in writers.CURVE_COLUMNS)
    stored = spark.read.schema(f"{columns}, bin_count bigint, head string").option("header", True).csv(path)
    place = F.round(F.col("left_edge") * BINS).cast("int")
    return stored.select("head", place.alias("bin"), *[r6(c).alias(c) for c in writers.CURVE_COLUMNS], "bin_count")


@query
def a12_metric_table(spark, sf):
    path = folder(spark, "metrics")
    writers.append_metrics(evaluation.evaluate(predictions(spark, sf), K, BINS), path, "evaluation")
    return rounded(spark.read.parquet(path).select("stage", "metric", "value"), "value")


@query
def a15_daily_store(spark, sf):
    path = folder(spark, "daily")
    writers.write_daily_store(e_line(spark, sf), path)
    stored = spark.read.parquet(path).select("asset", F.col("day").cast("timestamp_ntz").alias("day"), "n", "mid_mean")
    return rounded(stored, "mid_mean")


@query
def a13_daily_extraction(spark, sf):
    path = folder(spark, "book")
    writers.write_book(e_book(spark, sf), path)
    stored = readers.scan_book(spark, path, FIRST, LAST, EVENT_ASSETS)
    return stored.groupBy("asset", F.col("ts").cast("date").cast("timestamp_ntz").alias("day")).agg(
        F.count("*").alias("n"), F.min("row_id").alias("first_row")
    )


@query
def a14_retained_rows(spark, sf):
    path = folder(spark, "retained")
    writers.write_retained(e_line(spark, sf), path, 0.05, 42)
    kept = spark.read.parquet(path)
    return rounded(kept.select("asset", "snap_idx", "ts", "mid"), "mid")


# ---- B: expressions ---------------------------------------------------------


@query
def b3_epoch_units(spark, sf):
    micros = epoch_micros("ts")
    unit = F.when(F.col("asset") == "click", micros * 1000).when(F.col("asset") == "error", micros)
    unit = unit.when(F.col("asset") == "view", F.floor(micros / 1000)).otherwise(F.floor(micros / 1_000_000))
    raw = book_events(spark, sf).select("asset", "row_id", unit.cast("long").alias("raw"))
    return readers.normalize_epoch(raw, "raw", "ts", EVENT_ASSETS)


@query
def b6_spread_and_mid(spark, sf):
    book = l_book(spark, sf)
    return rounded(snapshots(book).withColumn("spread_pct", spread_pct()).select("asset", "ts", "mid", "spread_pct"), "mid", "spread_pct")


@query
def b7_quality_flags(spark, sf):
    rows = top_of_book(book_events(spark, sf))
    return rows.withColumns(quality_flags(PROFILE.high_spread_pct)).select(
        "asset", "ts", *[F.col(f).cast("int").alias(f) for f in FLAGS]
    )


@query
def b8_anomaly_types(spark, sf):
    rows = snapshots(e_book(spark, sf)).withColumns(quality_flags(0.2))
    bad = rows.where(any_severe()).withColumn("anomaly_type", anomaly_type())
    return bad.groupBy("asset", "anomaly_type").agg(F.count("*").alias("n"))


@query
def b9_plot_series(spark, sf):
    series = diagnostics.plot_series(stage(e_records(spark, sf), "records"), 2.0, EVENT_ASSETS)
    cols = ("spread_clipped", "relative_spread", "mid_change_pct")
    return rounded(series.select("asset", "sample_idx", "elapsed_seconds", *cols), *cols)


@query
def b14_label_range(spark, sf):
    return diagnostics.label_range(l_samples(spark, sf), K)


@query
def b16_quality_filter(spark, sf):
    kept = diagnostics.quality_filter(snapshots(e_book(spark, sf)), ["inverted_spread", "zero_ask_quantity"], 5.0)
    kept = diagnostics.price_sanity_filter(kept, 1.5, EVENT_ASSETS)
    return kept.select("asset", "ts", *FEATURES)


# ---- C: snapshots and depth -------------------------------------------------


@query
def c1_top_of_book(spark, sf):
    return top_of_book(l_book(spark, sf))


@query
def c1_stream_top_of_book(spark, sf):
    """The events as a stream: snapshots that a day of delay has closed."""
    batch = table(spark, sf, "events")
    source = spark.readStream.schema(batch.schema).parquet(f"{sf}/events.parque[t]")  # a pattern, as the table may be one file
    book = readers.book_rows(events_book(spark, source), FIRST, LAST, EVENT_ASSETS)
    path = folder(spark, "stream")
    run_to_end(stream_top_of_book(book, "1 day"), path, folder(spark, "stream-state"))
    return spark.read.parquet(path)


@query
def c1_top_of_book_unfiltered(spark, sf):
    return top_of_book(book_events(spark, sf))


@query
def c2_snapshots(spark, sf):
    return snapshots(book_events(spark, sf))


def l_ranked(spark, sf):
    return depth.ranked_levels(depth.price_levels(l_book(spark, sf)))


@query
def c3_adaptive_depth(spark, sf):
    ranked = stage(l_ranked(spark, sf), "levels")
    kept = depth.adaptive_depth(ranked, 200)
    return kept.groupBy("asset", "side", "level").agg(F.count("*").alias("n"), r6(F.sum("quantity")).alias("quantity"))


@query
def c4_compress_depth(spark, sf):
    bins = depth.compress_depth(l_ranked(spark, sf), 3, 2, 4)
    return rounded(bins, "price", "quantity")


@query
def c5_compression_report(spark, sf):
    return rounded(depth.compression_report(l_ranked(spark, sf), 3, 2, 4), "ratio")


# ---- D: time line -----------------------------------------------------------


@query
def d1_dense_index(spark, sf):
    return timeline.index_snapshots(snapshots(l_book(spark, sf))).select("asset", "ts", "snap_idx")


@query
def d2_source_order(spark, sf):
    return timeline.source_order_report(book_events(spark, sf))


@query
def d3_gap_report(spark, sf):
    indexed = timeline.index_snapshots(snapshots(e_book(spark, sf)))
    return timeline.check_gaps(indexed, EVENT_PARAMS, "report")


@query
def d4_skip_gaps(spark, sf):
    return _flat_line(e_line(spark, sf, EVENT_PARAMS.with_(gap_mode="skip")))


@query
def d5_forward_fill(spark, sf):
    return _flat_line(e_line(spark, sf, EVENT_PARAMS.with_(gap_mode="forward_fill")))


@query
def d6_interpolate(spark, sf):
    return _flat_line(e_line(spark, sf))


@query
def d6_interpolate_lineitem(spark, sf):
    return _flat_line(l_line(spark, sf))


def _flat_line(line):
    out = line.select("asset", "snap_idx", "ts", *FEATURES, "mid", F.col("is_filled").cast("int").alias("is_filled"))
    return rounded(out, *FEATURES, "mid")


@query
def d7_gap_statistics(spark, sf):
    out = timeline.gap_statistics(e_line(spark, sf), EVENT_PARAMS, 2.0, 6.0)
    return rounded(out, "diag_gap_fraction_large", "diag_gap_fraction_very_large")


def raw_snaps(spark, sf):
    """Snapshots on the events' own microsecond times, for alignment."""
    events = table(spark, sf, "events")
    return events.select(
        F.col("event_type").alias("asset"),
        "ts",
        F.col("value").alias("bid_price"),
        (F.col("user_id") % 20).cast("double").alias("bid_quantity"),
        (F.col("value") + 1.0).alias("ask_price"),
        (F.col("user_id") % 7).cast("double").alias("ask_quantity"),
        (F.col("value") + 0.5).alias("mid"),
    )


GRID = 600
TOLERANCE_MS = 120_000
GRID_GAP = 3600


@query
def d8_uniform_grid(spark, sf):
    return align.uniform_grid(raw_snaps(spark, sf), "view", GRID)


def aligned_events(spark, sf):
    return align.align_to_grid(raw_snaps(spark, sf), GRID, TOLERANCE_MS)


@query
def d9_align_to_grid(spark, sf):
    return rounded(aligned_events(spark, sf), "error_ms", *FEATURES, "mid")


def resampled(spark, sf, method):
    aligned = stage(aligned_events(spark, sf), "aligned")
    grid = align.uniform_grid(raw_snaps(spark, sf), "view", GRID)
    return align.resample(grid, aligned, EVENT_ASSETS, method, GRID, GRID_GAP, EVENT_PARAMS.block_rows)


@query
def d10_resample_forward_fill(spark, sf):
    out = resampled(spark, sf, "forward_fill").select("asset", "grid_idx", "ts", "bid_price", "mid", F.col("is_filled").cast("int").alias("is_filled"))
    return rounded(out, "bid_price", "mid")


@query
def d10_resample_linear(spark, sf):
    out = resampled(spark, sf, "linear").select("asset", "grid_idx", "ts", "bid_price", "mid", F.col("is_filled").cast("int").alias("is_filled"))
    return rounded(out, "bid_price", "mid")


def completeness_report(grid_rows):
    return align.completeness(grid_rows, 4, len(EVENT_ASSETS), 12, 0.25, EVENT_PARAMS.block_rows)


@query
def d11_completeness(spark, sf):
    report = completeness_report(resampled(spark, sf, "forward_fill"))
    return rounded(report.withColumn("kept", F.col("kept").cast("int")), "missing_share")


@query
def d11_complete_samples(spark, sf):
    rows = stage(resampled(spark, sf, "forward_fill"), "grid")
    kept = align.complete_samples(rows, completeness_report(rows))
    return kept.groupBy("asset").agg(F.count("*").alias("n"), F.count("mid").alias("present"))


@query
def d12_stack_assets(spark, sf):
    wide = align.stack_assets(resampled(spark, sf, "forward_fill"), EVENT_ASSETS, ["mid"])
    return rounded(wide, *[f"mid_{a}" for a in EVENT_ASSETS])


@query
def d13_alignment_quality(spark, sf):
    snaps = raw_snaps(spark, sf)
    out = align.alignment_quality(snaps, aligned_events(spark, sf))
    return rounded(out, "discarded_share", "mean_abs_error_ms", "max_abs_error_ms")


@query
def d14_interval_distribution(spark, sf):
    indexed = timeline.index_snapshots(snapshots(e_book(spark, sf)))
    return timeline.gap_intervals(indexed, EVENT_PARAMS.block_rows)


# ---- E: windows -------------------------------------------------------------


@query
def e1_forward_extremes(spark, sf):
    out = labels.forward_extremes(l_line(spark, sf), LINEITEM_PARAMS)
    return rounded(out.select("asset", "snap_idx", "future_high", "future_low"), "future_high", "future_low")


@query
def e2_lookback_windows(spark, sf):
    rows = features.lookback_windows(e_line(spark, sf), EVENT_PARAMS)
    steps = rows.select("asset", "sample_idx", F.posexplode("window").alias("step", "w")).select("asset", "sample_idx", "step", "w.*")
    return rounded(steps, *FEATURES)


@query
def e3_eligible_anchors(spark, sf):
    rows = labels.eligible(e_line(spark, sf), EVENT_PARAMS)
    return rows.groupBy("asset").agg(
        F.count("*").alias("n"), F.min("snap_idx").alias("first_idx"), F.max("snap_idx").alias("last_idx")
    )


@query
def e4_anchor_times(spark, sf):
    return labels.samples(e_line(spark, sf), EVENT_PARAMS).select("asset", "sample_idx", "snap_idx", "ts")


@query
def e5_lag_lead(spark, sf):
    line = e_line(spark, sf)
    cells = halo(line, "snap_idx", 1, 1, EVENT_PARAMS.block_rows)
    w = block_window("snap_idx")
    s = epoch_seconds("ts")
    out = cells.withColumns({"since_previous": s - F.lag(s).over(w), "until_next": F.lead(s).over(w) - s})
    return out.where("_own").select("asset", "snap_idx", "since_previous", "until_next")


@query
def e6_neighbourhood(spark, sf):
    line = e_line(spark, sf)
    anchors = check_anchors(line)
    out = diagnostics.neighbourhood(line, anchors, PROFILE.label_examples, EVENT_PARAMS.window_steps, EVENT_PARAMS.horizon_steps, EVENT_ASSETS)
    return rounded(out, "offset_seconds", "mid", "change_pct")


def check_anchors(line):
    p = EVENT_PARAMS
    rows = splits.chronological_split(labels.samples(line, p), labels.sample_counts(line, p), p)
    lengths = line.groupBy("asset").agg((F.max("snap_idx") + 1).alias("n_line"))
    return diagnostics.label_check_anchors(rows.where(F.col("split") == "train"), lengths, p, PROFILE)


@query
def e7_rolling_volatility(spark, sf):
    out = features.rolling_volatility(e_line(spark, sf), 86400, EVENT_PARAMS)
    return rounded(out.select("asset", "snap_idx", "vol", "vol_norm"), "vol", "vol_norm")


@query
def e8_volume_percentile(spark, sf):
    out = features.volume_percentile(stage(e_line(spark, sf), "line"))
    return rounded(out.select("asset", "snap_idx", "volume_percentile"), "volume_percentile")


@query
def e9_momentum(spark, sf):
    out = features.momentum(e_line(spark, sf), 6, EVENT_PARAMS)
    cols = ("price_momentum", "volume_momentum")
    return rounded(out.select("asset", "snap_idx", *cols), *cols)


@query
def e10_level_rank(spark, sf):
    return rounded(l_ranked(spark, sf).select("asset", "ts", "side", "level", "price", "quantity"), "price", "quantity")


@query
def e11_cumulative_depth(spark, sf):
    out = depth.relative_depth(l_ranked(spark, sf))
    cols = ("cumulative_qty", "relative_depth")
    return rounded(out.select("asset", "ts", "side", "level", *cols), *cols)


# ---- F: labels --------------------------------------------------------------


@query
def f1_dominant_move(spark, sf):
    rows = l_samples(spark, sf)
    cols = ("max_up_move_pct", "max_down_move_pct", "price_change")
    return rounded(rows.select("asset", "sample_idx", *cols), *cols)


@query
def f2_magnitude_bins(spark, sf):
    rows = l_samples(spark, sf).withColumn("size", magnitude_bin(F.abs("price_change"), LINEITEM_PARAMS.boundaries))
    return rows.groupBy("asset", "size").agg(F.count("*").alias("n"), r6(F.max(F.abs("price_change"))).alias("largest"))


@query
def f3_signed_label(spark, sf):
    return e_samples(spark, sf).groupBy("asset", "label").agg(F.count("*").alias("n"))


@query
def f4_intensity_labels(spark, sf):
    return e_samples(spark, sf).groupBy("asset", "label_up", "label_down").agg(F.count("*").alias("n"))


@query
def f5_targets(spark, sf):
    rows = l_samples(spark, sf)
    cols = ("max_up_move_pct", "max_down_move_pct", "price_change")
    out = rows.select("asset", "sample_idx", "snap_idx", "ts", *cols, "label", "label_up", "label_down", "split", "split_idx")
    return rounded(out, *cols)


@query
def f6_one_hot(spark, sf):
    rows = e_samples(spark, sf)
    hot = rows.select("asset", "sample_idx", one_hot("label_up", K).alias("up"), one_hot("label_down", K).alias("down"))
    return hot.select("asset", "sample_idx", *[F.col(h)[i].alias(f"{h}_{i}") for h in ("up", "down") for i in range(K)])


@query
def f7_class_weights(spark, sf):
    train = l_samples(spark, sf).where(F.col("split") == "train")
    return rounded(labels.class_weights(train, "label_up", K), "weight")


@query
def f7_weighted_samples(spark, sf):
    rows = stage(l_samples(spark, sf), "samples")
    weights = labels.class_weights(rows.where(F.col("split") == "train"), "label_up", K)
    joined = labels.with_class_weight(rows, weights, "label_up", K, LINEITEM_ASSETS)
    return rounded(joined.select("asset", "sample_idx", "label_up", "class_weight"), "class_weight")


@query
def f8_signed_percentage(spark, sf):
    rows = l_samples(spark, sf)
    edge = F.when(F.col("l_returnflag") == "A", 1.0).otherwise(2.0)
    bounds = table(spark, sf, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("asset"), F.array(edge, edge * 2.5, edge * 5.0).alias("boundaries")).distinct()
    out = labels.signed_percentage_labels(rows, bounds, 3, LINEITEM_ASSETS)
    return out.groupBy("asset", "label_signed").agg(F.count("*").alias("n"))


@query
def f9_class_distribution(spark, sf):
    return labels.class_distribution_rollup(e_samples(spark, sf)).select(
        F.coalesce("split", F.lit("all")).alias("split"),
        F.coalesce("head", F.lit("all")).alias("head"),
        F.coalesce("class", F.lit(-1)).alias("class"),
        "n",
    )


@query
def f10_absolute_labels(spark, sf):
    out = labels.absolute_labels(l_line(spark, sf), LINEITEM_PARAMS, (2.0, 5.0, 10.0))
    return rounded(out, "up", "down")


@query
def f10_adaptive_labels(spark, sf):
    line = stage(e_line(spark, sf), "line")  # several branches read it
    volatility = features.rolling_volatility(line, 86400, EVENT_PARAMS)
    out = labels.adaptive_labels(labels.samples(line, EVENT_PARAMS), volatility, EVENT_PARAMS.boundaries, 0.25)
    return out.groupBy("asset", "label_up_adaptive", "label_down_adaptive").agg(F.count("*").alias("n"))


# ---- G: time features -------------------------------------------------------

LOCAL = ("hour_of_day", "day_of_week", "minute_of_hour")


@query
def g5_temporal_features(spark, sf):
    rows = stage(e_samples(spark, sf), "samples")
    out = features.add_temporal_features(rows, LOCAL, ("days_since_start", "market_session", "trend"), EVENT_ASSETS)
    numeric = [c for c in features.temporal_columns(LOCAL, ("days_since_start", "trend"))]
    return rounded(out.select("asset", "sample_idx", "market_session", *numeric), *numeric)


@query
def g8_temporal_concat(spark, sf):
    line = stage(e_line(spark, sf), "line")  # several branches read it
    anchors = labels.samples(line, EVENT_PARAMS).select("asset", "sample_idx", "ts")
    timed = features.add_temporal_features(anchors, ("hour_of_day",), (), EVENT_ASSETS).drop("ts")
    rows = features.lookback_windows(line, EVENT_PARAMS).join(timed, ["asset", "sample_idx"])
    steps = F.transform(F.col("window"), lambda s: F.array(*[s[c] for c in FEATURES]))
    full = rows.select("asset", "sample_idx", features.concat_temporal(steps, [F.col("hour_sin"), F.col("hour_cos")]).alias("x"))
    flat = full.select("asset", "sample_idx", F.posexplode("x").alias("step", "v"))
    return flat.groupBy("asset", "step").agg(
        F.count("*").alias("n"), F.min(F.size("v")).alias("width"), *[r6(F.max(F.col("v")[i])).alias(f"max_{i}") for i in range(6)]
    )


# ---- H: model-ready features ------------------------------------------------


@query
def h1_grid_patch(spark, sf):
    rows = features.lookback_windows(e_line(spark, sf), EVENT_PARAMS)
    flat = rows.select("asset", "sample_idx", F.posexplode(features.grid_patch(F.col("window"), 3, 2)).alias("step", "g"))
    return flat.select("asset", "sample_idx", "step", *[r6(F.col("g")[i]).alias(f"cell_{i}") for i in range(6)])


@query
def h3_missing_policy(spark, sf):
    return features.require_snapshots(e_line(spark, sf), "fail").groupBy("asset").agg(F.count("*").alias("n"))


@query
def h4_quote_features(spark, sf):
    out = features.quote_features(snapshots(l_book(spark, sf)))
    cols = ("bid_ask_spread", "volume_imbalance", "weighted_mid_price")
    return rounded(out.select("asset", "ts", *cols), *cols)


@query
def h4_depth_imbalance(spark, sf):
    out = depth.depth_imbalance(l_ranked(spark, sf), 5)
    return rounded(out, "bid_depth", "ask_depth", "depth_imbalance")


@query
def h5_level_features(spark, sf):
    out = depth.level_features(stage(l_ranked(spark, sf), "levels"))
    cols = ("price", "quantity", "price_delta_mid", "cumulative_qty", "relative_depth")
    return rounded(out.select("asset", "ts", "side", "level", *cols), *cols)


@query
def h6_feature_grid(spark, sf):
    feats = depth.level_features(stage(l_ranked(spark, sf), "levels"))
    grid = depth.feature_grid(feats, 3, ("price_delta_mid", "quantity"), 4, 5)
    return grid.select("asset", "ts", *[r6(F.col("grid")[i]).alias(f"g{i:02d}") for i in range(20)])


def _scaled(spark, sf, method):
    rows = stage(l_samples(spark, sf), "samples")
    columns = ["mid", "bid_quantity"]
    scaler = features.fit_scaler(rows.where(F.col("split") == "train"), columns, method)
    out = features.apply_scaler(rows, scaler, columns, LINEITEM_ASSETS)
    return rounded(out.select("asset", "sample_idx", *columns), *columns)


@query
def h7_scale_min_max(spark, sf):
    return _scaled(spark, sf, "min_max")


@query
def h7_scale_standard(spark, sf):
    return _scaled(spark, sf, "standard")


@query
def h7_scale_robust(spark, sf):
    return _scaled(spark, sf, "robust")


@query
def h8_feature_quantiles(spark, sf):
    rows = features.quote_features(snapshots(l_book(spark, sf)))
    out = features.exact_quantiles(rows, ["bid_ask_spread", "volume_imbalance", "bid_quantity"], [0.0, 0.05, 0.5, 0.95, 1.0])
    return rounded(out, "value")


@query
def h8_depth_profile(spark, sf):
    out = depth.depth_profile(depth.level_features(stage(l_ranked(spark, sf), "levels")))
    return rounded(out, "mean_quantity", "mean_cumulative_qty", "mean_relative_depth")


# ---- I: splits, samples, weights --------------------------------------------


@query
def i1_chronological_split(spark, sf):
    return e_samples(spark, sf).groupBy("asset", "split").agg(
        F.count("*").alias("n"), F.min("sample_idx").alias("first_idx"), F.max("sample_idx").alias("last_idx")
    )


@query
def i2_uniform_sample(spark, sf):
    line = e_line(spark, sf)
    p = EVENT_PARAMS
    rows = splits.chronological_split(labels.samples(line, p), labels.sample_counts(line, p), p)
    out = splits.uniform_sample(rows.where(F.col("split") == "train"), split_counts(line, p), "sample_idx", 97, EVENT_ASSETS)
    return out.select("asset", "sample_idx", "ts")


@query
def i3_random_sample(spark, sf):
    train = stage(e_samples(spark, sf), "samples").where(F.col("split") == "train")
    return splits.random_sample(train, "sample_idx", 100, 42, EVENT_ASSETS).select("asset", "sample_idx", "ts")


@query
def i4_head_cap(spark, sf):
    capped = splits.head_cap(l_samples(spark, sf), 300)
    return capped.groupBy("asset", "split").agg(F.count("*").alias("n"), F.max("sample_idx").alias("last_idx"))


def folded(spark, sf):
    rows = stage(l_samples(spark, sf), "samples")
    return splits.expanding_folds(rows, 720, 240, 3, LINEITEM_ASSETS)


@query
def i5_expanding_folds(spark, sf):
    return folded(spark, sf).groupBy("asset", "fold", "role").agg(
        F.count("*").alias("n"), F.min("sample_idx").alias("first_idx"), F.max("sample_idx").alias("last_idx")
    )


BANDS = (("recent", 0, 60), ("six_months", 180, 240), ("twelve_months", 360, 420), ("eighteen_months", 540, 600))


@query
def i6_age_bands(spark, sf):
    rows = splits.age_bands(stage(l_samples(spark, sf), "samples"), BANDS, LINEITEM_ASSETS)
    return rows.groupBy("asset", "band").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"))


@query
def i7_decay_weights(spark, sf):
    lives = {"weight_7": 7.0, "weight_30": 30.0, "weight_90": 90.0}
    out = splits.decay_weights(stage(l_samples(spark, sf), "samples"), lives, LINEITEM_ASSETS)
    cols = [*lives, "weight_mean"]
    return rounded(out.select("asset", "sample_idx", *cols), *cols)


FACTORS = {0: 0.5, 1: 2.0, 2: 1.5, 3: 1.25}


@query
def i9_rebalance(spark, sf):
    train = e_samples(spark, sf).where(F.col("split") == "train")
    return splits.rebalance(train, "label_up", FACTORS, "sample_idx", 42).select("asset", "sample_idx", "label_up", "copy")


# ---- J: profile -------------------------------------------------------------


@query
def j1_records(spark, sf):
    out = e_records(spark, sf, ProfileParams(num_samples=200, high_spread_pct=0.5))
    flat = out.select("asset", *diagnostics.RECORD_COLUMNS, *[F.col(f).cast("int").alias(f) for f in FLAGS])
    return rounded(flat, "bid_price", "ask_price", "bid_quantity", "ask_quantity", "mid_price", "spread_pct")


@query
def j1_random_records(spark, sf):
    line = e_line(spark, sf)
    out = train_and_records(line, EVENT_PARAMS, ProfileParams(sample_method="random", num_samples=150))
    return rounded(out.select("asset", "sample_idx", "label", "spread_pct"), "spread_pct")


def _round_all(df):
    return rounded(df, *[c for c, t in df.dtypes if t == "double"])


@query
def j2_describe(spark, sf):
    return _round_all(diagnostics.describe(l_records(spark, sf)))


@query
def j3_spread_statistics(spark, sf):
    return _round_all(diagnostics.spread_statistics(l_records(spark, sf), PROFILE))


@query
def j4_mid_consistency(spark, sf):
    return _round_all(diagnostics.mid_consistency(l_records(spark, sf)))


@query
def j5_outlier_percent(spark, sf):
    q = ProfileParams(z_threshold=1.2)
    return _round_all(diagnostics.outlier_percent(stage(l_records(spark, sf, q), "records"), q, LINEITEM_ASSETS))


@query
def j6_flag_fractions(spark, sf):
    return _round_all(diagnostics.flag_fractions(e_records(spark, sf)))


@query
def j7_nonzero_counts(spark, sf):
    return diagnostics.nonzero_counts(e_records(spark, sf))


@query
def j8_price_histogram(spark, sf):
    out = diagnostics.price_histogram(stage(l_records(spark, sf), "records"), PROFILE.histogram_bins, LINEITEM_ASSETS)
    return rounded(out, "left_edge")


def e_series(spark, sf):
    records = stage(e_records(spark, sf), "records")
    return stage(diagnostics.plot_series(records, 2.0, EVENT_ASSETS), "series")


@query
def j9_spread_time_histogram(spark, sf):
    return diagnostics.spread_time_histogram(e_series(spark, sf), 20, 10, EVENT_ASSETS)


@query
def j10_spread_label_histogram(spark, sf):
    return diagnostics.spread_label_histogram(e_series(spark, sf), K, 10, EVENT_ASSETS)


@query
def j11_depth_heatmap(spark, sf):
    heat = diagnostics.depth_heatmap(e_book(spark, sf), e_series(spark, sf), PROFILE.num_samples, 20, 10, EVENT_ASSETS)
    return rounded(heat, "volume")


@query
def j12_anomalies(spark, sf):
    q = ProfileParams(high_spread_pct=0.5)
    out = diagnostics.anomalies(e_records(spark, sf, q), q.anomaly_limit)
    return rounded(out.select("asset", "sample_idx", "label", "spread_pct", "anomaly_type"), "spread_pct")


@query
def j13_label_check_levels(spark, sf):
    out = diagnostics.label_check_levels(check_anchors(e_line(spark, sf)), EVENT_PARAMS)
    return rounded(out, "level")


@query
def j14_profile(spark, sf):
    line = stage(l_line(spark, sf), "line")  # read by three branches
    records = stage(train_and_records(line, LINEITEM_PARAMS), "records")
    return rounded(diagnostics.profile(records, line, LINEITEM_PARAMS, PROFILE), "value")


# ---- K: joins ---------------------------------------------------------------


@query
def k1_sample_snapshot_join(spark, sf):
    line = e_line(spark, sf)
    anchors = labels.samples(line, EVENT_PARAMS).select("asset", "sample_idx", "snap_idx", "label")
    joined = anchors.join(line, ["asset", "snap_idx"])
    return joined.groupBy("asset", "label").agg(F.count("*").alias("n"), r6(F.max("mid")).alias("max_mid"))


@query
def k2_sample_features(spark, sf):
    rows = stage(e_samples(spark, sf), "samples")
    timed = features.add_temporal_features(rows.select("asset", "sample_idx", "ts"), ("day_of_week",), (), EVENT_ASSETS)
    joined = rows.select("asset", "sample_idx", "label_up").join(timed.drop("ts"), ["asset", "sample_idx"])
    return joined.groupBy("label_up").agg(F.count("*").alias("n"), r6(F.avg("dow_sin")).alias("mean_dow_sin"))


@query
def k3_sampled_rows(spark, sf):
    series = e_series(spark, sf)
    quotes = diagnostics.depth_quotes(e_book(spark, sf), series, PROFILE.num_samples, EVENT_ASSETS)
    return quotes.groupBy("asset").agg(F.count("*").alias("n"), r6(F.sum("quantity")).alias("quantity"))


@query
def k4_truth_join(spark, sf):
    # the truth comes from the source table, two assets share the same sample numbers
    label = table(spark, sf, "embeddings").select(F.col("vec_id").alias("sample_idx"), F.pmod(F.col("label"), F.lit(K)).cast("int").alias("up"))
    heads = F.array(F.struct(F.lit("up").alias("head"), F.col("up").alias("y")), F.struct(F.lit("down").alias("head"), F.pmod(F.col("up") + 1, F.lit(K)).alias("y")))
    flat = label.select("sample_idx", F.explode(heads).alias("h")).select("sample_idx", "h.head", "h.y")
    shift = F.when(F.col("asset") == "b", 1).otherwise(0)
    truth = flat.select(F.explode(F.array(F.lit("a"), F.lit("b"))).alias("asset"), "*").withColumn("y_true", F.pmod(F.col("y") + shift, F.lit(K))).drop("y")
    preds = predictions(spark, sf).drop("y_true").select(F.explode(F.array(F.lit("a"), F.lit("b"))).alias("asset"), "*")
    found = evaluation.accuracy(evaluation.match_truth(preds, truth), ("asset", "head"))
    return found.select("asset", "head", r6("accuracy").alias("accuracy"), "n")


def daily_totals(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.groupBy(F.col("o_orderdate").alias("ts")).agg(F.round(F.sum("o_totalprice"), 0).alias("total"))


@query
def k6_asof_orders(spark, sf):
    snaps = snapshots(l_book(spark, sf)).withColumn("market", F.lit("all"))
    right = daily_totals(spark, sf).withColumn("market", F.lit("all"))
    out = align.asof_join(snaps, right, ["market"], ["total"], 3 * 86400)
    return out.select("asset", "ts", "matched_ts", "total")


@query
def k6_asof_events(spark, sf):
    snaps = raw_snaps(spark, sf)
    left = snaps.where(F.col("asset") == "view").select("ts", "mid", F.lit(1).alias("k"))
    right = snaps.where(F.col("asset") != "view").select("ts", F.col("mid").alias("other_mid"), F.lit(1).alias("k"))
    out = align.asof_join(left, right, ["k"], ["other_mid"], 300)
    return out.select("ts", "mid", "matched_ts", "other_mid")


@query
def k6_nearest_events(spark, sf):
    snaps = raw_snaps(spark, sf)
    left = snaps.where(F.col("asset") == "view").select("ts", "mid", F.lit(1).alias("k"))
    right = snaps.where(F.col("asset") != "view").select("ts", F.col("mid").alias("other_mid"), F.lit(1).alias("k"))
    out = align.asof_join(left, right, ["k"], ["other_mid"], 300, "nearest")
    return out.select("ts", "mid", "matched_ts", "other_mid")


# ---- L: evaluation ----------------------------------------------------------


@query
def l1_argmax(spark, sf):
    return evaluation.with_prediction(predictions(spark, sf)).select("sample_idx", "head", "y_true", "y_pred")


@query
def l2_accuracy(spark, sf):
    return rounded(evaluation.accuracy(predictions(spark, sf)), "accuracy")


@query
def l3_confusion(spark, sf):
    return evaluation.confusion(predictions(spark, sf), K)


def class_table(spark, sf):
    return evaluation.per_class(evaluation.confusion(predictions(spark, sf), K))


@query
def l4_per_class(spark, sf):
    return rounded(class_table(spark, sf), "precision", "recall", "f1")


@query
def l5_macro(spark, sf):
    return rounded(evaluation.macro(class_table(spark, sf)), "macro_precision", "macro_recall", "macro_f1")


@query
def l6_brier(spark, sf):
    return rounded(evaluation.brier(predictions(spark, sf)), "brier_score")


@query
def l7_reliability(spark, sf):
    return rounded(evaluation.reliability(predictions(spark, sf), BINS), "left_edge", "right_edge", "bin_confidence", "bin_accuracy")


@query
def l8_calibration_error(spark, sf):
    return rounded(evaluation.calibration_error(evaluation.reliability(predictions(spark, sf), BINS)), "ece", "mce")


@query
def l9_shape_report(spark, sf):
    return evaluation.shape_report(predictions(spark, sf), K)


@query
def l10_evaluate(spark, sf):
    return rounded(evaluation.evaluate(predictions(spark, sf), K, BINS), "value")


@query
def l11_weighted_f1(spark, sf):
    return rounded(evaluation.weighted_f1(class_table(spark, sf), 100), "weighted_f1")


@query
def l13_directional_accuracy(spark, sf):
    both = F.explode(F.array(F.lit("a"), F.lit("b"))).alias("asset")
    sign = F.when(F.col("asset") == "b", -1.0).otherwise(1.0)
    moves = table(spark, sf, "embeddings").select(both, F.col("vec_id").alias("sample_idx"), F.element_at("embedding", 9).cast("double").alias("raw"))
    moves = moves.select("asset", "sample_idx", (sign * F.col("raw")).alias("price_change"))
    preds = predictions(spark, sf).select(both, "*")
    return rounded(evaluation.directional_accuracy(preds, moves), "directional_accuracy")


@query
def l14_top_k(spark, sf):
    out = evaluation.top_k_accuracy(predictions(spark, sf), (1, 2, 3))
    return rounded(out, "top_1_accuracy", "top_2_accuracy", "top_3_accuracy", "mean_entropy")


@query
def l15_confidence_histogram(spark, sf):
    return evaluation.confidence_histogram(predictions(spark, sf), BINS)


@query
def l15_class_reliability(spark, sf):
    out = evaluation.reliability(predictions(spark, sf), BINS, per_label=True)
    return rounded(out, "left_edge", "right_edge", "bin_confidence", "bin_accuracy")


TEMPERATURES = (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0)


@query
def l16_temperature_losses(spark, sf):
    return rounded(evaluation.temperature_losses(predictions(spark, sf), TEMPERATURES), "nll")


@query
def l16_temperature_scaling(spark, sf):
    # fitted to the samples of even number, scored on the others
    preds = predictions(spark, sf)
    fitted = evaluation.fit_temperature(preds.where("sample_idx % 2 = 0"), TEMPERATURES)
    return rounded(evaluation.brier(evaluation.apply_temperature(preds.where("sample_idx % 2 = 1"), fitted)), "brier_score")


@query
def l17_isotonic_values(spark, sf):
    preds = stage(predictions(spark, sf), "predictions")
    blocks = calibration.isotonic_blocks(preds.where("sample_idx % 2 = 0"))
    wanted = calibration.class_rows(preds.where("sample_idx % 2 = 1")).select("head", "class", "p")
    return rounded(calibration.isotonic_values(blocks, wanted), "p", "value")


@query
def l17_isotonic(spark, sf):
    preds = stage(predictions(spark, sf), "predictions")
    fitted = calibration.isotonic_calibrate(preds.where("sample_idx % 2 = 0"), preds.where("sample_idx % 2 = 1"), K)
    return rounded(evaluation.brier(fitted), "brier_score")


@query
def l18_band_metrics(spark, sf):
    age = F.expr("sample_idx % 180")
    band = F.when(age < 60, "recent").when(age < 120, "six_months").otherwise("twelve_months")
    preds = predictions(spark, sf).withColumn("band", band)
    by = ("band", "head")
    classes = evaluation.per_class(evaluation.confusion(preds, K, by), by)
    out = evaluation.accuracy(preds, by).join(evaluation.macro(classes, by), list(by))
    return rounded(out, "accuracy", "macro_precision", "macro_recall", "macro_f1")


# ---- M: training as Spark jobs ----------------------------------------------


def model_rows(spark, sf):
    line = e_line(spark, sf)
    p = EVENT_PARAMS
    rows = splits.chronological_split(labels.samples(line, p), labels.sample_counts(line, p), p)
    summary = ml.window_summary(line, p)
    return rows.select("asset", "snap_idx", "sample_idx", "ts", "label_up", "label_down", "split").join(summary, ["asset", "snap_idx"])


@query
def m1_two_head(spark, sf):
    rows = stage(model_rows(spark, sf), "training")
    models = ml.fit_two_head(rows.where(F.col("split") == "train"), ml.WINDOW_FEATURES, K, maxIter=15)
    scored = ml.predict_two_head(models, rows.where(F.col("split") == "test"), K)
    return rounded(evaluation.accuracy(scored), "accuracy")


@query
def m1_window_summary(spark, sf):
    return rounded(ml.window_summary(e_line(spark, sf), EVENT_PARAMS), *ml.WINDOW_FEATURES)


HALF_LIVES = {"weight_7": 7.0, "weight_30": 30.0, "weight_90": 90.0}


@query
def m1_training_weights(spark, sf):
    rows = stage(l_samples(spark, sf), "samples")
    out = ml.training_weights(rows, K, HALF_LIVES, LINEITEM_ASSETS)
    return rounded(out.select("asset", "sample_idx", "weight_up", "weight_down"), "weight_up", "weight_down")


@query
def m1_weighted_heads(spark, sf):
    rows = stage(ml.training_weights(model_rows(spark, sf), K, HALF_LIVES, EVENT_ASSETS), "training")
    models = ml.fit_two_head(rows.where(F.col("split") == "train"), ml.WINDOW_FEATURES, K, weighted=True, maxIter=15)
    scored = ml.predict_two_head(models, rows.where(F.col("split") == "test"), K)
    total = F.sum(F.aggregate("probs", F.lit(0.0), lambda a, p: a + p))
    outside = F.count_if(F.exists("probs", lambda p: (p < 0) | (p > 1) | F.isnan(p)))
    return scored.groupBy("head").agg(F.count("*").alias("n"), F.sum("y_true").alias("label_total"), F.round(total, 6).alias("probability_total"), outside.alias("outside"))


@query
def m2_search(spark, sf):
    rows = splits.expanding_folds(stage(model_rows(spark, sf), "training"), 12, 6, 2, EVENT_ASSETS)
    space = {"regParam": (0.0, 0.01, 0.1), "maxIter": (5, 10)}
    out = ml.search(rows, ml.WINDOW_FEATURES, K, space, 2, 42, "val_up_intensity_accuracy", "maximize")
    return out.select("trial", r6("value").alias("value"), F.col("best").cast("int").alias("best"))


# ---- N: long-term context ---------------------------------------------------


@query
def n1_daily_statistics(spark, sf):
    out = longterm.daily_statistics(e_line(spark, sf)).withColumn("day", F.col("day").cast("timestamp_ntz"))
    return rounded(out, "mid_mean", "mid_std", "mid_skew", "mid_kurtosis", "total_volume")


@query
def n2_trailing_days(spark, sf):
    daily = stage(longterm.daily_statistics(e_line(spark, sf)), "daily")
    history = longterm.trailing_days(daily, ["mid_mean"], 7)
    flat = history.select("asset", F.col("day").cast("timestamp_ntz").alias("anchor_day"), F.posexplode("history").alias("pos", "h"))
    return flat.select("asset", "anchor_day", "pos", F.col("h.day").cast("timestamp_ntz").alias("day"), r6("h.mid_mean").alias("mid_mean"))


@query
def n2_sample_history(spark, sf):
    line = stage(e_line(spark, sf), "line")  # several branches read it
    history = longterm.trailing_days(longterm.daily_statistics(line), ["mid_mean"], 7)
    joined = longterm.attach_history(labels.samples(line, EVENT_PARAMS), history)
    days = F.size("history")
    return joined.groupBy("asset", days.alias("days")).agg(F.count("*").alias("n"))


def daily_table(spark, sf):
    return stage(longterm.daily_returns(e_line(spark, sf), EVENT_PARAMS), "daily")


@query
def n3_daily_returns(spark, sf):
    out = daily_table(spark, sf).withColumn("day", F.col("day").cast("timestamp_ntz"))
    return rounded(out, "close", "volatility", "volume", "daily_return")


@query
def n3_context(spark, sf):
    out = longterm.context(daily_table(spark, sf), 10, 3.0).withColumn("day", F.col("day").cast("timestamp_ntz"))
    return rounded(out, "mean_return", "ew_volatility", "mean_volume")


@query
def n4_regimes(spark, sf):
    out = longterm.regimes(longterm.context(daily_table(spark, sf), 10, 3.0), 0.002, 0.0046)
    flags = [f"is_{r}" for r in longterm.REGIMES]
    return out.select("asset", F.col("day").cast("timestamp_ntz").alias("day"), F.coalesce("regime", F.lit("none")).alias("regime"), *flags)


@query
def n5_context_summary(spark, sf):
    out = longterm.summarize(longterm.context(daily_table(spark, sf), 10, 3.0), ["mean_return", "ew_volatility", "mean_volume"])
    return rounded(out, "mean", "std", "min", "max")

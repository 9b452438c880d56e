"""The asset list is a size hint: it never changes a result, whatever it names."""

import pytest
from pyspark.sql import functions as F

from depthframe.operators import diagnostics, evaluation, features, labels, splits
from depthframe.operators.window import bounded_broadcast
from depthframe.plans.targets import build_line
from depthframe.params import ProfileParams
from depthframe.sources import readers
from tests.conftest import at
from tests.helpers import book, params, snaps

LISTS = (None, ("x",), tuple(f"a{i}" for i in range(100_003)))


@pytest.fixture(scope="module")
def rows(spark):
    data = [(a, i, at(86400 * i), 100.0 + i % 7, 1.0 + i % 3, 101.0 + i % 7, 2.0, 100.5 + i % 7, i % 4, float(i % 5) - 2.0) for a in ("x", "z") for i in range(37)]
    schema = "asset string, sample_idx long, ts timestamp_ntz, bid_price double, bid_quantity double, ask_price double, ask_quantity double, mid double, label int, price_change double"
    return spark.createDataFrame(data, schema).withColumn("snap_idx", F.col("sample_idx")).cache()


def records(rows):
    return diagnostics.records(rows, ProfileParams())


def series(rows, assets):
    return diagnostics.plot_series(records(rows), 1.0, assets)


CASES = {
    "chronological_split": lambda r, a: splits.chronological_split(r, r.groupBy("asset").agg(F.count("*").alias("num_samples")), params(assets=a)),
    "uniform_sample": lambda r, a: splits.uniform_sample(r, r.groupBy("asset").agg(F.count("*").alias("n")), "sample_idx", 5, a),
    "random_sample": lambda r, a: splits.random_sample(r, "sample_idx", 5, 42, a),
    "expanding_folds": lambda r, a: splits.expanding_folds(r, 10, 5, 2, a),
    "age_bands": lambda r, a: splits.age_bands(r, [("new", 0, 10)], a),
    "decay_weights": lambda r, a: splits.decay_weights(r, {"w": 7.0}, a),
    "scaler": lambda r, a: features.apply_scaler(r, features.fit_scaler(r, ["mid"], "standard"), ["mid"], a),
    "temporal": lambda r, a: features.add_temporal_features(r, ("hour_of_day",), ("trend",), a),
    "class_weight": lambda r, a: labels.with_class_weight(r, labels.class_weights(r, "label", 4), "label", 4, a),
    "signed_percentage": lambda r, a: labels.signed_percentage_labels(r, r.select("asset", F.array(F.lit(1.0), F.lit(2.0)).alias("boundaries")).distinct(), 2, a),
    "outliers": lambda r, a: diagnostics.outlier_percent(records(r), ProfileParams(z_threshold=1.0), a),
    "plot_series": series,
    "price_histogram": lambda r, a: diagnostics.price_histogram(records(r), 5, a),
    "spread_time": lambda r, a: diagnostics.spread_time_histogram(series(r, a), 4, 4, a),
    "spread_label": lambda r, a: diagnostics.spread_label_histogram(series(r, a), 4, 4, a),
    "depth_quotes": lambda r, a: diagnostics.depth_quotes(r, series(r, a), 37, a),
    "depth_heatmap": lambda r, a: diagnostics.depth_heatmap(r, series(r, a), None, 4, 4, a),
    "neighbourhood": lambda r, a: diagnostics.neighbourhood(r, r.where("snap_idx = 9"), 1, 2, 2, a),
    "price_sanity": lambda r, a: diagnostics.price_sanity_filter(r, 1.0, a),
    "epoch": lambda r, a: readers.normalize_epoch(r.select("asset", F.when(F.col("asset") == "z", F.lit(1_700_000_000_000)).otherwise(F.lit(1_700_000_000)).alias("raw")), "raw", "out", a),
}


@pytest.mark.parametrize("name", CASES)
def test_list_never_changes_rows(spark, rows, name):
    found = [sorted(map(repr, CASES[name](rows, a).collect())) for a in LISTS]
    assert found[0] == found[1] == found[2]
    assert any("'z'" in r for r in found[0])


def test_hint_only_below_the_row_limit(rows):
    stats = rows.groupBy("asset").count()
    plan = lambda a: rows.join(bounded_broadcast(stats, a), "asset")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(("x",)) and "broadcast" not in plan(None) and "broadcast" not in plan(LISTS[2])


def test_line_is_restricted_once(spark):
    raw = book(spark, [(a, 10 * i, 9, 1, 11, 1, i) for a in ("x", "z") for i in range(4)])
    assert {r.asset for r in build_line(raw, params(assets=("x",))).collect()} == {"x"}
    assert {r.asset for r in build_line(raw, params(assets=None)).collect()} == {"x", "z"}


def test_same_sample_number_in_two_assets(spark):
    data = [(a, i, h, [0.2, 0.8] if (a == "a") == (h == "up") else [0.8, 0.2]) for a in "ab" for i in range(3) for h in ("up", "down")]
    preds = spark.createDataFrame(data, "asset string, sample_idx long, head string, probs array<double>")
    truth = preds.select("asset", "sample_idx", "head", F.when(F.col("asset") == "a", 1).otherwise(0).alias("y_true"))
    assert evaluation.match_truth(preds, truth).count() == 12
    moves = preds.select("asset", "sample_idx", F.when(F.col("asset") == "a", 1.0).otherwise(-1.0).alias("price_change")).distinct()
    found = evaluation.directional_accuracy(preds, moves).first()
    assert (found.directional_accuracy, found.n) == (1.0, 6)


def test_evaluate_refuses_labels_outside(spark):
    bad = spark.createDataFrame([(0, "up", 5, [0.5, 0.5]), (0, "down", 0, [0.5, 0.5])], "sample_idx long, head string, y_true int, probs array<double>")
    with pytest.raises(ValueError):
        evaluation.evaluate(bad, 2, 5)


def test_head_cap_bounds_training_rows_only(spark):
    data = [(s, i) for s in ("train", "test") for i in range(9)]
    capped = splits.head_cap(spark.createDataFrame(data, "split string, split_idx long"), 4)
    assert {(r.split, r["count"]) for r in capped.groupBy("split").count().collect()} == {("train", 4), ("test", 9)}


def test_forward_extremes_take_one_shuffle(spark):
    line = snaps(spark, [("x", 10 * i, 100 + i % 5) for i in range(40)]).withColumn("snap_idx", F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 10) - F.lit(1704067200 // 10))
    plan = labels.forward_extremes(line, params())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1

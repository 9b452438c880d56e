import pytest
from pyspark.sql import functions as F

from depthframe.operators import calibration, diagnostics, evaluation, features, labels, ml, splits
from depthframe.params import ProfileParams
from depthframe.session import stage, stage_dir
from depthframe.sources import readers, writers
from tests.conftest import at
from tests.helpers import book, line, params
from tests.test_profile_evaluation import preds

ROWS = [("x", 0, 100, 1, 101, 2, 0), ("x", 10, 0, 1, 101, 2, 1), ("y", 86399, 50, 1, 51, 2, 2), ("y", 86399.5, 50, 1, 51, 2, 3)]


def test_scan_filters_and_prunes(spark, tmp_path):
    path = str(tmp_path / "book")
    writers.write_book(book(spark, ROWS), path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    out = readers.scan_book(spark, path, "2024-01-01", "2024-01-01", ["x", "y"])
    assert sorted(r.row_id for r in out.collect()) == [0, 2]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters")[1].split("]")[0]
    pushed = plan.split("PushedFilters")[1].split("ReadSchema")[0]
    assert "GreaterThan(bid_price" in pushed and "GreaterThanOrEqual(ts" in pushed
    days = writers.extract_days(spark.read.parquet(path), ["y"], "2024-01-01", "2024-01-01")
    assert days.count() == 2


def test_missing_source_policy(spark, tmp_path):
    path = str(tmp_path / "nothing")
    out = readers.scan_book(spark, path, "2024-01-01", "2024-01-02", on_missing="empty")
    assert out.columns == readers.BOOK_COLUMNS and out.count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.scan_book(spark, path, "2024-01-01", "2024-01-02", on_missing="fail")


def test_per_asset_tables(spark, tmp_path):
    rows = book(spark, ROWS)
    rows.where("asset = 'x'").drop("asset").write.parquet(str(tmp_path / "orderbook_xusd"))
    out = readers.scan_asset_tables(spark, str(tmp_path), "orderbook_", ["XUSD", "GONE"], "2024-01-01", "2024-01-01")
    assert [(r.asset, r.num_samples) for r in readers.row_counts(out).collect()] == [("XUSD", 1)]


def test_typed_rows(spark):
    raw = book(spark, ROWS).withColumn("ask_price", F.when(F.col("row_id") == 2, "oops").otherwise(F.col("ask_price").cast("string")))
    assert readers.typed_rows(raw, "quarantine").count() == 3
    assert [r.row_id for r in readers.rejected_rows(raw).collect()] == [2]
    with pytest.raises(Exception, match="order-book row 2"):
        readers.typed_rows(raw, "fail").collect()
    with pytest.raises(ValueError, match="lack columns"):
        readers.typed_rows(raw.drop("batch_id"), "fail")


@pytest.mark.parametrize("unit, factor", [("seconds", 1), ("milliseconds", 1000), ("microseconds", 10**6), ("nanoseconds", 10**9)])
def test_epoch_units(spark, unit, factor):
    df = spark.createDataFrame([("x", 1704067200 * factor), ("x", 1704067210 * factor)], "asset string, raw long")
    out = readers.normalize_epoch(df, "raw", "ts", ("x",)).orderBy("ts").collect()
    assert [r.ts for r in out] == [at(0), at(10)]
    text = spark.createDataFrame([("2024-01-01T00:00:10",)], "s string").select(readers.normalize_text(F.col("s")).alias("t"))
    assert text.first().t == at(10)


def test_fingerprint_ignores_order_and_partitioning(spark):
    df = spark.range(1000).select("id", (F.col("id") * 0.5).alias("v"))
    a = writers.fingerprint(df).first()
    b = writers.fingerprint(df.repartition(13).orderBy(F.desc("v"))).first()
    c = writers.fingerprint(df.withColumn("v", F.when(F.col("id") == 5, 9.0).otherwise(F.col("v")))).first()
    assert a == b and a.rows == 1000 and a.fingerprint != c.fingerprint


def test_training_set_cache(spark, tmp_path):
    p = params()
    l = line(spark, [100.0 + i % 7 for i in range(60)])
    rows = splits.chronological_split(labels.samples(l, p), labels.sample_counts(l, p), p)
    windows = features.lookback_windows(l, p).join(rows.select("asset", "sample_idx", "label_up", "label_down", "split"), ["asset", "sample_idx"])
    path = writers.write_training_set(stage(windows, "w"), str(tmp_path), "v1")
    back = spark.read.parquet(path)
    assert "/v1/" in path and {r.split for r in back.select("split").distinct().collect()} == {"train", "validation"}
    assert back.count() == rows.where("split <> 'test'").count()


def test_csv_reports(spark, tmp_path):
    p = preds(spark)
    m = evaluation.confusion(p, 3)
    writers.write_confusion_csv(m, str(tmp_path / "cm"), 3)
    text = [f.read_text() for f in (tmp_path / "cm" / "head=up").glob("*.csv")]
    assert text == ["1,0,0\n2,0,0\n0,0,1\n"]
    writers.write_curve_csv(evaluation.reliability(p, 5), str(tmp_path / "curve"))
    (text,) = [f.read_text() for f in (tmp_path / "curve" / "head=up").glob("*.csv")]
    assert text.splitlines()[:2] == ["left_edge,right_edge,bin_confidence,bin_accuracy,bin_count", "0.000000,0.200000,0.100000,0.000000,3"]


def test_record_and_anomaly_csv(spark, tmp_path):
    l = line(spark, [100.0 + i % 7 for i in range(60)])
    recs = diagnostics.records(labels.samples(l, params()), ProfileParams(high_spread_pct=1.9))
    writers.write_record_csv(recs, str(tmp_path / "r"))
    found = diagnostics.anomalies(recs, 5)
    writers.write_anomaly_csv(found, str(tmp_path / "a"))
    back = spark.read.option("header", True).csv(str(tmp_path / "a"))
    assert back.count() == 5 and {r.anomaly_type for r in back.collect()} == {"high_spread"}
    assert set(spark.read.option("header", True).csv(str(tmp_path / "r")).columns) == {"asset", *diagnostics.RECORD_COLUMNS}


def test_metric_table_appends(spark, tmp_path):
    path = str(tmp_path / "m")
    metrics = evaluation.evaluate(preds(spark), 3, 5)
    writers.append_metrics(metrics, path, "evaluation")
    writers.append_metrics(metrics, path, "evaluation", step=2)
    assert spark.read.parquet(path).groupBy("step").count().count() == 2


def test_retention_and_daily_store(spark, tmp_path):
    l = line(spark, [100.0 + i % 7 for i in range(2000)])
    writers.write_retained(l, str(tmp_path / "k"), 0.1, 42)
    assert 120 < spark.read.parquet(str(tmp_path / "k")).count() < 280
    writers.write_daily_store(l, str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "d")).count() == 1


def test_missing_snapshots(spark):
    empty = line(spark, [1.0]).where("false")
    assert features.require_snapshots(empty, "skip").count() == 0
    with pytest.raises(ValueError, match="no snapshots"):
        features.require_snapshots(empty, "fail")


def test_stage_uses_the_session_folder(spark):
    assert stage_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert stage(spark.range(3), "t").count() == 3


def test_two_head_model_contract(spark):
    p = params()
    l = line(spark, [100.0 + 8 * ((i // 9) % 2) + i % 5 for i in range(240)])
    rows = splits.chronological_split(labels.samples(l, p), labels.sample_counts(l, p), p)
    rows = stage(rows.join(ml.window_summary(l, p), ["asset", "snap_idx"]), "t")
    models = ml.fit_two_head(rows.where("split = 'train'"), ml.WINDOW_FEATURES, p.num_classes, maxIter=5)
    scored = ml.predict_two_head(models, rows.where("split = 'test'"), p.num_classes)
    evaluation.check_shapes(scored, p.num_classes, 10)
    calibrated = calibration.isotonic_calibrate(scored, scored, p.num_classes)
    assert calibrated.where(F.abs(F.aggregate("probs", F.lit(0.0), lambda a, b: a + b) - 1) > 1e-9).count() == 0


def test_weights_decide_a_fit(spark):
    rows = [("x", i, i % 2, float(i % 2 == 0 or i > 20), "train", at(86400 * i)) for i in range(40)] + [("x", 40, 3, 0.0, "test", at(86400 * 40))]
    samples = spark.createDataFrame(rows, "asset string, sample_idx int, label_up int, f double, split string, ts timestamp_ntz").withColumn("label_down", F.col("label_up"))
    weighted = ml.training_weights(samples, 4, {"a": 10.0, "b": 20.0}, ("x",))
    assert weighted.columns == [*samples.columns, "weight_up", "weight_down"]
    got = {r.sample_idx: r.weight_up for r in weighted.collect()}
    assert got[40] == 0.0  # a class that no training row has
    assert got[0] == pytest.approx(0.5 * (0.5**4 + 0.5**2) / 2) and got[39] == pytest.approx(0.5 * (0.5**0.1 + 0.5**0.05) / 2)
    heavy = weighted.withColumns({f"weight_{h}": F.when(F.col("label_up") == 1, 100.0).otherwise(0.01) for h in ("up", "down")})
    models = ml.fit_two_head(heavy.where("split = 'train'"), ["f"], 4, weighted=True, maxIter=10)
    assert {max(range(4), key=lambda k: r.probs[k]) for r in ml.predict_two_head(models, heavy, 4).collect()} == {1}
    with pytest.raises(ValueError):
        ml.fit_two_head(heavy, ["f"], 4, "perceptron", weighted=True)


def test_search_marks_one_best_trial(spark):
    p = params()
    l = line(spark, [100.0 + 8 * ((i // 9) % 2) + i % 5 for i in range(200)], step=21600)
    rows = labels.samples(l, params(cadence_seconds=21600, window_seconds=43200, horizon_seconds=43200)).join(ml.window_summary(l, p), ["asset", "snap_idx"])
    folds = splits.expanding_folds(rows, 20, 10, 1, ("x",))
    out = ml.search(
        folds, ml.WINDOW_FEATURES, 4, {"regParam": (0.0, 0.1)}, 2, 1, "accuracy", "maximize"
    )
    assert [r.best for r in out.collect()].count(True) == 1

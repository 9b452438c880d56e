import numpy as np
import pytest

from depthframe.functions.quotes import FLAGS, anomaly_type, any_severe, quality_flags, spread_pct
from depthframe.operators import diagnostics, evaluation
from depthframe.params import ProfileParams
from tests.helpers import params

Q = "asset string, bid_price double, bid_quantity double, ask_price double, ask_quantity double"


def test_flags_and_anomaly_types(spark):
    df = spark.createDataFrame([("x", 105.0, 1.0, 100.0, 1.0), ("x", 90.0, 1.0, 100.0, 1.0), ("x", 100.0, -1.0, 101.0, 0.0), ("x", 0.0, 1.0, 5.0, 1.0)], Q)
    rows = df.withColumns(quality_flags(5.0)).withColumns({"s": spread_pct(), "bad": any_severe()})
    rows = rows.withColumn("kind", anomaly_type()).collect()
    assert [r.kind for r in rows] == ["inverted_spread", "high_spread", "negative_quantity", ""]
    assert [r.bad for r in rows] == [True, True, True, False]
    assert [None if r.s is None else round(r.s, 6) for r in rows] == [-4.878049, 10.526316, 0.995025, None]
    assert rows[3].zero_bid_price and rows[2].zero_ask_quantity and len(FLAGS) == 8


@pytest.mark.parametrize("ones, expected", [(10, 9.090909), (8, 0.0)])
def test_outlier_percent_needs_enough_points(spark, ones, expected):
    df = spark.createDataFrame([("x", 1.0, 1.0, 1.0, 1.0)] * ones + [("x", 100.0, 1.0, 1.0, 1.0)], Q)
    recs = diagnostics.records(df, ProfileParams())
    r = diagnostics.outlier_percent(recs, ProfileParams(), ("x",)).first()
    assert round(r.diag_bid_price_outliers_percent, 6) == expected
    assert r.diag_ask_price_outliers_percent == 0.0


def test_spread_statistics_without_valid_spread_are_zero(spark):
    df = spark.createDataFrame([("x", 0.0, 1.0, 1.0, 1.0)], Q)
    r = diagnostics.spread_statistics(diagnostics.records(df, ProfileParams()), ProfileParams()).first()
    assert (r.diag_spread_mean_pct, r.diag_spread_max_pct, r.diag_spread_fraction_high) == (0.0, 0.0, 0.0)


PREDICTIONS = [
    (0, [0.7, 0.2, 0.1], 0),
    (1, [0.4, 0.4, 0.2], 1),
    (2, [0.1, 0.1, 0.8], 2),
    (3, [0.5, 0.3, 0.2], 1),
]


def preds(spark):
    rows = [(i, h, y, p) for i, p, y in PREDICTIONS for h in ("up", "down")]
    return spark.createDataFrame(rows, "sample_idx long, head string, y_true int, probs array<double>")


def test_classification_metrics_of_the_worked_example(spark):
    p = preds(spark)
    evaluation.check_shapes(p, 3, 5)
    assert {r.accuracy for r in evaluation.accuracy(p).collect()} == {0.5}
    m = evaluation.confusion(p, 3)
    cells = {(r.y_true, r.y_pred): r.n for r in m.where("head = 'up' and n > 0").collect()}
    assert cells == {(0, 0): 1, (1, 0): 2, (2, 2): 1} and m.count() == 18
    c = evaluation.per_class(m).where("head = 'up'").orderBy("class").collect()
    assert [r.precision for r in c] == pytest.approx([1 / 3, 0, 1])
    assert [r.recall for r in c] == [1, 0, 1] and [r.f1 for r in c] == pytest.approx([0.5, 0, 1])
    macro = evaluation.macro(evaluation.per_class(m)).first()
    assert (macro.macro_precision, macro.macro_recall, macro.macro_f1) == pytest.approx((4 / 9, 2 / 3, 0.5))


def test_calibration_of_the_worked_example(spark):
    p = preds(spark)
    assert evaluation.brier(p).first().brier_score == pytest.approx(0.385)
    curve = evaluation.reliability(p, 5).where("head = 'up'").orderBy("bin").collect()
    got = [(r.bin_count, round(r.bin_confidence, 6), round(r.bin_accuracy, 6)) for r in curve]
    assert got == [(3, 0.1, 0.0), (4, 0.225, 0.25), (3, 0.433333, 0.333333), (1, 0.7, 1.0), (1, 0.8, 1.0)]
    assert evaluation.calibration_error(evaluation.reliability(p, 5)).first().ece == pytest.approx(0.1)


def test_reliability_bins_equal_numpy_masks(spark):
    rng = np.random.default_rng(4)
    probs = rng.dirichlet([1, 1, 1, 1], 300)
    probs[:50] = np.round(probs[:50], 1)
    rows = [(i, "up", int(i % 4), [float(x) for x in probs[i]]) for i in range(300)]
    df = spark.createDataFrame(rows, "sample_idx long, head string, y_true int, probs array<double>")
    curve = evaluation.reliability(df, 10).orderBy("bin").collect()
    edges = np.linspace(0.0, 1.0, 11)
    flat = probs.ravel()
    for i, r in enumerate(curve):
        upper = flat <= edges[i + 1] if i == 9 else flat < edges[i + 1]
        assert r.bin_count == int(((flat >= edges[i]) & upper).sum())


def test_evaluate_names_every_metric(spark):
    names = {r.metric for r in evaluation.evaluate(preds(spark), 3, 5).collect()}
    assert len(names) == 2 * (2 + 3 + 9 + 1)
    assert "eval_up_precision_class_2" in names and "eval_down_ece" in names


def test_shape_checks(spark):
    p = preds(spark)
    with pytest.raises(ValueError, match="wrong_size"):
        evaluation.check_shapes(p, 4, 5)
    with pytest.raises(ValueError, match="expected heads"):
        evaluation.check_shapes(p.where("head = 'up'"), 3, 5)
    with pytest.raises(ValueError, match="num_bins"):
        evaluation.check_shapes(p, 3, 0)


def test_temperature_prefers_the_lowest_loss(spark):
    p = preds(spark)
    losses = {(r.head, r.temperature): r.nll for r in evaluation.temperature_losses(p, (0.5, 1.0, 2.0)).collect()}
    best = evaluation.fit_temperature(p, (0.5, 1.0, 2.0)).where("head = 'up'").first()
    assert best.nll == min(v for (h, _), v in losses.items() if h == "up")
    tempered = evaluation.apply_temperature(p, evaluation.fit_temperature(p, (1.0,)))
    assert tempered.where("sample_idx = 0").first().probs == pytest.approx([0.7, 0.2, 0.1])


def test_label_check(spark):
    rows = spark.createDataFrame([(0, 3), (1, 4)], "label_up int, label_down int")
    assert diagnostics.label_range(rows, 4).first().down_outside == 1
    with pytest.raises(ValueError, match="outside"):
        diagnostics.check_labels(rows, 4)
    assert params().num_classes == 4

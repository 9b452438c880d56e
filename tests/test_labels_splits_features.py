import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from depthframe.functions.bins import equal_width_bin
from depthframe.functions.moves import magnitude_bin
from depthframe.operators import features, labels, splits
from depthframe.params import BookParams
from tests.conftest import at
from tests.helpers import line, params

MIDS = [100.0, 101.0, 98.0, 112.0, 100.0, 100.0]


def test_labels_of_the_worked_example(spark):
    rows = labels.samples(line(spark, MIDS), params()).orderBy("sample_idx").collect()
    got = [(r.snap_idx, round(r.max_up_move_pct, 6), round(r.max_down_move_pct, 6), round(r.price_change, 6), r.label, r.label_up, r.label_down) for r in rows]
    assert got == [
        (1, 10.891089, -2.970297, 10.891089, 6, 3, 1),
        (2, 14.285714, 2.040816, 14.285714, 6, 3, 0),
        (3, -10.714286, -10.714286, -10.714286, 0, 0, 3),
    ]


def test_bins_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(2.0,), (2.0000001,), (10.0,), (10.1,)], "x double")
    assert [r[0] for r in df.select(magnitude_bin(F.col("x"), (2.0, 5.0, 10.0))).collect()] == [0, 1, 2, 3]


@pytest.mark.parametrize("horizon, block", [(1, 3), (5, 5), (7, 50), (12, 1)])
def test_forward_extremes_equal_brute_force(spark, horizon, block):
    rng = random.Random(horizon)
    mids = [round(50 + 50 * rng.random(), 3) for _ in range(120)]
    p = params(horizon_seconds=horizon * 10, block_rows=block)
    got = {r.snap_idx: (r.future_high, r.future_low) for r in labels.forward_extremes(line(spark, mids), p).collect()}
    want = {i: (max(mids[i + 1 : i + horizon + 1]), min(mids[i + 1 : i + horizon + 1])) for i in range(len(mids) - horizon)}
    assert got == want


def test_too_short_line_gives_no_sample(spark):
    p = params(window_seconds=40, horizon_seconds=40)
    assert labels.samples(line(spark, MIDS), p).count() == 0
    assert labels.sample_counts(line(spark, MIDS), p).first().num_samples == 0


def test_lookback_window_is_oldest_first(spark):
    r = features.lookback_windows(line(spark, MIDS), params()).where("sample_idx = 0").first()
    assert [w.bid_price for w in r.window] == [99.0, 100.0]


@pytest.mark.parametrize("n, sizes", [(3, (2, 0, 1)), (10, (7, 1, 2)), (20, (14, 3, 3))])
def test_split_sizes(spark, n, sizes):
    rows = spark.range(n).select(F.lit("x").alias("asset"), F.col("id").alias("sample_idx"))
    counts = spark.createDataFrame([("x", n)], "asset string, num_samples long")
    out = splits.chronological_split(rows, counts, params()).orderBy("sample_idx").collect()
    assert tuple(sum(r.split == s for r in out) for s in splits.SPLITS) == sizes
    assert [r.split for r in out] == sorted((r.split for r in out), key=splits.SPLITS.index)


@pytest.mark.parametrize("n, m", [(100, 7), (1000, 97), (50, 50), (10, 20), (101, 2), (37, 1)])
def test_uniform_sample_equals_linspace(spark, n, m):
    rows = spark.range(n).select(F.lit("x").alias("asset"), F.col("id").alias("i"))
    counts = spark.createDataFrame([("x", n)], "asset string, n long")
    got = sorted(r.i for r in splits.uniform_sample(rows, counts, "i", m, ("x",)).collect())
    want = list(range(n)) if m >= n else np.linspace(0, n - 1, m, dtype="int64").tolist()
    assert got == want


def test_random_sample_is_exact_and_stable(spark):
    rows = spark.range(5000).select(F.lit("x").alias("asset"), F.col("id").alias("i"))
    a = sorted(r.i for r in splits.random_sample(rows, "i", 40, 42, ("x",)).collect())
    b = sorted(r.i for r in splits.random_sample(rows.repartition(7), "i", 40, 42, None).collect())
    assert len(a) == 40 and a == b
    assert len(splits.random_sample(rows.limit(5), "i", 40, 42, ("x",)).collect()) == 5


def test_rebalance_factors(spark):
    rows = spark.range(400).select(F.lit("x").alias("asset"), F.col("id").alias("i"), (F.col("id") % 2).alias("c"))
    out = splits.rebalance(rows, "c", {0: 2.0, 1: 0.5}, "i", 1).groupBy("c").count().collect()
    n = {r.c: r["count"] for r in out}
    assert n[0] == 400 and 70 < n[1] < 130
    assert splits.balance_factors({0: 10, 1: 40, 2: 0}, "undersampling") == {0: 1.0, 1: 0.25}


def test_time_features(spark):
    import datetime

    rows = spark.createDataFrame(
        [("x", datetime.datetime(2024, 1, 1, 6, 30)), ("x", datetime.datetime(2024, 1, 3, 20, 0))], "asset string, ts timestamp_ntz"
    )
    out = features.add_temporal_features(rows, ("hour_of_day", "day_of_week", "minute_of_hour"), ("days_since_start", "market_session"), ("x",))
    r = out.orderBy("ts").collect()
    first = [r[0][c] for c in ("hour_sin", "hour_cos", "dow_sin", "dow_cos", "minute_sin", "minute_cos", "days_since_start")]
    assert first == pytest.approx([1, 0, 0, 1, 0, -1, 0], abs=1e-12)
    assert r[1].days_since_start == 2.0 and r[1].market_session == "american"
    assert spark.sql("select weekday(timestamp_ntz'1970-01-01 00:00:00')").first()[0] == 3
    with pytest.raises(ValueError, match="unknown local"):
        features.add_temporal_features(rows, ("week",), (), None)


def test_parameter_checks():
    with pytest.raises(ValueError, match="multiple"):
        params(window_seconds=25)
    with pytest.raises(ValueError, match="sum to 1"):
        params(test_ratio=0.5)
    with pytest.raises(ValueError, match="gap_mode"):
        params(gap_mode="drop")
    assert isinstance(params(), BookParams) and params().num_classes == 4


def test_equal_width_bins_follow_histogram_edges(spark):
    rng = random.Random(5)
    xs = [rng.choice([0.1 * k for k in range(11)] + [rng.random()]) for _ in range(400)] + [0.0, 1.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    b = equal_width_bin(F.col("x"), F.lit(min(xs)), F.lit(max(xs)), 10)
    got = {r.b: r["count"] for r in df.select(b.alias("b")).groupBy("b").count().collect()}
    counts, _ = np.histogram(xs, bins=np.linspace(min(xs), max(xs), 11))
    assert [got.get(i, 0) for i in range(10)] == counts.tolist()


def test_exact_quantiles_equal_numpy(spark):
    rng = random.Random(9)
    xs = [round(rng.gauss(0, 5), 1) for _ in range(501)]
    df = spark.createDataFrame([("x", x) for x in xs] + [("x", None)], "asset string, v double")
    out = features.exact_quantiles(df, ["v"], [0.0, 0.1, 0.5, 0.9, 1.0]).orderBy("probability").collect()
    assert [r.value for r in out] == pytest.approx(np.quantile(xs, [0.0, 0.1, 0.5, 0.9, 1.0]).tolist())


def test_rolling_volatility_equals_brute_force(spark):
    rng = random.Random(2)
    mids = [100 + rng.random() for _ in range(60)]
    rows = line(spark, mids)
    got = {r.snap_idx: r.vol for r in features.rolling_volatility(rows, 70, params()).collect()}
    returns = [None] + [math.log(b / a) for a, b in zip(mids, mids[1:])]
    for i in range(60):
        seen = [returns[j] for j in range(60) if returns[j] is not None and 0 <= (i - j) * 10 <= 70]
        if seen:
            assert got[i] == pytest.approx(np.std(seen), abs=1e-9)
        else:
            assert got[i] is None


def test_scaler_uses_training_rows_only(spark):
    rows = spark.createDataFrame([("x", 0.0, "train"), ("x", 10.0, "train"), ("x", 40.0, "test")], "asset string, v double, split string")
    scaler = features.fit_scaler(rows.where("split = 'train'"), ["v"], "min_max")
    out = features.apply_scaler(rows, scaler, ["v"], ("x",)).orderBy("v").collect()
    assert [r.v for r in out] == [0.0, 1.0, 4.0]


def test_expanding_folds_never_train_on_later_days(spark):
    rows = spark.range(300).select(F.lit("x").alias("asset"), (F.lit(at(0)).cast("timestamp") + F.make_dt_interval(F.col("id").cast("int"))).cast("timestamp_ntz").alias("ts"))
    out = splits.expanding_folds(rows, 100, 50, 3, ("x",))
    ends = out.groupBy("fold", "role").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).collect()
    by = {(r.fold, r.role): r for r in ends}
    for f in range(3):
        assert by[f, "train"].hi < by[f, "validation"].lo

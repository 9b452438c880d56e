import random

import pytest
from pyspark.sql import functions as F

from depthframe.operators import align, depth, longterm
from tests.conftest import at
from tests.helpers import book, line, snaps

LEVELS = [
    ("x", 0, 100, 1, 101, 2, 0),
    ("x", 0, 99, 3, 102, 4, 1),
    ("x", 0, 99, 2, 103, 4, 2),
    ("x", 0, 97, 4, 101, 1, 3),
]


def ranked(spark):
    return depth.ranked_levels(depth.price_levels(book(spark, LEVELS).repartition(3)))


def test_level_ranks_and_cumulative_depth(spark):
    rows = ranked(spark).orderBy("side", "level").collect()
    got = [(r.side, r.level, r.price, r.quantity, r.cumulative_qty) for r in rows]
    assert got == [
        ("ask", 1, 101.0, 3.0, 3.0),
        ("ask", 2, 102.0, 4.0, 7.0),
        ("ask", 3, 103.0, 4.0, 11.0),
        ("bid", 1, 100.0, 1.0, 1.0),
        ("bid", 2, 99.0, 5.0, 6.0),
        ("bid", 3, 97.0, 4.0, 10.0),
    ]


def test_compression_keeps_every_level(spark):
    rows = depth.compress_depth(ranked(spark), 1, 1, 1).where("side = 'bid'").orderBy("bin").collect()
    assert [(r.bin, r.quantity, r.levels) for r in rows] == [(1, 1.0, 1), (2, 9.0, 2)]
    assert rows[1].price == pytest.approx((99 * 5 + 97 * 4) / 9)


def test_feature_grid_pads_with_zeros(spark):
    feats = depth.level_features(ranked(spark))
    grid = depth.feature_grid(feats, 2, ("price_delta_mid", "quantity"), 3, 5).first().grid
    assert grid == [-0.5, 1.0, 0.5, 3.0, 0.0, -1.5, 5.0, 1.5, 4.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]


def test_adaptive_depth_drops_rare_levels(spark):
    assert depth.adaptive_depth(ranked(spark), 2).count() == 0
    assert depth.adaptive_depth(ranked(spark), 1).count() == 6


def test_alignment_and_resampling(spark):
    rows = snaps(spark, [("x", 0, 100), ("x", 9.8, 101), ("x", 10.3, 102), ("x", 31, 104), ("y", 0, 50), ("y", 30, 53)])
    aligned = align.align_to_grid(rows, 10, 500)
    base = int(at(0).replace(tzinfo=__import__("datetime").timezone.utc).timestamp()) // 10
    got = {(r.asset, r.grid_idx - base): r.mid for r in aligned.collect()}
    assert got == {("x", 0): 100.0, ("x", 1): 101.0, ("y", 0): 50.0, ("y", 3): 53.0}
    grid = align.uniform_grid(rows, "x", 10)
    assert grid.count() == 4
    ff = align.resample(grid, aligned, ("x", "y"), "forward_fill", 10, 20, 2)
    x = {r.grid_idx - base: r.mid for r in ff.where("asset = 'x'").collect()}
    assert x == {0: 100.0, 1: 101.0, 2: 101.0, 3: 101.0}
    y = {r.grid_idx - base: r.mid for r in ff.where("asset = 'y'").collect()}
    assert y == {0: 50.0, 1: 50.0, 2: 50.0, 3: 53.0}
    lin = align.resample(grid, aligned, ("x", "y"), "linear", 10, 30, 2)
    y = {r.grid_idx - base: r.mid for r in lin.where("asset = 'y'").collect()}
    assert y == pytest.approx({0: 50.0, 1: 51.0, 2: 52.0, 3: 53.0})
    short = align.resample(grid, aligned, ("y",), "linear", 10, 20, 2)
    assert short.where("mid is null").count() == 2
    report = align.completeness(ff, 2, 2, 2, 0.0, 100)
    assert report.where("kept").count() == 4
    wide = align.stack_assets(ff, ("x", "y"), ["mid"]).orderBy("grid_idx").collect()
    assert (wide[3].mid_x, wide[3].mid_y) == (101.0, 53.0)


@pytest.mark.parametrize("direction", ["backward", "nearest"])
def test_asof_equals_brute_force(spark, direction):
    rng = random.Random(8)
    lefts = [("k" if rng.random() < 0.8 else "j", round(rng.random() * 50, 3)) for _ in range(150)]
    rights = [("k" if rng.random() < 0.8 else "j", round(rng.random() * 50, 3), float(i)) for i in range(60)]
    left = spark.createDataFrame([(k, at(t)) for k, t in lefts], "k string, ts timestamp_ntz")
    right = spark.createDataFrame([(k, at(t), v) for k, t, v in rights], "k string, ts timestamp_ntz, v double")
    got = align.asof_join(left, right, ["k"], ["v"], 2, direction).collect()
    assert len(got) == len(lefts)
    for r in got:
        near = [(t, v) for k, t, v in rights if k == r.k and abs((at(t) - r.ts).total_seconds()) <= 2]
        if direction == "backward":
            near = [(t, v) for t, v in near if at(t) <= r.ts]
        if not near:
            assert r.v is None
            continue
        size = min(abs((at(t) - r.ts).total_seconds()) for t, _ in near)
        assert abs((r.matched_ts - r.ts).total_seconds()) == pytest.approx(size)


@pytest.mark.parametrize("direction", ["backward", "nearest"])
def test_asof_hot_key_ties_and_nulls(spark, direction):
    """One key over many partitions, repeated times on both sides, a null key and a null time."""
    rng = random.Random(11)
    lefts = [("hot", rng.randrange(0, 400_000, 250)) for _ in range(1500)] + [("hot", 7_000)] * 500 + [(None, 7_000), ("hot", None)]
    rights = [("hot", rng.randrange(0, 400_000, 125), float(i)) for i in range(300)] + [("hot", 7_125, 5.0), ("hot", 7_125, 6.0), (None, 7_000, 1.0), ("hot", None, 2.0)]
    when = lambda ms: None if ms is None else at(ms / 1000)
    left = spark.createDataFrame([(k, when(t)) for k, t in lefts], "k string, ts timestamp_ntz").repartition(32)
    right = spark.createDataFrame([(k, when(t), v) for k, t, v in rights], "k string, ts timestamp_ntz, v double").repartition(16)
    out = align.asof_join(left, right, ["k"], ["v"], 1, direction)
    best = {}
    for _, t, v in (r for r in rights if r[0] and r[1] is not None):
        best[t] = max(v, best.get(t, v))

    def expected(k, t):
        if k is None or t is None:
            return None
        near = [r for r in best if abs(r - t) <= 1000 and (direction == "nearest" or r <= t)]
        return best[min(near, key=lambda r: (abs(r - t), r))] if near else None

    got = sorted((str(r.k), str(r.ts), str(r.v)) for r in out.collect())
    assert got == sorted((str(k), str(when(t)), str(expected(k, t))) for k, t in lefts)


@pytest.mark.parametrize("direction", ["backward", "nearest"])
def test_asof_builds_the_merged_frame_once(spark, direction, tmp_path):
    for side in ("left", "right"):
        spark.range(20).selectExpr("'a' as k", "timestamp_ntz '2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id) as ts", "id as v").write.parquet(str(tmp_path / side))
    left, right = (spark.read.parquet(str(tmp_path / side)) for side in ("left", "right"))
    out = align.asof_join(left.select("k", "ts"), right, ["k"], ["v"], 3, direction)
    assert out.count() == 20
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 3  # the merged frame, and the left rows that it is joined to


def test_daily_statistics_and_history(spark):
    rows = line(spark, [100.0, 102.0, 104.0, 110.0, 90.0, 95.0], step=43200)
    daily = longterm.daily_statistics(rows).orderBy("day").collect()
    assert [(r.n, r.mid_mean) for r in daily] == [(2, 101.0), (2, 107.0), (2, 92.5)]
    history = longterm.trailing_days(longterm.daily_statistics(rows), ["mid_mean"], 2).orderBy("day").collect()
    assert [[h.mid_mean for h in r.history] for r in history] == [[], [101.0], [101.0, 107.0]]


def test_ewma_weights_newest_most(spark):
    df = spark.createDataFrame([([(1.0,), (4.0,)],)], "h array<struct<v:double>>")
    assert df.select(longterm.ewma(F.col("h"), "v", 1.0)).first()[0] == pytest.approx((0.5 * 1 + 4) / 1.5)


def test_regime_tags(spark):
    df = spark.createDataFrame([(0.02, 0.1), (-0.02, 0.1), (0.0, 0.1), (0.02, 0.9), (None, 0.1)], "mean_return double, ew_volatility double")
    assert [r.regime for r in longterm.regimes(df, 0.01, 0.5).collect()] == ["bull", "bear", "sideways", "high_volatility", None]

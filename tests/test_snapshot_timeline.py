import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from depthframe.operators import timeline
from depthframe.operators.snapshot import snapshots, top_of_book
from depthframe.operators.window import banded_sums, block_window, dense_index, halo, prefix_offsets, value_bands
from depthframe.plans.targets import build_line, build_targets
from tests.conftest import at
from tests.helpers import book, line, params, snaps

TIES = [
    ("x", 10, 100, 1, 101, 2, 0),
    ("x", 10, 100, 5, 100.5, 3, 1),
    ("x", 10, 99, 9, 100.5, 7, 2),
    ("x", 20, 0, 1, 102, 1, 3),
    ("x", 20, 101, -1, 103, 1, 4),
    ("x", 30, 101, 0, 102, 0, 5),
]


def test_best_quotes_keep_first_row_of_a_tie(spark):
    rows = snapshots(book(spark, TIES).repartition(5)).orderBy("ts").collect()
    got = [(r.ts, r.bid_price, r.bid_quantity, r.ask_price, r.ask_quantity, r.mid) for r in rows]
    assert got == [(at(10), 100.0, 1.0, 100.5, 3.0, 100.25), (at(30), 101.0, 0.0, 102.0, 0.0, 101.5)]


def test_same_row_id_falls_back_to_lowest_quantity(spark):
    rows = [("x", 0, 100, q, 101, q, 7) for q in (5, 2, 9)]
    r = top_of_book(book(spark, rows).repartition(3)).first()
    assert (r.bid_quantity, r.ask_quantity) == (2.0, 2.0)


def test_hot_snapshot_is_aggregated_before_the_shuffle(spark):
    hot = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, "x").otherwise(F.concat(F.lit("a"), F.col("id") % 50)).alias("asset"),
        F.lit(at(0)).cast("timestamp_ntz").alias("ts"),
        (100 + F.col("id") % 7).cast("double").alias("bid_price"),
        F.lit(1.0).alias("bid_quantity"),
        (110 + F.col("id") % 7).cast("double").alias("ask_price"),
        F.lit(1.0).alias("ask_quantity"),
        F.col("id").alias("row_id"),
    )
    out = top_of_book(hot)
    assert "partial_max" in out._jdf.queryExecution().executedPlan().toString()
    assert out.where("asset = 'x'").first().bid_price == 106.0


GAPS = [("x", 0, 100), ("x", 10, 101), ("x", 35, 106), ("x", 100, 110)]


@pytest.mark.parametrize(
    "mode, expected",
    [
        ("skip", [(0, 100.0), (10, 101.0), (35, 106.0), (100, 110.0)]),
        ("forward_fill", [(0, 100.0), (10, 101.0), (20, 101.0), (35, 106.0), (100, 110.0)]),
        ("interpolate", [(0, 100.0), (10, 101.0), (20, 103.5), (35, 106.0), (100, 110.0)]),
    ],
)
def test_gap_modes(spark, mode, expected):
    filled = timeline.fill_gaps(timeline.index_snapshots(snaps(spark, GAPS)), params(gap_mode=mode))
    rows = filled.orderBy("snap_idx").collect()
    assert [(r.ts, r.mid) for r in rows] == [(at(s), m) for s, m in expected]
    assert [r.snap_idx for r in rows] == list(range(len(expected)))


def test_gap_report_and_statistics(spark):
    indexed = timeline.index_snapshots(snaps(spark, GAPS))
    r = timeline.gap_report(indexed, params()).first()
    assert (r.max_gap_seconds, r.min_gap_seconds, r.within_limit) == (65, 10, False)
    with pytest.raises(ValueError, match="65 s"):
        timeline.check_gaps(indexed, params(), "fail")
    filled = timeline.fill_gaps(indexed, params())
    s = timeline.gap_statistics(filled, params(), 2.0, 6.0).first()
    assert (s.diag_gap_max_seconds, s.diag_gap_fraction_large, s.diag_gap_fraction_very_large) == (65.0, 0.25, 0.25)


def test_sub_second_times_are_truncated_and_stay_apart(spark):
    rows = snaps(spark, [("x", 0.25, 100), ("x", 0.75, 101), ("x", 10.5, 102)])
    out = timeline.fill_gaps(timeline.index_snapshots(rows), params()).orderBy("snap_idx").collect()
    assert [(r.ts, r.mid) for r in out] == [(at(0), 100.0), (at(0), 101.0), (at(10), 102.0)]


def test_fill_modes_insert_the_same_times(spark):
    rng = random.Random(3)
    t, rows = 0, []
    for i in range(200):
        t += rng.choice([10, 10, 10, 20, 30, 47, 90])
        rows.append((("x", "y")[i % 2], t, 100 + rng.random()))
    indexed = timeline.index_snapshots(snaps(spark, rows))
    a = timeline.fill_gaps(indexed, params(gap_mode="forward_fill")).select("asset", "snap_idx", "ts", "is_filled")
    b = timeline.fill_gaps(indexed, params()).select("asset", "snap_idx", "ts", "is_filled")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert a.where("is_filled").count() > 0


@pytest.mark.parametrize("bucket_seconds", [1, 300, 10_000_000])
def test_positions_equal_row_number_with_a_hot_asset(spark, bucket_seconds):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 5)).alias("asset"),
        F.timestamp_seconds(F.xxhash64("id") % 1_000_000 / 7.0).cast("timestamp_ntz").alias("ts"),
        "id",
    ).dropDuplicates(["asset", "ts"])
    got = dense_index(df, "pos", bucket_seconds)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("asset").orderBy("ts")) - 1)
    assert got.count() == df.count()
    assert want.select("asset", "ts", "pos").exceptAll(got.select("asset", "ts", F.col("pos").cast("int"))).isEmpty()


def test_prefix_offsets(spark):
    df = spark.range(300).select((F.col("id") % 2).alias("asset"), (F.col("id") * 7 - 900).alias("b"), (F.col("id") % 13).alias("v"), F.lit(1).alias("one"))
    before = Window.partitionBy("asset").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("asset", "b", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(n) for n, c in (("x", "v"), ("y", "one"))])
    got = prefix_offsets(df, "b", {"x": "v", "y": "one"})
    assert got.count() == 300 and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("mode", ["forward_fill", "interpolate", "skip"])
def test_plans_write_no_file(spark, mode, monkeypatch, tmp_path):
    """The labelled samples of a book are a plan: nothing is staged and no job has run when it is built."""
    monkeypatch.setattr("depthframe.session.stage_dir", lambda s: pytest.fail("staged"))
    spark.sparkContext.setJobGroup("plan", "plan")
    rows = [("x", 10 * i + (40 if i > 20 else 0), 100 + i % 7, 1, 102 + i % 7, 1, i) for i in range(60)]
    out = build_targets(book(spark, rows), params(gap_mode=mode, block_rows=3))
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("plan") == []
    spark.sparkContext.setJobGroup("run", "run")
    # 60 snapshots and one gap of 50 s, of which four steps are missing
    assert out.count() == 60 + (0 if mode == "skip" else 4) - 2 - 1


@pytest.mark.parametrize("before, after, block", [(0, 5, 7), (11, 0, 16), (3, 4, 1), (1, 1, 1000)])
def test_halo_window_equals_plain_window(spark, before, after, block):
    df = spark.range(500).select(
        F.concat(F.lit("a"), F.col("id") % 2).alias("asset"), F.floor(F.col("id") / 2).alias("i"), (F.rand(7) * 100).alias("v")
    ).cache()
    frame = Window.partitionBy("asset").orderBy("i").rowsBetween(-before, after)
    plain = df.select("asset", "i", F.collect_list("v").over(frame).alias("w"))
    cells = halo(df, "i", before, after, block)
    blocked = cells.withColumn("w", F.collect_list("v").over(block_window("i").rowsBetween(-before, after)))
    blocked = blocked.where("_own").select("asset", "i", "w")
    assert blocked.count() == 500
    assert plain.exceptAll(blocked).isEmpty()


def test_banded_sums_equal_plain_window(spark):
    df = spark.range(3000).select(
        (F.col("id") % 3 > 0).cast("int").alias("k"), ((F.xxhash64("id") % 100000) / 7.0).alias("x"), (F.col("id") % 11).alias("v")
    ).dropDuplicates(["k", "x"])
    w = Window.partitionBy("k").orderBy("x")
    want = df.select("k", "x", (F.row_number().over(w) - 1).cast("long").alias("r"), F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("s"))
    got = banded_sums(df, ["k"], "x", {"r": None, "s": F.col("v")}).select("k", "x", "r", "s")
    assert got.count() == df.count()
    assert want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("values", ["rand(3) * 1e-5 + 2e-5", "exp(rand(3) * 20.7)", "-1e6 * rand(3)", "case when id % 50 = 0 then id * 1e7 else id / 7e9 end"])
def test_bands_are_of_about_equal_size(spark, values):
    """Also for values that are nearly equal, and for a spread of 1e9."""
    df = spark.range(40000).selectExpr("id % 2 as k", f"{values} as x").dropDuplicates(["k", "x"]).cache()
    sizes = [r["count"] for r in value_bands(df, df.select("k").distinct(), ["k"], "x", 32).groupBy("k", "_band").count().collect()]
    assert len(sizes) == 64 and max(sizes) < 1.3 * df.count() / 64
    w = Window.partitionBy("k").orderBy("x")
    want = df.select("k", "x", (F.row_number().over(w) - 1).cast("long").alias("r"))
    got = banded_sums(df, ["k"], "x", {"r": None}, {"r": "n"}, band_rows=100, bands=32)
    assert got.select("n").distinct().collect()[0].n == df.count() // 2
    assert want.exceptAll(got.select("k", "x", "r")).isEmpty()


def test_small_and_large_groups(spark):
    df = spark.range(9000).selectExpr("case when id % 3 > 0 then -1 else id % 600 end as k", "id * 0.37 - 500 as x", "id % 11 as v")
    w = Window.partitionBy("k").orderBy("x")
    want = df.select("k", "x", (F.row_number().over(w) - 1).cast("long").alias("r"), F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("s"), F.sum("v").over(Window.partitionBy("k")).alias("t"))
    got = banded_sums(df, ["k"], "x", {"r": None, "s": F.col("v")}, {"s": "t"}, band_rows=500, bands=16)
    assert got.count() == 9000
    assert want.exceptAll(got.select("k", "x", "r", "s", "t")).isEmpty()


def test_source_order(spark):
    rows = [("x", 0, 1, 1, 2, 1, 0), ("x", 10, 1, 1, 2, 1, 1), ("x", 5, 1, 1, 2, 1, 70000), ("y", 3, 1, 1, 2, 1, 2)]
    out = {r.asset: (r.min_step_seconds, r.monotonic) for r in timeline.source_order_report(book(spark, rows)).collect()}
    assert out == {"x": (-5, False), "y": (None, True)}


def test_line_of_a_book(spark):
    rows = [("x", 10 * i, 100 + i, 1, 102 + i, 1, i) for i in range(5)]
    out = build_line(book(spark, rows), params(), on_gap="fail")
    assert [r.mid for r in out.orderBy("snap_idx").collect()] == [101.0, 102.0, 103.0, 104.0, 105.0]
    empty = build_line(book(spark, []), params())
    assert empty.count() == 0


def test_line_helper_is_dense(spark):
    assert line(spark, [1.0, 2.0]).count() == 2

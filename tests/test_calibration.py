import random

import pytest
from pyspark.sql import functions as F

from depthframe.operators import calibration

SCHEMA = "sample_idx long, head string, y_true int, probs array<double>"


def sample(n, seed, steps):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        p = rng.randrange(steps) / steps
        rows.append((i, rng.choice(["up", "down"]), int(rng.random() < p * 0.7 + 0.1), [1 - p, p]))
    return rows


def min_max(points):
    """Isotonic fit of (p, hit): the greatest least mean, quadratic."""
    ps = sorted({p for p, _ in points})
    fit = {}
    for q in ps:
        best = None
        for a in (x for x in ps if x <= q):
            least = min(sum(h for p, h in points if a <= p <= b) / sum(1 for p, _ in points if a <= p <= b) for b in ps if b >= q)
            best = least if best is None else max(best, least)
        fit[q] = best
    return fit


def interpolated(fit, p):
    below, above = [x for x in fit if x <= p], [x for x in fit if x >= p]
    if not below or not above:
        return fit[min(fit) if not below else max(fit)]
    lo, hi = max(below), min(above)
    return fit[lo] if lo == hi else fit[lo] + (fit[hi] - fit[lo]) * (p - lo) / (hi - lo)


@pytest.mark.parametrize("band_rows", [4, 65536])
def test_fit_and_values_equal_the_min_max_form(spark, band_rows):
    rows = sample(300, 3, 37)
    holdout = spark.createDataFrame(rows, SCHEMA).repartition(9)
    asked = spark.createDataFrame(sample(120, 4, 101) + [(0, "up", 0, [float("nan"), None])], SCHEMA)
    wanted = calibration.class_rows(asked).select("head", "class", "p")
    got = calibration.isotonic_values(calibration.isotonic_blocks(holdout), wanted, band_rows).collect()
    assert len(got) == wanted.distinct().count()
    for head in ("up", "down"):
        for k in (0, 1):
            fit = min_max([(r[3][k], int(r[2] == k)) for r in rows if r[1] == head])
            for r in (r for r in got if (r.head, r["class"]) == (head, k)):
                assert r.value == pytest.approx(interpolated(fit, r.p), abs=1e-12)


def test_blocks_do_not_depend_on_partitions(spark):
    holdout = spark.createDataFrame(sample(400, 5, 400), SCHEMA)
    blocks = lambda df: sorted(map(tuple, calibration.isotonic_blocks(df).collect()))
    assert blocks(holdout.coalesce(1)) == blocks(holdout.repartition(17))
    falling = [(i, "up", int(i < 50), [i / 100.0]) for i in range(100)]  # one block from all ranges
    assert [(r.lo, r.hi, r.hits, r.n) for r in calibration.isotonic_blocks(spark.createDataFrame([(i, h, 1 - y, p) for i, h, y, p in falling], SCHEMA)).collect()] == [(0.0, 0.99, 50, 100)]


def test_calibrated_rows_are_kept_whole(spark):
    """Equal rows, a class without hold-out, null and NaN probabilities, no hold-out at all, extra columns."""
    holdout = spark.createDataFrame([(0, "up", 1, [0.3, 0.7]), (1, "up", 0, [0.6, 0.4])], SCHEMA)
    rows = spark.createDataFrame(
        [(0, "up", 1, [0.5, 0.5])] * 2 + [(1, "up", 0, [float("nan"), None]), (2, "down", 0, [0.2, 0.8]), (3, "up", 0, [0.9]), (4, "up", 0, None)], SCHEMA
    ).withColumn("value", F.lit("own"))
    out = calibration.isotonic_calibrate(holdout, rows, 2).orderBy("sample_idx").collect()
    assert [r.sample_idx for r in out] == [0, 0, 1, 2, 3, 4] and {r.value for r in out} == {"own"}
    assert out[0].probs == pytest.approx([2 / 3, 1 / 3])
    assert out[2].probs == [0.5, 0.5] and out[3].probs == pytest.approx([0.2, 0.8])
    assert out[4].probs == [1.0, 0.0] and out[5].probs == [0.5, 0.5]
    unfitted = calibration.isotonic_calibrate(holdout.limit(0), rows.where("sample_idx = 0"), 2).collect()
    assert [r.probs for r in unfitted] == [[0.5, 0.5]] * 2

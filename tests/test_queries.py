"""Registered queries against their SQL on the smallest tables."""

import pytest

import __spark_entry__ as driver
from checks.compare import compare, duck
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
CHOSEN = (
    "a1_scan_book",
    "b7_quality_flags",
    "c1_top_of_book_unfiltered",
    "c4_compress_depth",
    "d6_interpolate",
    "d10_resample_linear",
    "e7_rolling_volatility",
    "f5_targets",
    "g5_temporal_features",
    "h7_scale_robust",
    "i2_uniform_sample",
    "j14_profile",
    "k6_nearest_events",
    "l10_evaluate",
    "n3_context",
)


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    without = set(QUERIES) - set(ORACLES)
    assert without == {"m1_two_head", "m2_search"}


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, name):
    result = compare(spark, duck(SF), SF, name, driver.queries()[name], driver.oracle_sql()[name])
    assert result.startswith("ok"), result

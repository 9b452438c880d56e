from pyspark.sql import DataFrame, SparkSession

from depthframe.params import BookParams
from depthframe.sources.readers import BOOK_SCHEMA
from tests.conftest import at

SNAP = "asset string, ts timestamp_ntz, bid_price double, bid_quantity double, ask_price double, ask_quantity double, mid double"


def params(**changes) -> BookParams:
    base = dict(
        cadence_seconds=10,
        window_seconds=20,
        horizon_seconds=20,
        boundaries=(2.0, 5.0, 10.0),
        max_gap_seconds=60,
        gap_mode="interpolate",
        assets=("x", "y"),
        block_rows=4,
    )
    return BookParams(**{**base, **changes})


def book(spark: SparkSession, rows) -> DataFrame:
    """rows of (asset, seconds, bid, bid_q, ask, ask_q, row_id)"""
    data = [(a, at(s), float(b), float(bq), float(k), float(kq), 0, i) for a, s, b, bq, k, kq, i in rows]
    return spark.createDataFrame(data, BOOK_SCHEMA)


def snaps(spark: SparkSession, rows) -> DataFrame:
    """rows of (asset, seconds, mid); quotes one unit around the mid"""
    data = [(a, at(s), m - 1.0, 1.0, m + 1.0, 2.0, float(m)) for a, s, m in rows]
    return spark.createDataFrame(data, SNAP)


def line(spark: SparkSession, mids, asset="x", step=10) -> DataFrame:
    data = [(asset, i, at(i * step), m - 1.0, 1.0, m + 1.0, 2.0, float(m)) for i, m in enumerate(mids)]
    return spark.createDataFrame(data, SNAP.replace("asset string,", "asset string, snap_idx long,"))

import pytest
from pyspark.sql import functions as F

from depthframe.operators.snapshot import top_of_book
from depthframe.sources.readers import BOOK_SCHEMA
from depthframe.streaming.book import run_to_end, stream_top_of_book
from tests.helpers import book


def rows(first, last):
    return [("x" if i % 2 else "y", 10 * (i // 4), 100 + i % 5, i % 7, 110 - i % 3, i % 4, i) for i in range(first, last)]


@pytest.fixture
def folders(tmp_path):
    return [str(tmp_path / name) for name in ("in", "out", "check")]


def test_closed_snapshots_equal_the_batch(spark, folders):
    source, out, check = folders
    first, second = book(spark, rows(0, 200)), book(spark, rows(200, 400))
    first.coalesce(1).write.mode("append").parquet(source)
    stream = stream_top_of_book(spark.readStream.schema(BOOK_SCHEMA).parquet(source), "60 seconds")
    assert run_to_end(stream, out, check) == 0
    closed = top_of_book(first).where("ts <= timestamp_ntz'2024-01-01 00:07:10'")  # newest 8:10, less 60 s
    assert sorted(spark.read.parquet(out).collect()) == sorted(closed.collect())
    # the open snapshots are state: rows of both runs meet in them
    second.union(book(spark, [("x", 480, 500, 1, 90, 1, -1)])).coalesce(1).write.mode("append").parquet(source)
    assert run_to_end(stream, out, check) == 0
    every = top_of_book(spark.read.schema(BOOK_SCHEMA).parquet(source)).where("ts <= timestamp_ntz'2024-01-01 00:15:30'")
    got = spark.read.parquet(out)
    assert sorted(got.collect()) == sorted(every.collect())
    assert got.where("bid_price = 500").count() == 1


def test_late_rows_are_counted(spark, folders):
    source, out, check = folders
    book(spark, rows(0, 200)).coalesce(1).write.mode("append").parquet(source)
    stream = stream_top_of_book(spark.readStream.schema(BOOK_SCHEMA).parquet(source), "60 seconds")
    run_to_end(stream, out, check)
    before = spark.read.parquet(out).count()
    book(spark, [("x", 0, 900, 1, 901, 1, 7), ("y", 5, 900, 1, 901, 1, 8)]).coalesce(1).write.mode("append").parquet(source)
    assert run_to_end(stream, out, check) == 2
    assert spark.read.parquet(out).count() == before
    assert spark.read.parquet(out).where(F.col("bid_price") == 900).count() == 0

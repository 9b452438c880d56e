"""Order-book scans. Everything stays lazy; Spark pushes the filters to the files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depthframe.functions.clock import epoch_unit, from_epoch
from depthframe.operators.window import with_scalars
from depthframe.session import require_utc

BOOK_SCHEMA = T.StructType(
    [
        T.StructField("asset", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("bid_price", T.DoubleType()),
        T.StructField("bid_quantity", T.DoubleType()),
        T.StructField("ask_price", T.DoubleType()),
        T.StructField("ask_quantity", T.DoubleType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("row_id", T.LongType()),
    ]
)
BOOK_COLUMNS = [f.name for f in BOOK_SCHEMA]
NUMERIC = ["bid_price", "bid_quantity", "ask_price", "ask_quantity"]


def book_rows(
    book: DataFrame, start_date: str, end_date: str, assets: Sequence[str] | None = None
) -> DataFrame:
    """Book columns between start 00:00:00 and end 23:59:59, both prices positive.

    The end bound is the last whole second, so its sub-second tail is not read.
    A table stored with an ``event_date`` partition column is pruned by date.
    """
    require_utc(book.sparkSession)
    rows = book
    if "event_date" in book.columns:
        rows = rows.where(F.col("event_date").between(F.lit(start_date).cast("date"), F.lit(end_date).cast("date")))
    first = F.lit(f"{start_date} 00:00:00").cast("timestamp_ntz")
    last = F.lit(f"{end_date} 23:59:59").cast("timestamp_ntz")
    rows = rows.where(F.col("ts").between(first, last))
    rows = rows.where((F.col("bid_price") > 0) & (F.col("ask_price") > 0))
    if assets is not None:
        rows = rows.where(F.col("asset").isin(*assets))
    return rows.select(*BOOK_COLUMNS)


def _read(spark: SparkSession, path: str, on_missing: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as err:
        if on_missing == "fail" or err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], BOOK_SCHEMA)


def scan_book(
    spark: SparkSession,
    path: str,
    start_date: str,
    end_date: str,
    assets: Sequence[str] | None = None,
    on_missing: str = "fail",
) -> DataFrame:
    """Scan one parquet table that holds all assets.

    ``on_missing="empty"`` gives an empty book for a path without a table.
    """
    if on_missing not in ("fail", "empty"):
        raise ValueError("on_missing must be 'fail' or 'empty'")
    return book_rows(_read(spark, path, on_missing), start_date, end_date, assets)


def asset_table(prefix: str, asset: str) -> str:
    return f"{prefix}{asset.lower()}"


def scan_asset_tables(
    spark: SparkSession,
    root: str,
    prefix: str,
    assets: Sequence[str],
    start_date: str,
    end_date: str,
    on_missing: str = "empty",
) -> DataFrame:
    """Scan one table per asset (prefix + lower-case symbol) as a single book."""
    if on_missing not in ("fail", "empty"):
        raise ValueError("on_missing must be 'fail' or 'empty'")
    out = None
    for asset in assets:
        table = _read(spark, f"{root.rstrip('/')}/{asset_table(prefix, asset)}", on_missing)
        table = book_rows(table.withColumn("asset", F.lit(asset)), start_date, end_date)
        out = table if out is None else out.unionByName(table)
    if out is None:
        raise ValueError("assets must not be empty")
    return out


def route_assets(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Union per-asset frames under their asset name, in the order given."""
    out = None
    for asset, table in tables.items():
        table = table.withColumn("asset", F.lit(asset))
        out = table if out is None else out.unionByName(table)
    if out is None:
        raise ValueError("tables must not be empty")
    return out


def row_counts(book: DataFrame) -> DataFrame:
    return book.groupBy("asset").agg(F.count("*").alias("num_samples"))


def _unparsable() -> Column:
    out = F.lit(False)
    for name in NUMERIC:
        out = out | F.col(name).try_cast("double").isNull()
    return out


def check_width(raw: DataFrame) -> None:
    needed = ["ts", *NUMERIC, "batch_id"]
    missing = [c for c in needed if c not in raw.columns]
    if missing:
        raise ValueError(f"order-book rows lack columns {missing}")


def typed_rows(raw: DataFrame, on_bad: str) -> DataFrame:
    """Cast prices and quantities to double.

    ``on_bad="fail"`` raises at run time and names the row; ``"quarantine"``
    leaves bad rows out (``rejected_rows`` returns them).
    """
    check_width(raw)
    if on_bad == "quarantine":
        return raw.where(~_unparsable()).withColumns({c: F.col(c).try_cast("double") for c in NUMERIC})
    if on_bad != "fail":
        raise ValueError("on_bad must be 'fail' or 'quarantine'")
    message = F.concat(F.lit("cannot parse price or quantity of order-book row "), F.col("row_id").cast("string"))
    bad = _unparsable()
    return raw.withColumns(
        {c: F.when(bad, F.raise_error(message).cast("double")).otherwise(F.col(c).try_cast("double")) for c in NUMERIC}
    )


def rejected_rows(raw: DataFrame) -> DataFrame:
    check_width(raw)
    return raw.where(_unparsable())


def normalize_epoch(
    df: DataFrame, raw: str, out: str, assets: Sequence[str] | None = None
) -> DataFrame:
    """Epoch numbers to timestamps; the unit comes from each asset's smallest value."""
    first = df.groupBy("asset").agg(F.min(raw).alias("_first"))
    joined = with_scalars(df, first.select("asset", epoch_unit(F.col("_first")).alias("_unit")), assets)
    return joined.withColumn(out, from_epoch(F.col(raw), F.col("_unit"))).drop("_unit")


def normalize_text(raw: Column) -> Column:
    """ISO text to a timestamp."""
    return raw.cast("timestamp_ntz")

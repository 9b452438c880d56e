"""Top-of-book snapshots from tall order-book rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthframe.functions.quotes import mid_price, valid_ask, valid_bid


def top_of_book(book: DataFrame) -> DataFrame:
    """Best bid and best ask with their quantities, per (asset, ts).

    One aggregation with map-side partial results. The sides are independent
    within a row; equal prices keep the row with the lowest ``row_id``, then the
    lowest quantity. ``ts`` leads the grouping so that its value, not the few
    asset names, is the sort prefix of the aggregation.
    """
    bid = F.struct("bid_price", -F.col("row_id"), -F.col("bid_quantity"))
    ask = F.struct("ask_price", "row_id", "ask_quantity")
    best = book.groupBy("ts", "asset").agg(
        F.max(F.when(valid_bid(), bid)).alias("bid"),
        F.min(F.when(valid_ask(), ask)).alias("ask"),
    )
    return best.select(
        "asset",
        "ts",
        F.col("bid.bid_price").alias("bid_price"),
        (-F.col("bid.col3")).alias("bid_quantity"),
        F.col("ask.ask_price").alias("ask_price"),
        F.col("ask.ask_quantity").alias("ask_quantity"),
    )


def assemble(best: DataFrame) -> DataFrame:
    """Keep snapshots with two positive best prices and add the mid price."""
    whole = best.where((F.col("bid_price") > 0) & (F.col("ask_price") > 0))
    return whole.withColumn("mid", mid_price())


def snapshots(book: DataFrame) -> DataFrame:
    return assemble(top_of_book(book))

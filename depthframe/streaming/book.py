"""Top-of-book snapshots of a stream of tall order-book rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthframe.operators.snapshot import top_of_book


def stream_top_of_book(book: DataFrame, delay: str) -> DataFrame:
    """``top_of_book`` of a streaming book, emitted once per (asset, ts) when it is closed.

    State holds the best rows of the snapshots that are still open: those less than ``delay``
    older than the newest row. Rows of closed snapshots are late and dropped; ``run_to_end``
    counts them. Rows without ``ts`` are left out.
    """
    timed = book.where(F.col("ts").isNotNull()).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    best = top_of_book(timed)
    return best.withColumn("ts", F.col("ts").cast("timestamp_ntz")).select("asset", "ts", "bid_price", "bid_quantity", "ask_price", "ask_quantity")


def run_to_end(stream: DataFrame, path: str, checkpoint: str) -> int:
    """Append all closed snapshots of what is available now to parquet files; the number of late rows.

    A second call with the same ``checkpoint`` goes on with the rows that came since. Late rows are counted
    after the map-side aggregation: several of one task and snapshot are one.
    """
    query = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])

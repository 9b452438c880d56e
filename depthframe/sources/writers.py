"""Sinks: training sets, metric tables, CSV reports, partitioned stores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from depthframe.operators.diagnostics import RECORD_COLUMNS
from depthframe.operators.longterm import daily_statistics
from depthframe.operators.splits import hash_fraction_sample
from depthframe.session import stage

CURVE_COLUMNS = ("left_edge", "right_edge", "bin_confidence", "bin_accuracy")


def canonical_text(df: DataFrame, decimals: int = 6) -> Column:
    """One text for a row: columns by name, joined with |; ~ for NULL, microseconds for times, fractions in units of 10^-decimals."""
    cells = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        c, kind = F.col(f"`{f.name}`"), f.dataType.simpleString()
        if kind in ("double", "float"):
            # whole units as far as a long goes, the plain number beyond and for NaN
            units = F.floor(c.cast("double") * 10.0**decimals + 0.5)
            c = F.when(F.abs(c) < 2.0**62 / 10.0**decimals, units.cast("string")).otherwise(c.cast("string"))
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.unix_micros(c.cast("timestamp")).cast("string")
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            c = F.to_json(c)
        cells.append(F.coalesce(c.cast("string"), F.lit("~")))
    return F.concat_ws("|", *cells)


def fingerprint(df: DataFrame, decimals: int = 6) -> DataFrame:
    """One row (rows, fingerprint): SHA-256 over the schema, the row count and a digest of the multiset of rows.

    The four 32-bit words of each row's MD5 are summed, so neither row order nor partitioning changes the
    value, repeated rows count, and any engine can repeat it. Fractions count to ``decimals`` places.
    """
    digest = F.md5(canonical_text(df, decimals))
    words = [F.conv(F.substring("d", 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    sums = df.select(digest.alias("d")).agg(F.count("*").alias("rows"), *[F.coalesce(F.sum(w.cast("decimal(20,0)")), F.lit(0)).cast("string").alias(f"s{k}") for k, w in enumerate(words)])
    schema = F.lit(",".join(f"{f.name}:{f.dataType.simpleString()}" for f in sorted(df.schema.fields, key=lambda f: f.name)))
    parts = F.concat_ws("|", schema, F.col("rows").cast("string"), *[f"s{k}" for k in range(4)])
    return sums.select("rows", F.sha2(parts, 256).alias("fingerprint"))


def write_training_set(windows: DataFrame, root: str, version: str, asset_first: bool = True) -> str:
    """Write train and validation rows by asset and split; the path names version and fingerprint.

    The rows are staged, so the windows are computed once for both.
    """
    rows = stage(windows.where(F.col("split").isin("train", "validation")), "training-set")
    digest = fingerprint(rows).first()["fingerprint"]
    path = f"{root.rstrip('/')}/{version}/{digest}"
    keys = ("asset", "split") if asset_first else ("split", "asset")
    rows.write.mode("overwrite").partitionBy(*keys).parquet(path)
    return path


def append_metrics(metrics: DataFrame, path: str, stage: str, step: int | None = None) -> None:
    """Append (stage, metric, step, value) rows to the long metrics table."""
    rows = metrics.select(
        *[c for c in ("asset",) if c in metrics.columns],
        F.lit(stage).alias("stage"),
        "metric",
        F.lit(step).cast("int").alias("step"),
        F.col("value").cast("double").alias("value"),
    )
    rows.write.mode("append").parquet(path)


def write_record_csv(records: DataFrame, path: str) -> None:
    """Diagnostic sample: nine columns with a header, one folder per asset."""
    records.select("asset", *RECORD_COLUMNS).write.mode("overwrite").partitionBy("asset").option("header", True).csv(path)


def write_anomaly_csv(anomalies: DataFrame, path: str) -> None:
    anomalies.select("asset", *RECORD_COLUMNS, "anomaly_type").write.mode("overwrite").partitionBy("asset").option(
        "header", True
    ).csv(path)


def confusion_wide(matrix: DataFrame, num_classes: int) -> DataFrame:
    """Confusion counts with one row per true class and one column per predicted class."""
    cells = matrix.groupBy("head", "y_true").pivot("y_pred", list(range(num_classes))).agg(F.sum("n"))
    return cells.na.fill(0).select("head", "y_true", *[F.col(str(k)).alias(f"pred_{k}") for k in range(num_classes)])


def write_confusion_csv(matrix: DataFrame, path: str, num_classes: int) -> None:
    """One folder per head; rows are true classes in order, columns predicted classes."""
    wide = confusion_wide(matrix, num_classes)
    ordered = wide.repartition(1).sortWithinPartitions("head", "y_true").drop("y_true")  # heads x K rows
    ordered.write.mode("overwrite").partitionBy("head").csv(path)


def write_curve_csv(curve: DataFrame, path: str) -> None:
    """Calibration curve with six decimals and a header, one folder per head."""
    text = [F.format_string("%.6f", F.col(c)).alias(c) for c in CURVE_COLUMNS]
    rows = curve.repartition(1).sortWithinPartitions("head", "bin")  # heads x bins rows
    rows.select("head", *text, "bin_count").write.mode("overwrite").partitionBy("head").option("header", True).csv(path)


def write_book(book: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store tall rows by asset and day, so later scans read only their days.

    The rebalance hint gathers the rows of a day, joins small groups and splits
    hot ones to files of the advisory size, in one pass over the book. Files are
    ordered by time, so the time filter of a scan skips row groups.
    """
    dated = book.withColumn("event_date", F.col("ts").cast("date"))
    placed = dated.hint("rebalance", "asset", "event_date").sortWithinPartitions("asset", "event_date", "ts")
    placed.write.mode(mode).partitionBy("asset", "event_date").parquet(path)


def extract_days(book: DataFrame, assets: Sequence[str], first_day: str, last_day: str) -> DataFrame:
    """Rows of some assets and days; partition columns prune the files."""
    day = F.col("event_date") if "event_date" in book.columns else F.col("ts").cast("date")
    return book.where(F.col("asset").isin(*assets) & day.between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")))


def write_retained(line: DataFrame, path: str, fraction: float, seed: int) -> None:
    """Keep a reproducible fraction of snapshots for later diagnosis."""
    hash_fraction_sample(line, "snap_idx", fraction, seed).write.mode("overwrite").partitionBy("asset").parquet(path)


def write_daily_store(line: DataFrame, path: str) -> None:
    """Persist daily statistics per asset."""
    daily_statistics(line).repartition("asset").write.mode("overwrite").partitionBy("asset").parquet(path)

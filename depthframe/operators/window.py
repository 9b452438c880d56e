"""Ordered computations that never put a whole asset into one task.

A window partitioned by asset alone sorts that asset in one task. The helpers
here cut the order into pieces of bounded size instead:

* ``dense_index`` numbers rows inside time buckets and adds the rows of earlier buckets,
* ``halo`` copies the few rows next to each block border, so a ROWS frame can be
  evaluated inside blocks of a dense index,
* ``banded_sums`` ranks or running-sums a large group through bands of its own values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthframe.session import MAX_BROADCAST_ROWS

BEFORE = (Window.unboundedPreceding, -1)
BAND_ROWS = 65536
BANDS = 256


def bounded_broadcast(table: DataFrame, assets: Sequence[str] | None, rows_per_asset: int = 1) -> DataFrame:
    """Hint that a table of at most ``rows_per_asset`` rows for each of ``assets`` is small.

    Passing ``assets`` states that the rows hold no others (``build_line`` restricts the
    book to them), which bounds the broadcast. The table is never filtered: with a list of
    any length, or none, a join gives the same rows. Without a list, or beyond the row
    limit, the join is left to the run-time size check and skew handling of adaptive
    execution.
    """
    if assets is None or len(assets) * rows_per_asset > MAX_BROADCAST_ROWS:
        return table
    return F.broadcast(table)


def with_scalars(df: DataFrame, stats: DataFrame, assets: Sequence[str] | None) -> DataFrame:
    """Attach per-asset scalars (count, range, mean) to every row of that asset."""
    return df.join(bounded_broadcast(stats, assets), "asset", "left")


def prefix_offsets(totals: DataFrame, bucket: str, outs: Mapping[str, str], keys: Sequence[str] = ("asset",)) -> DataFrame:
    """Per bucket the sum over the earlier buckets of its group, for each ``outs`` name -> value column.

    The second level of a prefix sum: one window task holds the totals of a group's buckets, three
    numbers for each few thousand rows of the first level.
    """
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(*BEFORE)
    return totals.select(*keys, bucket, *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(out) for out, v in outs.items()])


def dense_index(df: DataFrame, out: str, bucket_seconds: int) -> DataFrame:
    """Add the 0-based position of each row in the time order of its asset; (asset, ts) is unique.

    Rows are numbered inside time buckets, and a bucket starts after the rows of all earlier
    ones. A hot asset is spread over its buckets; nothing is written and no job runs here.
    """
    rows = df.withColumn("_bucket", F.floor(epoch_seconds("ts") / bucket_seconds))
    totals = rows.groupBy("asset", "_bucket").agg(F.count("*").alias("_n"))
    inside = F.row_number().over(Window.partitionBy("asset", "_bucket").orderBy("ts")) - 1
    placed = rows.withColumn("_in", inside).join(prefix_offsets(totals, "_bucket", {"_before": "_n"}), ["asset", "_bucket"])
    return placed.select(*df.columns, (F.col("_before") + F.col("_in")).alias(out))


def banded_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    outs: Mapping[str, Column | None],
    group_totals: Mapping[str, str] | None = None,
    band_rows: int = BAND_ROWS,
    bands: int = BANDS,
) -> DataFrame:
    """Add, per name in ``outs``, the sum of its value over the rows of smaller ``order``.

    A value of None counts rows, which gives a 0-based rank. ``group_totals``
    names, per output, a column for the sum over the whole group. ``order`` is unique in a group.

    A group is one window unless it has more than ``band_rows`` rows. Such a group is cut at splitters,
    drawn from its own values by a mergeable sketch, into ``bands`` bands of about equal size; a row's
    sum is the total of the bands before its own plus the sum inside it. Where no group is large,
    adaptive execution drops the joins once the sizes are known.
    """
    values = list(outs.values())
    # two counts that need the value columns: column pruning then leaves the shuffle that the ranks read, too
    used = [v for v in values if v is not None] or [F.col(order)]
    sizes = df.groupBy(*keys).agg((F.count_if(used[0] >= 0) + F.count_if(F.coalesce(used[0] < 0, F.lit(True)))).alias("_size"))
    large = sizes.where(F.col("_size") > band_rows).select(*keys)

    cell = [*keys, "_band"]
    banded = value_bands(df, large, keys, order, bands).repartition(*cell)  # a band of a hot group is one task, not the group
    fine = Window.partitionBy(*cell).orderBy(order)
    inner = {}
    for i, value in enumerate(values):
        running = F.row_number().over(fine) - 1 if value is None else F.coalesce(F.sum(value).over(fine.rowsBetween(*BEFORE)), F.lit(0))
        inner[f"_in{i}"] = running.cast("long") if value is None else running
    for out in group_totals or {}:
        i = list(outs).index(out)
        inner[f"_all{i}"] = (F.count("*") if values[i] is None else F.sum(values[i])).over(Window.partitionBy(*cell))

    sums = [(F.count("*") if v is None else F.sum(v)).alias(f"_t{i}") for i, v in enumerate(values)]
    at = Window.partitionBy(*keys).orderBy("_band").rowsBetween(*BEFORE)
    before = [F.coalesce(F.sum(f"_t{i}").over(at), F.lit(0)).alias(f"_off{i}") for i in range(len(values))]
    before += [F.sum(f"_t{list(outs).index(out)}").over(Window.partitionBy(*keys)).alias(f"_group_{name}") for out, name in (group_totals or {}).items()]
    offsets = banded.where("_split").groupBy(*cell).agg(*sums).select(*cell, *before)
    joined = banded.withColumns(inner).join(offsets, cell, "left")
    results = [(F.coalesce(f"_off{i}", F.lit(0)) + F.col(f"_in{i}")).alias(out) for i, out in enumerate(outs)]
    results += [F.coalesce(f"_group_{name}", f"_all{list(outs).index(out)}").alias(name) for out, name in (group_totals or {}).items()]
    return joined.select(*df.columns, *results)


def value_bands(df: DataFrame, large: DataFrame, keys: Sequence[str], order: str, bands: int) -> DataFrame:
    """Add ``_split``, whether the row's group is one of ``large``, and ``_band``, how many of its splitters are below ``order``.

    Splitters are approximate quantiles of the group, within a tenth of a band.
    """
    shares = [k / bands for k in range(1, bands)]
    cuts = df.join(large, list(keys)).groupBy(*keys).agg(F.percentile_approx(order, shares, F.lit(10 * bands)).alias("_cuts"))
    placed = df.join(cuts, list(keys), "left").withColumn("_split", F.col("_cuts").isNotNull())
    below = F.size(F.filter("_cuts", lambda x: x < F.col(order)))
    return placed.withColumn("_band", F.when(F.col("_split"), below).otherwise(0)).drop("_cuts")


def epoch_micros(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp"))


def epoch_seconds(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_seconds(ts.cast("timestamp"))


def halo(df: DataFrame, index: str, before: int, after: int, block_rows: int) -> DataFrame:
    """Copy rows into every block whose frames reach them; adds ``_block`` and ``_own``.

    A frame of ``before`` rows back and ``after`` rows ahead around any row with
    ``_own`` true is complete inside its (asset, _block) group. A group has at
    most ``block_rows + before + after`` rows of a dense index.
    """
    i = F.col(index)
    size = max(block_rows, before + after + 1)
    first = F.floor((i - after) / size)
    first = F.when(i >= 0, F.greatest(first, F.lit(0))).otherwise(first).cast("long")
    last = F.floor((i + before) / size).cast("long")
    home = F.floor(i / size).cast("long")
    return (
        df.withColumn("_home", home)
        .withColumn("_block", F.explode(F.sequence(first, last)))
        .withColumn("_own", F.col("_block") == F.col("_home"))
        .drop("_home")
    )


def block_window(index: str, *extra: str) -> Window:
    return Window.partitionBy("asset", "_block", *extra).orderBy(index)


def run_extremes(cells: DataFrame, index: str, column: str, length: int) -> DataFrame:
    """Running extremes of ``column`` inside runs of ``length`` rows of a halo frame.

    ``_head_*`` runs from the start of a run to the row, ``_rest_*`` from the row
    to the end of its run. Any window of ``length`` rows is the rest of one run
    plus the head of the next, so its extremes cost two lookups, whatever the
    length.
    """
    upto = (Window.unboundedPreceding, 0)
    runs = cells.withColumn("_run", F.floor(F.col(index) / length))
    head = block_window(index, "_run").rowsBetween(*upto)
    rest = Window.partitionBy("asset", "_block", "_run").orderBy(F.desc(index)).rowsBetween(*upto)
    return runs.withColumns(
        {
            "_head_hi": F.max(column).over(head),
            "_head_lo": F.min(column).over(head),
            "_rest_hi": F.max(column).over(rest),
            "_rest_lo": F.min(column).over(rest),
        }
    )

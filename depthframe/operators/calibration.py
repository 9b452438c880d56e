"""Isotonic calibration as pooled adjacent violators over sorted ranges.

The fit of a (head, class) pools neighbouring probabilities until their hit rates rise. Pooling is
mergeable: blocks pooled inside a range of the order stay together in the whole, so ranges are folded
alone and their blocks are folded again, with the result of one pass over everything. Sums are whole
numbers and rates are compared by cross products, so the fit is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthframe.operators.window import BAND_ROWS, BANDS, value_bands

KEYS = ("head", "class")
BLOCKS = "head string, class int, lo double, hi double, hits long, n long"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pool neighbouring blocks of rows sorted by (head, class, lo) as long as rates do not rise."""
    schema = pa.schema([("head", pa.string()), ("class", pa.int32()), ("lo", pa.float64()), ("hi", pa.float64()), ("hits", pa.int64()), ("n", pa.int64())])
    group, stack = None, []

    def out() -> pa.RecordBatch:
        columns = list(zip(*stack))
        return pa.RecordBatch.from_arrays(
            [pa.array([group[0]] * len(stack), pa.string()), pa.array([group[1]] * len(stack), pa.int32()), *(pa.array(c, t) for c, t in zip(columns, schema.types[2:]))],
            schema=schema,
        )

    for batch in batches:
        columns = batch.to_pydict()
        for head, label, lo, hi, hits, n in zip(*(columns[name] for name in schema.names)):
            if (head, label) != group:
                if stack:
                    yield out()
                group, stack = (head, label), []
            while stack and stack[-1][2] * n >= hits * stack[-1][3]:
                lo, _, older_hits, older_n = stack.pop()
                hits, n = hits + older_hits, n + older_n
            stack.append((lo, hi, hits, n))
    if stack:
        yield out()


def class_rows(predictions: DataFrame) -> DataFrame:
    """One row per prediction and class, with its probability ``p``; a null or NaN probability has none."""
    flat = predictions.select("*", F.posexplode("probs").alias("class", "p"))
    return flat.where(F.col("p").isNotNull() & ~F.isnan("p"))


def isotonic_blocks(holdout: DataFrame) -> DataFrame:
    """Fitted blocks (head, class, lo, hi, hits, n): the hit rate of probabilities ``lo`` to ``hi`` is hits / n.

    Equal probabilities are added up first. A range partition is folded as a stream that holds its blocks only;
    then the blocks of a (head, class) are folded by one task. Rates of neighbours differ, so n rows
    have fewer than 3 n^(2/3) blocks, whatever the data, and about n^(1/3) where rates rise smoothly.
    A null ``y_true`` hits no class.
    """
    hit = F.coalesce((F.col("class") == F.col("y_true")).cast("long"), F.lit(0))
    flat = class_rows(holdout).withColumn("p", F.col("p") + F.lit(0.0))  # one zero
    points = flat.groupBy("head", "class", "p").agg(F.sum(hit).alias("hits"), F.count("*").alias("n"))
    points = points.select("head", "class", F.col("p").alias("lo"), F.col("p").alias("hi"), "hits", "n")
    ranges = points.repartitionByRange(*KEYS, "lo").sortWithinPartitions(*KEYS, "lo").mapInArrow(_fold, BLOCKS)
    return ranges.repartition(*KEYS).sortWithinPartitions(*KEYS, "lo").mapInArrow(_fold, BLOCKS)


def isotonic_values(blocks: DataFrame, wanted: DataFrame, band_rows: int = BAND_ROWS) -> DataFrame:
    """(head, class, p, value) per distinct (head, class, p) of ``wanted``.

    Inside a block the value is its rate, between two blocks it runs linearly from one to the other,
    beyond the first and the last it stays. It is null where the class has no blocks. Probabilities and
    block starts are merged inside bands cut at splitters from the data; the last block of a
    band is carried into the next ones.
    """
    rate = (F.col("hits") / F.col("n")).alias("rate")
    order = Window.partitionBy(*KEYS).orderBy("lo")
    ahead = blocks.select("*", rate).select("*", F.lead("lo").over(order).alias("next_lo"), F.lead("rate").over(order).alias("next_rate"))
    knots = ahead.select(*KEYS, F.col("lo").alias("p"), F.struct("lo", "hi", "rate", "next_lo", "next_rate").alias("knot"))
    asked = wanted.select(*KEYS, (F.col("p") + F.lit(0.0)).alias("p"), F.lit(True).alias("asked"), F.lit(None).cast(knots.schema["knot"].dataType).alias("knot"))
    merged = asked.unionByName(knots.withColumn("asked", F.lit(False))).groupBy(*KEYS, "p").agg(F.max("asked").alias("asked"), F.max("knot").alias("knot"))
    large = merged.groupBy(*KEYS).agg(F.count("*").alias("size")).where(F.col("size") > band_rows).select(*KEYS)
    cell = [*KEYS, "_band"]
    banded = value_bands(merged, large, KEYS, "p", BANDS).repartition(*cell)
    inside = Window.partitionBy(*cell).orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*KEYS).orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*KEYS)
    bands = banded.groupBy(*cell).agg(F.max("knot").alias("last"), F.min("knot").alias("first"))
    bands = bands.select(*cell, F.last("last", ignorenulls=True).over(before).alias("carried"), F.min("first").over(whole).alias("first"))
    placed = banded.select("*", F.last("knot", ignorenulls=True).over(inside).alias("_own")).where("asked").join(bands, cell)
    at = F.coalesce("_own", "carried")
    share = (F.col("p") - at["hi"]) / (at["next_lo"] - at["hi"])
    between = at["rate"] + (at["next_rate"] - at["rate"]) * share
    value = F.when(at.isNull(), F.col("first.rate")).when((F.col("p") <= at["hi"]) | at["next_lo"].isNull(), at["rate"]).otherwise(between)
    return placed.select(*KEYS, "p", value.alias("value"))


def isotonic_calibrate(holdout: DataFrame, rows: DataFrame, num_classes: int) -> DataFrame:
    """Probabilities of ``rows`` through the fit on ``holdout``, renormalised over the classes.

    A probability without a fit stays as it is, one that is null or NaN counts as 0; where all are 0 the classes share
    equally. Rows with fewer classes than ``num_classes`` get zeros, more classes are dropped.
    """
    values = isotonic_values(isotonic_blocks(holdout), class_rows(rows).select("head", "class", "p"))
    out = rows
    for k in range(num_classes):  # one equi-join a class; rows are not regrouped, so equal rows stay apart
        of_class = values.where(F.col("class") == k).select(F.col("head").alias("_h"), F.col("p").alias("_p"), F.col("value").alias(f"_c{k}"))
        p = _probability(k)
        out = out.join(of_class, (out["head"] == F.col("_h")) & (p + F.lit(0.0) == F.col("_p")), "left").drop("_h", "_p")
    fitted = [F.coalesce(F.col(f"_c{k}"), _probability(k), F.lit(0.0)) for k in range(num_classes)]
    total = sum(fitted[1:], fitted[0])
    probs = F.when(total > 0, F.array(*[c / total for c in fitted])).otherwise(F.array(*[F.lit(1.0 / num_classes)] * num_classes))
    return out.select(*[c for c in rows.columns if c != "probs"], probs.alias("probs"))


def _probability(k: int) -> Column:
    p = F.try_element_at("probs", F.lit(k + 1))
    return F.when(~F.isnan(p), p)

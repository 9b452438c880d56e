"""Daily context of an asset: statistics, trailing windows, regimes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthframe.operators.features import log_returns
from depthframe.params import BookParams

REGIMES = ("high_volatility", "bull", "bear", "sideways")


def daily_statistics(line: DataFrame) -> DataFrame:
    """Moments of mid and total best quantity per asset and day (population moments, excess kurtosis)."""
    volume = F.col("bid_quantity") + F.col("ask_quantity")
    return line.groupBy("asset", F.col("ts").cast("date").alias("day")).agg(
        F.count("*").alias("n"),
        F.avg("mid").alias("mid_mean"),
        F.stddev_pop("mid").alias("mid_std"),
        F.skewness("mid").alias("mid_skew"),
        F.kurtosis("mid").alias("mid_kurtosis"),
        F.sum(volume).alias("total_volume"),
    )


def daily_returns(line: DataFrame, p: BookParams) -> DataFrame:
    """Per asset and day: closing mid, daily return, volatility of log returns, volume."""
    returns = log_returns(line, p)
    days = returns.groupBy("asset", F.col("ts").cast("date").alias("day")).agg(
        F.max_by("mid", "snap_idx").alias("close"),
        F.coalesce(F.stddev_pop("log_return"), F.lit(0.0)).alias("volatility"),
        F.sum(F.col("bid_quantity") + F.col("ask_quantity")).alias("volume"),
    )
    previous = F.lag("close").over(_days())
    return days.withColumn("daily_return", F.col("close") / previous - 1.0)


def _days():
    """Days of one asset: a window over the daily table, whose size is the calendar."""
    return Window.partitionBy("asset").orderBy("day")


def trailing_days(daily: DataFrame, columns: Sequence[str], days: int) -> DataFrame:
    """Arrays of the previous ``days`` daily rows, oldest first, the day itself excluded."""
    before = _days().rowsBetween(-days, -1)
    step = F.struct("day", *columns)
    return daily.select("asset", "day", F.collect_list(step).over(before).alias("history"))


def attach_history(samples: DataFrame, history: DataFrame) -> DataFrame:
    """History of the anchor's day for every sample (equi join on asset and day)."""
    keyed = samples.withColumn("day", F.col("ts").cast("date"))
    return keyed.join(history, ["asset", "day"], "left")


def ewma(history: Column, column: str, half_life: float) -> Column:
    """Exponentially weighted mean of a trailing array, newest element weight 1."""
    decay = 0.5 ** (1.0 / half_life)
    n = F.size(history)
    weighted = F.transform(
        history, lambda s, i: F.struct((s[column] * F.pow(F.lit(decay), n - 1 - i)).alias("v"), F.pow(F.lit(decay), n - 1 - i).alias("w"))
    )
    top = F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x["v"])
    bottom = F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x["w"])
    return F.when(n > 0, top / bottom)


def context(daily: DataFrame, days: int, half_life: float) -> DataFrame:
    """Trailing mean return, EW volatility and mean volume per asset and day."""
    history = trailing_days(daily, ["daily_return", "volatility", "volume"], days)
    full = daily.select("asset", "day").join(history, ["asset", "day"])
    h = F.col("history")

    def mean(column: str) -> Column:
        present = F.filter(F.transform(h, lambda s: s[column]), lambda v: v.isNotNull())
        total = F.aggregate(present, F.lit(0.0), lambda a, v: a + v)
        return F.when(F.size(present) > 0, total / F.size(present))

    return full.select(
        "asset",
        "day",
        F.size(h).alias("days_seen"),
        mean("daily_return").alias("mean_return"),
        ewma(h, "volatility", half_life).alias("ew_volatility"),
        mean("volume").alias("mean_volume"),
    )


def regimes(context_: DataFrame, return_limit: float, volatility_limit: float) -> DataFrame:
    """Regime tag and its one-hot columns; high volatility takes precedence.

    NULL context gives no tag and zeros.
    """
    r, v = F.col("mean_return"), F.col("ew_volatility")
    tag = (
        F.when(r.isNull() | v.isNull(), F.lit(None).cast("string"))
        .when(v > volatility_limit, "high_volatility")
        .when(r > return_limit, "bull")
        .when(r < -return_limit, "bear")
        .otherwise("sideways")
    )
    tagged = context_.withColumn("regime", tag)
    return tagged.withColumns(
        {f"is_{name}": F.coalesce((F.col("regime") == name).cast("int"), F.lit(0)) for name in REGIMES}
    )


def summarize(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, population deviation, minimum and maximum of each column per asset, in long form."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"_{c}_mean"), F.stddev_pop(c).alias(f"_{c}_std"), F.min(c).cast("double").alias(f"_{c}_min"), F.max(c).cast("double").alias(f"_{c}_max")]
    wide = rows.groupBy("asset").agg(*aggs)
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            *[F.col(f"_{c}_{s}").alias(s) for s in ("mean", "std", "min", "max")],
        )
        for c in columns
    ]
    return wide.select("asset", F.explode(F.array(*cells)).alias("c")).select("asset", "c.*")

"""Column expressions on time: epoch units, cyclical encodings, sessions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# An epoch number of at least this size is read in this unit, else in seconds.
EPOCH_UNITS = (
    ("nanoseconds", 1_000_000_000_000_000_000),
    ("microseconds", 1_000_000_000_000_000),
    ("milliseconds", 1_000_000_000_000),
)
# Market sessions by UTC hour [from, to); the cut-offs are this library's choice.
SESSIONS = (("asian", 0, 8), ("european", 8, 16), ("american", 16, 24))


def epoch_unit(first: Column) -> Column:
    """Unit name inferred from the size of the first value of a series."""
    size = F.abs(first)
    out = None
    for name, least in EPOCH_UNITS:
        out = F.when(size >= least, name) if out is None else out.when(size >= least, name)
    return out.otherwise("seconds")


def from_epoch(value: Column, unit: Column) -> Column:
    """Epoch number in ``unit`` to a UTC timestamp of microsecond resolution."""
    micros = (
        F.when(unit == "nanoseconds", F.floor(value / F.lit(1000).cast("decimal(20,0)")))
        .when(unit == "microseconds", value)
        .when(unit == "milliseconds", value * 1000)
        .otherwise(value * 1_000_000)
    )
    return F.timestamp_micros(micros.cast("long")).cast("timestamp_ntz")


def cyclical(value: Column, period: int) -> tuple[Column, Column]:
    angle = F.lit(2.0 * math.pi) * (value.cast("double") / float(period))
    return F.sin(angle), F.cos(angle)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def minute_of_hour(ts: Column) -> Column:
    return F.minute(ts)


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def market_session(ts: Column) -> Column:
    out = None
    for name, start, end in SESSIONS:
        test = (F.hour(ts) >= start) & (F.hour(ts) < end)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out

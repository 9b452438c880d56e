"""Column expressions on best quotes: mid, spread, imbalance, quality flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

FEATURES = ("bid_price", "bid_quantity", "ask_price", "ask_quantity")

# The anomaly names and their order in the anomaly type string.
SEVERE_FLAGS = ("negative_price", "negative_quantity", "inverted_spread", "high_spread")
FLAGS = (
    "negative_price",
    "zero_bid_price",
    "zero_ask_price",
    "negative_quantity",
    "zero_bid_quantity",
    "zero_ask_quantity",
    "inverted_spread",
    "high_spread",
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid_bid() -> Column:
    return (F.col("bid_price") > 0) & (F.col("bid_quantity") >= 0)


def valid_ask() -> Column:
    return (F.col("ask_price") > 0) & (F.col("ask_quantity") >= 0)


def both_prices_positive() -> Column:
    return (F.col("bid_price") > 0) & (F.col("ask_price") > 0)


def mid_price(bid: Column | str = "bid_price", ask: Column | str = "ask_price") -> Column:
    return F.lit(0.5) * (col(bid) + col(ask))


def spread_pct() -> Column:
    """Spread in percent of mid; NULL unless both prices are positive."""
    spread = F.col("ask_price") - F.col("bid_price")
    return F.when(both_prices_positive(), spread / mid_price() * 100.0)


def quality_flags(high_spread_pct: float) -> dict[str, Column]:
    bid, ask = F.col("bid_price"), F.col("ask_price")
    bid_qty, ask_qty = F.col("bid_quantity"), F.col("ask_quantity")
    tests = {
        "negative_price": (bid < 0) | (ask < 0),
        "zero_bid_price": bid == 0,
        "zero_ask_price": ask == 0,
        "negative_quantity": (bid_qty < 0) | (ask_qty < 0),
        "zero_bid_quantity": bid_qty == 0,
        "zero_ask_quantity": ask_qty == 0,
        "inverted_spread": both_prices_positive() & (bid >= ask),
        "high_spread": spread_pct() > high_spread_pct,
    }
    return {name: F.coalesce(tests[name], F.lit(False)) for name in FLAGS}


def any_severe() -> Column:
    out = F.lit(False)
    for name in SEVERE_FLAGS:
        out = out | F.col(name)
    return out


def anomaly_type() -> Column:
    """Names of the severe flags that are set, joined by a pipe."""
    return F.concat_ws("|", *[F.when(F.col(n), F.lit(n)) for n in SEVERE_FLAGS])


def clip(value: Column | str, low: Column, high: Column) -> Column:
    """Clamp to [low, high]; NULL limits leave the value as it is."""
    v = col(value)
    return F.when(low.isNull() | high.isNull(), v).otherwise(F.least(F.greatest(v, low), high))


def relative_spread(spread: Column | str) -> Column:
    return col(spread) / 100.0


def pct_change(price: Column | str, reference: Column | str) -> Column:
    return (col(price) / col(reference) - 1.0) * 100.0


def boundary_levels(mid: Column | str, boundaries: Sequence[float]) -> Column:
    """Price levels ``mid * (1 + b/100)`` of the class boundaries."""
    return F.array(*[col(mid) * (1.0 + float(b) / 100.0) for b in boundaries])


def imbalance(bid_qty: Column | str, ask_qty: Column | str) -> Column:
    """(bid - ask) / (bid + ask); NULL when both are zero."""
    total = col(bid_qty) + col(ask_qty)
    return F.when(total != 0, (col(bid_qty) - col(ask_qty)) / total)


def weighted_mid() -> Column:
    """Mid weighted by the opposite quantity; NULL when both quantities are zero."""
    total = F.col("bid_quantity") + F.col("ask_quantity")
    cross = F.col("bid_price") * F.col("ask_quantity") + F.col("ask_price") * F.col("bid_quantity")
    return F.when(total != 0, cross / total)

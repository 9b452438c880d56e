"""Order-book views over the supplied tables.

One text per view for both engines; only the time functions differ. Prices are
triangle waves over the row's own time, quantities and ids come from the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from depthframe.params import BookParams

EVENTS = """
select event_type as asset, cast(date_trunc('hour', ts) as {ntz}) as ts,
  case when user_id % 50 = 0 then 0e0
       else (100e0 + abs((h % 97) - 48) * 5e-1) * (1e0 - 5e-4 * lvl) end as bid_price,
  value as bid_quantity,
  (100e0 + abs((h % 97) - 48) * 5e-1)
    * (case when event_type = 'error' and value > 150e0 then 99e-2 else 1e0 + 5e-4 * lvl end) as ask_price,
  cast(user_id % 20 as double) as ask_quantity,
  cast(floor(h / 24e0) as bigint) as batch_id, event_id as row_id
from (select *, {hour} - 473328 as h, event_id % 10 + 1 as lvl from {events}) e
"""
LINEITEM = """
select concat(l_returnflag, l_linestatus) as asset, cast(l_shipdate as {ntz}) as ts,
  (100e0 + abs((dd % 61) - 30) * 5e-1) * (1e0 - 5e-4 * lvl) as bid_price, l_quantity as bid_quantity,
  (100e0 + abs((dd % 61) - 30) * 5e-1) * (1e0 + 5e-4 * lvl) as ask_price,
  l_quantity * (1e0 - l_discount) as ask_quantity,
  cast(floor(dd / 7e0) as bigint) as batch_id, l_orderkey * 10 + l_linenumber as row_id
from (select *, {day} as dd, (l_suppkey + l_linenumber) % 20 + 1 as lvl from {lineitem}) l
"""


def _weights(first: int, el: str) -> str:
    out = []
    for k in range(4):
        out.append(
            f"abs(cast({el}(embedding, {first + k}) as double)) + case when label % 4 = {k} "
            f"and vec_id % 3 <> 0 then 3e-1 else 0e0 end as w{k}"
        )
    return ", ".join(out)


def predictions_sql(el: str, table: str) -> str:
    total = "(w0 + w1 + w2 + w3)"
    shares = ", ".join(f"w{k} / {total} as p{k}" for k in range(4))
    return f"""
select vec_id as sample_idx, head, y_true, {shares}
from (
  select vec_id, 'up' as head, label % 4 as y_true, {_weights(1, el)} from {table}
  union all
  select vec_id, 'down' as head, label % 4 as y_true, {_weights(5, el)} from {table}) w
"""


DUCK_HOUR = "cast(epoch(date_trunc('hour', ts)) as bigint) // 3600"
DUCK_DAY = "cast(epoch(l_shipdate) as bigint) // 86400"
DUCK_EVENTS = EVENTS.format(ntz="timestamp", hour=DUCK_HOUR, events="events")
DUCK_LINEITEM = LINEITEM.format(ntz="timestamp", day=DUCK_DAY, lineitem="lineitem")
DUCK_PREDICTIONS = predictions_sql("list_extract", "embeddings")

EVENT_ASSETS = ("click", "error", "purchase", "signup", "view")
LINEITEM_ASSETS = ("AF", "AO", "NF", "NO", "RF", "RO")

EVENT_PARAMS = BookParams(
    cadence_seconds=3600,
    window_seconds=12 * 3600,
    horizon_seconds=24 * 3600,
    boundaries=(2.0, 5.0, 10.0),
    max_gap_seconds=14400,
    gap_mode="interpolate",
    assets=EVENT_ASSETS,
)
LINEITEM_PARAMS = BookParams(
    cadence_seconds=86400,
    window_seconds=30 * 86400,
    horizon_seconds=30 * 86400,
    boundaries=(2.0, 5.0, 10.0),
    max_gap_seconds=4 * 86400,
    gap_mode="interpolate",
    assets=LINEITEM_ASSETS,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_book(spark: SparkSession, events: DataFrame) -> DataFrame:
    hour = "unix_seconds(cast(date_trunc('hour', ts) as timestamp)) div 3600"
    text = EVENTS.format(ntz="timestamp_ntz", hour=hour, events="{events}")
    return spark.sql(text, events=events)


def book_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_book(spark, table(spark, sf_dir, "events"))


def book_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = "unix_seconds(cast(l_shipdate as timestamp)) div 86400"
    text = LINEITEM.format(ntz="timestamp_ntz", day=day, lineitem="{lineitem}")
    return spark.sql(text, lineitem=table(spark, sf_dir, "lineitem"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = predictions_sql("element_at", "{embeddings}")
    wide = spark.sql(text, embeddings=table(spark, sf_dir, "embeddings"))
    return wide.selectExpr("sample_idx", "head", "y_true", "array(p0, p1, p2, p3) as probs")

"""The same queries as plain SQL over the supplied tables."""

from __future__ import annotations

import math

from checks.adapters import (
    DUCK_EVENTS,
    DUCK_LINEITEM,
    DUCK_PREDICTIONS,
    EVENT_ASSETS,
    EVENT_PARAMS,
    LINEITEM_PARAMS,
)
from depthframe.functions.bins import unit_edges

ORACLES: dict[str, str] = {}
FEATS = ("bid_price", "bid_quantity", "ask_price", "ask_quantity")
K = 4
BINS = 10


def r6(e: str) -> str:
    return f"(round(({e}) * 1e6 + 1e-4) / 1e6 + 0e0)"


def cols6(*names: str) -> str:
    return ", ".join(f"{r6(n)} as {n}" for n in names)


def add(name: str, *ctes: list[str] | str, select: str) -> None:
    parts: list[str] = []
    for c in ctes:
        parts += c if isinstance(c, list) else [c]
    ORACLES[name] = ("with " + ",\n".join(parts) + "\n" if parts else "") + select


# ---- shared steps -----------------------------------------------------------

SOURCES = {"e": (DUCK_EVENTS, EVENT_PARAMS), "l": (DUCK_LINEITEM, LINEITEM_PARAMS)}


def raw(src: str) -> list[str]:
    return [f"rawbook as ({SOURCES[src][0]})"]


def book(src: str) -> list[str]:
    return raw(src) + [
        "book as (select * from rawbook where ts between timestamp '1990-01-01 00:00:00' "
        "and timestamp '2099-12-31 23:59:59' and bid_price > 0 and ask_price > 0)"
    ]


def best(src: str, unfiltered: bool = False) -> list[str]:
    table = "rawbook" if unfiltered else "book"
    return (raw(src) if unfiltered else book(src)) + [
        f"""bids as (select asset, ts, bid_price, bid_quantity from (select *, row_number() over (partition by asset, ts
            order by bid_price desc, row_id, bid_quantity) as rn from {table} where bid_price > 0 and bid_quantity >= 0) where rn = 1)""",
        f"""asks as (select asset, ts, ask_price, ask_quantity from (select *, row_number() over (partition by asset, ts
            order by ask_price, row_id, ask_quantity) as rn from {table} where ask_price > 0 and ask_quantity >= 0) where rn = 1)""",
        f"""best as (select k.asset, k.ts, bid_price, bid_quantity, ask_price, ask_quantity from (select distinct asset, ts from {table}) k
            left join bids b on k.asset = b.asset and k.ts = b.ts left join asks a on k.asset = a.asset and k.ts = a.ts)""",
    ]


def snaps(src: str, unfiltered: bool = False) -> list[str]:
    return best(src, unfiltered) + [
        "snaps as (select *, 5e-1 * (bid_price + ask_price) as mid from best where bid_price > 0 and ask_price > 0)"
    ]


def line(src: str, mode: str = "interpolate") -> list[str]:
    p = SOURCES[src][1]
    carried = (*FEATS, "mid")
    nexts = ", ".join(f"lead({c}) over w as n_{c}" for c in carried)
    if mode == "interpolate":
        w = "(cast(k as double) / cast(missing + 1 as double))"
        values = ", ".join(f"case when k = 0 then {c} else (1e0 - {w}) * {c} + {w} * n_{c} end as {c}" for c in carried)
    else:
        values = ", ".join(carried)
    fill = "0" if mode == "skip" else (
        f"case when s1 - s0 > {p.cadence_seconds} and s1 - s0 <= {p.max_gap_seconds} "
        f"then (s1 - s0) // {p.cadence_seconds} - 1 else 0 end"
    )
    return snaps(src) + [
        "indexed as (select *, row_number() over (partition by asset order by ts) - 1 as i0, epoch_us(ts) // 1000000 as s0 from snaps)",
        f"pairs as (select *, lead(s0) over w as s1, {nexts} from indexed window w as (partition by asset order by i0))",
        f"gaps as (select *, {fill} as missing from pairs)",
        "points as (select g.*, unnest(range(0, missing + 1)) as k from gaps g)",
        f"""line as (select asset, row_number() over (partition by asset order by i0, k) - 1 as snap_idx,
            make_timestamp((s0 + k * {p.cadence_seconds}) * 1000000) as ts, {values}, case when k > 0 then 1 else 0 end as is_filled from points)""",
    ]


def bin_case(x: str, edges) -> str:
    whens = " ".join(f"when {x} <= {e} then {i}" for i, e in enumerate(edges))
    return f"(case {whens} else {len(edges)} end)"


def lit(b: float) -> str:
    return f"{b!r}e0"


def samples(src: str, mode: str = "interpolate") -> list[str]:
    p = SOURCES[src][1]
    t, h = p.window_steps, p.horizon_steps
    edges = [lit(b) for b in p.boundaries]
    n_train = f"cast(trunc(cast(n as double) * {p.train_ratio}e0) as bigint)"
    n_val = f"cast(trunc(cast(n as double) * {p.validation_ratio}e0) as bigint)"
    return line(src, mode) + [
        f"""future as (select *, max(mid) over w as future_high, min(mid) over w as future_low, count(*) over w as ahead
            from line window w as (partition by asset order by snap_idx rows between 1 following and {h} following))""",
        f"""moves as (select *, snap_idx - {t - 1} as sample_idx, (future_high - mid) / mid * 100e0 as max_up_move_pct,
            (future_low - mid) / mid * 100e0 as max_down_move_pct from future where ahead = {h} and snap_idx >= {t - 1})""",
        "changes as (select *, case when abs(max_up_move_pct) >= abs(max_down_move_pct) then max_up_move_pct else max_down_move_pct end as price_change from moves)",
        f"""labelled as (select *, case when {bin_case('abs(price_change)', edges)} = 0 or price_change = 0 then {len(edges)}
              when price_change > 0 then {len(edges)} + {bin_case('abs(price_change)', edges)}
              else {len(edges)} - {bin_case('abs(price_change)', edges)} end as label,
            {bin_case('greatest(max_up_move_pct, 0e0)', edges)} as label_up,
            {bin_case('greatest(-max_down_move_pct, 0e0)', edges)} as label_down from changes)""",
        "sized as (select *, count(*) over (partition by asset) as n from labelled)",
        f"ended as (select *, {n_train} as train_end, least({n_train} + {n_val}, n) as validation_end from sized)",
        """samples as (select *, case when sample_idx < train_end then 'train' when sample_idx < validation_end then 'validation' else 'test' end as split,
            sample_idx - case when sample_idx < train_end then 0 when sample_idx < validation_end then train_end else validation_end end as split_idx from ended)""",
    ]


def records(src: str, m: int | None = None, high: float = 5.0, method: str = "uniform") -> list[str]:
    ok = "bid_price > 0 and ask_price > 0"
    spread = f"case when {ok} then (ask_price - bid_price) / (5e-1 * (bid_price + ask_price)) * 100e0 end"
    if m is None:
        pick = "picked as (select * from samples where split = 'train')"
    elif method == "uniform":
        step = f"(cast(train_end - 1 as double) / {m - 1}e0)"
        pick = f"""train as (select *, train_end as n_train from samples where split = 'train'),
            kk as (select unnest(range(0, {m})) as kk),
            spots as (select distinct t.asset, case when kk = {m - 1} then t.n_train - 1 else cast(floor(kk * {step.replace('train_end', 't.n_train')}) as bigint) end as sample_idx
              from (select distinct asset, n_train from train) t, kk where t.n_train > {m}),
            picked as (select * from train t where n_train <= {m} or exists (select 1 from spots s where s.asset = t.asset and s.sample_idx = t.sample_idx))"""
    else:
        pick = f"""train as (select * from samples where split = 'train'),
            picked as (select * from (select *, row_number() over (partition by asset order by md5('42:' || asset || ':' || sample_idx), sample_idx) as rk from train) where rk <= {m})"""
    return samples(src) + [
        pick,
        f"""records as (select *, case when {ok} then 5e-1 * (bid_price + ask_price) end as mid_price, {spread} as spread_pct, ({ok}) as valid_spread,
            cast(bid_price < 0 or ask_price < 0 as int) as negative_price, cast(bid_price = 0 as int) as zero_bid_price, cast(ask_price = 0 as int) as zero_ask_price,
            cast(bid_quantity < 0 or ask_quantity < 0 as int) as negative_quantity, cast(bid_quantity = 0 as int) as zero_bid_quantity,
            cast(ask_quantity = 0 as int) as zero_ask_quantity, cast({ok} and bid_price >= ask_price as int) as inverted_spread,
            cast(coalesce({spread} > {lit(high)}, false) as int) as high_spread from picked)""",
    ]


ANOMALY = """concat_ws('|', case when negative_price = 1 then 'negative_price' end, case when negative_quantity = 1 then 'negative_quantity' end,
  case when inverted_spread = 1 then 'inverted_spread' end, case when high_spread = 1 then 'high_spread' end)"""
SEVERE = "(negative_price = 1 or negative_quantity = 1 or inverted_spread = 1 or high_spread = 1)"


def series(sigmas: float = 2.0, src: str = "e") -> list[str]:
    return records(src) + [
        f"""stats as (select asset, min(ts) as base, avg(case when valid_spread then mid_price end) as ref,
            avg(spread_pct) as m, stddev_pop(spread_pct) as s from records group by asset)""",
        f"""series as (select r.*, (epoch_us(r.ts) - epoch_us(base)) // 1000000 as elapsed_seconds,
            case when s > 0 then least(greatest(spread_pct, m - {sigmas}e0 * s), m + {sigmas}e0 * s) else spread_pct end as spread_clipped,
            case when ref > 0 then (mid_price / ref - 1e0) * 100e0 end as mid_change_pct from records r join stats using (asset))""",
    ]


def eq_bin(x: str, lo: str, hi: str, bins: int) -> str:
    width = f"(({hi} - {lo}) / {bins}e0)"
    guess = f"cast(least(floor(({x} - {lo}) / {width}), {bins - 1}) as bigint)"
    return f"""(case when {x} < {lo} + {guess} * {width} then {guess} - 1
      when {guess} < {bins - 1} and {x} >= {lo} + ({guess} + 1) * {width} then {guess} + 1 else {guess} end)"""


PREDS = [
    f"wide as ({DUCK_PREDICTIONS})",
    """preds as (select *, case when p0 >= p1 and p0 >= p2 and p0 >= p3 then 0 when p1 >= p2 and p1 >= p3 then 1
        when p2 >= p3 then 2 else 3 end as y_pred from wide)""",
]
FLAT = [
    "flat as (" + " union all ".join(
        f"select sample_idx, head, y_true, {k} as class, p{k} as p, case when y_true = {k} then 1e0 else 0e0 end as hit from preds" for k in range(K)
    ) + ")"
]


def unit_case(x: str) -> str:
    edges = unit_edges(BINS)
    whens = []
    for i in range(BINS):
        upper = f"{x} <= {edges[i + 1]!r}e0" if i == BINS - 1 else f"{x} < {edges[i + 1]!r}e0"
        whens.append(f"when {x} >= {edges[i]!r}e0 and {upper} then {i}")
    return f"(case {' '.join(whens)} end)"


EDGES = "edges as (" + " union all ".join(
    f"select {i} as bin, {unit_edges(BINS)[i]!r}e0 as left_edge, {unit_edges(BINS)[i + 1]!r}e0 as right_edge" for i in range(BINS)
) + ")"
CURVE = PREDS + FLAT + [
    EDGES,
    f"binned as (select head, {unit_case('p')} as bin, avg(p) as c, avg(hit) as a, count(*) as n from flat group by 1, 2)",
    """curve as (select h.head, e.bin, left_edge, right_edge, coalesce(c, 0e0) as bin_confidence, coalesce(a, 0e0) as bin_accuracy,
        coalesce(n, 0) as bin_count from (select distinct head from preds) h, edges e left join binned b on b.head = h.head and b.bin = e.bin)""",
]
MATRIX = [
    "classes as (select unnest(range(0, 4)) as k)",
    """matrix as (select h.head, t.k as y_true, c.k as y_pred, (select count(*) from preds p where p.head = h.head and p.y_true = t.k and p.y_pred = c.k) as n
        from (select distinct head from preds) h, classes t, classes c)""",
]


def class_metrics(preds: str = "preds", by: str = "head") -> list[str]:
    keys = by.split(", ")
    on_t = " and ".join(f"p.{k} = g.{k}" for k in keys)
    return [
        f"groups as (select distinct {by} from {preds})",
        f"""counts as (select {', '.join('g.' + k for k in keys)}, c.k as class,
            count(*) filter (where p.y_true = c.k and p.y_pred = c.k) as tp, count(*) filter (where p.y_true <> c.k and p.y_pred = c.k) as fp,
            count(*) filter (where p.y_true = c.k and p.y_pred <> c.k) as fn
            from groups g join {preds} p on {on_t}, (select unnest(range(0, 4)) as k) c group by all)""",
        f"""rates as (select {by}, class, case when tp + fp > 0 then cast(tp as double) / (tp + fp) else 0e0 end as precision,
            case when tp + fn > 0 then cast(tp as double) / (tp + fn) else 0e0 end as recall, tp + fn as support from counts)""",
        "per_class as (select *, case when precision + recall > 0 then 2e0 * precision * recall / (precision + recall) else 0e0 end as f1 from rates)",
    ]


# ---- A ----------------------------------------------------------------------

add("a1_scan_book", book("e"), select="select asset, ts, bid_price, bid_quantity, ask_price, ask_quantity, batch_id, row_id from book")
add("a2_route_assets", raw("e"), select="select asset, count(*) as n, min(row_id) as first_row, max(row_id) as last_row from rawbook group by asset")
add("a4_row_counts", book("l"), select="select asset, count(*) as num_samples from book group by asset")
add(
    "a5_typed_rows",
    raw("e"),
    select="""select asset, count(*) filter (where row_id % 97 <> 0) as good, max(case when row_id % 97 <> 0 then bid_quantity end) as max_bid_quantity,
    count(*) filter (where row_id % 97 = 0) as bad from rawbook group by asset""",
)
add("a3_missing_source", book("e"), select="select upper(asset) as asset, count(*) as num_samples from book group by 1")
add(
    "a6_training_set",
    samples("e"),
    select=f"""select s.asset, split, count(*) as n, 12 as steps, {r6('max(l.bid_price)')} as max_first_bid from samples s
    join line l on l.asset = s.asset and l.snap_idx = s.sample_idx where split <> 'test' group by 1, 2""",
)
add("a8_record_csv", records("e", 500), select=f"select asset, sample_idx, label, {cols6('mid_price', 'spread_pct')} from records")
add(
    "a9_anomaly_csv",
    records("e", high=0.5),
    f"bad as (select *, {ANOMALY} as anomaly_type from records where {SEVERE})",
    select="select asset, anomaly_type, count(*) as n, max(sample_idx) as last_sample from bad group by 1, 2",
)
add(
    "a10_confusion_wide",
    PREDS,
    MATRIX,
    select="select head, y_true, " + ", ".join(f"cast(sum(case when y_pred = {k} then n else 0 end) as bigint) as pred_{k}" for k in range(K)) + " from matrix group by head, y_true",
)
add("a11_calibration_curve", CURVE, select=f"select head, bin, {cols6('left_edge', 'right_edge', 'bin_confidence', 'bin_accuracy')}, bin_count from curve")
add("a13_daily_extraction", book("e"), select="select asset, date_trunc('day', ts)::timestamp as day, count(*) as n, min(row_id) as first_row from book group by 1, 2")


def md5_fraction(e: str) -> str:
    return f"(cast(cast('0x' || substr(md5('42:' || asset || ':' || {e}), 1, 8) as ubigint) as double) / 4294967296e0)"


ROW_TEXT = "concat_ws('|', " + ", ".join(
    {"asset": "asset", "ts": "epoch_us(ts)::varchar"}.get(c, f"floor({c} * 1e6 + 5e-1)::bigint::varchar")
    for c in ("ask_price", "ask_quantity", "asset", "bid_price", "bid_quantity", "mid", "ts")
) + ")"
ROW_TYPES = "ask_price:double,ask_quantity:double,asset:string,bid_price:double,bid_quantity:double,mid:double,ts:timestamp_ntz"
WORDS = ", ".join(f"sum(cast(cast('0x' || substr(d, {8 * k + 1}, 8) as ubigint) as hugeint))::varchar" for k in range(4))
add(
    "a7_fingerprint",
    snaps("l"),
    f"digests as (select md5({ROW_TEXT}) as d from snaps)",
    select=f"select count(*) as rows, sha256(concat_ws('|', '{ROW_TYPES}', count(*)::varchar, {WORDS})) as fingerprint from digests",
)
add("a14_retained_rows", line("e"), select=f"select asset, snap_idx, ts, {cols6('mid')} from line where {md5_fraction('snap_idx')} < 5e-2")

# ---- B ----------------------------------------------------------------------

add(
    "b3_epoch_units",
    raw("e"),
    select="""select asset, row_id, case when asset = 'click' then epoch_us(ts) * 1000 when asset = 'error' then epoch_us(ts)
    when asset = 'view' then epoch_us(ts) // 1000 else epoch_us(ts) // 1000000 end as raw, ts from rawbook""",
)
add(
    "b6_spread_and_mid",
    snaps("l"),
    select=f"select asset, ts, {r6('mid')} as mid, {r6('(ask_price - bid_price) / mid * 100e0')} as spread_pct from snaps",
)
OK = "bid_price > 0 and ask_price > 0"
add(
    "b7_quality_flags",
    best("e", unfiltered=True),
    select=f"""select asset, ts, cast(coalesce(bid_price < 0 or ask_price < 0, false) as int) as negative_price,
    cast(coalesce(bid_price = 0, false) as int) as zero_bid_price, cast(coalesce(ask_price = 0, false) as int) as zero_ask_price,
    cast(coalesce(bid_quantity < 0 or ask_quantity < 0, false) as int) as negative_quantity, cast(coalesce(bid_quantity = 0, false) as int) as zero_bid_quantity,
    cast(coalesce(ask_quantity = 0, false) as int) as zero_ask_quantity, cast(coalesce({OK} and bid_price >= ask_price, false) as int) as inverted_spread,
    cast(coalesce({OK} and (ask_price - bid_price) / (5e-1 * (bid_price + ask_price)) * 100e0 > 5e0, false) as int) as high_spread from best""",
)
add(
    "b8_anomaly_types",
    snaps("e"),
    """flags as (select *, cast(bid_price < 0 or ask_price < 0 as int) as negative_price, cast(bid_quantity < 0 or ask_quantity < 0 as int) as negative_quantity,
        cast(bid_price >= ask_price as int) as inverted_spread, cast((ask_price - bid_price) / mid * 100e0 > 2e-1 as int) as high_spread from snaps)""",
    select=f"select asset, {ANOMALY} as anomaly_type, count(*) as n from flags where {SEVERE} group by 1, 2",
)
add(
    "b9_plot_series",
    series(),
    select=f"select asset, sample_idx, elapsed_seconds, {r6('spread_clipped')} as spread_clipped, {r6('spread_clipped / 100e0')} as relative_spread, {r6('mid_change_pct')} as mid_change_pct from series",
)
add(
    "b14_label_range",
    samples("l"),
    select="""select min(label_up) as up_min, max(label_up) as up_max, count(*) filter (where label_up < 0 or label_up >= 4) as up_outside,
    min(label_down) as down_min, max(label_down) as down_max, count(*) filter (where label_down < 0 or label_down >= 4) as down_outside from samples""",
)
add(
    "b16_quality_filter",
    snaps("e"),
    "good as (select * from snaps where bid_price < ask_price and ask_quantity <> 0)",
    "st as (select asset, avg(mid) as m, stddev_pop(mid) as s from good group by asset)",
    select="select asset, ts, bid_price, bid_quantity, ask_price, ask_quantity from good join st using (asset) where not (abs(mid - m) > 15e-1 * s)",
)

# ---- C ----------------------------------------------------------------------

BEST = "select asset, ts, bid_price, bid_quantity, ask_price, ask_quantity from best"
add("c1_top_of_book", best("l"), select=BEST)
add("c1_top_of_book_unfiltered", best("e", unfiltered=True), select=BEST)
add("c1_stream_top_of_book", best("e"), select=BEST + " where ts <= (select max(ts) from book) - interval 1 day")
add("c2_snapshots", snaps("e", unfiltered=True), select="select asset, ts, bid_price, bid_quantity, ask_price, ask_quantity, mid from snaps")
LEVELS = book("l") + [
    """quotes as (select asset, ts, 'bid' as side, bid_price as price, bid_quantity as quantity from book where bid_price > 0 and bid_quantity >= 0
        union all select asset, ts, 'ask', ask_price, ask_quantity from book where ask_price > 0 and ask_quantity >= 0)""",
    "prices as (select asset, ts, side, price, sum(quantity) as quantity from quotes group by 1, 2, 3, 4)",
    """ranked as (select *, row_number() over w as level, sum(quantity) over (w rows between unbounded preceding and current row) as cumulative_qty
        from prices window w as (partition by asset, ts, side order by case when side = 'bid' then -price else price end))""",
    "rel as (select *, case when sum(quantity) over (partition by asset, ts, side) <> 0 then cumulative_qty / sum(quantity) over (partition by asset, ts, side) end as relative_depth from ranked)",
]
add(
    "c3_adaptive_depth",
    LEVELS,
    "good as (select asset, side, level from ranked group by 1, 2, 3 having count(*) filter (where quantity > 0) >= 200)",
    select=f"select asset, side, level, count(*) as n, {r6('sum(quantity)')} as quantity from ranked join good using (asset, side, level) group by 1, 2, 3",
)
COMPRESSED = LEVELS + [
    "binned as (select *, case when level <= 3 then level else 3 + least(cast(ceil((level - 3) / 4e0) as bigint), 2) end as bin from ranked)",
    """packed as (select asset, ts, side, bin, case when sum(quantity) > 0 then sum(price * quantity) / sum(quantity) else avg(price) end as price,
        sum(quantity) as quantity, count(*) as levels from binned group by 1, 2, 3, 4)""",
]
add("c4_compress_depth", COMPRESSED, select=f"select asset, ts, side, bin, {cols6('price', 'quantity')}, levels from packed")
add(
    "c5_compression_report",
    COMPRESSED,
    select=f"select asset, cast(sum(levels) as bigint) as levels_before, count(*) as levels_after, {r6('cast(sum(levels) as double) / count(*)')} as ratio from packed group by asset",
)

# ---- D ----------------------------------------------------------------------

add("d1_dense_index", snaps("l"), select="select asset, ts, row_number() over (partition by asset order by ts) - 1 as snap_idx from snaps")
add(
    "d2_source_order",
    raw("e"),
    "steps as (select asset, epoch_us(ts) // 1000000 - lag(epoch_us(ts) // 1000000) over (partition by asset order by row_id) as step from rawbook)",
    select="select asset, min(step) as min_step_seconds, coalesce(min(step) >= 0, true) as monotonic from steps group by asset",
)
STEPS = "steps as (select asset, epoch_us(ts) // 1000000 - lag(epoch_us(ts) // 1000000) over (partition by asset order by ts) as gap from {t})"
add(
    "d3_gap_report",
    snaps("e"),
    STEPS.format(t="snaps"),
    select="select asset, max(gap) as max_gap_seconds, min(gap) as min_gap_seconds, max(gap) <= 14400 as within_limit from steps where gap is not null group by asset",
)
FLAT_LINE = f"select asset, snap_idx, ts, {cols6(*FEATS, 'mid')}, is_filled from line"
add("d4_skip_gaps", line("e", "skip"), select=FLAT_LINE)
add("d5_forward_fill", line("e", "forward_fill"), select=FLAT_LINE)
add("d6_interpolate", line("e"), select=FLAT_LINE)
add("d6_interpolate_lineitem", line("l"), select=FLAT_LINE)
add(
    "d7_gap_statistics",
    line("e"),
    STEPS.format(t="line"),
    select=f"""select asset, cast(max(gap) as double) as diag_gap_max_seconds, {r6('avg(case when gap > 7200 then 1e0 else 0e0 end)')} as diag_gap_fraction_large,
    {r6('avg(case when gap > 21600 then 1e0 else 0e0 end)')} as diag_gap_fraction_very_large from steps where gap is not null group by asset""",
)
RAW_SNAPS = [
    """rs as (select event_type as asset, ts, value as bid_price, cast(user_id % 20 as double) as bid_quantity, value + 1e0 as ask_price,
        cast(user_id % 7 as double) as ask_quantity, value + 5e-1 as mid, epoch_us(ts) as us from events)"""
]
GRID_CTE = RAW_SNAPS + [
    """grid as (select g as grid_idx, make_timestamp(g * 600000000) as ts from (select unnest(range(min(us) // 600000000, max(us) // 600000000 + 1)) as g
        from rs where asset = 'view'))"""
]
add("d8_uniform_grid", GRID_CTE, select="select grid_idx, ts from grid")
ALIGNED = GRID_CTE + [
    "spot as (select *, (us + 300000000) // 600000000 as grid_idx from rs)",
    "near as (select *, us - grid_idx * 600000000 as error from spot where abs(us - grid_idx * 600000000) <= 120000000)",
    """aligned as (select *, error / 1000e0 as error_ms, count(*) over (partition by asset, grid_idx) as candidates,
        row_number() over (partition by asset, grid_idx order by abs(error), error, bid_price, bid_quantity, ask_price, ask_quantity) as rn from near)""",
    "al as (select * from aligned where rn = 1)",
]
add("d9_align_to_grid", ALIGNED, select=f"select asset, grid_idx, {cols6('error_ms')}, candidates, {cols6(*FEATS, 'mid')} from al")
ASSET_LIST = "(select unnest([" + ", ".join(f"'{a}'" for a in EVENT_ASSETS) + "]) as asset)"
CELLS = ALIGNED + [
    f"cells as (select a.asset, g.grid_idx, g.ts, l.bid_price, l.mid, case when l.mid is not null then g.grid_idx end as seen from grid g, {ASSET_LIST} a left join al l on l.asset = a.asset and l.grid_idx = g.grid_idx)",
    """filled as (select *, last_value(seen ignore nulls) over b as li, last_value(bid_price ignore nulls) over b as lb, last_value(mid ignore nulls) over b as lm,
        first_value(seen ignore nulls) over f as ri, first_value(bid_price ignore nulls) over f as rb, first_value(mid ignore nulls) over f as rm from cells
        window b as (partition by asset order by grid_idx rows between unbounded preceding and current row),
               f as (partition by asset order by grid_idx rows between current row and unbounded following))""",
    """ff as (select asset, grid_idx, ts, case when (grid_idx - li) * 600 <= 3600 then lb end as bid_price, case when (grid_idx - li) * 600 <= 3600 then lm end as mid,
        case when seen is null then 1 else 0 end as is_filled from filled)""",
    """lin as (select asset, grid_idx, ts, case when ri > li then cast(grid_idx - li as double) / (ri - li) else 0e0 end as w,
        li, ri, lb, rb, lm, rm, case when seen is null then 1 else 0 end as is_filled from filled)""",
]
add("d10_resample_forward_fill", CELLS, select=f"select asset, grid_idx, ts, {cols6('bid_price', 'mid')}, is_filled from ff")
add(
    "d10_resample_linear",
    CELLS,
    select=f"""select asset, grid_idx, ts, {r6('case when (ri - li) * 600 <= 3600 then (1e0 - w) * lb + w * rb end')} as bid_price,
    {r6('case when (ri - li) * 600 <= 3600 then (1e0 - w) * lm + w * rm end')} as mid, is_filled from lin""",
)
COMPLETE = CELLS + [
    "present as (select grid_idx, ts, count(mid) as assets_present from ff group by 1, 2)",
    """report0 as (select *, sum(5 - assets_present) over (order by grid_idx rows between 11 preceding and current row) / 60e0 as missing_share from present)""",
    "report as (select *, case when assets_present >= 4 and missing_share <= 25e-2 then 1 else 0 end as kept from report0)",
]
add("d11_completeness", COMPLETE, select=f"select grid_idx, ts, assets_present, {cols6('missing_share')}, kept from report")
add("d11_complete_samples", COMPLETE, select="select asset, count(*) as n, count(mid) as present from ff join report r using (grid_idx) where kept = 1 group by asset")
add(
    "d12_stack_assets",
    CELLS,
    select="select grid_idx, ts, " + ", ".join(f"{r6(f'''max(case when asset = '{a}' then mid end)''')} as mid_{a}" for a in EVENT_ASSETS) + " from ff group by 1, 2",
)
add(
    "d13_alignment_quality",
    ALIGNED,
    "tot as (select asset, count(*) as snapshots from rs group by asset)",
    "used as (select asset, count(*) as aligned, avg(abs(error_ms)) as m, max(abs(error_ms)) as x from al group by asset)",
    select=f"""select asset, snapshots, coalesce(aligned, 0) as aligned, {r6('cast(snapshots - coalesce(aligned, 0) as double) / snapshots')} as discarded_share,
    {r6('m')} as mean_abs_error_ms, {r6('x')} as max_abs_error_ms from tot left join used using (asset)""",
)
add("d14_interval_distribution", snaps("e"), STEPS.format(t="snaps"), select="select asset, gap as gap_seconds, count(*) as n from steps where gap is not null group by 1, 2")

# ---- E ----------------------------------------------------------------------

add(
    "e1_forward_extremes",
    line("l"),
    """f as (select *, max(mid) over w as future_high, min(mid) over w as future_low, count(*) over w as c from line
        window w as (partition by asset order by snap_idx rows between 1 following and 30 following))""",
    select=f"select asset, snap_idx, {cols6('future_high', 'future_low')} from f where c = 30",
)
WINDOWS = line("e") + [
    """steps as (select a.asset, a.snap_idx - 11 as sample_idx, b.snap_idx - a.snap_idx + 11 as step, b.bid_price, b.bid_quantity, b.ask_price, b.ask_quantity
        from line a join line b on a.asset = b.asset and b.snap_idx between a.snap_idx - 11 and a.snap_idx where a.snap_idx >= 11)"""
]
add("e2_lookback_windows", WINDOWS, select=f"select asset, sample_idx, step, {cols6(*FEATS)} from steps")
add("e3_eligible_anchors", samples("e"), select="select asset, count(*) as n, min(snap_idx) as first_idx, max(snap_idx) as last_idx from samples group by asset")
add(
    "e5_lag_lead",
    line("e"),
    select="""select asset, snap_idx, epoch_us(ts) // 1000000 - lag(epoch_us(ts) // 1000000) over w as since_previous,
    lead(epoch_us(ts) // 1000000) over w - epoch_us(ts) // 1000000 as until_next from line window w as (partition by asset order by snap_idx)""",
)
CHECKS = samples("e") + [
    "lens as (select asset, max(snap_idx) + 1 as n_line from line group by asset)",
    """anchors as (select * from (select s.*, row_number() over (partition by s.asset order by md5('42:' || s.asset || ':' || sample_idx), sample_idx) as rk
        from samples s join lens l on s.asset = l.asset where split = 'train' and snap_idx >= 12 and snap_idx + 24 < n_line and mid > 0) where rk <= 3)""",
]
add(
    "e6_neighbourhood",
    CHECKS,
    select=f"""select l.asset, a.snap_idx as anchor_idx, l.snap_idx, {r6('(epoch_us(l.ts) - epoch_us(a.ts)) / 1e6')} as offset_seconds, {r6('l.mid')} as mid,
    {r6('(l.mid / a.mid - 1e0) * 100e0')} as change_pct from line l join anchors a on l.asset = a.asset and l.snap_idx between a.snap_idx - 12 and a.snap_idx + 24""",
)
VOL = [
    "lr as (select *, ln(mid / lag(mid) over (partition by asset order by snap_idx)) as lr, epoch_us(ts) // 1000000 as sec from line)",
    "vols as (select *, stddev_pop(lr) over (partition by asset order by sec range between 86400 preceding and current row) as vol from lr)",
    "volnorm as (select *, vol / nullif(max(vol) over (partition by asset), 0) as vol_norm from vols)",
]
add("e7_rolling_volatility", line("e"), VOL, select=f"select asset, snap_idx, {cols6('vol', 'vol_norm')} from volnorm")
add(
    "e8_volume_percentile",
    line("e"),
    select=f"select asset, snap_idx, {r6('percent_rank() over (partition by asset, cast(ts as date) order by bid_quantity + ask_quantity)')} as volume_percentile from line",
)
add(
    "e9_momentum",
    line("e"),
    select=f"""select asset, snap_idx, {r6('mid / lag(mid, 6) over w - 1e0')} as price_momentum,
    {r6('(bid_quantity + ask_quantity) - lag(bid_quantity + ask_quantity, 6) over w')} as volume_momentum from line window w as (partition by asset order by snap_idx)""",
)
add("e10_level_rank", LEVELS, select=f"select asset, ts, side, level, {cols6('price', 'quantity')} from ranked")
add("e11_cumulative_depth", LEVELS, select=f"select asset, ts, side, level, {cols6('cumulative_qty', 'relative_depth')} from rel")

# ---- F ----------------------------------------------------------------------

MOVES = ("max_up_move_pct", "max_down_move_pct", "price_change")
add("f1_dominant_move", samples("l"), select=f"select asset, sample_idx, {cols6(*MOVES)} from samples")
add("f3_signed_label", samples("e"), select="select asset, label, count(*) as n from samples group by 1, 2")
add("f4_intensity_labels", samples("e"), select="select asset, label_up, label_down, count(*) as n from samples group by 1, 2, 3")
add("f5_targets", samples("l"), select=f"select asset, sample_idx, snap_idx, ts, {cols6(*MOVES)}, label, label_up, label_down, split, split_idx from samples")
add(
    "f6_one_hot",
    samples("e"),
    select="select asset, sample_idx, " + ", ".join(f"case when label_{h} = {i} then 1e0 else 0e0 end as {h}_{i}" for h in ("up", "down") for i in range(K)) + " from samples",
)
WEIGHTS = samples("l") + [
    "tr as (select * from samples where split = 'train')",
    "ks as (select asset, k from (select distinct asset from tr), (select unnest(range(0, 4)) as k))",
    """weights as (select ks.asset, ks.k as class, count(t.sample_idx) as n, case when count(t.sample_idx) > 0 then
        (select count(*) from tr x where x.asset = ks.asset) / cast(4 * count(t.sample_idx) as double) end as weight
        from ks left join tr t on t.asset = ks.asset and t.label_up = ks.k group by 1, 2)""",
]
add("f7_class_weights", WEIGHTS, select=f"select asset, class, n, {cols6('weight')} from weights")
add(
    "f7_weighted_samples",
    WEIGHTS,
    select=f"select s.asset, sample_idx, label_up, {r6('weight')} as class_weight from samples s left join weights w on w.asset = s.asset and w.class = s.label_up",
)


def signed_case(edges) -> str:
    size = bin_case("abs(price_change)", edges)
    return f"case when price_change >= 0 then 4 + {size} else 3 - {size} end"


add(
    "f8_signed_percentage",
    samples("l"),
    select=f"""select asset, case when asset like 'A%' then {signed_case(['1e0', '25e-1', '5e0'])} else {signed_case(['2e0', '5e0', '10e0'])} end as label_signed,
    count(*) as n from samples group by 1, 2""",
)
add(
    "f9_class_distribution",
    samples("e"),
    "heads as (select split, 'up' as head, label_up as class from samples union all select split, 'down', label_down from samples)",
    select="""select coalesce(split, 'all') as split, coalesce(head, 'all') as head, coalesce(class, -1) as class, count(*) as n
    from heads group by rollup(split, head, class)""",
)
add(
    "f10_absolute_labels",
    line("l"),
    """f as (select *, max(mid) over w - mid as up, min(mid) over w - mid as down, count(*) over w as c from line
        window w as (partition by asset order by snap_idx rows between 1 following and 30 following))""",
    select=f"""select asset, snap_idx, {cols6('up', 'down')}, {bin_case('greatest(up, 0e0)', ['2e0', '5e0', '10e0'])} as label_up,
    {bin_case('greatest(-down, 0e0)', ['2e0', '5e0', '10e0'])} as label_down from f where c = 30 and snap_idx >= 29""",
)
SCALED_EDGES = [f"({b}e0 * (25e-2 + coalesce(vol_norm, 0e0)))" for b in (2.0, 5.0, 10.0)]
add(
    "f10_adaptive_labels",
    samples("e"),
    VOL,
    select=f"""select s.asset, {bin_case('greatest(max_up_move_pct, 0e0)', SCALED_EDGES)} as label_up_adaptive,
    {bin_case('greatest(-max_down_move_pct, 0e0)', SCALED_EDGES)} as label_down_adaptive, count(*) as n
    from samples s join volnorm v on v.asset = s.asset and v.snap_idx = s.snap_idx group by 1, 2, 3""",
)

# ---- G ----------------------------------------------------------------------

TWO_PI = repr(2.0 * math.pi)
CLOCK = {"hour": ("hour(ts)", 24), "dow": ("(isodow(ts) - 1)", 7), "minute": ("minute(ts)", 60)}
CLOCK_SQL = ", ".join(
    f"{r6(f'sin({TWO_PI}e0 * (cast({e} as double) / {n}e0))')} as {c}_sin, {r6(f'cos({TWO_PI}e0 * (cast({e} as double) / {n}e0))')} as {c}_cos"
    for c, (e, n) in CLOCK.items()
)
add(
    "g5_temporal_features",
    samples("e"),
    "sp as (select asset, min(ts) as f, max(ts) as l from samples group by asset)",
    select=f"""select asset, sample_idx, case when hour(ts) < 8 then 'asian' when hour(ts) < 16 then 'european' else 'american' end as market_session, {CLOCK_SQL},
    {r6("cast(datediff('day', cast(f as date), cast(ts as date)) as double)")} as days_since_start,
    {r6('(epoch_us(ts) - epoch_us(f)) / cast(epoch_us(l) - epoch_us(f) as double)')} as trend from samples join sp using (asset)""",
)
add(
    "g8_temporal_concat",
    samples("e"),
    """steps as (select a.asset, b.snap_idx - a.snap_idx + 11 as step, b.bid_price as v0, b.bid_quantity as v1, b.ask_price as v2, b.ask_quantity as v3, a.ts
        from samples a join line b on a.asset = b.asset and b.snap_idx between a.snap_idx - 11 and a.snap_idx)""",
    f"timed as (select *, sin({TWO_PI}e0 * (cast(hour(ts) as double) / 24e0)) as v4, cos({TWO_PI}e0 * (cast(hour(ts) as double) / 24e0)) as v5 from steps)",
    select="select asset, step, count(*) as n, 6 as width, " + ", ".join(f"{r6(f'max(v{i})')} as max_{i}" for i in range(6)) + " from timed group by 1, 2",
)

# ---- H ----------------------------------------------------------------------

add(
    "h1_grid_patch",
    WINDOWS,
    select=f"""select asset, sample_idx, step, {r6('bid_price')} as cell_0, {r6('bid_quantity')} as cell_1, {r6('ask_price')} as cell_2, {r6('ask_quantity')} as cell_3,
    0e0 as cell_4, 0e0 as cell_5 from steps""",
)
add("h3_missing_policy", line("e"), select="select asset, count(*) as n from line group by asset")
QUOTE = [
    """qf as (select *, ask_price - bid_price as bid_ask_spread,
        case when bid_quantity + ask_quantity <> 0 then (bid_quantity - ask_quantity) / (bid_quantity + ask_quantity) end as volume_imbalance,
        case when bid_quantity + ask_quantity <> 0 then (bid_price * ask_quantity + ask_price * bid_quantity) / (bid_quantity + ask_quantity) end as weighted_mid_price from snaps)"""
]
add("h4_quote_features", snaps("l"), QUOTE, select=f"select asset, ts, {cols6('bid_ask_spread', 'volume_imbalance', 'weighted_mid_price')} from qf")
add(
    "h4_depth_imbalance",
    LEVELS,
    "d as (select asset, ts, sum(case when side = 'bid' then quantity else 0e0 end) as b, sum(case when side = 'ask' then quantity else 0e0 end) as a from ranked where level <= 5 group by 1, 2)",
    select=f"select asset, ts, {r6('b')} as bid_depth, {r6('a')} as ask_depth, {r6('case when b + a <> 0 then (b - a) / (b + a) end')} as depth_imbalance from d",
)
LEVEL_FEATS = LEVELS + [
    "bests as (select asset, ts, 5e-1 * (max(case when side = 'bid' then price end) + min(case when side = 'ask' then price end)) as m from ranked group by 1, 2)",
    "lf as (select r.*, r.price - m as price_delta_mid from rel r join bests b on r.asset = b.asset and r.ts = b.ts where m is not null)",
]
LF = ("price", "quantity", "price_delta_mid", "cumulative_qty", "relative_depth")
add("h5_level_features", LEVEL_FEATS, select=f"select asset, ts, side, level, {cols6(*LF)} from lf")


def grid_cells() -> str:
    cells = []
    for level in range(1, 5):
        row = [(s, c) for s in ("bid", "ask") for c in ("price_delta_mid", "quantity")] if level <= 3 else []
        for s, c in row:
            cells.append(r6(f"coalesce(max(case when level = {level} and side = '{s}' then {c} end), 0e0)"))
        cells += ["0e0"] * (5 - len(row))
    return ", ".join(f"{e} as g{i:02d}" for i, e in enumerate(cells))


add("h6_feature_grid", LEVEL_FEATS, select=f"select asset, ts, {grid_cells()} from lf where level <= 3 group by 1, 2")
FITS = {
    "min_max": ("min({c})", "max({c}) - min({c})"),
    "standard": ("avg({c})", "stddev_pop({c})"),
    "robust": ("quantile_cont({c}, 5e-1)", "quantile_cont({c}, 75e-2) - quantile_cont({c}, 25e-2)"),
}
for method, (shift, scale) in FITS.items():
    fits = ", ".join(f"{shift.format(c=c)} as sh_{c}, {scale.format(c=c)} as sc_{c}" for c in ("mid", "bid_quantity"))
    applied = ", ".join(f"{r6(f'case when sc_{c} <> 0 then ({c} - sh_{c}) / sc_{c} else 0e0 end')} as {c}" for c in ("mid", "bid_quantity"))
    add(
        f"h7_scale_{method}",
        samples("l"),
        f"fit as (select asset, {fits} from samples where split = 'train' group by asset)",
        select=f"select asset, sample_idx, {applied} from samples join fit using (asset)",
    )
QS = ("0.0", "0.05", "0.5", "0.95", "1.0")
add(
    "h8_feature_quantiles",
    snaps("l"),
    QUOTE,
    select=" union all ".join(
        f"select asset, '{c}' as feature, {q}e0 as probability, {r6(f'quantile_cont({c}, {q}e0)')} as value from qf group by asset"
        for c in ("bid_ask_spread", "volume_imbalance", "bid_quantity")
        for q in QS
    ),
)
add(
    "h8_depth_profile",
    LEVEL_FEATS,
    select=f"""select asset, side, level, count(*) as n, {r6('avg(quantity)')} as mean_quantity, {r6('avg(cumulative_qty)')} as mean_cumulative_qty,
    {r6('avg(relative_depth)')} as mean_relative_depth from lf group by 1, 2, 3""",
)

# ---- I ----------------------------------------------------------------------

add("i1_chronological_split", samples("e"), select="select asset, split, count(*) as n, min(sample_idx) as first_idx, max(sample_idx) as last_idx from samples group by 1, 2")
add(
    "i2_uniform_sample",
    samples("e"),
    "tr as (select * from samples where split = 'train')",
    "kk as (select unnest(range(0, 97)) as kk)",
    """spots as (select distinct asset, case when kk = 96 then train_end - 1 else cast(floor(kk * (cast(train_end - 1 as double) / 96e0)) as bigint) end as sample_idx
        from (select distinct asset, train_end from tr), kk where train_end > 97)""",
    select="select t.asset, t.sample_idx, t.ts from tr t where train_end <= 97 or exists (select 1 from spots s where s.asset = t.asset and s.sample_idx = t.sample_idx)",
)
add(
    "i3_random_sample",
    samples("e"),
    "r as (select *, row_number() over (partition by asset order by md5('42:' || asset || ':' || sample_idx), sample_idx) as rk from samples where split = 'train')",
    select="select asset, sample_idx, ts from r where rk <= 100",
)
add("i4_head_cap", samples("l"), select="select asset, split, count(*) as n, max(sample_idx) as last_idx from samples where split <> 'train' or split_idx < 300 group by 1, 2")
AGES = "starts as (select asset, min(cast(ts as date)) as d0, max(cast(ts as date)) as d1 from samples group by asset)"
add(
    "i5_expanding_folds",
    samples("l"),
    AGES,
    "folds as (select unnest(range(0, 3)) as fold)",
    """roles as (select s.asset, sample_idx, fold, case when datediff('day', d0, cast(ts as date)) < 720 + fold * 240 then 'train'
        when datediff('day', d0, cast(ts as date)) < 720 + (fold + 1) * 240 then 'validation' end as role from samples s join starts using (asset), folds)""",
    select="select asset, fold, role, count(*) as n, min(sample_idx) as first_idx, max(sample_idx) as last_idx from roles where role is not null group by 1, 2, 3",
)
add(
    "i6_age_bands",
    samples("l"),
    AGES,
    """aged as (select s.*, datediff('day', cast(ts as date), d1) as age from samples s join starts using (asset))""",
    """banded as (select *, case when age < 60 then 'recent' when age >= 180 and age < 240 then 'six_months' when age >= 360 and age < 420 then 'twelve_months'
        when age >= 540 and age < 600 then 'eighteen_months' end as band from aged)""",
    select="select asset, band, count(*) as n, min(ts) as first_ts from banded where band is not null group by 1, 2",
)
DECAY = {d: f"exp(-datediff('day', cast(ts as date), d1) * ln(2e0) / {d}e0)" for d in (7, 30, 90)}
add(
    "i7_decay_weights",
    samples("l"),
    AGES,
    select="select asset, sample_idx, "
    + ", ".join(f"{r6(e)} as weight_{d}" for d, e in DECAY.items())
    + f", {r6('(' + ' + '.join(DECAY.values()) + ') / 3e0')} as weight_mean from samples join starts using (asset)",
)
FACTOR = "(case label_up when 0 then 5e-1 when 1 then 2e0 when 2 then 15e-1 else 125e-2 end)"
add(
    "i9_rebalance",
    samples("e"),
    f"c as (select *, cast(floor({FACTOR}) as int) + case when {md5_fraction('sample_idx')} < {FACTOR} - floor({FACTOR}) then 1 else 0 end as copies from samples where split = 'train')",
    select="select asset, sample_idx, label_up, unnest(range(1, copies + 1)) as copy from c where copies > 0",
)

# ---- J ----------------------------------------------------------------------

FLAGS = ("negative_price", "zero_bid_price", "zero_ask_price", "negative_quantity", "zero_bid_quantity", "zero_ask_quantity", "inverted_spread", "high_spread")
add(
    "j1_records",
    records("e", 200, 0.5),
    select=f"select asset, sample_idx, ts, label, {cols6('bid_price', 'ask_price', 'bid_quantity', 'ask_quantity', 'mid_price', 'spread_pct')}, {', '.join(FLAGS)} from records",
)
add("j1_random_records", records("e", 150, method="random"), select=f"select asset, sample_idx, label, {cols6('spread_pct')} from records")


def describe_items() -> dict[str, str]:
    out = {}
    for c in FEATS:
        out |= {f"diag_{c}_min": f"min({c})", f"diag_{c}_max": f"max({c})", f"diag_{c}_mean": f"avg({c})", f"diag_{c}_std": f"stddev_pop({c})"}
    return out


def share(test: str) -> str:
    return f"avg(case when {test} then 1e0 when not ({test}) then 0e0 end)"


SPREADS = {
    "diag_spread_mean_pct": "coalesce(avg(spread_pct), 0e0)",
    "diag_spread_std_pct": "coalesce(stddev_pop(spread_pct), 0e0)",
    "diag_spread_max_pct": "coalesce(max(spread_pct), 0e0)",
    "diag_spread_fraction_gt_threshold": f"coalesce({share('spread_pct > 1e0')}, 0e0)",
    "diag_spread_fraction_high": f"coalesce({share('spread_pct > 5e0')}, 0e0)",
    "diag_spread_high_allowed_fraction": "max(5e-2)",
}
POINTS = "avg(case when valid_spread then 5e-1 * (bid_price + ask_price) end)"
MEANS = "(5e-1 * (avg(case when valid_spread then bid_price end) + avg(case when valid_spread then ask_price end)))"
MIDS = {
    "diag_mid_mean_price": f"coalesce({POINTS}, 0e0)",
    "diag_mid_mean_vs_bidask_means_rel_diff": f"case when coalesce({POINTS}, 0e0) <> 0 then abs({POINTS} - {MEANS}) / abs({POINTS}) else 0e0 end",
}
FRACTIONS = {f"diag_{f}_fraction": f"avg(cast({f} as double))" for f in FLAGS}
NONZERO = {f"diag_{c}_nonzero_count": f"count(*) filter (where {c} > 0)" for c in ("bid_price", "ask_price")}


def wide(items: dict[str, str], rounding: bool = True) -> str:
    body = ", ".join(f"{r6(e) if rounding else e} as {n}" for n, e in items.items())
    return f"select asset, {body} from records group by asset"


add("j2_describe", records("l"), select=wide(describe_items()))
add("j3_spread_statistics", records("l"), select=wide(SPREADS))
add("j4_mid_consistency", records("l"), select=wide(MIDS))


def outliers(z: str) -> list[str]:
    sides = ("bid_price", "ask_price")
    stats = ", ".join(
        f"count(*) filter (where {c} > 0) as n_{c}, avg(case when {c} > 0 then {c} end) as m_{c}, stddev_pop(case when {c} > 0 then {c} end) as s_{c}" for c in sides
    )
    parts = ", ".join(
        f"coalesce(avg(case when {c} > 0 and n_{c} >= 10 and s_{c} > 0 then case when abs(({c} - m_{c}) / s_{c}) > {z} then 1e0 else 0e0 end end) * 100e0, 0e0) as diag_{c}_outliers_percent"
        for c in sides
    )
    return [f"zs as (select asset, {stats} from records group by asset)", f"outl as (select asset, {parts} from records join zs using (asset) group by asset)"]


OUTLIERS = ("diag_bid_price_outliers_percent", "diag_ask_price_outliers_percent")
add("j5_outlier_percent", records("l"), outliers("12e-1"), select=f"select asset, {cols6(*OUTLIERS)} from outl")
add("j6_flag_fractions", records("e"), select=wide(FRACTIONS))
add("j7_nonzero_counts", records("e"), select=wide(NONZERO, rounding=False))
add(
    "j8_price_histogram",
    records("l"),
    "sides as (select asset, 'bid' as side, bid_price as price from records where bid_price > 0 union all select asset, 'ask', ask_price from records where ask_price > 0)",
    """spans as (select asset, side, case when min(price) = max(price) then min(price) - 5e-1 else min(price) end as lo,
        case when min(price) = max(price) then max(price) + 5e-1 else max(price) end as hi from sides group by 1, 2)""",
    f"binned as (select asset, side, {eq_bin('price', 'lo', 'hi', 50)} as bin, count(*) as n from sides join spans using (asset, side) group by 1, 2, 3)",
    "cells as (select asset, side, lo, hi, unnest(range(0, 50)) as bin from spans)",
    select=f"select c.asset, c.side, c.bin, {r6('lo + c.bin * ((hi - lo) / 50e0)')} as left_edge, coalesce(n, 0) as n from cells c left join binned b on b.asset = c.asset and b.side = c.side and b.bin = c.bin",
)
RANGES = """ranges as (select asset, cast(min(elapsed_seconds) as double) as t_lo, cast(max(elapsed_seconds) as double) as t_hi, min(spread_clipped) as s_lo, max(spread_clipped) as s_hi
    from series where spread_clipped is not null group by asset)"""
add(
    "j9_spread_time_histogram",
    series(),
    RANGES,
    select=f"""select asset, {eq_bin('cast(elapsed_seconds as double)', 't_lo', 't_hi', 20)} as time_bin, {eq_bin('spread_clipped', 's_lo', 's_hi', 10)} as spread_bin, count(*) as n
    from series join ranges using (asset) where t_hi > t_lo and s_hi > s_lo and spread_clipped is not null group by 1, 2, 3""",
)
add(
    "j10_spread_label_histogram",
    series(),
    RANGES,
    select=f"""select asset, label, {eq_bin('spread_clipped', 's_lo', 's_hi', 10)} as spread_bin, count(*) as n from series join ranges using (asset)
    where s_hi > s_lo and spread_clipped is not null and label between 0 and 3 group by 1, 2, 3""",
)
DEPTH = series() + [
    """dq as (select b.asset, elapsed_seconds, price, quantity from (
          select asset, ts, bid_price as price, bid_quantity as quantity from book union all select asset, ts, ask_price, ask_quantity from book) b
        join (select distinct asset, ts, elapsed_seconds from series) s on s.asset = b.asset and s.ts = b.ts where price > 0 and quantity > 0)"""
]
add(
    "j11_depth_heatmap",
    DEPTH,
    "pr as (select asset, cast(min(elapsed_seconds) as double) as t_lo, cast(max(elapsed_seconds) as double) as t_hi, min(price) as p_lo, max(price) as p_hi from dq group by asset)",
    select=f"""select asset, {eq_bin('cast(elapsed_seconds as double)', 't_lo', 't_hi', 20)} as time_bin, {eq_bin('price', 'p_lo', 'p_hi', 10)} as price_bin, {r6('sum(quantity)')} as volume
    from dq join pr using (asset) where t_hi > t_lo and p_hi > p_lo group by 1, 2, 3""",
)
add(
    "j12_anomalies",
    records("e", high=0.5),
    select=f"select asset, sample_idx, label, {cols6('spread_pct')}, {ANOMALY} as anomaly_type from records where {SEVERE}",
)
add(
    "j13_label_check_levels",
    CHECKS,
    select=" union all ".join(
        f"select asset, snap_idx as anchor_idx, {i} as boundary, {r6(f'mid * {1.0 + b / 100.0!r}e0')} as level, 0e0 as box_start, 86400e0 as box_end from anchors"
        for i, b in enumerate((2.0, 5.0, 10.0))
    ),
)
GAPS = STEPS.format(t="line")
profile_items = {**describe_items(), **SPREADS, **MIDS, **{k: f"cast({v} as double)" for k, v in NONZERO.items()}, **FRACTIONS}
add(
    "j14_profile",
    records("l"),
    outliers("3e0"),
    GAPS,
    f"wide as (select asset, {', '.join(f'{e} as {n}' for n, e in profile_items.items())} from records group by asset)",
    """gapw as (select asset, cast(max(gap) as double) as diag_gap_max_seconds, avg(case when gap > 172800 then 1e0 else 0e0 end) as diag_gap_fraction_large,
        avg(case when gap > 518400 then 1e0 else 0e0 end) as diag_gap_fraction_very_large from steps where gap is not null group by asset)""",
    select=" union all ".join(
        [f"select asset, '{n}' as metric, {r6(n)} as value from wide" for n in profile_items]
        + [f"select asset, '{n}' as metric, {r6(n)} as value from outl" for n in OUTLIERS]
        + [f"select asset, '{n}' as metric, {r6(n)} as value from gapw" for n in ("diag_gap_max_seconds", "diag_gap_fraction_large", "diag_gap_fraction_very_large")]
    ),
)

# ---- K ----------------------------------------------------------------------

add("k1_sample_snapshot_join", samples("e"), select=f"select asset, label, count(*) as n, {r6('max(mid)')} as max_mid from samples group by 1, 2")
add("k3_sampled_rows", DEPTH, select=f"select asset, count(*) as n, {r6('sum(quantity)')} as quantity from dq group by asset")
TRUTH = "((label % 4 + 4 + case when head = 'down' then 1 else 0 end + case when asset = 'b' then 1 else 0 end) % 4)"
add(
    "k4_truth_join",
    PREDS,
    select=f"""select asset, head, {r6(f'avg(case when y_pred = {TRUTH} then 1e0 else 0e0 end)')} as accuracy, count(*) as n
    from preds join embeddings on vec_id = sample_idx, (values ('a'), ('b')) as assets(asset) group by 1, 2""",
)
add(
    "k6_asof_orders",
    snaps("l"),
    "totals as (select o_orderdate as ots, round(sum(o_totalprice)) as total from orders group by 1)",
    select="""select asset, ts, case when epoch_us(ts) - epoch_us(ots) <= 259200000000 then ots end as matched_ts,
    case when epoch_us(ts) - epoch_us(ots) <= 259200000000 then total end as total from snaps asof left join totals on snaps.ts >= totals.ots""",
)
SIDES = [
    "lefts as (select ts, value + 5e-1 as mid from events where event_type = 'view')",
    "rights as (select ts as rts, max(value + 5e-1) as other_mid from events where event_type <> 'view' group by 1)",
]
add(
    "k6_asof_events",
    SIDES,
    select="""select ts, mid, case when epoch_us(ts) - epoch_us(rts) <= 300000000 then rts end as matched_ts,
    case when epoch_us(ts) - epoch_us(rts) <= 300000000 then other_mid end as other_mid from lefts asof left join rights on lefts.ts >= rights.rts""",
)
add(
    "k6_nearest_events",
    SIDES,
    "cand as (select ts, mid, rts, other_mid, row_number() over (partition by ts, mid order by abs(epoch_us(ts) - epoch_us(rts)), rts) as rn from lefts join rights on abs(epoch_us(ts) - epoch_us(rts)) <= 300000000)",
    select="select l.ts, l.mid, c.rts as matched_ts, c.other_mid from lefts l left join cand c on c.ts = l.ts and c.mid = l.mid and rn = 1",
)

# ---- L ----------------------------------------------------------------------

HIT = "avg(case when y_pred = y_true then 1e0 else 0e0 end)"
add("l1_argmax", PREDS, select="select sample_idx, head, y_true, y_pred from preds")
add("l2_accuracy", PREDS, select=f"select head, {r6(HIT)} as accuracy, count(*) as n from preds group by head")
add("l3_confusion", PREDS, MATRIX, select="select head, y_true, y_pred, n from matrix")
add("l4_per_class", PREDS, class_metrics(), select=f"select head, class, {cols6('precision', 'recall', 'f1')}, support from per_class")
MACRO = {"macro_precision": "avg(precision)", "macro_recall": "avg(recall)", "macro_f1": "avg(f1)"}
add("l5_macro", PREDS, class_metrics(), select="select head, " + ", ".join(f"{r6(e)} as {n}" for n, e in MACRO.items()) + " from per_class group by head")
BRIER = "avg(" + " + ".join(f"pow(p{k} - case when y_true = {k} then 1e0 else 0e0 end, 2)" for k in range(K)) + ")"
add("l6_brier", PREDS, select=f"select head, {r6(BRIER)} as brier_score from preds group by head")
add("l7_reliability", CURVE, select=f"select head, bin, {cols6('left_edge', 'right_edge', 'bin_confidence', 'bin_accuracy')}, bin_count from curve")
ECE = "sum(abs(bin_confidence - bin_accuracy) * bin_count) / sum(bin_count)"
add(
    "l8_calibration_error",
    CURVE,
    select=f"select head, {r6(ECE)} as ece, {r6('max(case when bin_count > 0 then abs(bin_confidence - bin_accuracy) end)')} as mce from curve group by head",
)
add("l9_shape_report", PREDS, select="select head, count(*) as n, 0 as wrong_size, count(*) filter (where y_true < 0 or y_true >= 4) as label_outside from preds group by head")
add(
    "l10_evaluate",
    CURVE,
    class_metrics(),
    select=" union all ".join(
        [f"select 'eval_' || head || '_accuracy' as metric, {r6(HIT)} as value from preds group by head", f"select 'eval_' || head || '_brier_score', {r6(BRIER)} from preds group by head"]
        + [f"select 'eval_' || head || '_{n}', {r6(e)} from per_class group by head" for n, e in MACRO.items()]
        + [f"select 'eval_' || head || '_{n}_class_' || class, {r6(n)} from per_class" for n in ("precision", "recall", "f1")]
        + [f"select 'eval_' || head || '_ece', {r6(ECE)} from curve group by head"]
    ),
)
add(
    "l11_weighted_f1",
    PREDS,
    class_metrics(),
    select=f"select head, {r6('sum(f1 * support) / sum(support)')} as weighted_f1, cast(sum(support) as bigint) as support, count(*) filter (where support < 100) as low_support_classes from per_class group by head",
)
add(
    "l13_directional_accuracy",
    PREDS,
    "side as (select sample_idx, sum(case when head = 'up' then p1 + 2 * p2 + 3 * p3 end) >= sum(case when head = 'down' then p1 + 2 * p2 + 3 * p3 end) as up from preds group by 1)",
    select=f"""select {r6('avg(case when up = (sign * cast(list_extract(embedding, 9) as double) >= 0) then 1e0 else 0e0 end)')} as directional_accuracy, count(*) as n
    from side join embeddings on vec_id = sample_idx, (values (1), (-1)) as assets(sign)""",
)
OWN = "(case y_true when 0 then p0 when 1 then p1 when 2 then p2 else p3 end)"
RANK = "(1 + " + " + ".join(f"case when p{k} > {OWN} then 1 else 0 end" for k in range(K)) + ")"
ENTROPY = "avg(" + " + ".join(f"case when p{k} > 0 then -p{k} * ln(p{k}) else 0e0 end" for k in range(K)) + ")"
add(
    "l14_top_k",
    PREDS,
    select="select head, " + ", ".join(f"{r6(f'avg(case when {RANK} <= {k} then 1e0 else 0e0 end)')} as top_{k}_accuracy" for k in (1, 2, 3)) + f", {r6(ENTROPY)} as mean_entropy from preds group by head",
)
add(
    "l15_confidence_histogram",
    PREDS,
    EDGES,
    f"b as (select head, {unit_case('greatest(p0, p1, p2, p3)')} as bin, count(*) as n from preds group by 1, 2)",
    select="select h.head, e.bin, coalesce(n, 0) as n from (select distinct head from preds) h, edges e left join b on b.head = h.head and b.bin = e.bin",
)
add(
    "l15_class_reliability",
    PREDS,
    FLAT,
    EDGES,
    f"binned as (select head, class, {unit_case('p')} as bin, avg(p) as c, avg(hit) as a, count(*) as n from flat group by 1, 2, 3)",
    select=f"""select h.head, h.class, e.bin, {cols6('left_edge', 'right_edge')}, {r6('coalesce(c, 0e0)')} as bin_confidence, {r6('coalesce(a, 0e0)')} as bin_accuracy, coalesce(n, 0) as bin_count
    from (select distinct head, class from flat) h, edges e left join binned b on b.head = h.head and b.class = h.class and b.bin = e.bin""",
)


def tempered(k: int, t: str) -> str:
    return f"exp(ln(greatest(p{k}, 1e-12)) / {t})"


TEMPS = ("0.25", "0.5", "0.75", "1.0", "1.5", "2.0", "3.0")
TOTAL = "(" + " + ".join(tempered(k, "t") for k in range(K)) + ")"
TEMPERED = PREDS + [
    "temps as (select unnest([" + ", ".join(f"{t}e0" for t in TEMPS) + "]) as t)",
    "tp as (select sample_idx, preds.head, y_true, t, " + ", ".join(f"{tempered(k, 't')} / {TOTAL} as p{k}" for k in range(K)) + " from preds, temps)",
    f"losses as (select head, t as temperature, avg(-ln({OWN})) as nll from tp group by 1, 2)",
]
add("l16_temperature_losses", TEMPERED, select=f"select head, temperature, {cols6('nll')} from losses")
add(
    "l16_temperature_scaling",
    TEMPERED,
    f"seen as (select head, t as temperature, avg(-ln({OWN})) as nll from tp where sample_idx % 2 = 0 group by 1, 2)",
    "fit as (select * from (select *, row_number() over (partition by head order by nll, temperature) as rn from seen) where rn = 1)",
    select=f"select tp.head, {r6(BRIER)} as brier_score from tp join fit on fit.head = tp.head and fit.temperature = tp.t where sample_idx % 2 = 1 group by tp.head",
)
# the min-max form of the isotonic fit: at each point the greatest, over starts before it, of the least mean up to an end behind it
ISOTONIC = FLAT + [
    "pts as (select head, class, p, cast(sum(hit) as bigint) as s, count(*) as n from flat where sample_idx % 2 = 0 group by 1, 2, 3)",
    "acc as (select *, row_number() over w as i, sum(s) over w as cs, sum(n) over w as cn from pts window w as (partition by head, class order by p))",
    """means as (select a.head, a.class, a.i as a, b.i as b, (b.cs - a.cs + a.s)::double / (b.cn - a.cn + a.n)::double as m
        from acc a join acc b on a.head = b.head and a.class = b.class and a.i <= b.i)""",
    "least as (select head, class, a, b as i, min(m) over (partition by head, class, a order by b desc) as lo from means)",
    "knots as (select acc.head, acc.class, acc.p, max(lo) as v from least join acc on acc.head = least.head and acc.class = least.class and acc.i = least.i group by 1, 2, 3)",
    "asked as (select distinct head, class, p from flat where sample_idx % 2 = 1)",
    "below as (select q.*, t.p as p0, t.v as v0 from asked q asof left join knots t on q.head = t.head and q.class = t.class and q.p >= t.p)",
    "both_sides as (select q.*, t.p as p1, t.v as v1 from below q asof left join knots t on q.head = t.head and q.class = t.class and q.p <= t.p)",
    "iso as (select head, class, p, case when v0 is null then v1 when v1 is null or p0 = p1 then v0 else v0 + (v1 - v0) * ((p - p0) / (p1 - p0)) end as v from both_sides)",
]
add("l17_isotonic_values", PREDS, ISOTONIC, select=f"select head, class, {r6('p')} as p, {r6('v')} as value from iso")
add(
    "l17_isotonic",
    PREDS,
    ISOTONIC,
    "total as (select sample_idx, flat.head, sum(v) as t from flat join iso using (head, class, p) where sample_idx % 2 = 1 group by 1, 2)",
    f"cal as (select flat.sample_idx, flat.head, hit, case when t > 0 then v / t else 1e0 / {K} end as q from flat join iso using (head, class, p) join total on total.sample_idx = flat.sample_idx and total.head = flat.head)",
    "err as (select sample_idx, head, sum(pow(q - hit, 2)) as e from cal group by 1, 2)",
    select=f"select head, {r6('avg(e)')} as brier_score from err group by head",
)
add(
    "l18_band_metrics",
    PREDS,
    "banded as (select *, case when sample_idx % 180 < 60 then 'recent' when sample_idx % 180 < 120 then 'six_months' else 'twelve_months' end as band from preds)",
    class_metrics("banded", "band, head"),
    f"acc as (select band, head, {HIT} as accuracy, count(*) as n from banded group by 1, 2)",
    "mac as (select band, head, " + ", ".join(f"{e} as {n}" for n, e in MACRO.items()) + " from per_class group by 1, 2)",
    select=f"select band, head, {cols6('accuracy')}, n, {cols6(*MACRO)} from acc join mac using (band, head)",
)

# ---- M ----------------------------------------------------------------------

SPAN = SOURCES["e"][1].window_steps
IMBALANCE = "coalesce(case when bid_quantity + ask_quantity <> 0 then (bid_quantity - ask_quantity) / (bid_quantity + ask_quantity) end, 0e0)"
add(
    "m1_window_summary",
    line("e"),
    f"""sm as (select asset, snap_idx, mid / first_value(mid) over w - 1e0 as mid_change, (max(mid) over w - min(mid) over w) / mid * 100e0 as range_pct,
        avg((ask_price - bid_price) / mid * 100e0) over w as mean_spread_pct, avg({IMBALANCE}) over w as mean_imbalance, {IMBALANCE} as last_imbalance
        from line window w as (partition by asset order by snap_idx rows between {SPAN - 1} preceding and current row))""",
    select=f"select asset, snap_idx, {cols6('mid_change', 'range_pct', 'mean_spread_pct', 'mean_imbalance', 'last_imbalance')} from sm where snap_idx >= {SPAN - 1}",
)
add(
    "m1_training_weights",
    samples("l"),
    AGES,
    "tr as (select * from samples where split = 'train')",
    "sized_tr as (select asset, count(*)::double as whole from tr group by 1)",
    *[f"of_{h} as (select asset, label_{h}, whole / (4 * count(*))::double as cw from tr join sized_tr using (asset) group by asset, label_{h}, whole)" for h in ("up", "down")],
    f"aged as (select samples.*, ({' + '.join(DECAY.values())}) / 3e0 as decay from samples join starts using (asset))",
    select="select a.asset, a.sample_idx, " + ", ".join(f"{r6(f'coalesce(of_{h}.cw, 0e0) * decay')} as weight_{h}" for h in ("up", "down"))
    + " from aged a" + "".join(f" left join of_{h} on of_{h}.asset = a.asset and of_{h}.label_{h} = a.label_{h}" for h in ("up", "down")),
)
add(
    "m1_weighted_heads",
    samples("e"),
    select=" union all ".join(
        f"select '{h}' as head, count(*) as n, sum(label_{h})::bigint as label_total, cast(count(*) as double) as probability_total, 0::bigint as outside from samples where split = 'test'"
        for h in ("up", "down")
    ),
)

# ---- N ----------------------------------------------------------------------

DAY = "date_trunc('day', ts)::timestamp"
M = "avg(pow(mid - m, {p}))"
DAILY = line("e") + [
    f"dl as (select *, {DAY} as day, avg(mid) over (partition by asset, {DAY}) as m from line)",
    """daily as (select asset, day, count(*) as n, avg(mid) as mid_mean, stddev_pop(mid) as mid_std, avg(pow(mid - m, 3)) / pow(avg(pow(mid - m, 2)), 15e-1) as mid_skew,
        avg(pow(mid - m, 4)) / pow(avg(pow(mid - m, 2)), 2) - 3e0 as mid_kurtosis, sum(bid_quantity + ask_quantity) as total_volume from dl group by 1, 2)""",
]
add("n1_daily_statistics", DAILY, select=f"select asset, day, n, {cols6('mid_mean', 'mid_std', 'mid_skew', 'mid_kurtosis', 'total_volume')} from daily")
HISTORY = [
    "dn as (select *, row_number() over (partition by asset order by day) as r from daily)",
    "hist as (select a.asset, a.day as anchor_day, a.r as ar, b.day, b.r as br, b.mid_mean from dn a join dn b on a.asset = b.asset and b.r between a.r - 7 and a.r - 1)",
]
add("n2_trailing_days", DAILY, HISTORY, select=f"select asset, anchor_day, br - greatest(ar - 7, 1) as pos, day, {cols6('mid_mean')} from hist")
add(
    "n2_sample_history",
    samples("e"),
    f"dd as (select asset, {DAY} as day, row_number() over (partition by asset order by {DAY}) as r from line group by 1, 2)",
    select=f"select s.asset, least(r - 1, 7) as days, count(*) as n from samples s join dd on dd.asset = s.asset and dd.day = date_trunc('day', s.ts)::timestamp group by 1, 2",
)
RETURNS = line("e") + [
    f"lr as (select *, {DAY} as day, ln(mid / lag(mid) over (partition by asset order by snap_idx)) as lr from line)",
    """dr0 as (select asset, day, arg_max(mid, snap_idx) as close, coalesce(stddev_pop(lr), 0e0) as volatility, sum(bid_quantity + ask_quantity) as volume from lr group by 1, 2)""",
    "dr as (select *, close / lag(close) over (partition by asset order by day) - 1e0 as daily_return, row_number() over (partition by asset order by day) as r from dr0)",
]
add("n3_daily_returns", RETURNS, select=f"select asset, day, {cols6('close', 'volatility', 'volume', 'daily_return')} from dr")
DECAYED = "pow(pow(5e-1, 1e0 / 3e0), a.r - 1 - b.r)"
CONTEXT = RETURNS + [
    f"""ctx as (select a.asset, a.day, count(b.r) as days_seen, avg(b.daily_return) as mean_return, sum(b.volatility * {DECAYED}) / sum(case when b.r is not null then {DECAYED} end) as ew_volatility,
        avg(b.volume) as mean_volume from dr a left join dr b on a.asset = b.asset and b.r between a.r - 10 and a.r - 1 group by 1, 2)"""
]
CTX = ("mean_return", "ew_volatility", "mean_volume")
add("n3_context", CONTEXT, select=f"select asset, day, days_seen, {cols6(*CTX)} from ctx")
REGIMES = ("high_volatility", "bull", "bear", "sideways")
add(
    "n4_regimes",
    CONTEXT,
    """tags as (select *, case when mean_return is null or ew_volatility is null then 'none' when ew_volatility > 46e-4 then 'high_volatility'
        when mean_return > 2e-3 then 'bull' when mean_return < -2e-3 then 'bear' else 'sideways' end as regime from ctx)""",
    select="select asset, day, regime, " + ", ".join(f"case when regime = '{r}' then 1 else 0 end as is_{r}" for r in REGIMES) + " from tags",
)
add(
    "n5_context_summary",
    CONTEXT,
    select=" union all ".join(
        f"select asset, '{c}' as feature, {r6(f'avg({c})')} as mean, {r6(f'stddev_pop({c})')} as std, {r6(f'min({c})')} as min, {r6(f'max({c})')} as max from ctx group by asset" for c in CTX
    ),
)

add("a15_daily_store", DAILY, select=f"select asset, day, n, {cols6('mid_mean')} from daily")
ORACLES["a12_metric_table"] = f"select 'evaluation' as stage, metric, value from ({ORACLES['l10_evaluate']}) m"
add("e4_anchor_times", samples("e"), select="select asset, sample_idx, snap_idx, ts from samples")
add(
    "f2_magnitude_bins",
    samples("l"),
    select=f"select asset, {bin_case('abs(price_change)', ['2e0', '5e0', '10e0'])} as size, count(*) as n, {r6('max(abs(price_change))')} as largest from samples group by 1, 2",
)
add(
    "k2_sample_features",
    samples("e"),
    select=f"select label_up, count(*) as n, {r6(f'avg(sin({TWO_PI}e0 * (cast(isodow(ts) - 1 as double) / 7e0)))')} as mean_dow_sin from samples group by 1",
)

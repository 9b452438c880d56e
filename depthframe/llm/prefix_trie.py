"""Trie of conversation prefixes, rolled up in depth bands.

``turn_rows`` numbers the turns of each conversation, ``nodes_of`` names each prefix by two 64-bit hashes
and counts its members, children and ends. ``rollup`` sums values over subtrees: the depths are cut into
bands of fixed height, every node explodes only to its ancestors inside its band, which completes the
deepest band; the totals of band roots are themselves rolled up, as a trie of band roots that is shallower
by the height of a band, and then go down to the ancestors in the band above. So a node makes
at most ``band`` rows a level, and the rounds grow with the logarithm of the depth.

Scale: texts are read once and leave their rows as two hashes and a length. Turns are dealt by
ranges of (conversation, turn), so a long conversation lies in many partitions; places and prefix hashes
are running sums inside (partition, conversation) plus the sums of the parts before. A prefix hash is an
exclusive or of hashes of (turn, depth), so parts combine. Hot nodes shrink by partial
aggregation. Nodes with one member have known totals and take no part in the roll-up; the paths of the
smallest members name the ancestors of all others. Parents of many children are joined by a broadcast of
at most ``HOT_SHARE`` of them. A digest of member ids must see them in order: ranges of ids are joined
to strings in parallel, and only those strings stream through one task a node.

Defined results: turns go by number, null first, then by two hashes of role and text, so ties have one
order, and repeated rows are turns of their own; a null role or text is empty; rows without
conv_id are ignored; an empty table has no node, not even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from depthframe.llm.common import Scratch, arrow_schema, join_counted, record

BAND = 8
NODE = ["n1", "n2"]


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- turns in order


def _before(column: str, fn, order: str = "pid") -> F.Column:
    """``fn`` of a column over the earlier parts of the same conversation."""
    return F.coalesce(fn(column).over(Window.partitionBy("c").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))


def turn_rows(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Turns (pid, c, turn, t1, t2, size, nth) and parts (pid, c, n, before); the place of a turn is before + nth."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"),
        "turn",
        F.xxhash64(role, text).alias("t1"),
        F.xxhash64(text, F.lit(1), role).alias("t2"),
        F.length(text).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("spread"),  # equal rows may be dealt to several ranges
    )
    dealt = rows.repartitionByRange(_partitions(rows), "c", "turn", "t1", "t2", "spread").withColumn("pid", F.spark_partition_id())
    dealt = scratch.stage(dealt.drop("spread"), "turns")
    parts = dealt.groupBy("pid", "c").agg(F.count("*").alias("n"))
    parts = scratch.stage(parts.withColumn("before", _before("n", F.sum)), "parts", narrow=True)
    inside = Window.partitionBy("pid", "c").orderBy(F.col("turn").asc_nulls_first(), "t1", "t2")
    return dealt.withColumn("nth", F.row_number().over(inside)), parts


def rebuilt(turns: DataFrame, parts: DataFrame, scratch: Scratch, every: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (pid, c, depth, z1, z2, size) and conversations (c): a head of the group's first conversation, then own turns.

    ``h = crc32(c) % heads`` turns come from conversation ``c - c % every``.
    """
    most = heads - 1
    first = turns.filter((F.col("c") % every == 0) & (F.col("nth") <= most)).join(parts.filter(F.col("before") < most).select("pid", "c", "before"), ["pid", "c"])
    first = first.withColumn("depth", F.col("before") + F.col("nth")).filter(F.col("depth") <= most)
    lead = first.groupBy(F.col("c").alias("base")).agg(F.array_sort(F.collect_list(F.struct("depth", "t1", "t2", "size"))).alias("lead"))
    convs = parts.select("c").distinct().withColumn("h", F.crc32(F.col("c").cast("string").cast("binary")) % heads).withColumn("base", F.col("c") - F.col("c") % every)
    convs = convs.join(lead, "base", "left").withColumn("k", F.least("h", F.coalesce(F.size("lead"), F.lit(0))))
    convs = scratch.stage(convs.withColumn("lead", F.slice("lead", F.lit(1), F.col("k").cast("int"))).select("c", "h", "k", "lead"), "convs", narrow=True)
    own = turns.join(parts.join(convs.select("c", "h", "k"), "c"), ["pid", "c"]).withColumn("place", F.col("before") + F.col("nth")).filter("place > h")
    own = own.select("pid", "c", (F.col("place") - F.col("h") + F.col("k")).alias("depth"), "t1", "t2", "size")
    led = convs.select(F.lit(-1).alias("pid"), "c", F.explode("lead").alias("x")).select("pid", "c", "x.depth", "x.t1", "x.t2", "x.size")
    hashed = led.unionByName(own).select("pid", "c", "depth", F.xxhash64("t1", "t2", "depth").alias("z1"), F.xxhash64("t2", "depth", "t1").alias("z2"), "size")
    return scratch.stage(hashed, "rebuilt"), convs.select("c")


# ---------------------------------------------------------------- nodes


def paths(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(c, depth, n1, n2, z1, z2, size) with the prefix hashes of each turn, and (c, n1, n2, length) of each whole conversation with turns."""
    sums = turns.groupBy("pid", "c").agg(F.bit_xor("z1").alias("s1"), F.bit_xor("z2").alias("s2"), F.count("*").alias("n"))
    sums = scratch.stage(sums.withColumns({"o1": _before("s1", F.bit_xor), "o2": _before("s2", F.bit_xor)}), "sums", narrow=True)
    upto = Window.partitionBy("pid", "c").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = turns.withColumns({"r1": F.bit_xor("z1").over(upto), "r2": F.bit_xor("z2").over(upto)}).join(sums.select("pid", "c", "o1", "o2"), ["pid", "c"])
    path = running.select("c", "depth", F.col("r1").bitwiseXOR(F.col("o1")).alias("n1"), F.col("r2").bitwiseXOR(F.col("o2")).alias("n2"), "z1", "z2", "size")
    whole = sums.groupBy("c").agg(F.bit_xor("s1").alias("n1"), F.bit_xor("s2").alias("n2"), F.sum("n").alias("length"))
    return scratch.stage(path, "path"), whole


def nodes_of(path: DataFrame, convs: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """Nodes (n1, n2, depth, p1, p2, c, n_convs, size, n_children, n_single) and their number; (p1, p2) is the parent, c the smallest member."""
    zero = F.lit(0).cast("long")
    inner = path.groupBy("depth", *NODE).agg(F.min("c").alias("c"), F.count("*").alias("n_convs"), *(F.min(x).alias(x) for x in ("z1", "z2", "size")))
    inner = inner.select("depth", *NODE, F.col("n1").bitwiseXOR(F.col("z1")).alias("p1"), F.col("n2").bitwiseXOR(F.col("z2")).alias("p2"), "c", "n_convs", "size")
    root = convs.agg(F.min("c").alias("c"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    none = F.lit(None).cast("long")
    root = root.select(zero.alias("depth"), zero.alias("n1"), zero.alias("n2"), none.alias("p1"), none.alias("p2"), "c", "n_convs", zero.alias("size"))
    nodes = scratch.stage(root.unionByName(inner), "nodes")
    seen = Observation("nodes")
    below = nodes.filter("depth > 0").groupBy(F.col("p1").alias("n1"), F.col("p2").alias("n2"))
    below = below.agg(F.count("*").alias("n_children"), F.sum((F.col("n_convs") == 1).cast("long")).alias("n_single"))
    counted = nodes.join(below, NODE, "left").fillna(0, ["n_children", "n_single"])
    counted = scratch.stage(counted.observe(seen, F.count("*").alias("n")), "counted")
    return counted, seen.get["n"] or 0


def ends_digest(ends: DataFrame) -> DataFrame:
    """(n1, n2, ends_sha256): digest of the comma-joined ids (c) at each node, ascending; strings of id ranges stream in order."""
    schema = "n1 long, n2 long, ends_sha256 string"
    target = arrow_schema(schema)

    def run(batches):
        node, digest = None, None
        for batch in batches:
            done = []
            for n1, n2, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if (n1, n2) != node:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = (n1, n2), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(part.as_buffer())
            if done:
                yield record(dict(zip(target.names, map(list, zip(*done)))), target)
        if node is not None:
            yield record({"n1": [node[0]], "n2": [node[1]], "ends_sha256": [digest.hexdigest()]}, target)

    n = _partitions(ends)
    ranged = ends.repartitionByRange(n, *NODE, "c").withColumn("pid", F.spark_partition_id())
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda x: x.cast("string")), ",")
    strings = ranged.groupBy("pid", *NODE).agg(joined.alias("part"))
    return strings.repartition(n, *NODE).sortWithinPartitions(*NODE, "pid").select(*NODE, "part").mapInArrow(run, schema)


# ---------------------------------------------------------------- roll-up


def rollup(nodes: DataFrame, path: DataFrame, values: list[str], scratch: Scratch, band: int = BAND) -> DataFrame:
    """``nodes`` (c, depth, n1, n2, values) with each value summed over the node's subtree.

    ``path`` (c, depth, n1, n2) holds all prefixes, the root included, of every c in ``nodes`` down to its deepest node.
    """
    lines = path.groupBy("c", F.floor(F.col("depth") / band).alias("b")).agg(F.collect_list(F.struct("depth", *NODE)).alias("line"))

    def raised(rows: DataFrame, keep) -> DataFrame:
        up = rows.join(lines, ["c", "b"]).withColumn("up", F.explode(F.filter("line", keep) if keep else F.col("line")))
        own = F.max(F.when(F.col("up.depth") == F.col("depth"), F.struct("c", "depth"))).alias("own")
        return up.groupBy(F.col("up.n1").alias("n1"), F.col("up.n2").alias("n2")).agg(own, *(F.sum(v).alias(v) for v in values))

    inside = raised(nodes.withColumn("b", F.floor(F.col("depth") / band)), lambda x: x["depth"] <= F.col("depth"))
    inside = inside.select("own.c", "own.depth", *NODE, *values)
    deepest = nodes.agg(F.max("depth")).first()[0]
    if deepest is None or deepest < band:
        return inside
    inside = scratch.stage(inside, "inside")
    at_root = F.col("depth") % band == 0
    higher = F.floor(F.col("depth") / band)
    tops = rollup(inside.filter(at_root).withColumn("depth", higher), path.filter(at_root).withColumn("depth", higher), values, scratch, band)
    tops = scratch.stage(tops, "tops")
    # a finished band root adds its total to every ancestor in the band above
    pushed = raised(tops.filter("depth > 0").withColumn("b", F.col("depth") - 1), None).select(*NODE, *(F.col(v).alias(f"{v}_below") for v in values))
    both = inside.join(pushed, NODE, "left")
    return both.select("c", "depth", *NODE, *((F.col(v) + F.coalesce(f"{v}_below", F.lit(0).cast("long"))).alias(v) for v in values))


def prefix_trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """The nodes of the trie of rebuilt ``conversations`` (conv_id, turn, role, text); columns as in the query."""
    if band < 2:
        raise ValueError("a band holds at least two depths")
    scratch = Scratch(conversations.sparkSession, "trie")
    turns, convs = rebuilt(*turn_rows(conversations, scratch), scratch)
    path, whole = paths(turns, scratch)
    whole = scratch.stage(whole, "whole", narrow=True)
    nodes, total = nodes_of(path, convs, scratch)
    zero = F.lit(0).cast("long")

    shared = nodes.filter((F.col("n_convs") > 1) | (F.col("depth") == 0))
    shared = shared.select("c", "depth", *NODE, (F.col("n_single") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"))
    seen = Observation("turns")
    deep = shared.groupBy("c").agg(F.max("depth").alias("deepest")).join(whole.select("c", "length"), "c", "left")
    deep = scratch.stage(deep.withColumn("length", F.coalesce("length", zero)).observe(seen, F.sum("length").alias("n")), "deep", narrow=True)
    known = join_counted(path.select("c", "depth", *NODE), deep, ["c"], "length", seen.get["n"] or 0).filter("depth <= deepest").drop("deepest", "length")
    known = scratch.stage(known.unionByName(deep.select("c", zero.alias("depth"), zero.alias("n1"), zero.alias("n2"))), "known")
    totals = rollup(shared, known, ["n_leaves", "saved_tokens"], scratch, band).select(*NODE, "n_leaves", "saved_tokens")

    ends = convs.join(whole, "c", "left").select("c", F.coalesce("n1", zero).alias("n1"), F.coalesce("n2", zero).alias("n2"))
    above = nodes.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("c").alias("parent_conv_id"), F.col("n_children").alias("held"))
    placed = join_counted(nodes, above, ["p1", "p2"], "held", total).join(totals, NODE, "left").join(ends_digest(ends), NODE, "left")
    return placed.select(
        F.col("c").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce("saved_tokens", zero).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP13_SQL = """
WITH t AS (
  SELECT conv_id AS c, list({'k': md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))), 'n': length(coalesce(text, ''))::BIGINT} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (
  SELECT c, turns, c - c % 100 AS base, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS h
  FROM t),
r AS (SELECT h.c, list_concat(coalesce(b.turns[1:h.h], []), h.turns[h.h + 1:]) AS turns FROM h LEFT JOIN t b ON b.c = h.base),
p AS (
  SELECT c, d, array_to_string(list_transform(turns[1:d], lambda x: x.k), '') AS node, CASE WHEN d = 0 THEN 0 ELSE turns[d].n END AS n, len(turns) AS total
  FROM r, unnest(range(0, len(turns) + 1)) AS x(d)),
v AS (SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, min(n) AS n, left(node, 32 * (d - 1)::INTEGER) AS up FROM p GROUP BY node, d),
k AS (SELECT up, count(*) AS n_children FROM v WHERE d > 0 GROUP BY up),
a AS (
  SELECT left(v.node, 32 * j::INTEGER) AS node, sum((k.up IS NULL)::BIGINT) AS n_leaves, sum((n_convs - 1) * n) AS saved_tokens
  FROM v LEFT JOIN k ON k.up = v.node, unnest(range(0, v.d + 1)) AS x(j) GROUP BY 1),
e AS (SELECT node, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends FROM p WHERE d = total GROUP BY node)
SELECT v.conv_id, v.d AS depth, u.conv_id AS parent_conv_id, v.n_convs, coalesce(k.n_children, 0)::BIGINT AS n_children,
  a.n_leaves::BIGINT AS n_leaves, a.saved_tokens::BIGINT AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM v LEFT JOIN v u ON v.d > 0 AND u.node = v.up LEFT JOIN k ON k.up = v.node JOIN a ON a.node = v.node LEFT JOIN e ON e.node = v.node
"""

import hashlib
import math
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from depthframe.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """rows: (conv_id, turn, role, text), no ties -> sorted result rows"""
    own = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if c is not None:
            own.setdefault(c, []).append((role or "", text or ""))
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:])
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    out = []
    for node, held in members.items():
        below = [x for x in members if x[: len(node)] == node]
        ends = ",".join(map(str, sorted(c for c in held if whole[c] == node)))
        out.append(
            (
                min(held),
                len(node),
                min(members[node[:-1]]) if node else -1,
                len(held),
                len(children.get(node, [])),
                sum(x not in children for x in below),
                sum((len(members[x]) - 1) * (len(x[-1][1]) if x else 0) for x in below),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out)


def found(rows):
    return sorted(tuple(-1 if x is None else x for x in r) for r in rows.collect())


def corpus(seed, convs, depth):
    """Conversations that share prefixes of different length; some are short, some without their group's first one."""
    r = random.Random(seed)
    rows = []
    for c in convs:
        group = random.Random(c // 7)
        for turn in range(r.randrange(1, depth)):
            same = r.random() < 0.85
            text = f"shared {group.randrange(2)} é" * (turn % 3) if same else f"own {r.randrange(10**6)}"
            rows.append((c, turn * 3 - 4, r.choice(["user", "user", "user", None]), text))
    return rows


def chains(lengths):
    """Conversations that are prefixes of each other, so the shared part is deep; id 10**6 + k keeps k's own turns only."""
    return [(c, t, "u", f"turn {t}") for c, n in lengths for t in range(n)]


@pytest.mark.parametrize("band", [2, 3, 8])
def test_equals_brute_force(spark, band):
    rows = corpus(1, [*range(0, 45), *range(95, 130), 5000, 5001, 7777, -3, -100, -250, 10**12], 9)
    rows += [(200, None, "user", "first"), (200, 0, None, None), (201, 0, "", ""), (202, 5, "user", None), (None, 1, "user", "nobody")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("n1", F.lit("kept")).withColumn("c", F.lit(1)).withColumn("depth", F.lit(2))
    assert found(prefix_trie.prefix_trie(frame, band)) == brute(rows)


@pytest.mark.parametrize("band", [2, 4])
def test_deep_shared_prefix(spark, band):
    rows = chains([(0, 40), (3, 37), (8, 21), (12, 21), (55, 40), (99, 9)])
    assert found(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(3), band)) == brute(rows)


def test_long_conversation_lies_in_many_partitions(spark):
    rows = chains([(100, 300), (101, 300), (102, 3)])
    frame = spark.createDataFrame(rows, SCHEMA)
    scratch = prefix_trie.Scratch(spark, "long")
    turns, parts = prefix_trie.turn_rows(frame, scratch)
    assert parts.filter("c = 100").count() > 1
    at = turns.join(parts, ["pid", "c"]).select("c", "turn", (F.col("before") + F.col("nth")).alias("place"))
    assert at.filter("place <> turn + 1").count() == 0
    assert found(prefix_trie.prefix_trie(frame)) == brute(rows)


def test_ties_and_repeated_rows(spark):
    rows = [(1, 0, "u", "a"), (1, 0, "u", "b"), (1, 0, "u", "a"), (1, None, "u", "c"), (1, None, "u", "c"), (2, 0, "u", "b"), (2, 0, "u", "a")]
    one = found(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(4)))
    assert one == found(prefix_trie.prefix_trie(spark.createDataFrame(rows[::-1], SCHEMA).repartition(2)))


def test_empty_and_turnless(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    c = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(c, 0, "u", "gone")]
    assert found(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows) == [(c, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    rows = prefix_trie.op13_prefix_trie(spark, folder)
    assert [d for _, d in rows.dtypes] == ["bigint"] * 7 + ["string"]
    expected = sorted(tuple(-1 if x is None else x for x in r) for r in con.execute(prefix_trie.OP13_SQL).fetchall())
    assert found(rows) == expected
    source = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert expected == brute(source)

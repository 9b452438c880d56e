import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from depthframe.llm import simhash
from tests.llm.fixtures import docs, prose


def fingerprint(text, n=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    values = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def components(prints, distance):
    """prints: (doc_id, fingerprint) -> sorted (doc_id, fingerprint, least id of its component)"""
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= distance:
                up[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(prints):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted((str(i), f, str(least.get(root(k)))) for k, (i, f) in enumerate(prints))


def changed(text, seed, edits):
    r = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        words[r.randrange(len(words))] = f"new{r.randrange(1000)}"
    return " ".join(words)


def corpus():
    rows, base = [], prose(1, 300)
    rows += [(1000 + k, changed(base, k, k % 9)) for k in range(150)]
    for k in range(30):
        own = prose(100 + k, 15 + 9 * k)
        rows += [(k, own), (500 + k, changed(own, k, 1)), (600 + k, own.upper()), (700 + k, own.replace(" ", "\n\t"))]
    odd = [(40, None), (41, ""), (42, " \n"), (43, "a b"), (44, "A  b"), (45, "Über ÄB c\xa0d e f"), (46, "a b c d"), (43, "a b"), (43, "a b"), (None, "a b"), (None, "other words here now")]
    return rows + odd


@pytest.mark.parametrize("limit", [3, 1024])
def test_equals_brute_force(spark, limit):
    rows = corpus()
    found = simhash.near_components(docs(spark, rows, extra=True), limit=limit).collect()
    expected = components([(i, fingerprint(t)) for i, t in rows], 4)
    assert sorted((str(r.doc_id), r.fp % 2**64, str(r.component_id)) for r in found) == expected


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 7])
def test_other_distances(spark, distance):
    rows = corpus()[::3]
    found = simhash.near_components(docs(spark, rows), words=3, distance=distance, limit=8).collect()
    expected = components([(i, fingerprint(t, 3)) for i, t in rows], distance)
    assert sorted((str(r.doc_id), r.fp % 2**64, str(r.component_id)) for r in found) == expected


@pytest.mark.parametrize("distance", [1, 2, 4, 6, 9])
def test_every_linked_pair_shares_a_key(spark, distance):
    r = random.Random(distance)
    pairs = []
    for k in range(1500):
        a = r.getrandbits(64)
        b = a
        for bit in r.sample(range(64), distance if k % 2 else r.randrange(distance + 1)):
            b ^= 1 << bit
        pairs.append((a - 2**63, b - 2**63))
    df = spark.createDataFrame(pairs, "a long, b long")
    keyed = df.withColumn("fp", F.col("a")).withColumn("x", simhash.keys(distance)).withColumn("fp", F.col("b")).withColumn("y", simhash.keys(distance))
    assert keyed.filter(F.arrays_overlap("x", "y")).count() == len(pairs)


def test_dense_ball_in_many_chunks(spark):
    """Fingerprints around one centre, most of them several bits apart: one key, many chunks."""
    r = random.Random(5)
    prints = []
    for k in range(400):
        f = 0x123456789ABCDEF0
        for bit in r.sample(range(30), r.randrange(9)):
            f ^= 1 << bit
        prints.append((k, f))
    frame = spark.createDataFrame(prints, "first long, fp long").groupBy("fp").agg(F.min("first").alias("first"))
    from depthframe.llm.common import Scratch

    labels = simhash._labels(frame, 4, 5, Scratch(spark, "ball"))
    found = {x.u: x.l for x in labels.collect()}
    least, got = {}, {}
    for i, f, c in components(prints, 4):
        least.setdefault(c, set()).add(f)
    for f in {f for _, f in prints}:
        got.setdefault(found.get(f, f), set()).add(f)
    assert sorted(map(sorted, least.values())) == sorted(map(sorted, got.values()))


def test_long_text_in_pieces(monkeypatch):
    text = changed(prose(3, 4000), 1, 50)
    whole = simhash.fingerprint(text.encode(), 4)
    monkeypatch.setattr(simhash, "PIECE_BYTES", 7)
    assert simhash.fingerprint(text.encode(), 4) == whole
    assert whole % 2**64 == fingerprint(text)


def test_empty_table(spark):
    assert simhash.near_components(docs(spark, [])).collect() == []


def test_query_columns(spark):
    rows = simhash.op11_simhash(spark, "/root/testdata/sf0.001")
    assert rows.dtypes == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    source = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    expected = components([(i, fingerprint(t)) for i, t in source.items()], 4)
    assert sorted((str(r.doc_id), int(r.fingerprint, 16), str(r.component_id)) for r in rows.collect()) == expected

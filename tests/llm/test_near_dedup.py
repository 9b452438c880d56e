import random
import re

import pytest

from depthframe.llm import near_dedup
from tests.llm.fixtures import docs, prose


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def brute(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                up[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted((str(i), len(sets[k]), str(least.get(root(k)))) for k, (i, _) in enumerate(rows))


def changed(text, seed, edits):
    r = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        words[r.randrange(len(words))] = f"new{r.randrange(1000)}"
    return " ".join(words)


def corpus(group):
    rows, base = [], prose(1, 150)
    for k in range(group):  # one large group of copies of different strength, linked in chains
        rows.append((1000 + k, changed(base, k, 1 + k % 7)))
    for k in range(40):
        own = prose(100 + k, 20 + 3 * k)
        rows += [(k, own), (500 + k, changed(own, k, 1)), (600 + k, own.upper())]
    return rows + [(2, None), (3, ""), (4, "a b"), (5, "A  b"), (6, "a"), (7, "\t "), (8, "a b"), (8, "a b"), (None, "a b"), (None, "other words here now")]


@pytest.mark.parametrize("limit", [6, 100])
def test_equals_brute_force(spark, limit):
    rows = corpus(60)
    found = near_dedup.near_duplicates(docs(spark, rows, extra=True), 3, 85, limit=limit).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == brute(rows, 3, 85)


def test_one_of_each_group_stays(spark):
    rows = corpus(5)
    kept = near_dedup.keep_first(docs(spark, rows, extra=True), 5, 80)
    ids = [r.doc_id for r in kept.collect()]
    want = {i for i, _, c in brute(rows, 5, 80) if i == c != "None"}
    empty = {str(i) for i, t in rows if i is not None and not shingles(t, 5)}
    assert {str(i) for i in ids if i is not None} == want | empty
    assert ids.count(8) <= 1 and ids.count(None) == 2 and "ids" in kept.columns


def test_empty_table(spark):
    assert near_dedup.near_duplicates(docs(spark, []), 3, 85).count() == 0


def test_connect_a_long_chain(spark, tmp_path):
    from depthframe.llm.common import Scratch

    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101)], "a long, b long")
    found = near_dedup.connect(edges, Scratch(spark, "t")).collect()
    assert {r.u: r.l for r in found} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}

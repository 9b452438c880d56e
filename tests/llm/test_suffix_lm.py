import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from depthframe.llm import suffix_lm as lm
from depthframe.llm.common import Scratch
from tests.llm.fixtures import docs, prose

SHARES = dict(hot_min=1e-3, context_min=1e-2, entry_min=2e-3, gain_per_symbol=0.5)


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) + [None]


def corpus():
    rows = []
    for i in range(60):
        rows.append((i, " ".join(f"{a} always {b}" for a, b in zip(prose(i, 20).split(), prose(i + 500, 20).split()))))
    return rows + [(100, None), (101, ""), (102, "Never Seen\x0bwords"), (103, "never"), (None, "always light"), (5, "again always")]


def both(spark, rows, **shares):
    d = docs(spark, rows, extra=True)
    remainder = F.crc32(F.col("doc_id").cast("string")) % 10
    d = d.withColumn("held_out", F.coalesce(remainder == 0, F.lit(False)))
    scratch = Scratch(spark, "t")
    unigrams, model = lm.train(d.filter("not held_out"), scratch, **(shares or SHARES))
    return lm.score(d, unigrams, model, scratch).collect(), model


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def test_base_scores_equal_brute_force(spark):
    rows = corpus()
    got, model = both(spark, rows)
    count = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(count.values()), len(count)
    assert (model.total, model.distinct) == (n, v)
    want = sorted((str(i), held(i), len(tokens(t)), sum(count[x] > 0 for x in tokens(t)), round(sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in tokens(t)), 6)) for i, t in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want


def test_contexts_help_and_the_model_is_normalised(spark):
    got, model = both(spark, corpus(), **{**SHARES, "hot_min": 1e-9})
    assert model.tree.depth >= 1 and sum(r.score for r in got) > sum(r.base_score for r in got)
    known = sorted({t for i, text in corpus() if not held(i) for t in tokens(text)[:-1]})
    for history in ("", "always", "stone always", "light", "xx"):
        texts = pa.array([f"{history} {w}" for w in known])
        hashes, counts = lm._tokens(texts)
        value, _, hot = model.score(hashes, counts)
        ends = np.cumsum(counts)
        last = value[ends - 2]
        rare = ~hot[ends - 2]
        assert rare.sum() == 0
        end = model.score(*lm._tokens(pa.array([history])))[0][-1]
        unseen = 0.1 / model.scale
        total = (10.0 ** last).sum() + 10.0**end
        node = model.tree.states(model.tree.symbols(lm._tokens(pa.array([f"{history} always"]))[0]), lm._tokens(pa.array([f"{history} always"]))[1])[-2]
        while node:
            unseen *= 10.0 ** model.back[node]
            node = model.tree.parent[node]
        assert total + unseen == pytest.approx(1, abs=1e-6)


def test_rare_words_are_scored_by_the_join(spark):
    rows = corpus()
    few, model = both(spark, rows, hot_min=0.02, context_min=0.05, entry_min=0.02, gain_per_symbol=0.5)
    got, _ = both(spark, rows)
    key = lambda r: (str(r.doc_id), r.n_tokens)
    assert [round(r.base_score, 6) for r in sorted(few, key=key)] == [round(r.base_score, 6) for r in sorted(got, key=key)]
    assert len(model.tree.counts) < 50


def test_no_training_rows_and_empty_table(spark):
    ids = [i for i in range(100) if held(i)][:3]
    got, model = both(spark, [(i, "a b") for i in ids])
    assert model.total == 0 and {(r.n_tokens, r.n_known, r.base_score, r.score) for r in got} == {(3, 0, 0.0, 0.0)}
    assert both(spark, [])[0] == []


def brute_scores(rows, context_min, entry_min, gain, depth=3):
    """Scores by the definition: counts of all contexts in memory, back-off by recursion."""
    follow = {}
    unigram = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    total, scale = sum(unigram.values()), sum(unigram.values()) + 0.1 * (len(unigram) + 1)
    for i, text in rows:
        line = ["<s>"] + tokens(text)
        for at in range(1, len(line)) if not held(i) else ():
            for size in range(1, min(depth, at) + 1):
                follow.setdefault(tuple(line[at - size : at]), Counter())[line[at]] += 1
    follow = {c: n for c, n in follow.items() if sum(n.values()) >= context_min}
    chance = lambda c, x: follow[c][x] / sum(follow[c].values()) if c else unigram[x] / total
    kept = set()
    for c, n in follow.items():
        groups = [[x] for x, k in n.items() if k >= entry_min]
        rest = sum(k for k in n.values() if k < entry_min)
        value = sum(n[x] * math.log(chance(c, x) / chance(c[1:], x)) for (x,) in groups)
        if rest:
            value += rest * math.log(rest / sum(n.values()) / (1 - sum(chance(c[1:], x) for (x,) in groups)))
        if groups and value > gain * (len(groups) + (rest > 0)):
            kept |= {c[i:] for i in range(len(c))}

    def explicit(c):
        return {x: (k - 0.5) / sum(follow[c].values()) for x, k in follow[c].items() if k >= max(entry_min, 1)}

    memo = {}

    def p(c, x):
        if not c:
            return (unigram[x] + 0.1) / scale
        if c not in kept:
            return p(c[1:], x)
        own = memo.get(c) or memo.setdefault(c, (explicit(c), {}))
        if x in own[0]:
            return own[0][x]
        if "back" not in own[1]:
            own[1]["back"] = (1 - sum(own[0].values())) / (1 - sum(p(c[1:], y) for y in own[0]))
        return own[1]["back"] * p(c[1:], x)

    out = []
    for i, text in rows:
        line = ["<s>"] + tokens(text)
        out.append((str(i), round(sum(math.log10(p(tuple(line[max(0, at - depth) : at]), line[at])) for at in range(1, len(line))), 5)))
    return sorted(out), len(kept)


@pytest.mark.parametrize("hot_min", [1e-9, 5e-3, 2.0])
def test_scores_equal_brute_force_whatever_is_broadcast(spark, hot_min):
    got, _ = both(spark, corpus(), hot_min=hot_min, context_min=5, entry_min=2, gain_per_symbol=0.3)
    want, kept = brute_scores(corpus(), 5, 2, 0.3)
    assert kept > 3
    assert sorted((str(r.doc_id), round(r.score, 5)) for r in got) == want


def test_contexts_and_entries_grow_with_the_corpus(spark):
    # topics with words of their own: twice the topics are twice the contexts, however small the share of each
    def sizes(topics):
        rows = [(3 * t, " ".join(f"a{t} b{t} c{(t + k) % 2} d{t}" for k in range(60))) for t in range(topics)]
        _, model = both(spark, rows, hot_min=lm.HOT_MIN, context_min=lm.CONTEXT_MIN, entry_min=lm.ENTRY_MIN)
        return model.tree.parent.size, model.explicit.size, sum(not held(3 * t) for t in range(topics))

    (few, entries_few, t_few), (many, entries_many, t_many) = sizes(40), sizes(600)
    assert many - 1 >= 0.9 * (few - 1) * t_many / t_few and entries_many >= 0.9 * entries_few * t_many / t_few


def test_workers_get_texts_in_batches_of_bounded_size(spark):
    from pyspark.sql import functions as F

    from depthframe.llm.common import BATCH_BYTES, Scratch

    def seen(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], names=["n"])

    texts = spark.range(3000).select(F.repeat(F.lit("words "), 100).alias("text")).coalesce(1).mapInArrow(seen, "n long")
    before = spark.conf.get(BATCH_BYTES)
    staged = Scratch(spark, "t", batch_bytes=100_000).stage(texts, "x")
    assert max(r.n for r in staged.collect()) < 200_000 and sum(r.n for r in staged.collect()) > 1_800_000
    assert spark.conf.get(BATCH_BYTES) == before


def test_texts_are_read_four_times_to_train(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text

    rows = [(i, text) for i, text in corpus() if not held(i)]
    d = docs(spark, rows).select(seen("text").alias("text"))
    lm.train(d, Scratch(spark, "t"), hot_min=1e-3, context_min=2, entry_min=2, gain_per_symbol=0.0)
    assert read.value == 4 * len(rows)


def test_grams_are_counted_with_contexts_and_last_symbols(spark, monkeypatch):
    monkeypatch.setattr(lm, "HANDED", 7)
    rows = corpus()

    def keys(texts):
        grams, place, _ = lm._grams(*lm._tokens(texts), 3)
        at = np.flatnonzero(place > 2)
        return grams[2][at], grams[1][at - 1]

    got = {(r.g, r.c, r.x): r.n for r in lm._counted_grams(docs(spark, rows), keys, 2, 5).collect()}
    want = Counter()
    for _, text in rows:
        hashes, counts = lm._tokens(pa.array([text]))
        grams, place, _ = lm._grams(hashes, counts, 3)
        want.update((int(grams[2][i].view(np.int64)), int(grams[1][i - 1].view(np.int64)), int(grams[0][i].view(np.int64))) for i in np.flatnonzero(place > 2))
    assert len(got) > 20 and got == {k: n for k, n in want.items() if n >= 2}


def test_scored_n_grams_are_not_staged(spark, monkeypatch):
    # a staged table holds the scores of its part of the texts, and no list of n-grams
    seen = []
    stage = Scratch.stage
    monkeypatch.setattr(Scratch, "stage", lambda self, df, name, *more, **named: seen.append((name, df.columns)) or stage(self, df, name, *more, **named))
    both(spark, corpus())
    scored = [columns for name, columns in seen if name.startswith("scored")]
    assert len(scored) > 1 and all(columns == ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"] for columns in scored)

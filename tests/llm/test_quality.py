import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from depthframe.llm import quality
from tests.llm.fixtures import docs, prose


def rows(n):
    out = []
    for i in range(n):
        bad = i % 3 == 0
        text = prose(i, 40 + i % 60)
        out.append((i, " ".join(w + random.Random(i).choice(("###", "$$$", "%%%")) for w in text.split()) if bad else text, int(not bad)))
    return out


def test_features_do_not_depend_on_the_batch():
    texts = ["", None, "a a a b", "ÄÖ\n| x |", prose(1, 3000), "#"]
    whole = quality.features(pa.array(texts))
    assert whole.shape == (6, len(quality.NAMES)) and np.isfinite(whole).all()
    for k, t in enumerate(texts):
        assert np.allclose(whole[k], quality.features(pa.array([t], pa.string()))[0])


def test_learns_a_rule_and_an_interaction():
    r = np.random.default_rng(0)
    x = r.random((4000, len(quality.NAMES)))
    y = ((x[:, 3] > 0.5) != (x[:, 7] > 0.5)).astype(int)
    model = quality.Additive(x[:3000], y[:3000])
    assert (3, 7) in model.pairs
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


def test_held_out_accuracy_and_edge_rows(spark):
    data = rows(400)
    d = docs(spark, [(i, t) for i, t, _ in data] + [(9000, None), (9001, ""), (None, "x")], extra=True)
    labels = spark.createDataFrame([(i, q) for i, _, q in data] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = quality.fit(d, labels, max_rows=250)
    got = d.select("doc_id", quality.held_out("doc_id").alias("h"), quality.score_column(d, model).alias("p")).collect()
    want = {i: q for i, _, q in data}
    held = [(r.p >= 0.7) == bool(want[r.doc_id]) for r in got if r.h and r.doc_id in want]
    assert len(held) > 60 and np.mean(held) > 0.97
    assert len(got) == 403 and all(0 <= r.p <= 1 for r in got)
    assert quality.keep_good(d, labels).columns == d.columns


def test_without_labels_or_rows(spark):
    d = docs(spark, [(1, "x"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r[0] for r in d.select(quality.score_column(d, quality.fit(d, none))).collect()} == {0.5}
    empty = d.limit(0)
    assert empty.select(quality.score_column(empty, quality.fit(empty, none))).count() == 0
    assert d.select(F.sum(quality.held_out("doc_id").cast("int"))).first()[0] is not None

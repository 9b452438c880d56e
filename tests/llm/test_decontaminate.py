import hashlib
import re
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from depthframe.llm import decontaminate as d
from tests.llm.fixtures import docs, prose

ITEM = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu"
ITEMS = [(1, ITEM), (2, "only three words"), (3, None), (10, " -- "), (None, "harbour"), (20, ITEM.upper()), (30, prose(5, 25))]
TEXTS = [
    (1, f"{prose(1, 40)} {ITEM.lower()} {prose(2, 30)} ONLY-three_words"),
    (2, None),
    (3, ""),
    (4, prose(3, 200)),
    (5, ITEM + " " + ITEM),
    (5, ITEM + " " + ITEM),
    (None, "x only three words"),
    (7, "alpha beta gamma delta epsilon zeta eta theta iota"),
    (8, prose(9, 3000) + " " + prose(5, 25) + " " + prose(10, 3000)),
    (9, "alpha beta gamma extra delta epsilon zeta eta theta iota kappa"),
]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(text):
    w, hit, found = words(text), set(), set()
    for item_id, item in ITEMS:
        t = words(item)
        if item_id is None or not t:
            continue
        n = min(10, len(t))
        for k in range(len(t) - n + 1):
            for i in range(len(w) - n + 1):
                if w[i : i + n] == t[k : k + n]:
                    hit |= set(range(i, i + n))
                    found.add(item_id)
    return len(w), len(hit), sorted(found)


def test_equals_brute_force_with_long_documents_cut(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for size in (64, 1 << 20):
        found = d.decontaminate(docs(spark, TEXTS, extra=True), items, segment_words=size).collect()
        assert len(found) == len(TEXTS)
        got = sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in found)
        assert got == sorted((str(i), *brute(t)) for i, t in TEXTS)
        near = {r.doc_id: list(r.near_items) for r in found}
        assert near[9] == [1, 20] and near[7] == []  # one word between is in reach, a missing one is not


def test_blocks_of_windows_add_up(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    index = d.build_index(docs(spark, TEXTS)).cache()
    windows = d.item_windows(items).cache()
    one = d.search(index, windows).select("uid", F.explode("items").alias("i")).distinct().collect()
    many = d.search(index, windows, block_windows=5).select("uid", F.explode("items").alias("i")).distinct().collect()
    assert sorted(one) == sorted(many) and one


def test_a_segment_is_a_row_group(spark):
    """Spark reads thousands of rows of a row group at once, so a task held all its segments."""
    top = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = {*top.glob("index-*")}
    found = d.decontaminate(docs(spark, TEXTS).coalesce(1), spark.createDataFrame(ITEMS, "item_id long, text string"), segment_words=64)
    metas = [pq.ParquetFile(f).metadata for folder in {*top.glob("index-*")} - before for f in folder.glob("*-segments/*.parquet")]
    sizes = [m.row_group(k).num_rows for m in metas for k in range(m.num_row_groups)]
    assert len(sizes) > 50 and set(sizes) == {1}
    assert found.count() == len(TEXTS)


def test_empty_tables(spark):
    none = docs(spark, [])
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert d.decontaminate(none, items).count() == 0
    left = d.decontaminate(docs(spark, TEXTS), items.limit(0)).collect()
    assert len(left) == len(TEXTS) and {r.n_hit for r in left} == {0}
    assert d.drop_contaminated(docs(spark, TEXTS, extra=True), items).columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")

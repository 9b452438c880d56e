import math
import re
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from depthframe.llm import lexical
from tests.llm.fixtures import docs, prose


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(rows, items, k):
    bags = [Counter(terms(t)) for _, t in rows]
    n_docs, n_words = sum(bool(b) for b in bags), sum(sum(b.values()) for b in bags)
    df = Counter(t for b in bags for t in b)
    wanted = {}
    for item, text in items:
        if item is not None:
            wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        scores = []
        for (doc, _), bag in zip(rows, bags):
            m = 10 + 90 * sum(bag.values()) * n_docs // max(n_words, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m)) for t in own if bag[t])
            if score > 0 and doc is not None:
                scores.append((-score, doc))
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def corpus():
    rows = [(k, prose(k, 3 + 7 * (k % 23))) for k in range(200)]
    rows += [(300 + k, rows[k % 5][1]) for k in range(40)]  # ties
    return rows + [(7, prose(900, 30)), (7, rows[7][1]), (None, prose(3, 9)), (400, None), (401, ""), (402, "?!"), (403, "Stone STONE, ĂB_cd"), (404, " ".join(["river"] * 5000))]


def items(spark, extra=False):
    rows = [(k, prose(k, 12)) for k in range(12)] + [(50, prose(0, 3)), (50, "harbour quiet"), (51, "unknownword"), (52, ""), (53, None), (None, "river"), (54, "the of and"), (55, "ăb ĂB cd")]
    df = spark.createDataFrame(rows, "item_id long, text string")
    return rows, df


@pytest.mark.parametrize("segment_words, block_terms, k", [(1 << 20, 200_000, 10), (200, 30, 10), (200, 200_000, 1), (50, 7, 3)])
def test_equals_brute_force(spark, segment_words, block_terms, k):
    rows = corpus()
    asked, frame = items(spark)
    found = lexical.rank_documents(docs(spark, rows, extra=True), frame, k, segment_words, block_terms).collect()
    assert sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in found) == brute(rows, asked, k)


def test_few_accumulators(spark):
    """Once the rare terms fill the first places, common terms create no accumulator."""
    rows = [(k, "common " * 3 + f"w{k}") for k in range(500)] + [(600 + k, "rare common") for k in range(3)]
    index = lexical.build_index(docs(spark, rows).coalesce(1)).collect()
    assert len(index) == 1
    import pyarrow as pa

    column = {n: pa.array(index[0][n]) for n in ("ids", "named", "sizes", "terms", "counts", "docs", "freqs")}
    frequency = dict(zip(index[0].terms, index[0].counts))
    names = {t: int(x) for t, x in zip(("rare", "common"), lexical.signed(lexical.word_hashes(pa.array(["rare common"]), lexical.ALNUM)[0]))}
    block = lexical.Block([(1, names["rare"]), (1, names["common"])], frequency, index[0].n_docs, index[0].n_words)
    ids, scores = lexical.rank_segment(lexical.Postings(block, column), block.terms[0], 3, 0)
    assert sorted(ids.tolist()) == [600, 601, 602] and (np.diff(scores) == 0).all()


def test_a_segment_is_a_row_group(spark):
    """Spark reads thousands of rows of a row group at once, so a task held all its segments."""
    top = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = {*top.glob("lexical-*")}
    asked, frame = items(spark)
    # a slice of texts is the least that a segment holds
    rows = [(k, "the of stone " * 350_000) for k in range(4)]
    found = lexical.rank_documents(docs(spark, rows).coalesce(1), frame, segment_words=50)
    metas = [pq.ParquetFile(f).metadata for folder in {*top.glob("lexical-*")} - before for f in folder.glob("*-segments/*.parquet")]
    sizes = [m.row_group(k).num_rows for m in metas for k in range(m.num_row_groups)]
    assert len(sizes) == 4 and set(sizes) == {1}
    assert sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()) == brute(rows, asked, 10) != []


def test_empty_tables(spark):
    rows = corpus()[:3]
    asked, frame = items(spark)
    assert lexical.rank_documents(docs(spark, []), frame).collect() == []
    assert lexical.rank_documents(docs(spark, [(1, None), (2, "...")]), frame).collect() == []
    assert lexical.rank_documents(docs(spark, rows), frame.filter("item_id < 0")).collect() == []


def test_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    found = lexical.op12_lexical_search(spark, folder)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, found.collect())) == sorted(con.execute(lexical.OP12_SQL).fetchall())

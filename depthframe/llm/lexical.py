"""Ranked lexical search: accumulator-limited, a term at a time.

``build_index`` turns documents into segments: each row is the inverted index of a run of whole
documents (terms as 64-bit hashes, document places, term frequencies) with their lengths.
``search`` ranks all documents for each item. The terms of an item go from rarest to most common,
by document frequency over the whole corpus. A posting of a document without an accumulator
creates one, as long as the summed bounds of the terms still to come can reach the k-th best
partial score; from then on only documents that still can reach it are updated, exactly. A task
carries the k-th best score of each item from segment to segment, so later segments create few
accumulators or none.

Score of a document: the sum over the item's distinct terms of
``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` with ``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and
``m = 10 + (90 * n * N) div L``, all but the logarithm in whole numbers.

Scale: segments are written where the text is read; no text and no posting is shuffled. A task
holds one segment at a time, however many it has. Items
go to the tasks in blocks of about ``block_terms`` terms, so a broadcast does not grow with the
items; more items make more passes over the index. A task returns k rows an item, which a ranked
limit merges.

Defined results: a null or empty text has no term and takes part in nothing; rows of one item_id are one
item; a null item_id is ignored; a document row without doc_id counts in the statistics but is
never returned; a repeated doc_id is a document once per row; equal scores go by ascending
doc_id; an item without a document above score 0 has no row; a text is never split over segments,
so a very long one is a segment of its own; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depthframe.llm.common import ALNUM, BATCH_BYTES, SLICE_BYTES, Scratch, arrow_schema, lists, record, settings, signed, slices, word_hashes

K = 10
SEGMENT_WORDS = 1 << 20
BLOCK_TERMS = 200_000
INDEX = "ids array<long>, named array<boolean>, sizes array<long>, terms array<long>, counts array<int>, docs array<int>, freqs array<int>, n_docs long, n_words long"


# ---------------------------------------------------------------- index


def _segment(ids: list[int | None], sizes: list[int], hashes: np.ndarray) -> dict:
    doc = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(hashes, kind="stable")
    hashes, doc = hashes[order], doc[order]
    fresh = np.ones(len(doc), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(fresh)
    freqs = np.diff(np.append(at, len(doc)))
    hashes, doc = hashes[at], doc[at]
    head = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    return {
        "ids": [[i or 0 for i in ids]],
        "named": [[i is not None for i in ids]],
        "sizes": [sizes],
        "terms": lists(signed(hashes[head]), [len(head)], pa.int64()),
        "counts": lists(np.diff(np.append(head, len(hashes))).astype(np.int32), [len(head)], pa.int32()),
        "docs": lists(doc.astype(np.int32), [len(doc)], pa.int32()),
        "freqs": lists(freqs.astype(np.int32), [len(freqs)], pa.int32()),
        "n_docs": [sum(n > 0 for n in sizes)],
        "n_words": [sum(sizes)],
    }


def build_index(docs: DataFrame, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Segments of the inverted index of ``docs`` (doc_id, text)."""
    target = arrow_schema(INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, held = [], [], []
        for part in slices(batches, 1):
            hashes, counts = word_hashes(part.column(1), ALNUM)
            ids += part.column(0).to_pylist()
            sizes += counts.tolist()
            held.append(hashes)
            if sum(map(len, held)) >= segment_words:
                yield record(_segment(ids, sizes, np.concatenate(held)), target)
                ids, sizes, held = [], [], []
        if ids:
            yield record(_segment(ids, sizes, np.concatenate(held)), target)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, INDEX)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the distinct terms of each item."""
    schema = "item_id long, term long"
    target = arrow_schema(schema)

    def run(batches):
        for part in slices(batches, 1):
            hashes, counts = word_hashes(part.column(1), ALNUM)
            yield record({"item_id": part.column(0).take(pa.array(np.repeat(np.arange(part.num_rows), counts))), "term": signed(hashes)}, target)

    source = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.col("item_id").isNotNull())
    return source.mapInArrow(run, schema).distinct()


# ---------------------------------------------------------------- search


class Block:
    """Terms of a block of items, rarest first, with their weights."""

    def __init__(self, pairs: list[tuple[int, int]], frequency: dict[int, int], n_docs: int, n_words: int):
        self.n_docs, self.n_words = n_docs, n_words
        self.vocabulary = np.array(sorted({t for _, t in pairs if t in frequency}, key=lambda t: t % 2**64), dtype=np.int64)
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency[t] + 1))) for t in self.vocabulary.tolist()], dtype=np.int64)
        place = {t: k for k, t in enumerate(self.vocabulary.tolist())}
        own: dict[int, list[int]] = {}
        for item, term in pairs:
            if term in place and self.weight[place[term]] > 0:
                own.setdefault(item, []).append(term)
        self.items = sorted(own)
        self.terms = [np.array([place[t] for t in sorted(own[i], key=lambda t: (frequency[t], t))], dtype=np.int64) for i in self.items]


class Postings:
    """Impacts of the block's terms in one segment, and the largest impact of each."""

    def __init__(self, block: Block, column: dict[str, pa.Array]):
        terms, counts, docs, freqs = (column[n].to_numpy() for n in ("terms", "counts", "docs", "freqs"))
        self.ids, named = column["ids"].to_numpy(), column["named"].to_numpy(zero_copy_only=False)
        length = np.array([10 + 90 * n * block.n_docs // block.n_words for n in column["sizes"].to_pylist()], dtype=np.int64)
        at = np.minimum(np.searchsorted(terms.view(np.uint64), block.vocabulary.view(np.uint64)), max(len(terms) - 1, 0))
        found = terms[at] == block.vocabulary if len(terms) else np.zeros(len(block.vocabulary), bool)
        ends = np.cumsum(counts, dtype=np.int64)
        size = np.where(found, counts[at] if len(terms) else 0, 0).astype(np.int64)
        first = (ends[at] - counts[at]) if len(terms) else np.zeros(len(at), np.int64)
        begin = np.cumsum(size) - size
        pick = np.repeat(first - begin, size) + np.arange(size.sum())
        doc, tf, term = docs[pick], freqs[pick].astype(np.int64), np.repeat(np.arange(len(size)), size)
        impact = block.weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * length[doc]))
        keep = named[doc] & (impact > 0)
        self.doc, self.impact, term = doc[keep], impact[keep], term[keep]
        self.begin = np.searchsorted(term, np.arange(len(size) + 1))
        self.most = np.zeros(len(size), dtype=np.int64)
        np.maximum.at(self.most, term, self.impact)

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.begin[term], self.begin[term + 1]
        return self.doc[lo:hi], self.impact[lo:hi]


def _kth(partial: np.ndarray, k: int, floor: int) -> int:
    return max(floor, int(np.partition(partial, len(partial) - k)[len(partial) - k])) if len(partial) >= k else floor


def rank_segment(postings: Postings, terms: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc_id, score) of every document of a segment that may be among the best k; ``floor`` is the k-th score elsewhere."""
    terms = terms[postings.most[terms] > 0]
    left = np.append(np.cumsum(postings.most[terms][::-1])[::-1], 0)  # what the terms from here on can add at most
    score = np.zeros(len(postings.ids), dtype=np.int64)
    docs, bar, turn = np.zeros(0, np.int64), floor, 0
    while turn < len(terms) and left[turn] >= bar:  # accumulators may still be created
        doc, impact = postings.of(terms[turn])
        docs = np.concatenate([docs, doc[score[doc] == 0]])
        score[doc] += impact
        bar = _kth(score[docs], k, floor)
        turn += 1
    docs = np.sort(docs)
    for turn in range(turn, len(terms)):  # survivors only
        docs = docs[score[docs] + left[turn] >= bar]
        if not len(docs):
            break
        doc, impact = postings.of(terms[turn])
        at = np.minimum(np.searchsorted(doc, docs), len(doc) - 1)
        hit = doc[at] == docs
        score[docs[hit]] += impact[at[hit]]
        bar = _kth(score[docs], k, floor)
    docs = docs[score[docs] >= bar]
    return postings.ids[docs], score[docs]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def search(index: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the best k documents of a stored ``index`` for each of ``items`` (item_id, term)."""
    spark = index.sparkSession
    schema, count_schema = "item_id long, doc_id long, score long", "term long, n long"
    target = arrow_schema(schema)
    facts = index.agg(F.sum("n_docs").alias("n"), F.sum("n_words").alias("l")).first()
    n_docs, n_words = facts.n or 0, facts.l or 0
    n_blocks = -(-items.count() // block_terms) if n_docs else 0
    found = []
    for b in range(n_blocks):
        pairs = [(r.item_id, r.term) for r in items.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == b).collect()]
        wanted = spark.sparkContext.broadcast(np.array(sorted({t % 2**64 for _, t in pairs}), dtype=np.uint64))

        def count(batches, wanted=wanted):
            for batch in batches:
                for row in range(batch.num_rows):
                    terms, counts = (batch.column(c)[row].values.to_numpy() for c in (0, 1))
                    if len(terms):
                        at = np.minimum(np.searchsorted(terms.view(np.uint64), wanted.value), len(terms) - 1)
                        at = at[terms.view(np.uint64)[at] == wanted.value]
                        yield pa.RecordBatch.from_pydict({"term": terms[at], "n": counts[at].astype(np.int64)})

        total = index.select("terms", "counts").mapInArrow(count, count_schema).groupBy("term").agg(F.sum("n").alias("n"))
        with settings(spark, {BATCH_BYTES: str(SLICE_BYTES)}):
            frequency = {r.term: r.n for r in total.collect()}
        block = spark.sparkContext.broadcast(Block(pairs, frequency, n_docs, n_words))

        def rank(batches, block=block):
            held = block.value
            best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(held.items)
            for batch in batches:
                for row in range(batch.num_rows):
                    postings = Postings(held, {n: batch.column(n)[row].values for n in ("ids", "named", "sizes", "terms", "counts", "docs", "freqs")})
                    for i, terms in enumerate(held.terms):
                        ids, scores = best[i]
                        more, their = rank_segment(postings, terms, k, int(scores[-1]) if len(scores) == k else 0)
                        if len(more):
                            best[i] = _best(np.concatenate([ids, more]), np.concatenate([scores, their]), k)
            for item, (ids, scores) in zip(held.items, best):
                if len(ids):
                    yield record({"item_id": [item] * len(ids), "doc_id": ids, "score": scores}, target)

        found.append(index.select("ids", "named", "sizes", "terms", "counts", "docs", "freqs").mapInArrow(rank, schema))
    every = found[0] if found else spark.createDataFrame([], schema)
    for more in found[1:]:
        every = every.unionByName(more)
    # the limit on the rank is applied on the map side too
    falling = Window.partitionBy("item_id").orderBy(F.col("score").desc(), "doc_id")
    return every.withColumn("rank", F.row_number().over(falling)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K, segment_words: int = SEGMENT_WORDS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The best ``k`` rows of ``docs`` (doc_id, text) for each of ``items`` (item_id, text)."""
    scratch = Scratch(docs.sparkSession, "lexical", batch_bytes=SLICE_BYTES)
    index = scratch.stage(build_index(docs, segment_words), "segments", wide=True)
    wanted = scratch.stage(item_terms(items), "items", narrow=True)
    return scratch.stage(search(index, wanted, k, block_terms), "ranked")


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    return rank_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS terms
  FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term
  FROM benchmark WHERE item_id IS NOT NULL),
all_docs AS (SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_words FROM d WHERE len(terms) > 0),
m AS (SELECT r, doc_id, 10 + (90 * len(terms)::BIGINT * n_docs) // n_words AS m FROM d, all_docs WHERE len(terms) > 0),
p AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), all_docs),
s AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (r) WHERE doc_id IS NOT NULL GROUP BY item_id, r, doc_id),
f AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM f WHERE rank <= 10
"""

"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` turns the training texts into segments: each row is the inverted index of
a run of documents, with the position of every token, grouped by term. ``search`` takes
the n-word windows of the benchmark in bounded blocks. For each window it fetches the
postings of its terms from rarest to most common (rarity over the whole corpus),
shifts them by the term's place in the window and intersects them; what is left are
exact phrase matches, or proximity matches when every term may lie up to ``slop``
places off.

Scale: the index is written where the text is read, without a shuffle. A document longer
than a segment is cut into overlapping runs, so a segment is bounded by ``segment_words``
however the corpus is skewed. A task holds one segment at a time, however many it has. Only hit
documents are shuffled.

Defined results: a null text has no words; an item without words has no window; a null
item_id is ignored; a null doc_id stays null; equal rows give equal result rows; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthframe.llm.common import ALNUM, BATCH_BYTES, SLICE_BYTES, Scratch, arrow_schema, lists, record, settings, signed, slices, word_hashes

WINDOW = 10
SLOP = 2
SEGMENT_WORDS = 1 << 20
BLOCK_WINDOWS = 200_000

INDEX = (
    "uids array<long>, doc_ids array<long>, keys array<long>, places array<int>, sizes array<int>, firsts array<long>, owned array<int>, "
    "terms array<long>, counts array<int>, gaps array<int>"
)
HITS = "uid long, starts array<long>, ends array<long>, items array<long>, near_items array<long>, near_starts array<long>, near_ends array<long>"


def build_index(docs: DataFrame, segment_words: int = SEGMENT_WORDS, overlap: int = WINDOW - 1 + SLOP) -> DataFrame:
    """Segments of the positional index of ``docs`` (doc_id, text)."""
    target = arrow_schema(INDEX)
    apart = overlap + 1

    def segment(pieces: list) -> pa.RecordBatch:
        sizes = np.array([len(p[4]) for p in pieces], dtype=np.int64)
        places = np.concatenate([[0], np.cumsum(sizes + apart)[:-1]])
        hashes = np.concatenate([p[4] for p in pieces])
        position = np.repeat(places - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(len(hashes))
        order = np.argsort(hashes, kind="stable")
        hashes, position = hashes[order], position[order]
        head = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
        gaps = np.diff(position, prepend=0)
        gaps[head] = position[head]
        row = {
            "uids": [[p[0] for p in pieces]],
            "doc_ids": [[p[1] for p in pieces]],
            "places": [places.astype(np.int32)],
            "sizes": [sizes.astype(np.int32)],
            "firsts": [[p[2] for p in pieces]],
            "keys": [[p[5] for p in pieces]],
            "owned": [[p[3] for p in pieces]],
            "terms": lists(signed(hashes[head]), [len(head)], pa.int64()),
            "counts": lists(np.diff(np.append(head, len(hashes))).astype(np.int32), [len(head)], pa.int32()),
            "gaps": lists(gaps.astype(np.int32), [len(gaps)], pa.int32()),
        }
        return record(row, target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        uid = TaskContext.get().partitionId() << 40
        pieces, held = [], 0
        for part in slices(batches, 1):
            hashes, counts = word_hashes(part.column(1), ALNUM)
            at = 0
            for doc_id, key, n in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), counts.tolist()):
                words = hashes[at : at + n]
                at += n
                for lo in range(0, max(n, 1), segment_words):
                    hi = min(lo + segment_words, n)
                    left = max(0, lo - overlap)
                    piece = words[left : min(n, hi + overlap)].copy()
                    pieces.append((uid, doc_id, left, hi - lo, piece, key))
                    held += len(piece) + apart
                    if held >= segment_words:
                        yield segment(pieces)
                        pieces, held = [], 0
                uid += 1
        if pieces:
            yield segment(pieces)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("key")).mapInArrow(run, INDEX)


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, terms): each run of ``window`` words, or all words of a shorter item."""
    schema = "item_id long, terms array<long>"
    target = arrow_schema(schema)

    def run(batches):
        for part in slices(batches, 1):
            hashes, counts = word_hashes(part.column(1), ALNUM)
            hashes, ids, rows, at = signed(hashes), [], [], 0
            for item_id, n in zip(part.column(0).to_pylist(), counts.tolist()):
                for lo in range(max(1, n - window + 1) if n else 0):
                    ids.append(item_id)
                    rows.append(hashes[at + lo : at + min(lo + window, n)])
                at += n
            yield record({"item_id": ids, "terms": rows}, target)

    source = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.col("item_id").isNotNull())
    return source.mapInArrow(run, schema).distinct()


class _Block:
    """Windows of one block: terms from rarest to most common with their places, padded with -1."""

    def __init__(self, ids: np.ndarray, rows: list[np.ndarray], frequency: dict[int, int]):
        self.ids = ids
        self.sizes = np.array([len(r) for r in rows], dtype=np.int64)
        self.vocabulary = np.unique(np.concatenate(rows)) if rows else np.zeros(0, np.int64)
        count = np.array([frequency.get(t, 0) for t in self.vocabulary.tolist()], dtype=np.int64)
        width = int(self.sizes.max()) if len(rows) else 0
        self.terms = np.full((len(rows), width), -1, dtype=np.int64)
        self.places = np.zeros((len(rows), width), dtype=np.int64)
        for k, row in enumerate(rows):
            t = np.searchsorted(self.vocabulary, row)
            order = np.argsort(count[t], kind="stable")
            self.terms[k, : len(row)], self.places[k, : len(row)] = t[order], order


def _postings(terms: np.ndarray, counts: np.ndarray, gaps: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys (term << 32 | position) of a segment's postings for ``vocabulary``, and where each term's begin."""
    unsigned = terms.view(np.uint64)
    at = np.minimum(np.searchsorted(unsigned, vocabulary.view(np.uint64)), max(len(terms) - 1, 0))
    found = terms[at] == vocabulary if len(terms) else np.zeros(len(vocabulary), bool)
    size = np.where(found, counts[at] if len(terms) else 0, 0).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(size)])
    source = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[at] if len(terms) else np.zeros(len(vocabulary), np.int64)
    pick = np.repeat(source - begin[:-1], size) + np.arange(begin[-1])
    running = np.cumsum(gaps[pick].astype(np.int64))
    base = np.concatenate([[0], running])[begin[:-1]]
    position = running - np.repeat(base, size)
    return (np.repeat(np.arange(len(vocabulary)), size) << 32) | position, begin


def _intersect(block: _Block, keys: np.ndarray, begin: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows and start positions that match, and whether the match is exact; a slice of windows at a time."""
    out, lo = [], 0
    size = begin[block.terms[:, 0] + 1] - begin[block.terms[:, 0]]
    total = np.cumsum(size)
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + (1 << 20), side="right")))
        n = size[lo:hi]
        window = np.repeat(np.arange(lo, hi), n)
        pick = np.repeat(begin[block.terms[lo:hi, 0]] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        start = (keys[pick] & 0xFFFFFFFF) - block.places[window, 0]
        exact = np.ones(len(start), dtype=bool)
        for rank in range(1, block.terms.shape[1]):
            if not len(start):
                break
            more = block.sizes[window] > rank
            term, expected = np.maximum(block.terms[window, rank], 0), start + block.places[window, rank]
            low = (term << 32) | np.maximum(expected - slop, 0)
            at = np.searchsorted(keys, low)
            near = (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] <= ((term << 32) | np.maximum(expected + slop, 0)))
            at = np.searchsorted(keys, (term << 32) | np.maximum(expected, 0))
            same = (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == ((term << 32) | expected))
            keep = ~more | near
            window, start, exact = window[keep], start[keep], (exact & (~more | same))[keep]
        out.append((window, start, exact))
        lo = hi
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),)


def _union(start: np.ndarray, end: np.ndarray) -> tuple[list[int], list[int]]:
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    head = np.concatenate([[True], start[1:] > end[:-1]])
    last = np.append(np.flatnonzero(head)[1:] - 1, len(end) - 1)
    return start[head].tolist(), end[last].tolist()


def search(index: DataFrame, windows: DataFrame, slop: int = SLOP, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Hits of ``windows`` in a stored ``index``: word ranges and items, exact and near, a row per hit run of a document.

    Windows go to the executors in blocks of about ``block_windows``, so no broadcast grows
    with the benchmark; a larger benchmark makes more passes over the index.
    """
    spark = index.sparkSession
    n_blocks = -(-windows.count() // block_windows)
    block_of = F.pmod(F.xxhash64("item_id", "terms"), F.lit(max(n_blocks, 1)))
    schema, target = "term long, n long", arrow_schema(HITS)
    hits = []
    for b in range(n_blocks):
        held = windows.filter(block_of == b).toArrow()
        ids, rows = held.column("item_id").to_numpy(), [np.array(x, dtype=np.int64) for x in held.column("terms").to_pylist()]
        vocabulary = np.unique(np.concatenate(rows).view(np.uint64)).view(np.int64) if rows else np.zeros(0, np.int64)
        shared = spark.sparkContext.broadcast(vocabulary)

        def count(batches, shared=shared):
            for batch in batches:
                for k in range(batch.num_rows):
                    terms, counts = (batch.column(c)[k].values.to_numpy() for c in (0, 1))
                    at = np.minimum(np.searchsorted(terms.view(np.uint64), shared.value.view(np.uint64)), max(len(terms) - 1, 0))
                    found = np.flatnonzero(terms[at] == shared.value) if len(terms) else np.zeros(0, np.int64)
                    yield pa.RecordBatch.from_pydict({"term": shared.value[found], "n": counts[at[found]].astype(np.int64)})

        total = index.select("terms", "counts").mapInArrow(count, schema).groupBy("term").agg(F.sum("n").alias("n"))
        with settings(spark, {BATCH_BYTES: str(SLICE_BYTES)}):
            frequency = {r.term: r.n for r in total.collect()}
        block = spark.sparkContext.broadcast(_Block(ids, rows, frequency))

        def match(batches, block=block):
            for batch in batches:
                for k in range(batch.num_rows):
                    column = {n: batch.column(n)[k].values for n in batch.schema.names}
                    found = _segment_hits(block.value, column, slop)
                    if found["uid"]:
                        yield record(found, target)

        hits.append(index.mapInArrow(match, HITS))
    out = index.sparkSession.createDataFrame([], HITS) if not hits else hits[0]
    for more in hits[1:]:
        out = out.unionByName(more)
    return out


def _segment_hits(block: _Block, column: dict, slop: int) -> dict:
    out = {n: [] for n in ("uid", "starts", "ends", "items", "near_items", "near_starts", "near_ends")}
    if not len(block.vocabulary):
        return out
    keys, begin = _postings(*(column[n].to_numpy() for n in ("terms", "counts", "gaps")), block.vocabulary)
    if not len(keys):
        return out
    window, start, exact = _intersect(block, keys, begin, slop)
    if not len(window):
        return out
    places, sizes, firsts = (column[n].to_numpy().astype(np.int64) for n in ("places", "sizes", "firsts"))
    piece = np.searchsorted(places, start, side="right") - 1
    inside = (piece >= 0) & (start - places[piece] + block.sizes[window] <= sizes[piece])
    exact &= inside
    piece = np.maximum(piece, 0)
    left = np.maximum(start - places[piece], 0)
    right = np.minimum(left + block.sizes[window], sizes[piece])
    held = right > left
    window, exact, piece, left, right = window[held], exact[held], piece[held], left[held], right[held]
    order = np.argsort(piece, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(piece[order])) + 1):
        if not len(group):
            continue
        p = int(piece[group[0]])
        sure = group[exact[group]]
        out["uid"].append(column["uids"][p].as_py())
        for name, chosen in (("", sure), ("near_", group)):
            lo, hi = _union(left[chosen] + firsts[p], right[chosen] + firsts[p]) if len(chosen) else ([], [])
            out[f"{name}starts"].append(lo)
            out[f"{name}ends"].append(hi)
            out[f"{name}items"].append(np.unique(block.ids[window[chosen]]).tolist())
    return out


def covered(starts: str, ends: str):
    """Number of places in the union of ranges, given as arrays of arrays."""
    return F.expr(
        f"""aggregate(
            array_sort(arrays_zip(flatten({starts}), flatten({ends}))),
            named_struct('upto', -1L, 'n', 0L),
            (a, x) -> named_struct('upto', greatest(a.upto, x['1']), 'n', a.n + greatest(0L, x['1'] - greatest(a.upto, x['0']))),
            a -> a.n)"""
    )


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = SLOP, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, th (xxhash64 of the text), n_words, n_hit, items (sorted ids with an exact hit), n_near, near_items."""
    scratch = Scratch(docs.sparkSession, "index", batch_bytes=SLICE_BYTES)
    index = scratch.stage(build_index(docs, segment_words, window - 1 + slop), "segments", wide=True)
    windows = scratch.stage(item_windows(items, window), "windows")
    hit = scratch.stage(search(index, windows, slop), "hits").groupBy("uid").agg(*(F.collect_list(c).alias(c) for c in ("starts", "ends", "items", "near_starts", "near_ends", "near_items")))
    hit = hit.select(
        "uid",
        covered("starts", "ends").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"),
        covered("near_starts", "near_ends").alias("n_near"),
        F.array_sort(F.array_distinct(F.flatten("near_items"))).alias("near_items"),
    )
    rows = index.select(F.explode(F.arrays_zip("uids", "doc_ids", "keys", "owned")).alias("p"))
    rows = rows.groupBy(F.col("p.uids").alias("uid")).agg(F.first("p.doc_ids").alias("doc_id"), F.first("p.keys").alias("th"), F.sum("p.owned").alias("n_words"))
    none = F.array().cast("array<long>")
    return rows.join(hit, "uid", "left").select(
        "doc_id",
        "th",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.coalesce("near_items", none).alias("near_items"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a window of an item; whether one does depends on its text alone."""
    hit = decontaminate(docs, items).filter("n_hit > 0").select(F.col("th").alias("__th")).distinct()
    return docs.withColumn("__key", F.xxhash64("text")).join(hit, F.col("__key") == F.col("__th"), "left_anti").drop("__key")


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP1_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM documents),
i AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM benchmark WHERE item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[k : k + 9], ' ') AS win
  FROM i, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS t(k) WHERE len(words) > 0),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, k, n, array_to_string(words[k : k + n - 1], ' ') AS win
  FROM w, sizes, unnest(range(1, len(words) - n + 2)) AS t(k)),
hit AS (SELECT doc_id, k, dw.n, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hit) GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN places USING (doc_id) LEFT JOIN names USING (doc_id)
"""

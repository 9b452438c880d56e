"""Line dedup by pairwise alignment: rare line hashes find overlapping documents, patience diff aligns them.

A passage is a run of whole lines that, with the equal words before and after it, holds
``min_words`` words or more. Two documents have to share a key: the hash of the shortest run of whole
lines of that size from a line, or of a shorter line with half of the words that it lacks, taken before it or
after it (a common run that holds the line has so many on one side). Short
boilerplate lines make no key by themselves, so shared keys are rare however often the
lines in them occur. Each document that holds a key is paired with the first document
(by doc_id) that holds it, never with all others: the pairs are linear in the lines, whatever
the number of copies. Both line lists are aligned: lines unique on both sides are anchors, the
heaviest increasing sequence of anchors (by words) is kept and grown over equal neighbours, and
the rest is aligned again, from the 17th round on without regard to order, until no common line is left. Aligned common blocks that have at least
``min_words`` words together with the equal words on both sides are deleted from the later document;
the lines that the passage only begins or ends in stay. The first holder of a passage keeps it.

Scale: only hashes and word counts are shuffled for pairing and alignment; word hashes of paired documents only. A passage in a third of
all documents is one key with linear pairs. Texts are shuffled once, to meet their deletions.

Defined results: a null or empty text, and a row without doc_id, stays as it is and matches
nothing; rows with equal doc_id and text are one document and are treated alike; of rows with
equal doc_id the one with the smaller text hash comes first; lines are compared without
white space at their ends and blank lines never hold a passage; extra columns stay.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import accumulate, count, cycle
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthframe.llm.common import _VALUES, SCAN_BYTES, Scratch, _powers, arrow_schema, lists, mix, record, signed, slices
from depthframe.llm.suffix_lm import _bit_map

MIN_WORDS = 50
ROUNDS = 16


def line_digest(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash and number of words of every line; blank lines have no words."""
    lines = [line.strip() for line in text.split("\n")]
    hashes = np.fromiter((xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) if x else 1 for x in lines), dtype=np.uint64, count=len(lines))
    words = np.fromiter((x.count(" ") + 1 if x else 0 for x in lines), dtype=np.int32, count=len(lines))
    return hashes, words


def word_digest(text: str) -> np.ndarray:
    """Hashes of the words of all lines, as many as ``line_digest`` counts."""
    lines = [line.strip() for line in text.split("\n")]
    return np.fromiter((crc32(w) for x in lines if x for w in x.encode("utf-8", "surrogatepass").split(b" ")), dtype=np.uint32)


def _rolled(hashes: np.ndarray) -> np.ndarray:
    """Running sums of hashes times the powers of a step: the difference of two tells the run between them."""
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(len(hashes) + 1)[0][: len(hashes)])])


def _run(rolled: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return mix((rolled[hi] - rolled[lo]) * _powers(len(rolled))[1][lo] + (hi - lo).astype(np.uint64))


def _words(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words that end before ``ends``, a few hundred kilobytes at a time."""
    out, at, lo = [], 0, 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, lo + SCAN_BYTES)))
        part = ends[at:to] - lo
        out.append(_run(_rolled(_VALUES[data[lo : ends[to - 1]]]), np.concatenate([[0], part[:-1] + 1]), part))
        at, lo = to, int(ends[to - 1]) + 1
    return np.concatenate(out)


def passage_keys(texts: list[str], min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of each text, one text after the other, and how many each has.

    They are hashes of the shortest run of at least ``min_words`` words from each line with words and, for each line
    shorter than ``min_words``, of it with half of the missing words before it, and after it.
    """
    own = [[line.strip() for line in text.split("\n")] for text in texts]
    data = np.frombuffer("".join(f"{line}\n" for lines in own for line in lines).encode("utf-8", "surrogatepass"), dtype=np.uint8)
    ends = np.flatnonzero((data == 32) | (data == 10))
    stop = np.flatnonzero(data[ends] == 10) + 1  # the words up to the end of each line, a blank line as one
    begin = np.concatenate([[0], stop[:-1]])
    blank = ends[begin] == np.concatenate([[0], ends[stop[:-1] - 1] + 1])
    blank &= stop - begin == 1
    inside = np.ones(len(ends), dtype=bool)
    inside[begin[blank]] = False
    words = np.where(blank, 0, stop - begin)
    total = np.concatenate([[0], np.cumsum(words)])
    flat = _rolled(_words(data, ends)[inside])
    lines = np.where(blank, np.uint64(1), _run(flat, total[:-1], total[1:]))
    last_line = np.cumsum([len(x) for x in own])
    doc = np.repeat(np.arange(len(own)), [len(x) for x in own])
    to, first, stops = last_line[doc], total[np.append(0, last_line[:-1])][doc], total[last_line][doc]
    last = np.searchsorted(total, total[:-1] + min_words)
    start = np.flatnonzero((last <= to) & (words > 0))
    keys, docs = [_run(_rolled(lines), start, last[start])], [doc[start]]
    short = np.flatnonzero((words > 0) & (words < min_words))
    half = (min_words - words[short] + 1) // 2
    for side, lo, hi in ((1, total[short] - half, total[short]), (2, total[short + 1], total[short + 1] + half)):
        fits = (lo >= first[short]) & (hi <= stops[short])
        keys.append(mix(_run(flat, lo[fits], hi[fits]) + np.uint64(side) + lines[short[fits]]))
        docs.append(doc[short[fits]])
    key, of = np.concatenate(keys), np.concatenate(docs)
    order = np.lexsort((key, of))
    key, of = key[order], of[order]
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = (key[1:] != key[:-1]) | (of[1:] != of[:-1])
    return key[fresh], np.bincount(of[fresh], minlength=len(own))


def equal_words(a: list[int], i: int, j: int, b: list[int], k: int, m: int, limit: int) -> int:
    """How many words before a[i] and b[k], and from a[j] and b[m] on, are equal; up to ``limit`` on a side."""
    before = after = 0
    while before < min(limit, i, k) and a[i - 1 - before] == b[k - 1 - before]:
        before += 1
    while after < min(limit, len(a) - j, len(b) - m) and a[j + after] == b[m + after]:
        after += 1
    return before + after


def aligned_blocks(later: list[int], words: list[int], first: list[int], min_words: int, around=None) -> list[tuple[int, int]]:
    """Ranges [lo, hi) of lines of ``later`` in aligned common blocks with at least ``min_words`` words.

    ``around`` gives the equal words beside lines [lo, hi) of ``later`` and [at, to) of ``first``. After ``ROUNDS``
    increasing chains every line that is left takes its place in ``first`` and is grown, in order, so documents with
    their lines in any order take a bounded number of passes. A line that is unique in ``first`` has one place, so for such
    lines this is what more rounds would find; a repeated line takes its places in turn."""
    match: dict[int, int] = {}  # line of later -> line of first
    left = [i for i, w in enumerate(words) if w]
    places: dict[int, list[int]] = defaultdict(list)
    for j, h in enumerate(first):
        places[h].append(j)
    for turn in count():
        at: dict[int, list[int]] = defaultdict(list)
        for i in left:
            if later[i] in places:
                at[later[i]].append(i)
        if not at:
            break
        unique = [(x[0], places[h][0]) for h, x in at.items() if len(x) == 1 and len(places[h]) == 1]
        anchors = unique or [(i, j) for h, x in at.items() for i, j in zip(x, places[h] if turn < ROUNDS else cycle(places[h]))]
        chain = _heaviest(sorted(anchors), words) if turn < ROUNDS else sorted(anchors)
        for i, j in chain:
            for step in (1, -1):
                a, b = (i, j) if step == 1 else (i - 1, j - 1)
                while 0 <= a < len(later) and 0 <= b < len(first) and a not in match and later[a] == first[b]:
                    match[a] = b
                    a, b = a + step, b + step
        left = [i for i in left if i not in match and later[i] in places]
    out, lo = [], 0
    while lo < len(later):
        if lo not in match or not words[lo]:
            lo += 1
            continue
        hi = lo + 1
        while hi < len(later) and match.get(hi) == match[hi - 1] + 1:
            hi += 1
        end = hi
        while not words[end - 1]:
            end -= 1
        size = sum(words[lo:end])
        if size < min_words and around:
            size += around(lo, end, match[lo], match[end - 1] + 1)
        if size >= min_words:
            out.append((lo, end))
        lo = hi
    return out


def _heaviest(anchors: list[tuple[int, int]], words: list[int]) -> list[tuple[int, int]]:
    """The chain of anchors increasing on both sides that holds the most words."""
    order = {j: k + 1 for k, j in enumerate(sorted({j for _, j in anchors}))}
    tree: list[tuple[int, int]] = [(0, -1)] * (len(order) + 1)  # prefix maxima of (weight, anchor)
    back = [-1] * len(anchors)
    best = (0, -1)
    k = 0
    while k < len(anchors):
        same = k
        found = []
        while same < len(anchors) and anchors[same][0] == anchors[k][0]:
            p, top = order[anchors[same][1]] - 1, (0, -1)
            while p:
                top = max(top, tree[p])
                p &= p - 1
            found.append((same, top))
            same += 1
        for a, (weight, before) in found:
            back[a] = before
            weight += words[anchors[a][0]]
            best = max(best, (weight, a))
            p = order[anchors[a][1]]
            while p < len(tree):
                tree[p] = max(tree[p], (weight, a))
                p += p & -p
        k = same
    chain, a = [], best[1]
    while a >= 0:
        chain.append(anchors[a])
        a = back[a]
    return chain[::-1]


def _many(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    flat = np.concatenate(parts)
    return lists(signed(flat) if kind == pa.int64() else flat, [len(p) for p in parts], kind)


def _named(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")


def _keys(docs: DataFrame, min_words: int) -> DataFrame:
    schema = "doc_id long, th long, keys array<long>"
    target = arrow_schema(schema)

    def run(batches):
        for part in slices(batches, 2, SCAN_BYTES):
            keys, counts = passage_keys(part.column(2).to_pylist(), min_words)
            yield record({"doc_id": part.column(0), "th": part.column(1), "keys": lists(signed(keys), counts, pa.int64())}, target)

    return _named(docs).mapInArrow(run, schema)


def _digests(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Line and word hashes of the documents in ``pairs``, and of few others (a bit map of bounded size drops most)."""
    key = lambda d: F.xxhash64(f"{d}.doc_id", f"{d}.th")
    paired = pairs.sparkSession.sparkContext.broadcast(_bit_map(pairs.select(key("d").alias("k")).union(pairs.select(key("f"))).distinct()))
    schema = "doc_id long, th long, hashes array<long>, words array<int>, flat array<int>"
    target = arrow_schema(schema)

    def run(batches):
        for part in slices(batches, 2):
            part = part.filter(pa.array(paired.value.find(part.column(3).to_numpy().view(np.uint64))))
            if part.num_rows:
                texts = part.column(2).to_pylist()
                hashes, words = zip(*map(line_digest, texts))
                flat = [word_digest(text).view(np.int32) for text in texts]
                yield record({"doc_id": part.column(0), "th": part.column(1), "hashes": _many(hashes, pa.int64()), "words": _many(words, pa.int32()), "flat": _many(flat, pa.int32())}, target)

    return _named(docs).withColumn("k", F.xxhash64("doc_id", "th")).mapInArrow(run, schema)


def passage_deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, th, gone): for each document that loses lines, the ranges [lo, hi) of its lines that go."""
    scratch = Scratch(docs.sparkSession, "lines")
    keys = scratch.stage(_keys(docs, min_words), "keys")
    me = F.struct("doc_id", "th")
    held = keys.filter(F.size("keys") > 0).select(me.alias("d"), F.explode("keys").alias("key"))
    holder = held.groupBy("key").agg(F.min("d").alias("f"), F.max("d").alias("l")).filter(F.col("f") < F.col("l")).select("key", "f")
    pairs = held.join(holder, "key").filter(F.col("d") > F.col("f")).select("d", "f").distinct()
    pairs = scratch.stage(pairs, "pairs")
    scratch.drop(keys)
    digests = scratch.stage(_digests(docs, pairs), "digests")
    side = digests.select(me.alias("d"), "hashes", "words", "flat")
    other = digests.select(me.alias("f"), F.col("hashes").alias("first"), F.col("words").alias("first_words"), F.col("flat").alias("first_flat"))
    schema = "doc_id long, th long, lo array<int>, hi array<int>"
    target = arrow_schema(schema)

    def align(batches):
        for batch in batches:
            out = {"doc_id": [], "th": [], "lo": [], "hi": []}
            for k in range(batch.num_rows):
                doc_id, th, hashes, words, flat, first, first_words, first_flat = (c[k].as_py() for c in batch.columns)
                mine, theirs = [0, *accumulate(words)], [0, *accumulate(first_words)]

                def around(lo, hi, at, to):
                    return equal_words(flat, mine[lo], mine[hi], first_flat, theirs[at], theirs[to], min_words)

                blocks = aligned_blocks(hashes, words, first, min_words, around)
                if blocks:
                    out["doc_id"].append(doc_id)
                    out["th"].append(th)
                    out["lo"].append([b[0] for b in blocks])
                    out["hi"].append([b[1] for b in blocks])
            yield record(out, target)

    both = pairs.join(side, "d").join(other, "f").select("d.doc_id", "d.th", "hashes", "words", "flat", "first", "first_words", "first_flat")
    found = both.mapInArrow(align, schema)
    gone = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.arrays_zip("lo", "hi")))))
    return found.groupBy("doc_id", "th").agg(gone.alias("gone"))


def drop_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with aligned common passages deleted from later documents, plus n_lines and n_gone (lines and words-holding lines deleted)."""
    gone = passage_deletions(docs, min_words).withColumnsRenamed({"doc_id": "__id", "th": "__th", "gone": "__gone"})
    keyed = docs.withColumn("__text_hash", F.xxhash64("text"))
    joined = keyed.join(gone, (F.col("doc_id").cast("long") == F.col("__id")) & (F.col("__text_hash") == F.col("__th")), "left")
    parts = F.split("text", "\n", -1)
    stays = lambda line, i: ~F.exists("__gone", lambda r: (i >= r["lo"]) & (i < r["hi"]))
    kept = F.filter(parts, stays)
    out = joined.withColumns({
        "text": F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")),
        "n_lines": F.size(parts),
        "n_gone": F.when(F.col("__gone").isNull(), 0).otherwise(F.size(parts) - F.size(kept)),
    })
    return out.drop("__gone", "__id", "__th", "__text_hash")


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_passages(docs).select("doc_id", "n_lines", "n_gone", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars_left"), F.sha2("text", 256).alias("text_sha256"))

"""SimHash near-duplicates by pigeonring filtering.

Every word shingle of a text, repeats included, has an XXH64 value; bit j of the fingerprint is
set where more than half of the values have it. Two fingerprints link at ``distance`` differing
bits or fewer. The 64 bits form a ring of m = distance + 1 segments. If two fingerprints link,
some segment starts a chain along the ring whose first l segments together differ in at most
l * distance / m bits, for every l. So the first segment of that chain is equal and the second
differs in one bit at most, which leaves one half of it equal: (start, segment, half of the next
segment) is an equi-join key. Inside a key, pairs pass the budgets of longer and longer chains
before the whole distance is taken.

Scale: texts are read once and never shuffled. Equal fingerprints are one vertex, counted with
partial aggregation. A vertex has 2 * m keys; keys of a single vertex are dropped by a partial
count. Keys of up to ``limit`` vertices are gathered and return a star for each component found in
them, never all pairs. A larger key is dealt to chunks of about ``limit``, which are linked inside
first; then the vertices outside the largest component of the key meet all others, chunk by
chunk (pairs inside a component have nothing more to add). Components spread by joins. A
fingerprint or component with a large share of all rows is joined by a broadcast of at most
``HOT_SHARE`` of them.

Defined results: a null or empty text, or one of white space, has fingerprint zero and links like
any other; fewer words than a shingle form one shingle; equal rows give equal result rows; a row
without doc_id links, but names no component, and its component_id is null if no row of the
component has an id; a text of any length is hashed a piece at a time; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from depthframe.llm.common import Scratch, arrow_schema, join_counted, per_slice, record
from depthframe.llm.near_dedup import connect

WORDS = 4
DISTANCE = 4
SEED = 42
LIMIT = 1024
FEW = 4  # a large key sends its outsiders to every chunk while they are at most FEW * limit
PIECE_BYTES = 1 << 18
BLOCK_PAIRS = 1 << 20
BATCH_MEMBERS = 1 << 17
_WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"


# ---------------------------------------------------------------- fingerprints


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a bounded number of bytes at a time."""
    lo = 0
    while lo < len(text):
        hi = min(lo + PIECE_BYTES, len(text))
        while hi < len(text) and text[hi] not in _WHITE:
            hi += 1
        yield text[lo:hi].lower().split()
        lo = hi


def shingle_values(text: bytes, words: int) -> Iterator[np.ndarray]:
    """XXH64 of the space-joined shingles of a text, in order."""
    hold: list[bytes] = []
    any_full = False
    for part in _pieces(text):
        found = hold + part
        if len(found) >= words:
            any_full = True
            line = b" ".join(found)
            size = np.fromiter(map(len, found), np.int64, len(found)) + 1
            end = np.cumsum(size) - 1
            start = (end - size + 1)[: len(found) - words + 1].tolist()
            digest = xxhash.xxh64_intdigest
            yield np.array([digest(line[a:b], SEED) for a, b in zip(start, end[words - 1 :].tolist())], dtype=np.uint64)
            hold = found[len(found) - words + 1 :]
        else:
            hold = found
    if hold and not any_full:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(hold), SEED)], dtype=np.uint64)


def fingerprint(text: bytes, words: int) -> int:
    """The 64 majority bits, as a signed number."""
    ones, n = np.zeros(64, dtype=np.int64), 0
    for values in shingle_values(text, words):
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(values)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0]) if n else 0


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, fp) of every row of ``docs``."""

    def run(part: pa.RecordBatch) -> dict:
        texts = part.column(1).cast(pa.large_binary()).fill_null(b"")
        return {"doc_id": part.column(0), "fp": pa.array([fingerprint(t.as_buffer().to_pybytes(), words) for t in texts], pa.int64())}

    schema = "doc_id long, fp long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(per_slice(schema, run, text=1), schema)


# ---------------------------------------------------------------- candidate keys


def ring(distance: int) -> list[tuple[int, int]]:
    """(shift, width) of the segments, from the highest bits down."""
    m = distance + 1
    widths = [64 // m + (i < 64 % m) for i in range(m)]
    return [(64 - sum(widths[: i + 1]), w) for i, w in enumerate(widths)]


def chain_masks(distance: int) -> np.ndarray:
    """[start, l - 1]: the bits of the first l segments of the chain from ``start``."""
    segments = ring(distance)
    own = [((1 << w) - 1) << s for s, w in segments]
    m = len(own)
    return np.array([[sum(own[(i + k) % m] for k in range(n + 1)) for n in range(m)] for i in range(m)], dtype=np.uint64)


def keys(distance: int) -> F.Column:
    """The join keys of a fingerprint: (start and half, segment, half of the next segment) packed in a long."""
    segments, out = ring(distance), []
    for i, (shift, width) in enumerate(segments):
        low, after = segments[(i + 1) % len(segments)]
        first = F.shiftrightunsigned("fp", shift).bitwiseAND((1 << width) - 1)
        for half, (s, w) in enumerate(((low + after // 2, after - after // 2), (low, after // 2))):
            value = F.shiftrightunsigned("fp", s).bitwiseAND((1 << w) - 1)
            slot = F.lit((2 * i + half) << 58).cast("long")
            out.append(slot.bitwiseOR(F.shiftleft(first, 20)).bitwiseOR(value))
    return F.array(*out)


# ---------------------------------------------------------------- links inside gathered keys


def _pairs(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of places within each run, a bounded number at a time."""
    place = np.arange(int(sizes.sum()))
    count = np.repeat(starts + sizes, sizes) - place - 1
    total, lo = np.cumsum(count), 0
    while lo < len(place):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + BLOCK_PAIRS, side="right")))
        n = count[lo:hi]
        a = np.repeat(place[lo:hi], n)
        yield a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        lo = hi


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give both ends of every pair the smaller label, until nothing changes."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label[:] = label[label]


def _stars(start: np.ndarray, sizes: np.ndarray, v: np.ndarray, comp: np.ndarray, distance: int, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b) that connect what links in each gathered key, from the first member of each component."""
    bits = v.view(np.uint64)
    ring_start = np.repeat(start, sizes)
    label = np.arange(len(v))
    for a, b in _pairs(np.cumsum(sizes) - sizes, sizes):
        differ = (comp[a] != comp[b]) & (v[a] != v[b])
        a, b = a[differ], b[differ]
        for length in range(2, distance + 2):  # longer and longer chains; the last is the whole ring
            near = np.bitwise_count((bits[a] ^ bits[b]) & masks[ring_start[a], length - 1]) <= length * distance // (distance + 1)
            a, b = a[near], b[near]
        _merge(label, a, b)
    moved = np.flatnonzero(label != np.arange(len(v)))
    return v[label[moved]], v[moved]


def _edges(dealt: DataFrame, distance: int) -> DataFrame:
    """Distinct edges (a, b) found among the members (key, chunk, v, c)."""
    schema = "a long, b long"
    target, masks = arrow_schema(schema), chain_masks(distance)

    def run(batches):
        for batch in batches:
            members = batch.column(1)
            ends = members.offsets.to_numpy()
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + BATCH_MEMBERS, side="right")) - 1)
                held = members.slice(lo, hi - lo).flatten()
                start = (batch.column(0)[lo:hi].to_numpy().view(np.uint64) >> np.uint64(59)).astype(np.int64)
                a, b = _stars(start, np.diff(ends[lo : hi + 1]), held.field("v").to_numpy(), held.field("c").to_numpy(), distance, masks)
                if len(a):
                    yield record({"a": pa.array(a), "b": pa.array(b)}, target)
                lo = hi

    groups = dealt.groupBy("key", "chunk").agg(F.collect_list(F.struct("v", "c")).alias("members"))
    return groups.select("key", "members").mapInArrow(run, schema).distinct()


def _outsiders(members: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """Members of large keys that still hold several components, dealt so that all pairs between components meet."""
    at = members.join(labels.select(F.col("u").alias("v"), F.col("l").alias("c")), "v", "left").withColumn("c", F.coalesce("c", "v"))
    per = at.groupBy("key", "c").agg(F.count("*").alias("m"))
    state = per.groupBy("key").agg(F.max(F.struct("m", "c")).alias("big"), F.sum("m").alias("all"))
    state = state.filter(F.col("all") > F.col("big.m")).select("key", F.col("big.c").alias("big"), (F.col("all") - F.col("big.m")).alias("out"))
    chunks = F.ceil(F.col("size") / limit)
    own = F.pmod(F.xxhash64("v", F.lit(3)), chunks)
    every = F.sequence(F.lit(0).cast("long"), chunks - 1)
    grid = F.array_distinct(F.transform(every, lambda j: F.least(own, j) * chunks + F.greatest(own, j)))
    few = F.when(F.col("c") == F.col("big"), F.array(own)).otherwise(every)
    dealt = F.when(F.col("out") <= FEW * limit, few).otherwise(grid)
    return at.join(state, "key").select("key", "v", "c", F.explode(dealt).alias("chunk"))


def near_components(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, fp, component_id, the smallest doc_id of its component."""
    if not 0 <= distance < 16:
        raise ValueError("distance must be from 0 to 15")
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.stage(fingerprints(docs, words), "rows")
    seen = Observation("rows")
    vertices = rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    vertices = scratch.stage(vertices.observe(seen, F.sum("copies").alias("n")), "vertices")
    total = seen.get["n"] or 0
    labels = _labels(vertices, distance, limit, scratch) if distance else None
    if labels is None:
        named = vertices.select("fp", "copies", F.col("first").alias("component_id"))
    else:
        sizes = Observation("vertices")
        linked = vertices.join(labels.select(F.col("u").alias("fp"), F.col("l").alias("c")), "fp", "left").withColumn("c", F.coalesce("c", "fp"))
        linked = scratch.stage(linked.observe(sizes, F.count("*").alias("n")), "linked")
        least = linked.groupBy("c").agg(F.min("first").alias("component_id"), F.count("*").alias("held"))
        named = join_counted(linked, least, ["c"], "held", sizes.get["n"]).select("fp", "copies", "component_id")
    return join_counted(rows, scratch.stage(named, "named"), ["fp"], "copies", total).select("doc_id", "fp", "component_id")


def _labels(vertices: DataFrame, distance: int, limit: int, scratch: Scratch) -> DataFrame | None:
    """(u, l): linked fingerprints with the least fingerprint of their component; None if nothing links."""
    dealt = vertices.select("fp", F.explode(keys(distance)).alias("key"))
    shared = dealt.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    seen = Observation("members")
    members = dealt.join(shared, "key").select("key", F.col("fp").alias("v"), "size")
    members = scratch.stage(members.observe(seen, F.sum((F.col("size") > limit).cast("long")).alias("large")), "members")
    chunk = F.pmod(F.xxhash64("v", F.lit(3)), F.ceil(F.col("size") / limit))
    edges = scratch.stage(_edges(members.withColumns({"c": F.col("v"), "chunk": chunk}), distance), "edges", narrow=True)
    if edges.isEmpty() and not seen.get["large"]:
        return None
    labels = connect(edges, scratch)
    if seen.get["large"]:
        more = _edges(_outsiders(members.filter(F.col("size") > limit), labels, limit), distance)
        labels = connect(scratch.stage(edges.unionByName(more).distinct(), "edges", narrow=True), scratch)
    return labels


def op11_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

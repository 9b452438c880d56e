"""MinHash near-duplicates by chosen paths.

A document is its set of distinct word shingles. Equal sets are one vertex from the start.
Each vertex gets ``COORDINATES`` minwise values and a sketch. In every one of ``trees``
independent trees the vertices branch by a chosen minwise token: the root by one of them, a
larger node by one or two that a hash of the node chooses, a little more than 1 / similarity on
average, so that the chance to follow a similar vertex down does not vanish with depth. A node
is finished when it is small; small nodes are compared exhaustively, by sketches first. Every
pair that may link is confirmed on the full sets of both texts.

Scale: nodes are rows (node, vertex). Node sizes come from partial counts, node and vertex
meet by equi-joins, which split a hot key, and only nodes of bounded size are gathered. In a
node that is too large every vertex is compared with one leader; the linked ones share a
component from then on, and a node in which a single component is left has nothing more to
find. So a group of many near copies costs a number of comparisons that is linear in it. In a
large node with a bounded number of vertices outside its big component, those are compared
with everybody in bounded chunks; only what is left then branches. Inside a gathered node only
sets of nearly equal size meet, only across components, and only in the least node that both share. A small node with many candidate
pairs first returns spanning forests of them; pairs between components that are still apart
afterwards are all compared. Texts are shuffled only where a candidate pair needs them.
Components spread by joins, never on the driver.

Recall: a pair with the lowest linked similarity misses one small tree with probability 0.15 and
all eight with 3e-7; links between copies of one group back each other up.

Defined results: a null or empty text has an empty set and is linked with nothing; equal rows
are linked by equal sets; a row without doc_id takes part, but cannot name a component, and its
component_id is null if no row of the component has an id; other columns are not read. Vertices
are 64-bit hashes of sets; a second hash checks that no two sets share one, else the call fails.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from depthframe.llm.common import SPACED, Scratch, arrow_schema, lists, mix, record, signed, slices, word_hashes

TREES = 8
COORDINATES = 24
BINS = 512
NODE_LIMIT = 512
FEW = 4  # a large node is finished where at most FEW * limit members are outside its big component
DENSE = 2  # a node with more candidate pairs than DENSE * members first returns a spanning forest
MAX_LEVEL = 12
SECOND_BRANCH = 0.35
SLACK = 4.0
_A, _B, _C = (np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))
_RANDOM = np.random.default_rng(7)
_FLIP = _RANDOM.integers(1, 1 << 63, COORDINATES, dtype=np.uint64)
_TIMES = _RANDOM.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one text after the other, and set sizes."""
    hashes, counts = word_hashes(texts, SPACED)
    doc = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
    left = counts[doc] - place
    rolled = np.zeros(len(hashes), dtype=np.uint64)
    for k in range(words):
        part = np.zeros(len(hashes), dtype=np.uint64)
        part[: len(hashes) - k] = hashes[k:]
        rolled = mix(rolled * _A + np.where(left > k, part, _B) + _C)
    whole = (left >= words) | (place == 0)
    doc, rolled = doc[whole], rolled[whole]
    order = np.lexsort((rolled, doc))
    doc, rolled = doc[order], rolled[order]
    fresh = np.ones(len(doc), dtype=bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (rolled[1:] != rolled[:-1])
    return rolled[fresh], np.bincount(doc[fresh], minlength=len(counts)).astype(np.int64)


def _vertices(sets: np.ndarray, sizes: np.ndarray) -> tuple[list[int | None], list[int | None]]:
    """Two hashes of every set; none of an empty one."""
    ends, first, second = np.cumsum(sizes), [], []
    for e, n in zip(ends.tolist(), sizes.tolist()):
        whole = hashlib.blake2b(sets[e - n : e], digest_size=16).digest() if n else None
        first.append(int.from_bytes(whole[:8], "little", signed=True) if n else None)
        second.append(int.from_bytes(whole[8:], "little", signed=True) if n else None)
    return first, second


def sketches(sets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One byte for each of ``BINS`` ranges of hash values: 0 if the set has none there, else made from the least.

    Among the ranges where either of two sets has a value, the share that agrees estimates their similarity.
    """
    at = np.repeat(np.arange(len(sizes)), sizes) * BINS + (sets >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    head = np.ones(len(at), dtype=bool)
    head[1:] = at[1:] != at[:-1]
    out = np.zeros(len(sizes) * BINS, dtype=np.uint8)
    out[at[head]] = (mix(sets[head]) % np.uint64(255)).astype(np.uint8) + 1
    return out.reshape(len(sizes), BINS)


def _prints(docs: DataFrame, words: int, trees: int) -> DataFrame:
    """(doc_id, th, v, v2, n, sig, nodes): vertex, set size, sketch with minwise values, and the root's child in each tree."""
    schema = "doc_id long, th long, v long, v2 long, n long, sig binary, nodes array<long>"
    target = arrow_schema(schema)
    seeds = mix(np.arange(1, trees + 1, dtype=np.uint64))

    def run(batches):
        for part in slices(batches, 2):
            sets, sizes = shingle_sets(part.column(2), words)
            full = np.flatnonzero(sizes)
            starts = (np.cumsum(sizes) - sizes)[full]
            least = np.empty((len(full), COORDINATES), dtype=np.uint64)
            for c in range(COORDINATES if len(full) else 0):
                least[:, c] = np.minimum.reduceat((sets ^ _FLIP[c]) * _TIMES[c], starts)
            least = mix(least)
            packed = np.concatenate([sketches(sets, sizes)[full], least.astype(np.uint16).view(np.uint8).reshape(len(full), -1)], axis=1)
            sig: list[bytes | None] = [None] * part.num_rows
            for row, own in zip(full.tolist(), packed):
                sig[row] = own.tobytes()
            counts = np.zeros(part.num_rows, dtype=np.int64)
            counts[full] = trees
            v, v2 = _vertices(sets, sizes)
            nodes = lists(signed(mix(least[:, :trees] ^ seeds).ravel()), counts, pa.int64())
            yield record({"doc_id": part.column(0), "th": part.column(1), "v": v, "v2": v2, "n": sizes, "sig": sig, "nodes": nodes}, target)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text").mapInArrow(run, schema)


# ---------------------------------------------------------------- candidates


def _may_link(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether sketches may belong to linked sets, with ``SLACK`` standard deviations to spare, and whether they look like it.

    A sketch samples the union of both sets without replacement, so the deviation falls as the
    sample nears the union.
    """
    j = percent / 100
    held = ((a | b) > 0).sum(axis=-1)
    agree = ((a == b) & (a > 0)).sum(axis=-1)
    union = np.maximum((n_a + n_b) / (1 + j), held + 1.0)
    spread = np.sqrt(j * (1 - j) * held * (union - held) / (union - 1))
    sized = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    return (agree + 1 >= j * held - SLACK * spread) & sized, (agree >= j * held) & sized


def _rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), -1)


def _ordered(a: np.ndarray, b: np.ndarray) -> dict:
    return {"a": np.minimum(a, b), "b": np.maximum(a, b)}


def _near(comp: np.ndarray, n: np.ndarray, home: np.ndarray, lower: np.ndarray, sig: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (a, b) of the candidate pairs between components, and whether each looks linked. Members are sorted by ``n``.

    Every such pair has an end outside the largest component, and sets of nearly the same size.
    Pairs without a member that is at home here, and pairs that share one of their ``lower`` nodes
    (rows of node numbers, filled up with zeros), are compared elsewhere.
    """
    _, kind, many = np.unique(comp, return_inverse=True, return_counts=True)
    minor = kind != np.argmax(many)
    lo = np.searchsorted(n, -(-n * percent // 100))
    hi = np.searchsorted(n, n * 100 // percent, side="right")
    a, b, sure = [], [], []
    for i in np.flatnonzero(minor).tolist():
        js = np.arange(lo[i], hi[i])
        js = js[(kind[js] != kind[i]) & (home[js] | home[i]) & ~(minor[js] & (js < i))]
        if len(js) and (own := lower[i][lower[i] != 0]).size:
            js = js[~np.isin(lower[js], own).any(axis=1)]
        if len(js):
            may, like = _may_link(sig[i], n[i], sig[js], n[js], percent)
            found = js[may]
            a.append(np.full(len(found), i))
            b.append(found)
            sure.append(like[may])
    if not a:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    return np.concatenate(a), np.concatenate(b), np.concatenate(sure)


def _node_pairs(groups: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) between the components of gathered nodes (node, first, members).

    Where ``first`` is set, a node with many pairs returns spanning forests of the likely and of all
    pairs, and its number, to be gathered once more.
    """
    schema = "a long, b long, node long"
    target = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for node, first, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                members = members.values
                v, comp, n, home = (members.field(x).to_numpy(zero_copy_only=False) for x in ("v", "c", "n", "home"))
                if (comp == comp[0]).all():
                    continue
                order = np.argsort(n, kind="stable")
                v, comp, n, home = v[order], comp[order], n[order], home[order]
                sig = _rows(members.field("sig"))[order, :BINS]
                lower = _filled(members.field("lower"))[order]
                a, b, sure = _near(comp, n, home, lower, sig, percent)
                dense = first and len(a) > DENSE * len(v)
                if dense:
                    a, b = (np.concatenate(x) for x in zip(_forest(len(v), a[sure], b[sure]), _forest(len(v), a, b)))
                if len(a):
                    yield record({**_ordered(v[a], v[b]), "node": pa.array([node if dense else None] * len(a), pa.int64())}, target)

    return groups.select("node", "first", "members").mapInArrow(run, schema)


def _filled(numbers: pa.ListArray) -> np.ndarray:
    """One row for each list, filled up with zeros."""
    counts = np.asarray(pc.list_value_length(numbers))
    out = np.zeros((len(counts), int(counts.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < counts[:, None]] = numbers.flatten().to_numpy()
    return out


def _forest(size: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shallow trees that span the graph of the edges (a, b): breadth first, from the vertex with most neighbours."""
    near = np.zeros((size, size), dtype=bool)
    near[a, b] = near[b, a] = True
    fresh = near.any(axis=1)
    degree = near.sum(axis=1)
    a, b = [], []
    while fresh.any():
        queue = [int(np.argmax(np.where(fresh, degree, -1)))]
        fresh[queue[0]] = False
        for top in queue:
            found = np.flatnonzero(near[top] & fresh).tolist()
            fresh[found] = False
            a += [top] * len(found)
            b += found
            queue += found
    return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


def _star_pairs(large: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of each large node's leader, the vertex with most equal documents, with the other members."""
    schema = "a long, b long"
    target = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                v, n, leader, leader_n = (batch.column(x).to_numpy() for x in ("v", "n", "leader", "leader_n"))
                ok, _ = _may_link(_rows(batch.column("sig"))[:, :BINS], n, _rows(batch.column("leader_sig"))[:, :BINS], leader_n, percent)
                yield record(_ordered(leader[ok], v[ok]), target)

    first = large.groupBy("node").agg(F.max(F.struct("copies", "v")).alias("top")).select("node", F.col("top.v").alias("v"))
    lead = large.join(first, ["node", "v"]).select("node", F.col("v").alias("leader"), F.col("n").alias("leader_n"), F.col("sig").alias("leader_sig"))
    return large.join(lead, "node").filter("v <> leader").select("v", "n", "sig", "leader", "leader_n", "leader_sig").mapInArrow(run, schema)


def _children(rows: DataFrame, level: int, trees: int) -> DataFrame:
    """Members of large nodes, dealt to the children by the minwise tokens that the node chooses."""
    schema = "node long, v long, n long, sig binary, copies long"
    target = arrow_schema(schema)
    free = COORDINATES - trees

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column(0).to_numpy().view(np.uint64)
            values = np.ascontiguousarray(_rows(batch.column(3))[:, BINS:]).view(np.uint16)
            chosen = mix(node + np.uint64(level))
            first = (chosen % np.uint64(free)).astype(np.int64)
            second = (first + 1 + ((chosen >> np.uint64(8)) % np.uint64(free - 1)).astype(np.int64)) % free
            twice = np.flatnonzero((chosen >> np.uint64(32)) % np.uint64(1000) < np.uint64(1000 * SECOND_BRANCH))
            for coordinate, who in ((first, np.arange(len(node))), (second, twice)):
                at = trees + coordinate[who]
                child = mix(node[who] * _A + at.astype(np.uint64) * _B + values[who, at].astype(np.uint64) + _C)
                rest = [batch.column(c).take(pa.array(who)) for c in (1, 2, 3, 4)]
                yield record({"node": signed(child), "v": rest[0], "n": rest[1], "sig": rest[2], "copies": rest[3]}, target)

    return rows.select("node", "v", "n", "sig", "copies").mapInArrow(run, schema)


def _sized(members: DataFrame) -> DataFrame:
    """Members of nodes that hold at least two, with the node's size."""
    return members.join(members.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1"), "node")


# ---------------------------------------------------------------- links and components


def _texts(docs: DataFrame, words: int, wanted: DataFrame) -> DataFrame:
    """(v, text): a compressed text for each wanted vertex."""
    schema = "v long, text binary"
    target = arrow_schema(schema)

    def run(batches):
        for part in slices(batches, 0):
            pack = zstandard.ZstdCompressor(level=1).compress
            v, _ = _vertices(*shingle_sets(part.column(0), words))
            yield record({"v": v, "text": [pack((t or "").encode("utf-8")) for t in part.column(0).to_pylist()]}, target)

    packed = docs.select("text").mapInArrow(run, schema).filter(F.col("v").isNotNull())
    return packed.join(wanted, "v", "left_semi").dropDuplicates(["v"])


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link, decided on the full sets."""
    schema = "a long, b long"
    target = arrow_schema(schema)

    def run(batches):
        for part in slices(batches, 3, 1 << 20):
            unpack = zstandard.ZstdDecompressor().decompress
            known: dict[int, int] = {}
            blobs = []
            a, b = part.column(0).to_numpy(), part.column(1).to_numpy()
            for v, blob in zip([*a.tolist(), *b.tolist()], [*part.column(2), *part.column(3)]):
                if v not in known:
                    known[v] = len(blobs)
                    blobs.append(unpack(blob.as_py()))
            sets, sizes = shingle_sets(pa.array(blobs, pa.binary()), words)
            ends = np.cumsum(sizes)
            linked = np.zeros(len(a), dtype=bool)
            for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
                x, y = known[x], known[y]
                both = np.sort(np.concatenate([sets[ends[x] - sizes[x] : ends[x]], sets[ends[y] - sizes[y] : ends[y]]]))
                common = int((both[1:] == both[:-1]).sum())
                linked[k] = 100 * common >= percent * (sizes[x] + sizes[y] - common)
            yield record({"a": a[linked], "b": b[linked]}, target)

    left = pairs.join(texts.withColumnsRenamed({"v": "a", "text": "text_a"}), "a")
    both = left.join(texts.withColumnsRenamed({"v": "b", "text": "text_b"}), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, schema)


def connect(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, l): every end of ``edges`` (a, b) with the smallest end of its component."""
    both = scratch.stage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "both", narrow=True)
    labels = scratch.stage(both.groupBy(F.col("a").alias("u")).agg(F.least(F.first("a"), F.min("b")).alias("l")), "labels", narrow=True)
    while True:
        # the least label among the neighbours, then that label's own label
        near = both.join(labels, both["b"] == labels["u"]).groupBy("a").agg(F.min("l").alias("m"))
        lower = labels.join(near, labels["u"] == near["a"]).select("u", F.least("l", "m").alias("m"), F.col("l").alias("old"))
        up = labels.select(F.col("u").alias("m"), F.col("l").alias("beyond"))
        moved = lower.join(up, "m").select("u", F.least("m", "beyond").alias("l"), "old")
        seen = Observation("moved")
        after = scratch.stage(moved.observe(seen, F.sum((F.col("l") < F.col("old")).cast("long")).alias("n")), "labels", narrow=True)
        scratch.drop(labels)
        labels = after
        if not seen.get["n"]:
            scratch.drop(both)
            return labels.select("u", "l")


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` (.., v) with the component c of each vertex; one without a label is its own."""
    if labels is None:
        return rows.withColumn("c", F.col("v"))
    return rows.join(labels, "v", "left").withColumn("c", F.coalesce("c", "v"))


def _merged(labels: DataFrame | None, links: DataFrame, scratch: Scratch) -> DataFrame | None:
    """Labels (v, c) after joining the components at both ends of the links."""
    a = _labelled(links.withColumnRenamed("a", "v"), labels).select(F.col("c").alias("a"), F.col("b").alias("v"))
    ends = _labelled(a, labels).select("a", F.col("c").alias("b")).filter("a <> b").distinct()
    edges = scratch.stage(ends, "edges", narrow=True)
    if edges.isEmpty():
        return labels
    moved = connect(edges, scratch)
    new = moved.select(F.col("u").alias("v"), F.col("l").alias("c"))
    if labels is not None:
        kept = labels.join(moved, labels["c"] == moved["u"], "left").select("v", F.coalesce("l", "c").alias("c"))
        new = kept.unionByName(new.join(labels.select("v"), "v", "left_anti"))
    return scratch.stage(new, "components", narrow=True)


def _chunked(rows: DataFrame, limit: int, all_pairs: bool) -> DataFrame:
    """Members (with c, big, size) dealt to chunks that together hold every pair with a vertex outside the big component."""
    chunks = F.ceil(F.col("size") / limit)
    own = F.pmod(F.xxhash64("v", F.lit(11)), chunks)
    every = F.sequence(F.lit(0).cast("long"), chunks - 1)
    if all_pairs:
        dealt = F.array_distinct(F.transform(every, lambda j: F.least(own, j) * chunks + F.greatest(own, j)))
    else:
        dealt = F.when((F.col("c") == F.col("big")) & (chunks > 1), F.array(own)).otherwise(every)
    home = F.lit(True) if all_pairs else F.col("chunk") == own
    return rows.withColumn("chunk", F.explode(dealt)).withColumn("home", home)


def near_duplicates(docs: DataFrame, words: int, percent: int, trees: int = TREES, limit: int = NODE_LIMIT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, th, n_shingles, component_id, first_th.

    ``th`` is xxhash64(text); (component_id, first_th) is the smallest (doc_id, th) of the component.
    """
    scratch = Scratch(docs.sparkSession, "near")
    prints = scratch.stage(_prints(docs, words, trees), "prints")
    clash = Observation("clash")
    sets = prints.filter("n > 0").groupBy("v").agg(*(F.first(x).alias(x) for x in ("n", "sig", "nodes")), F.count("*").alias("copies"), F.min("v2").alias("lo"), F.max("v2").alias("hi"))
    sets = scratch.stage(sets.observe(clash, F.sum((F.col("lo") != F.col("hi")).cast("long")).alias("n")).drop("lo", "hi"), "sets")
    if clash.get["n"]:
        raise ValueError("two sets share a hash")
    rows = scratch.stage(prints.select("doc_id", "th", "v", "n"), "rows")
    scratch.drop(prints)
    facts = sets.select("v", "n", "sig", "copies")
    # the first nodes are staged without sketches, which only gathered members fetch
    shared, n_large = _staged_members(_sized(sets.select(F.explode("nodes").alias("node"), "v")), limit, scratch)
    small = large = again = starred = labels = texts = None
    if shared is not None:
        small = shared.filter(F.col("size") <= limit)
        large = scratch.stage(shared.filter(F.col("size") > limit).join(facts, "v"), "large") if n_large else None
    level = 0
    while small is not None or large is not None or starred is not None or again is not None:
        gathered, onward, few = [], None, None
        for members, first in ((small, True), (again, False)):
            if members is not None:
                members = members if "sig" in members.columns else members.join(facts, "v")
                gathered.append(_labelled(members, labels).withColumns({"chunk": F.lit(0).cast("long"), "home": F.lit(True), "first": F.lit(first)}))
        if starred is not None:
            # large nodes after their star: how many components are left in each?
            at = _labelled(starred, labels)
            per = at.groupBy("node", "c").agg(F.count("*").alias("m"))
            state = per.groupBy("node").agg(F.max(F.struct("m", "c")).alias("big"), F.sum("m").alias("all")).filter(F.col("all") > F.col("big.m"))
            state = state.select("node", F.col("big.c").alias("big"), ((F.col("all") - F.col("big.m") <= FEW * limit) | F.lit(level > MAX_LEVEL)).alias("few"))
            at = scratch.stage(at.join(state, "node"), "open")
            few = at.filter("few").drop("c", "big", "all", "few")
            gathered.append(_chunked(at.filter("few"), limit, level > MAX_LEVEL))
            onward = _sized(_children(at.filter("not few"), level, trees)) if level <= MAX_LEVEL else None
        candidates = []
        if gathered:
            needed = ("node", "chunk", "first", "v", "c", "n", "sig", "home")
            every = reduce(DataFrame.unionByName, (g.select(*needed) for g in gathered))
            # a pair that shares several nodes of this pass is compared in the least of them
            mine = every.select("v", "node").groupBy("v").agg(F.collect_set("node").alias("nodes"))
            every = every.join(mine, "v").withColumn("lower", F.filter("nodes", lambda x: x < F.col("node")))
            members = F.collect_list(F.struct("v", "c", "n", "sig", "home", "lower")).alias("members")
            candidates.append(_node_pairs(every.groupBy("node", "chunk", "first").agg(members), percent))
        if large is not None:
            candidates.append(_star_pairs(large, percent).withColumn("node", F.lit(None).cast("long")))
        found = scratch.stage(reduce(DataFrame.unionByName, candidates).distinct(), "pairs", narrow=True)
        pairs = found.select("a", "b").distinct()
        if texts is None:
            wanted = pairs.select(F.col("a").alias("v")).union(pairs.select("b"))
            wanted = wanted if shared is None else wanted.union(shared.filter(F.col("size") > limit).select("v"))
            texts = scratch.stage(_texts(docs, words, wanted.distinct()), "texts")
        labels = _merged(labels, _confirmed(pairs, texts, words, percent), scratch)
        dense = found.filter(F.col("node").isNotNull()).select("node").distinct()
        again = small.join(dense, "node", "left_semi") if small is not None and not dense.isEmpty() else None
        # large nodes go to their chunks next, dense ones once more
        starred = None if large is None else large.withColumn("first", F.lit(True))
        if few is not None and not dense.isEmpty():
            more = few.join(dense, "node", "left_semi").withColumn("first", F.lit(False))
            starred = more if starred is None else starred.unionByName(more.select(starred.columns))
        small = large = None
        if onward is not None:
            fresh, n_large = _staged_members(onward, limit, scratch)
            if fresh is not None:
                small = fresh.filter(F.col("size") <= limit)
                large = fresh.filter(F.col("size") > limit) if n_large else None
        level += 1
    rows = _labelled(rows.withColumnRenamed("n", "n_shingles"), labels).select("doc_id", "th", "n_shingles", "c")
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "th"))).alias("first")
    named = rows.filter(F.col("c").isNotNull()).groupBy("c").agg(first)
    linked = rows.join(named, "c", "left")
    alone = F.col("c").isNull()
    return linked.select(
        "doc_id",
        "th",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        F.when(alone, F.col("th")).otherwise(F.col("first.th")).alias("first_th"),
    )


def _staged_members(members: DataFrame, limit: int, scratch: Scratch) -> tuple[DataFrame | None, int]:
    """Staged members, or None if there are none, and how many are in nodes above ``limit``."""
    seen = Observation("members")
    staged = scratch.stage(members.observe(seen, F.count("*").alias("n"), F.sum((F.col("size") > limit).cast("long")).alias("large")), "members")
    return (staged if seen.get["n"] else None), seen.get["large"] or 0


def keep_first(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """One document of each component of near-duplicates: the one with the smallest doc_id. Rows without an id stay."""
    th = "__th"
    found = near_duplicates(docs, words, percent)
    kept = found.filter((F.col("doc_id") == F.col("component_id")) & (F.col("th") == F.col("first_th")))
    kept = kept.select(F.col("doc_id").alias("__id"), F.col("th").alias(th)).distinct()
    keyed = docs.withColumn(th, F.xxhash64("text"))
    same = (F.col("doc_id").cast("long") == F.col("__id")) & (keyed[th] == kept[th])
    once = keyed.filter(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id", th])
    return once.join(kept, same, "left_semi").unionByName(keyed.filter(F.col("doc_id").isNull())).drop(th)


def op2_near_duplicates(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[k : k + 2], ' ') AS sh
  FROM w, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS t(k) WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 85 * (na.n + nb.n - common)),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id, d.doc_id = coalesce(c.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (
  WITH RECURSIVE reach(doc_id, r) AS (
    SELECT a, a FROM links UNION SELECT b, b FROM links
    UNION SELECT steps.b, reach.r FROM reach JOIN steps ON reach.doc_id = steps.a)
  SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""

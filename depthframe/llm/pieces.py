"""SentencePiece encoding and decoding over a relational lattice.

Texts are split into units where no piece can span: before white-space marks, around line ends,
and between ASCII punctuation and characters that the piece table never puts next to it; a long unit
also between any two characters that stand side by side in no piece. Each distinct unit explodes
into the places where a substring of it can begin a piece; an equi-join with the piece table, keyed
by first characters, finds the pieces there: the edges of the unit's lattice. Edges are
grouped by unit and folded. For a unigram model the fold is Viterbi with Spark's higher-order
``aggregate`` over the places of the unit. A BPE model's encoder does not look for the path with the
best sum of scores: its scores are ranks, and it joins two neighbours by the best-ranked edge, again
and again. That fold runs in Arrow batches over the same grouped edges, because as an ``aggregate`` it
took too long (see the README). Characters without a piece fall back to their bytes.

Scale: the distinct units are stored once; the lattice is built per distinct unit, not per
occurrence, and joins and groups units where they lie. The ``HOT_UNITS`` most frequent units are sent to every task, where a text
becomes their piece numbers with gaps; it fetches the numbers of its other units by an equi-join, in the order of their first
place. Per text one shuffle moves its numbers, and the compressed text if that is kept, to them. Whether numbers decode to the text
is told by SHA-256 digests of both.

Defined results: a null or empty text has no pieces and decodes to an empty text; equal rows are
encoded alike; the mark U+2581 in a text decodes as a blank, as in the library; extra columns stay.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from depthframe.llm.common import SLICE_BYTES, Scratch, arrow_schema, lists, record, slices

MARK = "▁"
HOT_UNITS = 1 << 18
HELD_UNITS = 150_000
PREFIX = 4
UNITS_A_TASK = 40_000
GROUPS_IN_MEMORY = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
TURNS = 3
SHORT = 250
MAX_BROADCAST_PIECES = 1_000_000
UNKNOWN_PENALTY = 10.0
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


@dataclass(frozen=True)
class Pieces:
    """A piece table: normal pieces with ids and scores, byte pieces, and whether the model is a BPE model."""

    names: tuple[str, ...]
    ids: tuple[int, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]
    unknown: int
    bpe: bool

    def __post_init__(self):
        if any(MARK in p.lstrip(MARK) for p in self.names) or any("\n" in p and p != "\n" for p in self.names):
            raise ValueError("a piece spans words")

    def splitter(self) -> re.Pattern:
        """Units of a marked text: no piece holds two characters on both sides of a cut.

        Cuts lie between ASCII punctuation and other characters, unless one of those stands next to
        punctuation in some piece; a run that touches such a character stays whole.
        """
        beside = {c for p in self.names for c in p if any(x in PUNCTUATION for x in p)} - set(PUNCTUATION) - {MARK, "\n"}
        glue, marks = "".join(map(re.escape, sorted(beside))), re.escape(PUNCTUATION)
        apart = f"(?![{glue}])" if glue else ""
        return re.compile(rf"{MARK}*+(?:[^{MARK}\n{marks}{glue}]++{apart}|[{marks}]++{apart}|[^{MARK}\n]++)|\n|{MARK}++")

    def neighbours(self) -> frozenset[str]:
        """All pairs of characters that stand side by side in some piece."""
        return frozenset(p[i : i + 2] for p in self.names for i in range(len(p) - 1))

    @property
    def packed(self) -> np.dtype:
        """The narrowest type that holds every piece number; its largest value is none, and stands for a unit yet to be looked up."""
        return np.dtype(np.uint16 if max([*self.ids, *self.byte_ids, self.unknown]) < (1 << 16) - 1 else np.int32)

    @property
    def longest(self) -> int:
        return max(map(len, self.names))


def read_pieces(path: str, bpe: bool = True) -> Pieces:
    """The table of a SentencePiece model file with an identity normaliser and a leading blank."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    every = range(model.get_piece_size())
    normal = [i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    by_byte = {int(model.id_to_piece(i)[1:-1], 16): i for i in every if model.is_byte(i)}
    return Pieces(
        tuple(model.id_to_piece(i) for i in normal),
        tuple(normal),
        tuple(model.get_score(i) for i in normal),
        tuple(by_byte[b] for b in range(256)) if by_byte else (),
        model.unk_id(),
        bpe,
    )


def units(text: str | None, splitter: re.Pattern, neighbours: frozenset[str] = frozenset()) -> list[str]:
    """The units of a text; one above ``SHORT`` characters is also cut between characters that are ``neighbours`` in no piece."""
    found = splitter.findall(MARK + text.replace(" ", MARK)) if text else []
    if neighbours and text and len(text) > SHORT and max(map(len, found)) > SHORT:
        return [part for unit in found for part in ([unit] if len(unit) <= SHORT else _apart(unit, neighbours))]
    return found


def _apart(unit: str, neighbours: frozenset[str]) -> list[str]:
    cuts = [i for i in range(1, len(unit)) if unit[i - 1 : i + 1] not in neighbours]
    return [unit[lo:hi] for lo, hi in zip([0, *cuts], [*cuts, len(unit)])]


# ---------------------------------------------------------------- the lattice


def _vocabulary(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """(unit, n): distinct units of all texts, counted per task first."""
    schema = "unit string, n long"
    target = arrow_schema(schema)
    splitter, pairs = pieces.splitter(), pieces.neighbours()

    def run(batches):
        held: Counter = Counter()
        for part in slices(batches, 0):
            for text in part.column(0).to_pylist():
                held.update(units(text, splitter, pairs))
                if len(held) > HELD_UNITS:
                    yield record({"unit": list(held), "n": list(held.values())}, target)
                    held = Counter()
        yield record({"unit": list(held), "n": list(held.values())}, target)

    return docs.select("text").mapInArrow(run, schema).groupBy("unit").agg(F.sum("n").alias("n"))


def _keyed(spark: SparkSession, pieces: Pieces, least: int) -> tuple[DataFrame, list[int]]:
    """The piece table by its first ``PREFIX`` characters, or all of a shorter piece: (key, pieces), and the lengths of the keys."""
    order = np.argsort(-np.array(pieces.scores), kind="stable")
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order), dtype=np.int64)
    held: dict[str, list] = {}
    for name, r, score in zip(pieces.names, rank, pieces.scores):
        if len(name) >= least:
            held.setdefault(name[:PREFIX], []).append({"piece": name, "rank": int(r), "score": float(score)})
    kind = pa.list_(pa.struct([("piece", pa.string()), ("rank", pa.int64()), ("score", pa.float64())]))
    rows = spark.createDataFrame(pa.table({"key": list(held), "pieces": pa.array(list(held.values()), kind)}))
    return (F.broadcast(rows) if len(pieces.names) <= MAX_BROADCAST_PIECES else rows), sorted({len(k) for k in held})


def _edges(words: DataFrame, table: DataFrame, sizes: list[int], least: int, tasks: int, packed: bool = False) -> DataFrame:
    """(unit, n, edges): the pieces among the substrings of short units, as (rank, s, e, score), or ``packed`` (rank, s, e) in one number.

    A place of a unit explodes to its substrings of the lengths of a key; those that a piece begins with are
    joined, and the pieces that go on as the unit does are edges. Every unit also has one row without a
    place, so that a unit without edges is not lost. Units are dealt by a number, and neither the explode,
    nor the join with a small table, nor the grouping moves them again.
    """
    dealt = words.withColumn("uid", F.monotonically_increasing_id()).repartition(tasks, "uid")
    place = F.sequence(F.lit(-1), F.length("unit") - least)
    places = dealt.select("uid", "unit", "n", F.explode(F.when(F.length("unit") >= least, place).otherwise(F.array(F.lit(-1)))).alias("s"))
    keyed = places.select("*", F.explode(F.array(*map(F.lit, sizes))).alias("size")).filter(f"(s < 0 and size = {sizes[0]}) or (s >= 0 and s + size <= length(unit))")
    starts = keyed.withColumn("key", F.expr("if(s < 0, null, substring(unit, s + 1, size))"))
    joined = starts.join(table, "key", "left").filter("s < 0 or pieces is not null").select("uid", "unit", "n", "s", F.explode_outer("pieces").alias("p"))
    length = F.length("p.piece")
    found = joined.filter((F.col("s") < 0) | (F.substring("unit", F.col("s") + 1, length) == F.col("p.piece")))
    if packed:
        edge = (F.col("p.rank") * 256 + F.col("s")) * 256 + F.col("s") + length
    else:
        edge = F.struct(F.col("p.rank").alias("rank"), "s", (F.col("s") + length).alias("e"), F.col("p.score").alias("score"))
    return found.groupBy("uid", "unit", "n").agg(F.collect_list(F.when(F.col("s") >= 0, edge)).alias("edges")).drop("uid")


#: Viterbi: for each place the best score of a path from the start, and the place before it.
_VITERBI = """aggregate(sequence(1, length(unit)), array(named_struct('score', 0D, 'back', 0)), (best, e) -> concat(best, array(array_max(
    transform(filter(edges, x -> x.e = e), x -> named_struct('score', best[x.s].score + x.score, 'back', x.s))))))"""
_BACK = """aggregate(sequence(1, length(unit)), named_struct('at', length(unit), 'cuts', cast(array() as array<int>)), (a, i) ->
    if(a.at <= 0, a, named_struct('at', best[a.at].back, 'cuts', if(best[a.at].back > 0, concat(array(best[a.at].back), a.cuts), a.cuts))), a -> a.cuts)"""
SEGMENT = "unit string, n long, cuts array<int>"
CODED = "unit string, n long, code binary"


def segment(vocabulary: DataFrame, pieces: Pieces, coded: bool = False) -> DataFrame:
    """(unit, n, cuts): the places inside each unit of a stored ``vocabulary`` where its pieces meet.

    With ``coded`` a column code instead of cuts: the packed piece numbers.
    """
    least = 2 if pieces.bpe else 1
    table, sizes = _keyed(vocabulary.sparkSession, pieces, least)
    # a unit has about a dozen edges, so tasks hold few units
    tasks = max(int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions")), vocabulary.count() // UNITS_A_TASK + 1)
    if not pieces.bpe:
        folded = _viterbi(vocabulary, table, sizes, pieces, tasks)
        return folded.mapInArrow(_finish(pieces, lambda unit, cuts: cuts, coded), CODED) if coded else folded
    short = _edges(vocabulary.filter(F.length("unit") <= SHORT), table, sizes, least, tasks, packed=True)
    finish = _finish(pieces, lambda unit, edges: joined(len(unit), edges), coded)
    done = short.mapInArrow(finish, CODED if coded else SEGMENT)
    heap = _finish(pieces, _by_heap, coded)
    long = _long_edges(vocabulary.filter(F.length("unit") > SHORT), _table(vocabulary.sparkSession, pieces), pieces.longest)
    return done.unionByName(long.mapInArrow(heap, CODED if coded else SEGMENT))


def _finish(pieces: Pieces | None, fold, coded: bool):
    """An Arrow function from (unit, n, edges) to (unit, n, cuts or code), a bounded number of units at a time."""
    target = arrow_schema(CODED if coded else SEGMENT)

    def run(batches):
        names, kind = (dict(zip(pieces.names, pieces.ids)), pieces.packed) if coded else ({}, None)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                own = part.column(0).to_pylist()
                out = [fold(unit, edges) for unit, edges in zip(own, part.column(2).to_pylist())]
                if coded:
                    out = [np.array(_numbers(pieces, names, unit, cuts), dtype=kind).tobytes() for unit, cuts in zip(own, out)]
                yield record({"unit": part.column(0), "n": part.column(1), target.names[2]: out}, target)

    return run


def _table(spark: SparkSession, pieces: Pieces) -> DataFrame:
    order = np.argsort(-np.array(pieces.scores), kind="stable")
    table = spark.createDataFrame(pa.table({"piece": [pieces.names[i] for i in order], "rank": np.arange(len(order), dtype=np.int64)}))
    return F.broadcast(table) if len(pieces.names) <= MAX_BROADCAST_PIECES else table


_MASKS: dict[int, tuple[int, int]] = {}  # by both ends of an edge, at most 2^16


def joined(length: int, edges: list[int]) -> list[int]:
    """Cuts left after joining neighbours, best rank first and leftmost among equals.

    Places are bits; an edge can join where both its ends are cuts and just one cut lies between.
    """
    places = (1 << (length + 1)) - 1
    masks = []
    for code in sorted(edges):
        place = code & 65535
        mask = _MASKS.get(place)
        if mask is None:
            s, e = place >> 8, place & 255
            mask = _MASKS[place] = (1 << s | 1 << e, (1 << e) - (2 << s))
        masks.append(mask)
    again = True
    while again:
        again = False
        for ends, inner in masks:
            if places & ends == ends:
                between = places & inner
                if between and not between & (between - 1):
                    places ^= between
                    again = True
                    break
    return [i for i in range(1, length) if places >> i & 1]


def _viterbi(vocabulary: DataFrame, table: DataFrame, sizes: list[int], pieces: Pieces, tasks: int) -> DataFrame:
    unknown = min(pieces.scores) - UNKNOWN_PENALTY
    edges = _edges(vocabulary, table, sizes, 1, tasks)
    # every character also has an edge of its own at the penalty of an unknown piece
    own = F.expr(f"transform(sequence(0, length(unit) - 1), s -> named_struct('rank', -1L, 's', s, 'e', s + 1, 'score', double({unknown})))")
    best = edges.withColumn("edges", F.concat("edges", own)).withColumn("best", F.expr(_VITERBI))
    return best.select("unit", "n", F.expr(_BACK).alias("cuts"))


def _long_edges(words: DataFrame, table: DataFrame, longest: int) -> DataFrame:
    """(unit, n, edges) of long units: their substrings are keyed by a digest, and edges meet by it."""
    target = arrow_schema("key string, s int, e int, piece string")

    def explode(batches):
        for batch in batches:
            for key, unit in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for lo in range(0, len(unit), 4096):
                    spans = [(s, s + n) for s in range(lo, min(lo + 4096, len(unit))) for n in range(2, min(longest, len(unit) - s) + 1)]
                    yield record({"key": [key] * len(spans), "s": [s for s, _ in spans], "e": [e for _, e in spans], "piece": [unit[s:e] for s, e in spans]}, target)

    keyed = words.select(F.md5("unit").alias("key"), "unit", "n")
    sub = keyed.select("key", "unit").mapInArrow(explode, "key string, s int, e int, piece string")
    edges = sub.join(table, "piece").groupBy("key").agg(F.collect_list(F.struct("rank", "s", "e")).alias("edges"))
    return keyed.join(edges, "key", "left").select("unit", "n", "edges")


def _by_heap(unit: str, edges: list[dict] | None) -> list[int]:
    return merged(len(unit), {(x["s"], x["e"]): x["rank"] for x in edges or []})


def _long(words: DataFrame, table: DataFrame, longest: int) -> DataFrame:
    """(unit, n, cuts) by the heap, whatever the length of the units."""
    return _long_edges(words, table, longest).mapInArrow(_finish(None, _by_heap, False), SEGMENT)


def merged(length: int, rank: dict[tuple[int, int], int]) -> list[int]:
    """Cuts left after joining neighbours, best rank first and leftmost among equals."""
    after = list(range(1, length + 1))
    before = list(range(-1, length - 1))
    alive = [True] * length
    heap = [(rank[s, s + 2], s, s + 1, s + 2) for s in range(length - 1) if (s, s + 2) in rank]
    heapq.heapify(heap)
    while heap:
        _, s, mid, e = heapq.heappop(heap)
        if not alive[s] or after[s] != mid or mid >= length or not alive[mid] or after[mid] != e:
            continue
        after[s], alive[mid] = e, False
        if e < length:
            before[e] = s
            if (s, after[e]) in rank:
                heapq.heappush(heap, (rank[s, after[e]], s, e, after[e]))
        if before[s] >= 0 and (before[s], e) in rank:
            heapq.heappush(heap, (rank[before[s], e], before[s], s, e))
    return [s for s in range(1, length) if alive[s]]


# ---------------------------------------------------------------- texts


def _numbers(pieces: Pieces, names: dict[str, int], unit: str, cuts: list[int]) -> list[int]:
    out = []
    for lo, hi in zip([0, *cuts], [*cuts, len(unit)]):
        piece = unit[lo:hi]
        if piece in names:
            out.append(names[piece])
        elif pieces.byte_ids:
            out += [pieces.byte_ids[b] for b in piece.encode("utf-8")]
        else:
            out.append(pieces.unknown)
    return out


def encode(docs: DataFrame, pieces: Pieces, hot_units: int = HOT_UNITS, round_trip: str | None = None) -> DataFrame:
    """``docs`` plus ids, the piece numbers of its text; a column ids of ``docs`` is replaced.

    ``round_trip`` names a further column: whether the piece numbers decode to the text again. They are
    decoded where they are made, so a task holds one Python worker, not two.
    """
    return encoder(docs, pieces, hot_units, round_trip)(docs)


def encoder(docs: DataFrame, pieces: Pieces, hot_units: int = HOT_UNITS, round_trip: str | None = None):
    """A function that does what ``encode`` does, for ``docs`` or any part of its rows; the units of all texts are segmented once."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "pieces", batch_bytes=SLICE_BYTES)
    splitter, pairs = pieces.splitter(), pieces.neighbours()
    vocabulary = scratch.stage(_vocabulary(docs, pieces), "vocabulary")
    # a task's edges are a few numbers for each of its UNITS_A_TASK units: they are grouped in memory, not sorted
    lattice = Scratch(spark, "lattice", batch_bytes=SLICE_BYTES)
    lattice.settings[GROUPS_IN_MEMORY] = str(2 * UNITS_A_TASK)
    coded = lattice.stage(segment(vocabulary, pieces, coded=True), "coded")
    scratch.drop(vocabulary)
    hot = coded.orderBy(F.desc("n"), "unit").limit(hot_units).select("unit", "code").toArrow()
    shared = spark.sparkContext.broadcast(dict(zip(hot.column("unit").to_pylist(), hot.column("code").to_pylist())))
    return lambda part, stage=None: _attached(part, coded, shared, pieces, round_trip, stage)


def _attached(docs: DataFrame, coded: DataFrame, shared, pieces: Pieces, round_trip: str | None, stage=None) -> DataFrame:
    """``docs`` plus ids from the coded units; the most frequent ones are ``shared``.

    Texts are cut once where ``stage`` stores what is found, twice without it. A stored part holds no text, and neither does its result."""
    splitter, pairs = pieces.splitter(), pieces.neighbours()
    kept = [f for f in docs.schema.fields if f.name not in ("ids", round_trip) and not (stage and f.name == "text")]
    kind, gap = pieces.packed, np.array([np.iinfo(pieces.packed).max], dtype=pieces.packed).tobytes()
    asked = [StructField("__th", LongType()), StructField("__rare", ArrayType(StringType()))]
    found = [StructField("__codes", BinaryType()), StructField("__which", ArrayType(IntegerType())), StructField("__sum", BinaryType())]
    carried = [StructField(f.name, BinaryType()) if f.name == "text" else f for f in kept]

    def cutter(fields: list[StructField]):
        """For each text its rarer units, in the order of their first place, and if asked the numbers of all others, with gaps."""
        target, full = to_arrow_schema(StructType(fields)), len(fields) > len(asked)

        def run(batches):
            known, press = shared.value, zstandard.ZstdCompressor(level=3).compress
            for part in slices(batches, 0):
                texts, rows = part.column(0).to_pylist(), []
                for text in texts:
                    own = units(text, splitter, pairs)
                    codes = list(map(known.get, own))
                    rare, which = {}, []
                    if None in codes:
                        missing = [u for u, code in zip(own, codes) if code is None]
                        rare = {u: i for i, u in enumerate(dict.fromkeys(missing))}
                        if full:
                            which = [rare[u] for u in missing]
                            codes = [gap if code is None else code for code in codes]
                    same = hashlib.sha256((text or "").replace(MARK, " ").encode("utf-8")).digest() if full and round_trip else None
                    rows.append((list(rare), b"".join(codes) if full else None, which, same))
                columns = dict(zip(("__rare", "__codes", "__which", "__sum"), zip(*rows)))
                columns["__th"] = part.column(1)
                for i, f in enumerate(carried if full else []):
                    columns[f.name] = [None if t is None else press(t.encode("utf-8")) for t in texts] if f.name == "text" else part.column(2 + i)
                yield record(columns, target)

        return run

    own = [F.lit(None).cast("binary").alias("text") if f.name == "text" else F.col(f"`{f.name}`") for f in kept]
    texts = docs.select(F.col("text").alias("__text"), F.xxhash64("text").alias("__th"), *own)
    fields = [*asked, *found, *carried]
    cut = texts.mapInArrow(cutter(fields), StructType(fields))
    if stage:
        cut = stage(cut)
        needed = cut.select("__th", "__rare")
    else:
        needed = texts.select("__text", "__th").mapInArrow(cutter(asked), StructType(asked))
    # the units a text needs, in their order, depend on the text alone: copies share them. A unit outside the
    # broadcast is rarer than all of those, so a text of many copies asks for few of them.
    needed = needed.select("__th", F.posexplode("__rare").alias("k", "unit"))
    fetched = needed.join(coded.select("unit", "code"), "unit").groupBy("__th").agg(F.array_sort(F.collect_set(F.struct("k", "code"))).alias("__rarer"))

    flag = [StructField(round_trip, BooleanType())] if round_trip else []
    out = StructType([*kept, StructField("ids", ArrayType(IntegerType())), *flag])
    opened = to_arrow_schema(out)

    def numbers(batches):
        open_ = zstandard.ZstdDecompressor().decompress
        decode = _decoder(pieces) if flag else None
        for part in slices(batches, 0, SLICE_BYTES // 4):
            values, counts, same = [], [], []
            for codes, which, told, extra in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), part.column(part.num_columns - 1)):
                if which:
                    mine, lo, runs = extra.values.field("code").to_pylist(), 0, []
                    for at, i in zip((np.flatnonzero(np.frombuffer(codes, dtype=kind) == np.iinfo(kind).max) * kind.itemsize).tolist(), which):
                        runs += (codes[lo:at], mine[i])
                        lo = at + kind.itemsize
                    codes = b"".join([*runs, codes[lo:]])
                values.append(codes)
                counts.append(len(codes) // kind.itemsize)
                if flag:
                    same.append(hashlib.sha256(decode(np.frombuffer(codes, dtype=kind)).encode("utf-8")).digest() == told)
            ids = lists(np.frombuffer(b"".join(values), dtype=kind).astype(np.int32), counts, pa.int32())
            columns = [part.column(3 + i) for i in range(len(kept))]
            columns = [pa.array([None if blob is None else open_(blob).decode("utf-8") for blob in c.to_pylist()], pa.string()) if f.name == "text" else c for c, f in zip(columns, kept)]
            flags = [pa.array(same, pa.bool_())] if flag else []
            yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(columns, opened)), ids.cast(opened.field("ids").type), *flags], schema=opened)

    return cut.drop("__rare").join(fetched, "__th", "left").drop("__th").mapInArrow(numbers, out)


def _decoder(pieces: Pieces):
    """A function from an array of piece numbers to their text."""
    size = max([*pieces.ids, *pieces.byte_ids, pieces.unknown]) + 1
    raw = np.full(size, b" \xe2\x81\x87 ", dtype=object)
    for name, i in zip(pieces.names, pieces.ids):
        raw[i] = name.replace(MARK, " ").encode("utf-8")
    for b, i in enumerate(pieces.byte_ids):
        raw[i] = bytes([b])
    return lambda ids: b"".join(raw[ids].tolist()).removeprefix(b" ").decode("utf-8", "replace")


def decode_column(spark: SparkSession, pieces: Pieces, ids: str = "ids") -> F.Column:
    """The text of an array of piece numbers."""
    shared = spark.sparkContext.broadcast(pieces)

    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        decode = _decoder(shared.value)
        return pa.array([decode(one.values.to_numpy()) if one.is_valid and len(one.values) else "" for one in column], pa.string())

    return text(F.col(ids))


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(docs, pieces)


def digests(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """doc_id, n_pieces, ids_sha256 and round_trip of ``docs`` (doc_id, text), in ``TURNS`` parts: texts and units of one part are on disk at a time."""
    scratch = Scratch(docs.sparkSession, "digests", batch_bytes=SLICE_BYTES)
    attach = encoder(docs, pieces, round_trip="round_trip")
    done = []
    for turn in range(TURNS):
        cut = []
        part = attach(docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(TURNS)) == turn), lambda df: cut.append(scratch.stage(df, "texts")) or cut[0]).select(
            "doc_id",
            F.size("ids").cast("long").alias("n_pieces"),
            F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
            "round_trip",
        )
        done.append(scratch.stage(part, f"part{turn}"))
        scratch.drop(*cut)
    return reduce(DataFrame.union, done)

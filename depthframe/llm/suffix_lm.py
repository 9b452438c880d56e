"""Language-model scores from a probabilistic suffix tree over word tokens.

Training counts every token; contexts then grow one token a pass. A context is a candidate
when it occurs ``context_min`` times, and it is retained when the distribution of its next
symbol differs from that of the shorter context: the log-likelihood gain of its own
distribution has to exceed ``gain_per_symbol`` nats for each of its symbols, where those seen less than
``entry_min`` times after it count as one. Ancestors of a
retained context stay too. Distributions are smoothed by absolute discounting: a state
keeps explicit entries for the symbols seen ``entry_min`` times in it, and what
is left backs off, normalised, to the shorter state, down to the smoothed unigram base. A token
is scored in the longest retained suffix of the tokens before it.

Both minimum counts are absolute, so contexts and entries grow with the corpus. They lie in
staged tables keyed by the hash of an n-gram. With the value log p(x | c) - back(c) - log p(x | parent)
for an entry, a token's log probability is its base value plus, over the suffixes c of what precedes it,
back(c) and the value of the entry (c, x), where either exists: an entry of c is one of its parent too. So
a document's score is a sum over its n-grams, made by an equi-join of its distinct n-grams with the tables.

Scale: four passes over the texts to count and one, in ``SCORE_TURNS`` parts, to score; no text is shuffled. Counts are
combined per task before they are shuffled, with the context of each n-gram, from which and its hash the last symbol
follows. Only what is broadcast has a bound, and no bound changes a result: n-grams with a
share of ``hot_min`` or more are scored where the text is read, and bit maps of at most 2^28 bits keep
most n-grams that cannot be in a table out of a shuffle, whose exact keys then decide. What a part of the texts
brings to the join is on disk for that part only.

Defined results: a null or empty text holds only the end token; a null doc_id counts as
training; equal rows are scored alike, a row each; without training text every token
has probability 1 in the base. Other columns are not read. Tokens and n-grams are told apart by
64-bit hashes.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthframe.llm.common import SLICE_BYTES, SPACED, Scratch, arrow_schema, mix, record, signed, slices, unmix, word_hashes

ADD = 0.1
DISCOUNT = 0.5
DEPTH = 3
HOT_MIN = 2e-6
CONTEXT_MIN = 50
ENTRY_MIN = 2
GAIN_PER_SYMBOL = 1.0
END = np.uint64(0x5E4D5E4D5E4D5E4D)
START = np.uint64(0x3C6F3C6F3C6F3C6F)
_STEP = np.uint64(0x9E3779B97F4A7C15)
MAP_BITS = 28
MAP_PART = 1 << 20
FLUSH = 1 << 20  # keys with one number beside them; fewer of those with more
HANDED = 1 << 16
TOKENS_A_RANGE, MIN_RANGES = 1 << 20, 24  # of the texts, for each range of n-grams that are added up at once
COUNT_BYTES, SCORE_BYTES = 1 << 21, 1 << 20  # of text that a worker holds n-grams of at once
SCORE_TURNS = 2  # the texts are scored in so many parts, one after the other: the n-grams of one part are on disk at a time
VALUES_A_TASK = 1 << 20


class Lookup:
    """Positions of 64-bit keys in an open-addressing table, for whole arrays at once."""

    def __init__(self, keys: np.ndarray):
        keys = keys.astype(np.uint64, copy=False)
        self.bits = max(4, int(np.ceil(np.log2(4 * len(keys) + 1))))
        self.key = np.zeros(1 << self.bits, dtype=np.uint64)
        self.value = np.full(1 << self.bits, -1, dtype=np.int32)
        left, place = np.arange(len(keys)), self._place(keys)
        while len(left):
            free = self.value[place] < 0
            self.value[place[free]] = left[free]
            won = self.value[place] == left
            self.key[place[won]] = keys[left[won]]
            left, place = left[~won], (place[~won] + 1) & ((1 << self.bits) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.uint64, copy=False)
        out = np.full(len(keys), -1, dtype=np.int32)
        left, place, wanted = np.arange(len(keys)), self._place(keys), keys
        while len(left):
            value = self.value[place]
            hit = (value >= 0) & (self.key[place] == wanted)
            out[left[hit]] = value[hit]
            on = (value >= 0) & ~hit
            left, place, wanted = left[on], (place[on] + 1) & ((1 << self.bits) - 1), wanted[on]
        return out


class BitMap:
    """Which keys may be in a set: all that are, and few others while the set is small against the map."""

    def __init__(self, bits: int, held: np.ndarray | None = None):
        self.bits = bits
        self.held = np.zeros(1 << (bits - 3), dtype=np.uint8) if held is None else held

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        spread = mix(keys.astype(np.uint64, copy=False))
        return spread >> np.uint64(64 - self.bits), (spread * _STEP) >> np.uint64(64 - self.bits)

    def add(self, keys: np.ndarray) -> None:
        for at in self._places(keys):
            np.bitwise_or.at(self.held, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def _set(self, at: np.ndarray) -> np.ndarray:
        return (self.held[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        first, second = self._places(keys)
        out = self._set(first)
        out[out] = self._set(second[out])
        return out


def _bit_map(keys: DataFrame) -> BitMap:
    """A map of the only column of ``keys``, 32 bits or more a key up to 2^MAP_BITS bits."""
    bits = int(np.clip(np.ceil(np.log2(32.0 * keys.count() + 1)), 16, MAP_BITS))

    def run(batches):
        part = BitMap(bits)
        for batch in batches:
            part.add(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        for lo in range(0, len(part.held), MAP_PART):
            yield record({"lo": [lo], "held": [part.held[lo : lo + MAP_PART].tobytes()]}, target)

    target = arrow_schema("lo long, held binary")
    out = BitMap(bits)
    for row in keys.coalesce(4).mapInArrow(run, "lo long, held binary").toLocalIterator():
        out.held[row.lo : row.lo + MAP_PART] |= np.frombuffer(row.held, dtype=np.uint8)
    return out


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, and where each key begins in it.

    The keys are sorted by their upper bits with their places in the lower ones; a key between two equal ones with its upper bits
    leaves them apart, which whoever adds up the counts repairs."""
    bits = np.uint64(len(keys).bit_length())
    packed = np.sort(keys >> bits << bits | np.arange(len(keys), dtype=np.uint64))
    order = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    keys = keys[order]
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = keys[1:] != keys[:-1]
    return order, np.flatnonzero(fresh)


class Counter:
    """Counts of 64-bit keys (the first of the columns), combined per task; hands out columns when it holds many."""

    def __init__(self, names: tuple[str, ...]):
        self.names, self.parts, self.held = names, [], 0
        self.limit = 2 * FLUSH // (len(names) + 1)

    def add(self, columns: tuple[np.ndarray, ...]) -> bool:
        order, head = _groups(columns[0])
        self.parts.append((*(c[order[head]] for c in columns), np.diff(np.append(head, len(order)))))
        self.held += len(head)
        if self.held >= 2 * self.limit:
            self._merge()
        return self.held >= self.limit

    def _merge(self) -> None:
        if len(self.parts) > 1:
            *columns, counts = (np.concatenate(c) for c in zip(*self.parts))
            order, head = _groups(columns[0])
            self.parts = [(*(c[order[head]] for c in columns), np.add.reduceat(counts[order], head) if len(head) else counts)]
            self.held = len(head)

    def take(self) -> dict:
        self._merge()
        *columns, counts = self.parts[0] if self.parts else (*(np.zeros(0, np.uint64) for _ in self.names), np.zeros(0, np.int64))
        self.parts, self.held = [], 0
        return {**{name: signed(c.astype(np.uint64)) for name, c in zip(self.names, columns)}, "n": counts.astype(np.int64)}


def _taken(batches, keys_of, names: tuple[str, ...]):
    """Columns of a task's keys and how often they occur, many at a time; ``keys_of`` gives the keys of a column of texts and what goes with them."""
    counter = Counter(names)
    for part in slices(batches, 0, COUNT_BYTES):
        if counter.add(keys_of(part.column(0))):
            counter._merge()
            if counter.held >= counter.limit:
                yield counter.take()
    yield counter.take()


def _counted(docs: DataFrame, keys_of) -> DataFrame:
    """k and n: how often each key occurs."""
    schema = "k long, n long"
    target = arrow_schema(schema)

    def run(batches):
        for columns in _taken(batches, keys_of, ("k",)):
            for lo in range(0, len(columns["n"]), HANDED):
                yield record({name: c[lo : lo + HANDED] for name, c in columns.items()}, target)

    return docs.select("text").mapInArrow(run, schema).groupBy("k").agg(F.sum("n").alias("n"))


def _counted_grams(docs: DataFrame, keys_of, least: float, parts: int) -> DataFrame:
    """(g, c, n, x) of the n-grams g that occur ``least`` times: context, count and last symbol, which follows from g and c.

    The n-grams are dealt by ranges of their hashes, a row for all of a task's n-grams in a range; each range is added up by itself."""
    schema = "part int, g binary, c binary, n binary"
    target = arrow_schema(schema)

    def deal(batches):
        for columns in _taken(batches, keys_of, ("g", "c")):
            part = ((columns["g"].view(np.uint64) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            if not len(part):
                continue
            own = [columns["g"], columns["c"], columns["n"].astype(np.uint32)]
            edge = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])  # they come in the order of their upper bits
            for at in range(0, len(edge) - 1, 64):
                some = list(zip(edge[at : at + 64], edge[at + 1 : at + 65]))
                yield record({"part": part[[lo for lo, _ in some]].astype(np.int32), **{name: [x[lo:hi].tobytes() for lo, hi in some] for name, x in zip("gcn", own)}}, target)

    def add_up(batches):
        blocks = defaultdict(list)
        for batch in batches:
            for part, *block in zip(*(x.to_pylist() for x in batch.columns)):
                blocks[part].append(block)
        while blocks:
            g, c, n = (np.frombuffer(b"".join(x), dtype=kind) for x, kind in zip(zip(*blocks.popitem()[1]), (np.uint64, np.uint64, np.uint32)))
            order = np.argsort(g)
            g = g[order]
            head = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            n = np.add.reduceat(n[order].astype(np.int64), head)
            head, n = head[n >= least], n[n >= least]
            g, c = g[head], c[order[head]]
            x = unmix(g) - c * _STEP
            for lo in range(0, len(g), HANDED):
                yield pa.RecordBatch.from_arrays([pa.array(v[lo : lo + HANDED].view(np.int64)) for v in (g, c, n, x)], names=["g", "c", "n", "x"])

    dealt = docs.select("text").mapInArrow(deal, schema).repartition(max(parts // 2, 1), "part")
    return dealt.mapInArrow(add_up, "g long, c long, n long, x long")


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes with the end token after each text, and token counts."""
    words, counts = word_hashes(texts, SPACED)
    out = np.full(len(words) + len(counts), END, dtype=np.uint64)
    ends = np.cumsum(counts + 1) - 1
    inside = np.ones(len(out), dtype=bool)
    inside[ends] = False
    out[inside] = words
    return out, counts + 1


def _grams(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes of the n-grams of 1 to ``size`` symbols that end at each place of the texts, a start symbol before each
    text; the number of symbols up to each place; the places of the tokens. An n-gram exists where its symbols do."""
    ends = np.cumsum(counts + 1)
    head = ends - counts - 1
    padded = np.full(len(hashes) + len(counts), START, dtype=np.uint64)
    inside = np.ones(len(padded), dtype=bool)
    inside[head] = False
    padded[inside] = hashes
    grams = [padded]
    for _ in range(1, size):
        longer = np.zeros(len(padded), dtype=np.uint64)
        longer[1:] = mix(grams[-1][:-1] * _STEP + padded[1:])
        grams.append(longer)
    return grams, np.arange(len(padded)) - np.repeat(head, counts + 1) + 1, np.flatnonzero(inside)


def _shortened(batches):
    """(g, c, n, s) of (g, c, n, x, b): the n-gram without its oldest symbol is its last symbol x after b."""
    for batch in batches:
        x, b = (batch.column(k).to_numpy().view(np.uint64) for k in (3, 4))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(signed(mix(b * _STEP + x)))], names=["g", "c", "n", "s"])


class Tree:
    """Frequent words, and frequent retained contexts as nodes; node 0 is the empty context."""

    def __init__(self, counts: np.ndarray, contexts: np.ndarray, parents: np.ndarray, depth: int):
        self.counts, self.depth = counts, depth
        self.nodes = Lookup(contexts)
        self.parent = np.append(0, self.nodes.find(parents) + 1).astype(np.int64)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        return hashes

    def states(self, symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Deepest node for each token of texts with ``counts`` tokens."""
        grams, place, at = _grams(symbols, counts, max(self.depth, 1))
        node = np.zeros(len(at), dtype=np.int64)
        for size in range(1, self.depth + 1):
            found = self.nodes.find(grams[size - 1][at - 1])
            step = (place[at - 1] >= size) & (found >= 0)
            node[step] = found[step] + 1
        return node


def train(docs: DataFrame, scratch: Scratch, depth: int = DEPTH, hot_min: float = HOT_MIN, context_min: float = CONTEXT_MIN, entry_min: float = ENTRY_MIN, gain_per_symbol: float = GAIN_PER_SYMBOL):
    """Counts of all tokens of ``docs`` (text) as a staged table (k, n), and the model."""
    spark = docs.sparkSession
    unigrams = scratch.stage(_counted(docs, lambda texts: (_tokens(texts)[0],)), "unigrams")
    total, distinct, n_docs = unigrams.agg(F.sum("n"), F.count("*"), F.max(F.when(F.col("k") == int(END.view(np.int64)), F.col("n")))).first()
    total, n_docs = total or 0, n_docs or 0
    scale = total + ADD * (distinct + 1)
    least = max(entry_min, 1)
    often = F.col("n") >= max(context_min, least)
    start = spark.createDataFrame([(int(START.view(np.int64)), n_docs)], "g long, n long")
    shorter, contexts, tables = unigrams.select(F.col("k").alias("g"), "n"), [], []
    for size in range(1, depth + 1):
        wanted = (shorter.select("g", "n").union(start) if size == 1 else shorter).filter(often)
        if wanted.isEmpty():
            break
        candidates = spark.sparkContext.broadcast(_bit_map(wanted.select("g")))

        def keys(texts, size=size, candidates=candidates):
            grams, place, _ = _grams(*_tokens(texts), size + 1)
            at = np.flatnonzero(place > size)
            at = at[candidates.value.find(grams[size - 1][at - 1])]
            return grams[size][at], grams[size - 1][at - 1]

        # g: the n-gram, seen n times; c: its context; s: the n-gram without its oldest symbol, seen m times
        table = _counted_grams(docs, keys, least, max(int(total) // TOKENS_A_RANGE, MIN_RANGES))
        if size == 1:
            table = table.withColumnRenamed("x", "s")
        else:  # b: the context without its oldest symbol
            table = table.join(wanted.select(F.col("g").alias("c"), F.col("s").alias("b")), "c")
            table = table.select("g", "c", "n", "x", "b").mapInArrow(_shortened, "g long, c long, n long, s long")
        table = table.join(shorter.select(F.col("g").alias("s"), F.col("n").alias("m")), "s")
        table = scratch.stage(table.select("g", "c", "s", "n", "m"), f"grams{size + 1}")
        low = F.col("m") - DISCOUNT if size > 1 else F.col("m") + ADD
        found = table.groupBy("c").agg(
            F.count("*").alias("kinds"),
            F.sum("n").alias("seen"),
            F.sum("m").alias("seen_below"),
            F.sum(F.col("n") * F.log(F.col("n") / F.col("m"))).alias("part"),
            F.sum(F.col("n") - DISCOUNT).alias("own"),
            F.sum(low).alias("low"),
        )
        if size == 1:
            found = found.join(wanted.select(F.col("g").alias("c"), F.col("n").alias("all")), "c")
            found = found.withColumns({"p": F.lit(0).cast("long"), "whole": F.lit(total).cast("long"), "under": F.lit(scale).cast("double")})
        else:
            found = found.join(wanted.select(F.col("g").alias("c"), F.col("s").alias("p"), F.col("n").alias("all")), "c")
            found = found.join(contexts[-1].select(F.col("c").alias("p"), F.col("all").alias("whole")), "p").withColumn("under", F.col("whole").cast("double"))
        floor = lambda x: F.greatest(1 - x, F.lit(1e-300))
        rest, below = F.col("all") - F.col("seen"), F.greatest(F.col("whole") - F.col("seen_below"), F.lit(1))
        gain = F.col("part") + F.when(rest > 0, rest * F.log(rest / below)).otherwise(0.0) + F.col("all") * F.log(F.col("whole") / F.col("all"))
        contexts.append(scratch.stage(found.select(
            "c", "p", "all", "under",
            F.log10(floor(F.col("own") / F.col("all")) / floor(F.col("low") / F.col("under"))).alias("back"),
            (gain > gain_per_symbol * (F.col("kinds") + F.when(rest > 0, 1).otherwise(0))).alias("differs"),
        ), f"contexts{size}"))
        tables.append(table)
        shorter = table
    values, states = [unigrams.select("k", "n", F.log10((F.col("n") + ADD) / F.lit(float(scale))).alias("v"), F.lit(True).alias("word"))], []
    above = None
    for size in range(len(tables), 0, -1):
        kept = contexts[size - 1]
        if above is None:
            kept = kept.filter("differs")
        else:
            kept = kept.join(above.select(F.col("p").alias("c"), F.lit(True).alias("needed")).distinct(), "c", "left").filter("differs or needed")
        above = kept = scratch.stage(kept.select("c", "p", "all", "under", "back", F.lit(size).alias("depth")), f"kept{size}")
        low = F.col("m") - DISCOUNT if size > 1 else F.col("m") + ADD
        entries = tables[size - 1].select("g", "c", "n", "m").join(kept, "c")
        entries = entries.select(F.col("g").alias("k"), "n", (F.log10((F.col("n") - DISCOUNT) / F.col("all")) - F.log10(low / F.col("under")) - F.col("back")).alias("v"), F.lit(False).alias("word"))
        values.append(scratch.stage(entries, f"entries{size}"))
        values.append(kept.select(F.col("c").alias("k"), F.col("all").alias("n"), F.col("back").alias("v"), F.lit(False).alias("word")))
        states.insert(0, kept)
    scratch.drop(*tables, *contexts)
    return unigrams, Model(values, states, total, distinct, hot_min)


class Model:
    """Tables of log10 values of words, entries and back-offs by n-gram; those of frequent n-grams are held here."""

    def __init__(self, values: list[DataFrame], states: list[DataFrame], total: int, distinct: int, hot_min: float):
        self.total, self.distinct = total, distinct
        self.scale = total + ADD * (distinct + 1)
        self.size = len(states) + 1
        hot = F.col("n") >= hot_min * max(total, 1)
        start = int(START.view(np.int64))
        keys = lambda column: column.to_numpy().view(np.uint64)
        words = values[0].filter(hot).toArrow()
        self.words = Lookup(keys(words.column("k")))
        counts = words.column("n").to_numpy()
        self.base = np.log10((counts + ADD) / self.scale)
        held = [s.filter((F.col("all") >= hot_min * max(total, 1)) | (F.col("c") == start)).toArrow() for s in states]
        column = lambda name: np.concatenate([t.column(name).to_numpy() for t in held]) if held else np.zeros(0, np.int64)
        self.tree = Tree(counts, column("c").view(np.uint64), column("p").view(np.uint64), max([i + 1 for i, t in enumerate(held) if len(t)], default=0))
        self.back = np.append(0.0, column("back"))
        entries = [v.filter(hot).toArrow() for v in values[1::2]]
        entry_keys = np.concatenate([np.zeros(0, np.uint64), *(keys(t.column("k")) for t in entries)])
        self.explicit = np.concatenate([np.zeros(0), *(t.column("v").to_numpy() for t in entries)])
        # what workers look up: a word's back-off is beside the word; longer n-grams have a value and a back-off, either may be 0
        nodes = column("c").view(np.uint64)
        self.word_back = np.append(0.0, column("back"))[self.tree.nodes.find(keys(words.column("k"))) + 1]
        self.start_back = self.back[self.tree.nodes.find(np.array([START]))[0] + 1]
        longer = np.unique(np.concatenate([entry_keys, nodes]))
        self.longer = Lookup(longer)
        self.value, self.after = np.zeros(len(longer)), np.zeros(len(longer))
        self.value[np.searchsorted(longer, entry_keys)] = self.explicit
        self.after[np.searchsorted(longer, nodes)] = column("back")
        self.values = values[0]
        for other in values[1:]:
            self.values = self.values.union(other)
        # the start symbol is always held
        cold = self.values.filter(~hot & ~F.col("word") & (F.col("k") != start)).select("k")
        self.rare = _bit_map(cold)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("values", "tree", "back", "explicit")}

    def _parts(self, hashes: np.ndarray, counts: np.ndarray):
        """As ``score``, and the n-grams whose values are in the tables only: text number and key of the words, and of the others.

        An n-gram is in the tables only where it is without its oldest symbol, from three symbols on."""
        grams, place, at = _grams(hashes, counts, self.size)
        text = np.repeat(np.arange(len(counts)), counts + 1)
        out, unigram, hot = np.zeros(len(place) + 1), np.zeros(len(place)), np.zeros(len(place), dtype=bool)
        found = self.words.find(hashes)
        known, word = at[found >= 0], found[found >= 0]
        hot[known] = True
        unigram[known] = self.base[word]
        out[:-1] += unigram
        out[known + 1] += self.word_back[word]
        out[np.flatnonzero(place == 1) + 1] += self.start_back
        # a rare word brings its back-off along with its count
        rest = [(text[at[found < 0]], hashes[found < 0])]
        where = np.arange(len(place))
        for size in range(2, self.size + 1):
            where = where[place[where] >= size]
            key = grams[size - 1][where]
            found = self.longer.find(key)
            inside = found >= 0
            out[where[inside]] += self.value[found[inside]]
            out[where[inside] + 1] += self.after[found[inside]]
            left = np.flatnonzero(~inside)
            left = left[self.rare.find(key[left])]
            rest.append((text[where[left]], key[left]))
            inside[left] = True
            where = where[inside]
        return out[:-1][at], unigram[at], hot[at], rest

    def score(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 probability of each token, its unigram part, and whether it is frequent; of rarer n-grams without their part."""
        return self._parts(hashes, counts)[:3]


def score(docs: DataFrame, unigrams: DataFrame, model: Model, scratch: Scratch) -> DataFrame:
    """Per row of ``docs`` (doc_id, held_out, text): doc_id, held_out, n_tokens, n_known, base_score, score."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    facts = "doc_id: long, held_out: boolean, n_tokens: long, n_known: long, base: double, score: double"
    schema = f"uid long, k long, m int, doc struct<{facts}>"
    target = arrow_schema(schema)

    def run(batches):
        from pyspark import TaskContext

        kind = target.field("doc").type
        uid = TaskContext.get().partitionId() << 40
        for part in slices(batches, 2, SCORE_BYTES):
            hashes, counts = _tokens(part.column(2))
            value, unigram, hot, rest = shared.value._parts(hashes, counts)
            starts = np.cumsum(counts) - counts
            per_doc = lambda x: np.add.reduceat(x, starts)  # noqa: E731  every text has its end token
            own = [part.column(0), part.column(1), pa.array(counts), pa.array(per_doc(hot.astype(np.int64))), pa.array(per_doc(unigram)), pa.array(per_doc(value))]
            uids = uid + np.arange(len(counts))
            doc = pa.StructArray.from_arrays([x.cast(f.type) for x, f in zip(own, kind)], fields=list(kind))
            # a key of its own, which no table holds, so that the texts are dealt evenly
            yield record({"uid": uids, "k": signed(mix(uids.astype(np.uint64))), "m": np.zeros(len(counts), np.int32), "doc": doc}, target)
            at, rare = (np.concatenate(x) for x in zip(*rest))
            order = np.argsort((at.astype(np.uint64) << np.uint64(48)) ^ (rare >> np.uint64(16)))
            at, rare, word = at[order], rare[order], order < len(rest[0][0])
            fresh = np.ones(len(at), dtype=bool)
            fresh[1:] = (at[1:] != at[:-1]) | (rare[1:] != rare[:-1]) | (word[1:] != word[:-1])
            head = np.flatnonzero(fresh)
            times = np.diff(np.append(head, len(at))) * np.where(word[head], 1, -1)  # below 0: not a word
            for lo in range(0, len(head), HANDED):
                some = head[lo : lo + HANDED]
                yield record({"uid": uids[at[some]], "k": signed(rare[some]), "m": times[lo : lo + HANDED].astype(np.int32), "doc": pa.nulls(len(some), kind)}, target)
            uid += len(counts)

    values = model.values.select("k", "v", "word")
    # the tables are the built side of the join, a bounded part a task
    tasks = values.count() // VALUES_A_TASK + 1
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        values = values.repartition(tasks, "k")
    unseen = float(np.log10(ADD / model.scale))
    is_word = (F.col("m") > 0) & F.coalesce("word", F.lit(True))
    part = F.when(is_word, F.col("m") * F.coalesce("v", F.lit(unseen))).otherwise(0.0)
    more = F.when(~F.col("word"), F.abs("m") * F.col("v")).otherwise(0.0)
    done = []
    for turn in range(SCORE_TURNS):
        some = docs.select("doc_id", "held_out", "text").filter(F.pmod(F.xxhash64("doc_id"), F.lit(SCORE_TURNS)) == turn)
        found = some.mapInArrow(run, schema).join(values.hint("shuffle_hash"), "k", "left")
        out = found.groupBy("uid").agg(
            F.max("doc.doc_id").alias("doc_id"),
            F.max("doc.held_out").alias("held_out"),
            F.sum("doc.n_tokens").alias("n_tokens"),
            F.sum(F.coalesce("doc.n_known", F.when((F.col("m") > 0) & F.col("word"), F.col("m")).otherwise(0))).cast("long").alias("n_known"),
            F.sum(F.coalesce("doc.base", part)).alias("base_score"),
            F.sum(F.coalesce("doc.score", part + more)).alias("score"),
        )
        done.append(scratch.stage(out.drop("uid"), f"scored{turn}"))
    out = done[0]
    for other in done[1:]:
        out = out.union(other)
    return out


def op9_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 10
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), "text")
    scratch = Scratch(spark, "suffix", batch_bytes=SLICE_BYTES)
    unigrams, model = train(docs.filter(~F.col("held_out")), scratch)
    return score(docs, unigrams, model, scratch).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")



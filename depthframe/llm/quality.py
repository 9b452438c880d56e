"""Quality classifier: a generalised additive model with pairwise interactions.

Features are shares and counts of a whole text. Every feature is cut into quantile bins; cyclic
boosting takes the features in turn, grows one shallow tree over a feature's bins against the
present gradient and adds it to the feature's lookup table. Then the pairs of features whose
coarse grids explain most of what is left get tables of their own, boosted the same way with
one cut a side. A score is a sum of looked-up bins, taken for whole batches.

Fitting uses at most ``max_rows`` labelled rows (a documented bound; those with the smallest
hash of doc_id), whose features are gathered; everything else is row-wise over all texts, without
a shuffle.

Defined results: null and empty texts have features of their own and a score like any text; rows
without doc_id are never fitted on; a doc_id with several labels is of quality 1 if one of them
is; without labels every score is 0.5. Extra columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthframe.llm.common import SPACED, arrow_schema, record, slices, text_bytes, word_hashes

MAX_ROWS = 20_000
BINS = 48
ROUNDS = 150
PAIRS = 8
PAIR_ROUNDS = 60
PAIR_BINS = 12
RATE = 0.1
SHRINK = 5.0
THRESHOLD = 0.7

#: Byte classes: 0 other, 1 a-z, 2 A-Z, 3 digit, 4 blank, 5 line end, 6 marks, 7 sentence ends, 8 bars, 9 brackets and quotes, 10 exclamation, 11 first byte of a longer character, 12 its other bytes.
_CLASS = np.zeros(256, dtype=np.int64)
for _n, _chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", "#$%&*@^~+=_<>\\", ".,;:?", "|", "()[]{}\"'`", "!"), 1):
    _CLASS[[ord(c) for c in _chars]] = _n
_CLASS[0xC0:] = 11
_CLASS[0x80:0xC0] = 12
_CLASSES = 13
NAMES = (
    "log_bytes", "log_words", "log_lines", "other", "lower", "upper", "digit", "blank", "line_end", "marks", "stops", "bars", "quotes", "exclaim", "wide",
    "word_length", "distinct_words", "top_word", "same_as_before", "distinct_pairs", "pair_repeats", "words_a_line",
)


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``NAMES`` per text."""
    data, offsets = text_bytes(texts)
    n = len(offsets) - 1
    doc_of = np.repeat(np.arange(n), np.diff(offsets))
    kinds = np.bincount(doc_of * _CLASSES + _CLASS[data], minlength=n * _CLASSES).reshape(n, _CLASSES).astype(float)
    size = np.diff(offsets).astype(float)
    chars = np.maximum(size - kinds[:, 12], 1)
    hashes, counts = word_hashes(texts, SPACED)
    doc = np.repeat(np.arange(n), counts)
    words = np.maximum(counts, 1).astype(float)
    distinct, top = _repeats(doc, hashes, n)
    inner = np.zeros(len(doc), dtype=bool)
    inner[1:] = doc[1:] == doc[:-1]
    same = np.bincount(doc[inner & (hashes == np.roll(hashes, 1))], minlength=n)
    pairs = (hashes * np.uint64(0x9E3779B97F4A7C15) + np.roll(hashes, 1))[inner]
    pair_kinds, pair_top = _repeats(doc[inner], pairs, n)
    n_pairs = np.maximum(counts - 1, 1).astype(float)
    lines = kinds[:, 5] + 1
    return np.column_stack([
        np.log1p(size), np.log1p(counts), np.log(lines), *(kinds[:, k] / chars for k in range(12)),
        (chars - kinds[:, 4] - kinds[:, 5]) / words, distinct / words, top / words, same / words, pair_kinds / n_pairs, pair_top / n_pairs, np.log1p(counts / lines),
    ])


def _repeats(doc: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: distinct keys and the count of the most frequent one."""
    order = np.lexsort((keys, doc))
    doc, keys = doc[order], keys[order]
    head = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (keys[1:] != keys[:-1])])) if len(doc) else np.zeros(0, np.int64)
    runs = np.diff(np.append(head, len(doc)))
    top = np.zeros(n)
    np.maximum.at(top, doc[head], runs)
    return np.bincount(doc[head], minlength=n).astype(float), top


class Additive:
    """Intercept, one table per feature and one per chosen pair."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.cuts = [np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS)) if len(x) else np.zeros(0) for f in range(len(NAMES))]
        self.coarse = [np.unique(np.quantile(x[:, f], np.arange(1, PAIR_BINS) / PAIR_BINS)) if len(x) else np.zeros(0) for f in range(len(NAMES))]
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        self.pairs: list[tuple[int, int]] = []
        self.grids: list[np.ndarray] = []
        share = (y.sum() + 0.5) / (len(y) + 1)
        self.intercept = float(np.log(share / (1 - share))) if len(y) else 0.0
        if 0 < y.sum() < len(y):
            self._fit(x, y.astype(float))

    def _bins(self, x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(cuts)])

    def _fit(self, x: np.ndarray, y: np.ndarray) -> None:
        fine, coarse = self._bins(x, self.cuts), self._bins(x, self.coarse)
        total = np.full(len(y), self.intercept)

        def gradient():
            p = 1 / (1 + np.exp(-total))
            return y - p, p * (1 - p)

        for _ in range(ROUNDS):
            for f, table in enumerate(self.tables):
                g, h = gradient()
                step = RATE * _tree(np.bincount(fine[:, f], g, len(table)), np.bincount(fine[:, f], h, len(table)), 2)
                table += step
                total += step[fine[:, f]]
        g, h = gradient()
        gains = [(_corner(*_grid(coarse, a, b, g, h, self.coarse))[0], a, b) for a, b in combinations(range(len(NAMES)), 2)]
        self.pairs = [(a, b) for gain, a, b in sorted(gains, reverse=True)[:PAIRS] if gain > 0]
        self.grids = [np.zeros((len(self.coarse[a]) + 1, len(self.coarse[b]) + 1)) for a, b in self.pairs]
        for _ in range(PAIR_ROUNDS):
            for (a, b), grid in zip(self.pairs, self.grids):
                g, h = gradient()
                step = RATE * _corner(*_grid(coarse, a, b, g, h, self.coarse))[1]
                grid += step
                total += step[coarse[:, a], coarse[:, b]]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            total += table[np.searchsorted(cuts, x[:, f], side="right")]
        for (a, b), grid in zip(self.pairs, self.grids):
            total += grid[np.searchsorted(self.coarse[a], x[:, a], side="right"), np.searchsorted(self.coarse[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def _tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Leaf values over the bins of a tree of ``depth``, by greatest gain of the Newton step."""
    out = np.full(len(g), g.sum() / (h.sum() + SHRINK))
    if depth and len(g) > 1:
        gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = gl**2 / (hl + SHRINK) + (g.sum() - gl) ** 2 / (h.sum() - hl + SHRINK)
        cut = int(np.argmax(gain)) + 1
        out[:cut], out[cut:] = _tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)
    return out


def _grid(bins: np.ndarray, a: int, b: int, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    shape = len(cuts[a]) + 1, len(cuts[b]) + 1
    flat = bins[:, a] * shape[1] + bins[:, b]
    return np.bincount(flat, g, shape[0] * shape[1]).reshape(shape), np.bincount(flat, h, shape[0] * shape[1]).reshape(shape)


def _corner(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of both sides into four quarters: its gain over no cut, and the quarters' values."""
    if g.shape[0] < 2 or g.shape[1] < 2:
        return 0.0, np.zeros(g.shape)

    def quarters(m):
        c = m.cumsum(0).cumsum(1)
        low, left, top, all_ = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        return low, left - low, top - low, all_ - left - top + low

    gain = sum(gq**2 / (hq + SHRINK) for gq, hq in zip(quarters(g), quarters(h)))
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    values = [gq[i, j] / (hq[i, j] + SHRINK) for gq, hq in zip(quarters(g), quarters(h))]
    out = np.empty(g.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = values
    return float(gain[i, j] - g.sum() ** 2 / (h.sum() + SHRINK)), out


def held_out(doc_id) -> F.Column:
    """Rows that are never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Additive:
    """Learn from at most ``max_rows`` labelled documents that are not held out."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out("doc_id"))
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max("quality").alias("quality"))
    chosen = F.broadcast(usable.orderBy(F.xxhash64("label_id"), "label_id").limit(max_rows))
    rows = docs.select(F.col("doc_id").cast("long").alias("label_id"), "text").join(chosen, "label_id").select("quality", "text", "label_id")
    schema = "label_id long, quality int, x array<double>"
    target = arrow_schema(schema)

    def run(batches):
        for part in slices(batches, 1):
            yield record({"label_id": part.column(2), "quality": part.column(0), "x": list(features(part.column(1)))}, target)

    held = rows.mapInArrow(run, schema).groupBy("label_id").agg(F.first("quality").alias("quality"), F.first("x").alias("x")).orderBy("label_id").toArrow()
    x = np.array(held.column("x").to_pylist(), dtype=float).reshape(held.num_rows, len(NAMES))
    return Additive(x, held.column("quality").to_numpy() if held.num_rows else np.zeros(0))


def score_column(docs: DataFrame, model: Additive, text: str = "text") -> F.Column:
    """The model's probability of quality 1 as a column over a text column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def quality(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        parts = [shared.value.score(features(p.column(0))) for p in slices([batch], 0)]
        return pa.array(np.concatenate([*parts, np.zeros(0)]), pa.float64())

    return quality(F.col(text))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts."""
    scored = docs.withColumn("__score", score_column(docs, fit(docs, labels)))
    return scored.filter(F.col("__score") >= threshold).drop("__score")


def op3_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = docs.select("doc_id", held_out("doc_id").alias("held_out"), score_column(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

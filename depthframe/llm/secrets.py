"""Secret scans: fixed patterns, and a battery of randomness tests under false-discovery control.

Base kinds are patterns: assignments, access keys and hexadecimal runs. The battery looks at
every other run of 20 or more token characters, whatever its symbols. It infers the encoding (the
smallest alphabet that holds the run), and tests the symbols for being drawn uniformly: chi-squared over
the alphabet, runs above and below its middle, and lag-one serial correlation. The smallest of the three
p-values, times three, is the run's p-value.

What natural runs look like is learnt from the corpus: its distinct words and numbers, all shorter than
a run, are put together to runs (digits, letters of one case, letters of two cases, letters with digits or
signs) of each length class, and take the same tests. Among the distinct runs of a group and class, the
clearly non-random ones tell how many are natural; that number times the share of composed runs with a
p-value at or above a cut estimates the false discoveries at that cut. The lowest cut that keeps them at
or below ``rate`` is used, so short runs, which tests cannot tell apart, need better p-values than long
ones, or are not reported. A run counts once however often it is repeated, and no key is a part of the
composed runs, so a source full of keys does not move the cuts of others.

Scale: one pass over the texts and one over the spans; where there are runs to judge, another pass
collects the distinct words, which are dealt to buckets of about ``BUCKET_WORDS`` and composed there. No
text is shuffled; only a few hundred counts reach the driver.

Defined results: a null text is empty; equal rows give equal results; places are code points,
ends exclusive; a run inside a base span is not reported again; a run with fewer than 20
characters before its closing = signs (an underlined heading) is no candidate; where there is no composed run
to compare with, nothing is added; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from depthframe.llm.common import Scratch, arrow_schema, record, slices

KINDS = ("assign", "access", "hex", "random")
MIN_RUN = 20
RATE = 0.05
BINS = 14
CLASSES = 9  # the last holds runs of 320 characters or more
GROUPS = 4  # digits, letters of one case, letters of two cases, letters with digits or signs
BUCKET_WORDS = 16_384
LEAST_RUNS = 128
HELD_WORDS = 500_000

#: Fixed patterns of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
_RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_RUN},}}")
_PART = re.compile(r"[A-Za-z]+|[0-9]+")
_WORDS = ("passw", "secret", "token", "apikey", "api_key")

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings, smallest alphabet first.
ALPHABETS = (
    _DIGITS, _DIGITS + "abcdef", _DIGITS + "ABCDEF", _LOWER, _UPPER, _UPPER + "234567", _DIGITS + _LOWER, _DIGITS + _UPPER,
    _LOWER + _UPPER, _UPPER + _LOWER + _DIGITS, _UPPER + _LOWER + _DIGITS + "+/", _UPPER + _LOWER + _DIGITS + "-_", _UPPER + _LOWER + _DIGITS + "+/-_",
)
_SYMBOL = np.full((len(ALPHABETS), 256), -1, dtype=np.int64)
for _row, _letters in zip(_SYMBOL, ALPHABETS):
    _row[[ord(c) for c in _letters]] = np.arange(len(_letters))
_SIZES = np.array([len(a) for a in ALPHABETS])


def _upper_tail(z: np.ndarray) -> np.ndarray:
    """P(Z > z) of a standard normal, to 1e-7 (a rational approximation, formula 26.2.17 of Abramowitz and Stegun)."""
    t = 1 / (1 + 0.2316419 * np.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = np.exp(-np.minimum(z * z, 1400) / 2) / np.sqrt(2 * np.pi) * poly
    return np.where(z >= 0, tail, 1 - tail)


def battery(runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Index of each run's encoding and its p-value under uniform random symbols; 1 for fewer than three symbols."""
    if not runs:
        return np.zeros(0, np.int64), np.zeros(0)
    cores = [(r.rstrip("=") or r).replace("=", "_").encode() for r in runs]
    size = np.array([len(c) for c in cores], dtype=np.int64)
    data = np.frombuffer(b"".join(cores), dtype=np.uint8)
    starts = np.cumsum(size) - size
    encoding = np.full(len(runs), -1)
    for a in range(len(ALPHABETS)):
        fits = np.minimum.reduceat(_SYMBOL[a][data], starts) >= 0
        encoding[(encoding < 0) & fits] = a
    run_of = np.repeat(np.arange(len(runs)), size)
    symbol = _SYMBOL[encoding[run_of], data]
    k, n = _SIZES[encoding].astype(float), np.maximum(size, 3).astype(float)
    add = lambda x: np.add.reduceat(x, starts)

    counts = np.bincount(run_of * 80 + symbol, minlength=80 * len(runs)).reshape(-1, 80)
    chi = (counts.astype(float) ** 2).sum(axis=1) * k / n - n
    chi_p = _upper_tail((chi - (k - 1)) / np.sqrt(2 * (k - 1) * (1 - 1 / n)))

    high = symbol >= (k / 2)[run_of]
    up = add(high.astype(float))
    down = n - up
    inner = np.ones(len(data), dtype=bool)
    inner[starts] = False
    change = np.zeros(len(data))
    change[1:] = high[1:] != high[:-1]
    seen = add(change * inner) + 1
    expected = 2 * up * down / n + 1
    spread = np.sqrt(np.maximum((expected - 1) * (expected - 2) / (n - 1), 1e-9))
    flat = np.minimum(up, down) < 2
    runs_p = np.where(flat, 2.0 ** (2 - n), 2 * _upper_tail(np.abs(seen - expected) / spread))

    mean = add(symbol.astype(float)) / n
    off = symbol - mean[run_of]
    lag = np.zeros(len(data))
    lag[1:] = off[1:] * off[:-1]
    power = add(off**2)
    serial = np.where(power > 0, add(lag * inner) / np.maximum(power, 1e-9), 1.0)
    serial_p = 2 * _upper_tail(np.abs(serial + 1 / n) * np.sqrt(n))
    p = np.clip(3 * np.minimum(np.minimum(chi_p, runs_p), serial_p), 1e-12, 1)
    return encoding, np.where(size < 3, 1.0, p)


def p_bin(p: np.ndarray) -> np.ndarray:
    """0 for the largest p-values; the last bin holds those below 1e-3."""
    return np.minimum(np.floor(-4 * np.log10(p)), BINS - 1).astype(np.int64)


def length_class(n: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(2 * np.log2(n / MIN_RUN) + 1e-9), 0, CLASSES - 1).astype(np.int64)


#: The shortest length of each class.
LENGTHS = [int(np.ceil(MIN_RUN * 2 ** (c / 2) - 1e-9)) for c in range(CLASSES)]


def group_of(encoding: np.ndarray) -> np.ndarray:
    """Which composed runs an encoding is compared with."""
    kinds = [0 if set(a) <= set(_DIGITS) else 1 if a in (_LOWER, _UPPER) else 2 if a == _LOWER + _UPPER else 3 for a in ALPHABETS]
    return np.array(kinds)[encoding]


def codes(runs: list[str]) -> np.ndarray:
    """(group, length class, p-value bin) of each run, as one number."""
    encoding, p = battery(runs)
    size = np.array([len(r.rstrip("=")) for r in runs], dtype=np.int64)
    return (group_of(encoding) * CLASSES + length_class(np.maximum(size, MIN_RUN))) * BINS + p_bin(p)


def base_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns; ``runs`` are the token runs of the text."""
    out = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    for lo, hi in runs:
        if hi - lo >= HEX_MIN:
            out += [(m.start(), 2, m.end()) for m in HEX.finditer(text, lo, hi)]
    return sorted(out)


def _scan(docs: DataFrame) -> DataFrame:
    schema = "doc_id long, starts array<int>, kinds array<int>, ends array<int>, run_starts array<int>, run_ends array<int>, run_codes array<int>, run_keys array<long>"
    target = arrow_schema(schema)

    def run(batches):
        for part in slices(batches, 1, 1 << 21):
            out = {n: [] for n in target.names[1:]}
            found, owner = [], []
            for i, text in enumerate(part.column(1).to_pylist()):
                runs = [m.span() for m in _RUN.finditer(text)]
                base = base_spans(text, runs)
                for name, at in (("starts", 0), ("kinds", 1), ("ends", 2)):
                    out[name].append([b[at] for b in base])
                covered = [b for b in base if b[2] - b[0] >= MIN_RUN or b[1] == 0]
                for lo, hi in runs:
                    token = text[lo:hi]
                    if len(token.rstrip("=")) >= MIN_RUN and not any(s <= lo and hi <= e for s, _, e in covered):
                        found.append((lo, hi, token))
                        owner.append(i)
            for name in ("run_starts", "run_ends", "run_codes", "run_keys"):
                out[name] = [[] for _ in range(part.num_rows)]
            for i, (lo, hi, token), code in zip(owner, found, codes([f[2] for f in found]).tolist()):
                key = xxhash.xxh64_intdigest(token.encode()) - (1 << 63)
                for name, value in (("run_starts", lo), ("run_ends", hi), ("run_codes", code), ("run_keys", key)):
                    out[name][i].append(value)
            yield record({"doc_id": part.column(0), **out}, target)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)


# ---------------------------------------------------------------- natural runs


def _parts(docs: DataFrame) -> DataFrame:
    """The distinct words and numbers (part) of all texts outside runs, lower-cased."""
    schema = "part string"
    target = arrow_schema(schema)

    def run(batches):
        held: set[str] = set()
        for batch in slices(batches, 0, 1 << 21):
            for text in batch.column(0).to_pylist():
                held.update(_PART.findall(_RUN.sub(" ", text).lower()))
                if len(held) > HELD_WORDS:
                    yield record({"part": [w for w in held if len(w) < MIN_RUN]}, target)
                    held = set()
        yield record({"part": [w for w in held if len(w) < MIN_RUN]}, target)

    return docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema).distinct()


def composed(words: list[str], group: int, length: int) -> list[str]:
    """Runs of ``length`` characters made of ``words``: each is used once, then all again in other orders up to ``LEAST_RUNS`` runs."""
    out, run, turn = [], "", 0
    while words and (turn == 0 or len(out) < LEAST_RUNS):
        for word in words if turn == 0 else sorted(words, key=lambda w: xxhash.xxh64_intdigest(w.encode(), seed=turn)):
            if group < 2:
                run += word
            elif group == 2:
                run += word.capitalize()
            else:
                run += (f"{word}_", f"{word}-", f"{word.capitalize()}{len(word)}", f"{word}/")[len(out) % 4]
            if len(run) >= length:
                out.append(run[:length])
                run = ""
        turn += 1
    return out


def _natural(parts: DataFrame, wanted: list[tuple[int, int]], n_parts: int) -> dict[int, int]:
    """How many composed runs have each code, for the (group, class) pairs in ``wanted``."""
    schema = "code int, n long"
    target = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for held in batch.column(0):
                held = [w["part"] for w in held.as_py()]
                numbers, words = [w for w in held if w.isdigit()], [w for w in held if not w.isdigit()]
                for group, size in wanted:
                    runs = composed(words if group else numbers, group, LENGTHS[size])
                    # a composed run stands for its group, whatever smaller alphabet would hold it
                    bins = np.bincount(p_bin(battery(runs)[1]), minlength=BINS)
                    yield record({"code": [(group * CLASSES + size) * BINS + b for b in range(BINS)], "n": bins.tolist()}, target)

    buckets = max(1, round(n_parts / BUCKET_WORDS))
    place = F.xxhash64("part")
    dealt = parts.groupBy(F.pmod(place, F.lit(buckets)).alias("bucket")).agg(F.array_sort(F.collect_list(F.struct(place.alias("place"), "part"))).alias("held"))
    return {r.code: r.n for r in dealt.select("held").mapInArrow(run, schema).groupBy("code").agg(F.sum("n").alias("n")).collect()}


def cuts(seen: dict[int, int], natural: dict[int, int], rate: float) -> list[int]:
    """For each group and length class the last p-value bin that is reported, or -1."""
    held, null = np.zeros((GROUPS * CLASSES, BINS)), np.zeros((GROUPS * CLASSES, BINS))
    for table, counts in ((held, seen), (null, natural)):
        for code, n in counts.items():
            table[code // BINS, code % BINS] = n
    out = []
    for found, like in zip(held, null):
        scale = (found[-1] + 1) / (like[-1] + 1)
        false, all_ = np.cumsum(like)[:-1] * scale, np.cumsum(found)[:-1]
        fine = np.flatnonzero((all_ > 0) & (false <= rate * all_) & (like.sum() > 0))
        out.append(int(fine[-1]) if len(fine) else -1)
    return out


def scan_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, base and spans, arrays of (start, kind, end) with kinds numbered as in ``KINDS``."""
    scratch = Scratch(docs.sparkSession, "secrets")
    scanned = scratch.stage(_scan(docs), "scanned")
    runs = scanned.select(F.explode(F.arrays_zip("run_codes", "run_keys")).alias("r")).select("r.*").distinct()
    seen = {r.run_codes: r["count"] for r in runs.groupBy("run_codes").count().collect()}
    natural: dict[int, int] = {}
    if seen:
        words = Observation("words")
        parts = scratch.stage(_parts(docs).observe(words, F.count("*").alias("n")), "parts")
        natural = _natural(parts, sorted({divmod(code // BINS, CLASSES) for code in seen}), words.get["n"] or 0)
    limit = F.array(*(F.lit(c) for c in cuts(seen, natural, rate)))
    base = F.expr("transform(arrays_zip(starts, kinds, ends), x -> named_struct('start', x.starts, 'kind', x.kinds, 'end', x.ends))")
    judged = F.arrays_zip("run_starts", "run_ends", "run_codes")
    random = F.transform(
        F.filter(judged, lambda x: x["run_codes"] % BINS <= F.element_at(limit, (F.floor(x["run_codes"] / BINS) + 1).cast("int"))),
        lambda x: F.struct(x["run_starts"].alias("start"), F.lit(len(KINDS) - 1).alias("kind"), x["run_ends"].alias("end")),
    )
    return scanned.select("doc_id", base.alias("base"), F.array_sort(F.concat(base, random)).alias("spans"))


def _written(spans: str) -> F.Column:
    kind = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kind, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op7_secrets(spark, sf_dir: str) -> DataFrame:
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    # not a lambda with k as a default: Spark fills a second parameter with the place in the array
    held = [F.size(F.expr(f"filter(base, s -> s.kind = {k})")).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)]
    return found.select("doc_id", *held, F.sha2(_written("base"), 256).alias("base_sha256"), _written("spans").alias("spans"))


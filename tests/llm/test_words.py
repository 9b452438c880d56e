import random
import re

import numpy as np
import pyarrow as pa

from depthframe.llm.common import ALNUM, SCAN_BYTES, SPACED, slices, word_hashes
from depthframe.llm.suffix_lm import Lookup

TEXTS = ["", None, "  a b  A\tB", "é-é Ünï x9_x9", "a" * (SCAN_BYTES + 77) + " z", "\x1c x\x0b", "one" * 3, "-- --", "ß" * 10 + "ß", " ".join("w%d" % (i % 900) for i in range(90_000))]
PATTERNS = ((SPACED, re.compile(r"[^\x20\x09-\x0D]+")), (ALNUM, re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")))


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def test_words_are_those_of_the_pattern():
    for member, pattern in PATTERNS:
        hashes, counts = word_hashes(pa.array(TEXTS), member)
        want = [pattern.findall(lowered(t)) for t in TEXTS]
        assert counts.tolist() == [len(w) for w in want]
        flat = [w for ws in want for w in ws]
        seen = {}
        for h, w in zip(hashes.tolist(), flat):
            assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)


def test_a_slice_of_a_column_hashes_alike():
    whole, counts = word_hashes(pa.array(TEXTS))
    part, _ = word_hashes(pa.array(TEXTS).slice(2, 3))
    lo = int(counts[:2].sum())
    assert part.tolist() == whole[lo : lo + len(part)].tolist()


def test_slices_keep_every_row():
    batch = pa.RecordBatch.from_pydict({"t": pa.array(TEXTS)})
    parts = list(slices([batch], 0, 100))
    assert [x for p in parts for x in p.column(0).to_pylist()] == TEXTS and len(parts) > 2


def test_lookup_finds_just_its_keys():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 60, 5000, dtype=np.uint64))
    table = Lookup(keys)
    assert table.find(keys).tolist() == list(range(len(keys)))
    assert (table.find(keys + np.uint64(1 << 61)) == -1).all()
    assert Lookup(np.zeros(0, np.uint64)).find(keys[:3]).tolist() == [-1, -1, -1]
    random.seed(0)

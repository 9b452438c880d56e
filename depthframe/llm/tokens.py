"""Token counts with overlap resynchronisation for huge documents.

Ordinary documents are encoded whole. A huge document is cut into chunks that overlap; every
chunk is encoded with offsets in a row of its own, and two neighbours are spliced at a boundary
that both encodings share and that is proven stable: the character before it is ASCII white
space, which this kind of tokenizer always drops between words, so no token and no added
token can span it and what follows is encoded as at the start of a text. When an overlap holds
no such boundary, it is doubled and the document's chunks are encoded again, until all
neighbours align or one chunk holds the whole text.

White space that separates words lets equal words be counted once: a worker keeps the token
count of words it has seen (``CACHE_WORDS`` at most), and asks the library only for new ones.

Scale: no shuffle for ordinary documents; a chunk of a huge one is a row of bounded size that
any task can take. Splicing joins neighbours on (document, chunk number) and sums per document.

Defined results: a null text is empty and has 0 bytes and 0 tokens; repeated rows and null ids
give a row each; other columns are not read.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthframe.llm.common import Scratch, arrow_schema, record, slices

LIMIT = 2048
HUGE_CHARS = 65_536
CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
CACHE_WORDS = 1 << 19

_GAP = re.compile(r"[ \t\n\r\x0b\x0c]")
_WORD = re.compile(r"[^ \t\n\r\x0b\x0c]+")
_STATE: dict = {}


def tokenizer(path: str):
    """The library's tokenizer, one per worker, with one thread."""
    if _STATE.get("path") != path:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        own.no_truncation()
        own.no_padding()
        _STATE.update(path=path, own=own, cache={})
    return _STATE["own"]


def count_words(path: str, words: list[str]) -> np.ndarray:
    """Token counts of words without white space."""
    own = tokenizer(path)
    cache = _STATE["cache"]
    fresh = [w for w in dict.fromkeys(words) if w not in cache]
    if len(cache) + len(fresh) > CACHE_WORDS:
        cache.clear()
        fresh = list(dict.fromkeys(words))
    for lo in range(0, len(fresh), 4096):
        part = fresh[lo : lo + 4096]
        cache.update(zip(part, (len(e) for e in own.encode_batch_fast(part, add_special_tokens=False))))
    return np.fromiter((cache[w] for w in words), dtype=np.int64, count=len(words))


def count_whole(path: str, texts: list[str]) -> list[int]:
    words = [_WORD.findall(t) for t in texts]
    sizes = [len(w) for w in words]
    total = np.concatenate([[0], np.cumsum(count_words(path, [w for ws in words for w in ws]))])
    ends = np.cumsum(sizes)
    return (total[ends] - total[ends - sizes]).tolist()


def count_tokens(docs: DataFrame, path: str, huge: int = HUGE_CHARS, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens."""
    scratch = Scratch(docs.sparkSession, "tokens")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "doc_id long, n_bytes long, n_tokens long"
    target = arrow_schema(schema)

    def whole(batches):
        for part in slices(batches, 1):
            texts = part.column(1)
            yield record({"doc_id": part.column(0), "n_bytes": pc.binary_length(texts.cast(pa.large_binary())), "n_tokens": count_whole(path, texts.to_pylist())}, target)

    size = F.length("text")
    small = docs.filter(size <= huge).mapInArrow(whole, schema)
    # an id of its own for every huge row, so that equal doc_ids stay apart
    large = scratch.stage(docs.filter(size > huge).withColumn("row", F.monotonically_increasing_id()), "huge")
    lengths = large.select("row", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.length("text").alias("size"))
    todo, done = large, []
    while True:
        spliced = scratch.stage(_spliced(todo, path, chunk, overlap, scratch), "spliced")
        done.append(spliced.filter("failed = 0").select("row", "n_tokens"))
        failed = spliced.filter("failed > 0").select("row")
        if failed.isEmpty():
            break
        overlap *= 2
        chunk = max(chunk, 2 * overlap)
        todo = large.join(failed, "row", "left_semi")
    counted = done[0]
    for more in done[1:]:
        counted = counted.unionByName(more)
    return small.unionByName(lengths.join(counted, "row").select("doc_id", "n_bytes", "n_tokens"))


def _spliced(large: DataFrame, path: str, chunk: int, overlap: int, scratch: Scratch) -> DataFrame:
    """(row, n_tokens, failed): tokens summed between splices, and how many overlaps did not align."""

    def cut(batches):
        # chunk i owns [i * chunk, (i + 1) * chunk) and reaches one overlap into the next
        for batch in slices(batches, 1):
            for row, text in zip(*(c.to_pylist() for c in batch.columns)):
                for i in range(max(1, -(-len(text) // chunk))):
                    yield pa.RecordBatch.from_pydict({"row": [row], "i": pa.array([i], pa.int64()), "piece": [text[i * chunk : (i + 1) * chunk + overlap]]})

    schema = "row long, i long, total long, left_at array<int>, left_n array<int>, right_at array<int>, right_n array<int>"
    target = arrow_schema(schema)

    def encode(batches):
        own = tokenizer(path)
        for batch in slices(batches, 2):
            out = {n: [] for n in target.names}
            for row, i, text in zip(*(c.to_pylist() for c in batch.columns)):
                e = own.encode(text, add_special_tokens=False)
                start = np.array([o[0] for o in e.offsets], dtype=np.int64)
                stop = np.maximum.accumulate(np.array([o[1] for o in e.offsets], dtype=np.int64)) if len(start) else start
                stable = np.array([m.end() for m in _GAP.finditer(text)], dtype=np.int64)
                n = np.searchsorted(start, stable)  # tokens that begin before the boundary
                clear = (n == 0) | (stop[np.maximum(n - 1, 0)] <= stable) if len(start) else np.ones(len(stable), bool)
                stable, n = stable[clear], n[clear]
                for side, lo, hi in (("left", 0, overlap), ("right", chunk, chunk + overlap)):
                    inside = (stable >= lo) & (stable <= hi)
                    out[f"{side}_at"].append((stable[inside] - lo).astype(np.int32))
                    out[f"{side}_n"].append(n[inside].astype(np.int32))
                out["row"].append(row)
                out["i"].append(i)
                out["total"].append(len(start))
            yield record(out, target)

    cuts = large.select("row", "text").mapInArrow(cut, "row long, i long, piece string").repartition("row", "i")
    chunks = scratch.stage(cuts.mapInArrow(encode, schema), "chunks")
    before = chunks.select("row", (F.col("i") + 1).alias("i"), "right_at", "right_n", F.col("total").alias("prior"))
    joined = chunks.select("row", "i", "total", "left_at", "left_n").join(before, ["row", "i"], "left")
    joined = joined.withColumn("at", F.array_min(F.array_intersect("left_at", "right_at")))
    # what the chunk gives from the splice on, less what its predecessor counted beyond it
    mine = F.element_at("left_n", F.array_position("left_at", F.col("at")).cast("int"))
    theirs = F.element_at("right_n", F.array_position("right_at", F.col("at")).cast("int"))
    gain = F.when(F.col("i") == 0, F.col("total")).otherwise(F.col("total") - mine - (F.col("prior") - theirs))
    failed = ((F.col("i") > 0) & F.col("at").isNull()).cast("int")
    return joined.groupBy("row").agg(F.sum(F.coalesce(gain, F.lit(0))).cast("long").alias("n_tokens"), F.sum(failed).alias("failed"))


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))

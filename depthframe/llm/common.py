"""Shared pieces of the training-data operators: staging, Arrow batches, word hashing.

Texts are scanned as UTF-8 bytes with numpy, a few hundred kilobytes at a time, so a
task's memory does not grow with the length of a text or the size of a partition.
"""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCAN_BYTES = 1 << 18
SLICE_BYTES = 1 << 22
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


# ---------------------------------------------------------------- staging


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold for what runs inside the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class Scratch:
    """One folder for the staged tables of one operator call.

    It lies in ``spark.checkpoint.dir``, which all executors share. Only a local-mode
    session that leaves the setting unset gets a folder of its own. With ``batch_bytes`` the Arrow
    batches that Python workers get while a table is staged hold about as many bytes; Spark's own bound lets a
    whole task's texts through at once, held by the executor and by the worker.
    """

    def __init__(self, spark: SparkSession, name: str, batch_bytes: int | None = None):
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="depthframe-llm-")
            atexit.register(shutil.rmtree, base, ignore_errors=True)
            spark.conf.set("spark.checkpoint.dir", base)
        self.spark = spark
        self.root = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
        self.n = 0
        self.settings = {CLEANUP: "true"}  # nothing reads the shuffle files of a finished table
        if batch_bytes:
            self.settings[BATCH_BYTES] = str(batch_bytes)
        _ROOTS.setdefault(spark.sparkContext.applicationId, []).append(self.root)

    def stage(self, df: DataFrame, name: str, narrow: bool = False, wide: bool = False) -> DataFrame:
        """Write ``df`` once and read it back: a lost executor costs a re-read of files.

        ``narrow`` is for tables of a few numbers a row, far smaller than the texts: they are
        written by a sixteenth of the shuffle's tasks. ``wide`` is for rows of megabytes: each is a row
        group of its own, so a writer and a reader hold one of them, however many a task has. (Parquet looks at
        a row group's size every 100 rows, and Spark reads thousands of rows of a row group at once.)
        """
        self.n += 1
        if narrow:
            df = df.coalesce(max(12, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // 16))
        path = f"{self.root}/{self.n:03d}-{name}"
        writer = df.write.option("compression", "zstd")
        if wide:
            writer = writer.option("parquet.block.row.count.limit", "1")
        with settings(self.spark, self.settings):
            writer.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._staged_at = path
        return out

    def drop(self, *staged: DataFrame) -> None:
        """Delete staged tables that nothing reads any more."""
        for df in staged:
            _delete(self.spark, df._staged_at)


_ROOTS: dict[str, list[str]] = {}


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete all staged tables of this session; results that read them must be written before."""
    for root in _ROOTS.pop(spark.sparkContext.applicationId, []):
        _delete(spark, root)


# ---------------------------------------------------------------- Arrow batches


def slices(batches: Iterator[pa.RecordBatch], text: int = 0, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows whose texts hold about ``limit`` bytes; one longer text stands alone."""
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        total = np.cumsum(size)
        lo = 0
        while lo < batch.num_rows:
            before = total[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(total, before + limit, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def per_slice(schema: str, fn: Callable, text: int = 0) -> Callable:
    """A mapInArrow function that gives ``fn`` one slice at a time; ``fn`` returns a dict of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for part in slices(batches, text):
            columns = fn(part)
            if columns is not None:
                yield record(columns, target)

    return run


def record(columns: dict, target: pa.Schema) -> pa.RecordBatch:
    arrays = []
    for field in target:
        value = columns[field.name]
        arrays.append(value if isinstance(value, pa.Array) and value.type == field.type else value.cast(field.type) if isinstance(value, pa.Array) else pa.array(value, type=field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=target)


def arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Arrow lists from flat values and list lengths."""
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


# ---------------------------------------------------------------- words


def _class(ranges: list[tuple[int, int]]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


#: Words of letters, digits and every byte of a character above 7F: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
ALNUM = _class([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
#: Words between ASCII white space: ``[^\x20\x09-\x0D]+``.
SPACED = ~_class([(0x20, 0x20), (0x09, 0x0D)])

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWERED = _VALUES.copy()
_LOWERED[0x41:0x5B] = _VALUES[0x61:0x7B]
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        n = max(n, SCAN_BYTES + 4096)
        up, down = np.full(n, _STEP), np.full(n, _BACK)
        up[0] = down[0] = 1
        _POWERS["up"], _POWERS["down"] = np.cumprod(up), np.cumprod(down)
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def unmix(h: np.ndarray) -> np.ndarray:
    """The hashes that ``mix`` spread."""
    h = (h ^ (h >> np.uint64(31)) ^ (h >> np.uint64(62))) * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    h = (h ^ (h >> np.uint64(27)) ^ (h >> np.uint64(54))) * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return h ^ (h >> np.uint64(30)) ^ (h >> np.uint64(60))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (null counts as empty) and the offset of each, plus the end."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of member bytes inside single texts: (base, bytes, starts, ends), a range of bytes at a time."""
    n, lo = len(data), 0
    while lo < n:
        hi = min(lo + SCAN_BYTES, n)
        while hi < n and member[data[hi - 1]] and member[data[hi]]:
            step = member[data[hi : hi + SCAN_BYTES]]
            cut = int(np.argmin(step))
            hi += len(step) if step[cut] else cut
        part = data[lo:hi]
        inside = member[part]
        first = offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi)] - lo
        fresh = np.zeros(len(part) + 1, dtype=bool)
        fresh[first] = True
        fresh[0] = fresh[-1] = True
        start = inside.copy()
        start[1:] &= ~inside[:-1] | fresh[1:-1]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | fresh[1:-1]
        yield lo, part, np.flatnonzero(start), np.flatnonzero(end) + 1
        lo = hi


def word_hashes(texts: pa.Array, member: np.ndarray = SPACED, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, in order, and how many each text has."""
    data, offsets = text_bytes(texts)
    values = _LOWERED if lower else _VALUES
    hashes, counts = [], np.zeros(len(offsets) - 1, dtype=np.int64)
    for lo, part, start, end in spans(data, offsets, member):
        if not len(start):
            continue
        up, down = _powers(len(part))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[part] * up[: len(part)])])
        hashes.append(mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)))
        counts += np.diff(np.searchsorted(start, offsets - lo))
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts


def signed(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.int64)


# ---------------------------------------------------------------- joins on skewed keys

HOT_SHARE = 1000


def join_counted(rows: DataFrame, facts: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """Left join of ``rows`` with ``facts``, unique by ``keys``, whose ``weight`` says how many rows hold a key.

    Keys with at least 1 / ``HOT_SHARE`` of the ``total`` weight, so never more than ``HOT_SHARE``
    of them, are broadcast; the rows of all other keys are shuffled.
    """
    hot = F.broadcast(facts.filter(F.col(weight) * HOT_SHARE >= F.lit(max(total, 1))))
    cold = rows.join(hot.select(keys), keys, "left_anti").join(facts, keys, "left")
    return rows.join(hot, keys).unionByName(cold)

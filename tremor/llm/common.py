"""Helpers shared by the operators: Arrow passes, byte columns, interval unions, frequent keys."""

from __future__ import annotations

import ctypes
import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Python processes these together at most; a batch of many long texts is cut into such slices.
SLICE_BYTES = 8 << 20

_LIBC = ctypes.CDLL(None)
_WORKER_CACHE: dict = {}
_WORKER_STAGE: list = [None]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names, so that other columns cannot clash."""
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))


def as_bytes(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in col.cast(pa.binary()).to_pylist()]


def as_text(col: pa.Array) -> list[str]:
    return [x or "" for x in col.to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one slice holds about ``limit`` bytes (or one row)."""
    for batch in batches:
        if batch.num_rows < 2 or batch.nbytes <= limit:
            yield batch
            continue
        step = max(1, int(batch.num_rows * limit / batch.nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def give_back() -> None:
    """Return freed memory to the machine: a worker goes on to other tasks, and what its allocators keep adds up with theirs."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same pass over batches, giving back memory when a task ends."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``mapInArrow`` of a function from one bounded slice to named columns, in the schema's order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            if part.num_rows:
                out = fn(part)
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in out.values()],
                                                 list(out))

    return df.mapInArrow(tidy(run), schema)


def cached(key: str, make: Callable[[], object]) -> object:
    """One object per Python worker (an automaton, a model), made on first use.  A worker outlives its stage: what the
    stage before has left is dropped on the first use in another one, so objects of several operators do not add up."""
    task = TaskContext.get()
    stage = task and task.stageId()
    if _WORKER_STAGE[0] != stage:
        for other in [k for k in _WORKER_CACHE if k != key]:
            del _WORKER_CACHE[other]
        _WORKER_STAGE[0] = stage
    if key not in _WORKER_CACHE:
        _WORKER_CACHE[key] = make()
    return _WORKER_CACHE[key]


class Memo(dict):
    """Results of a function of a key, with bounded memory: two generations of at most ``limit`` keys, so that
    keys in use survive.  Keys longer than ``longest`` are not kept."""

    _none = object()

    def __init__(self, make: Callable, limit: int, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, key):  # noqa: ANN001, ANN204
        value = self.old.pop(key, self._none)
        if value is self._none:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def held(spark: SparkSession, value: object, make: Callable[[object], object]) -> Callable[[], object]:
    """Broadcast a value of bounded size; the result gives ``make(value)``, made once per Python worker."""
    sent, key = spark.sparkContext.broadcast(value), uuid.uuid4().hex
    return lambda: cached(key, lambda: make(sent.value))


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def fold_of(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 4."""
    return F.crc32(id_col.cast("string").cast("binary")) % 4


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (multiply and xor-shift), element by element."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class RunningHash:
    """64-bit hashes of any byte ranges of a buffer: a polynomial of the bytes in an odd base modulo 2^64, from one
    running sum, times the inverse power of the range's start."""

    _base = 0x9E3779B97F4A7C15
    _powers: list[np.ndarray] = []
    _byte = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if not self._powers or len(self._powers[0]) < n:
            size = max(n, 1 << 20)
            self._powers[:] = [np.multiply.accumulate(np.append(np.uint64(1), np.full(size - 1, b, np.uint64)))
                               for b in (self._base, pow(self._base, -1, 1 << 64))]
        self.sums = np.append(np.uint64(0), np.add.accumulate(self._byte[data] * self._powers[0][:n - 1]))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self._powers[1][start]
        return mix64(h + (end - start).astype(np.uint64))


def union_runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of half-open intervals; touching ones merge."""
    if len(starts) == 0:
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], s[1:] > e[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(s) - 1]))
    return s[new], e[last]


class LocalCounts:
    """Keys seen at least ``least`` times within a bounded chunk of a task.

    Adding up the chunks' counts gives the keys that a large part of all rows
    share.  The result only steers partitioning and ordering; no result
    depends on a key being found.
    """

    def __init__(self, least: int, chunk: int = 1 << 21):
        self.least, self.chunk, self.parts, self.size = least, chunk, [], 0

    def add(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self.parts.append(keys)
        self.size += len(keys)
        if self.size >= self.chunk:
            yield from self.flush()

    def flush(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if self.size:
            keys, n = np.unique(np.concatenate(self.parts), return_counts=True)
            self.parts, self.size = [], 0
            many = n >= self.least
            if many.any():
                yield keys[many], n[many]


def frequent_keys(df: DataFrame, keys_of: Callable[[pa.RecordBatch], np.ndarray], least: int = 8,
                  capacity: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent 64-bit keys of a table and their estimated counts, at most ``capacity`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = LocalCounts(least)

        def out(found):
            for keys, n in found:
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["k", "n"])

        for part in slices(batches):
            if part.num_rows:
                yield from out(local.add(keys_of(part)))
        yield from out(local.flush())

    rows = (df.mapInArrow(tidy(run), "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "k").limit(capacity).toPandas())
    keys = rows["k"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows["n"].to_numpy(np.int64)[order]

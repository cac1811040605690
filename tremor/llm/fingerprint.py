"""Document fingerprints: an improbable-feature digest and its likeness.

Features are windows of ``WINDOW`` bytes.  A window's entropy, in 1001 levels, has a
rarity: levels are ranked by how few windows of the whole table have them (a
first pass counts all windows), and windows of very low entropy are left out.  In
each run of ``RUN`` neighbouring windows the leftmost rarest one scores a point;
windows with ``POINTS`` points are selected.  Selected features go into Bloom
filters of 2048 bits, five bits each; a filter takes ``PER_FILTER`` features, then the
next one of the chain starts.  A text shorter than a window, or without a window to select, is one feature by itself; an
empty text has none and the empty fingerprint.  A fingerprint is the number of features
and the filters in base64, so equal texts have equal fingerprints.

Likeness: the bits two filters share, less those that chance explains, over the
most they could share (nothing counts below ``CUT`` of that range).  Each filter
of the digest with fewer of them takes its best partner; the mean, weighted by
features, is the likeness.  Equal fingerprints have 1; an empty one has 0 with any other.

Texts over ``SEGMENT`` bytes are worked through in stretches, with the result of the whole text.  Null texts
count as empty.  Ids may be whole numbers, decimals, dates or texts.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.llm.common import as_bytes, held, id_text, mix64, sha256_hex, slices

WINDOW, RUN, POINTS, PER_FILTER = 64, 64, 16, 160
BITS, HASHES, CUT = 2048, 5, 0.3
LEVELS, LOWEST = 1001, 100
SEGMENT = 1 << 21
SLICE = 1 << 20  # bytes that one vectorised step takes
PART_BYTES = 16 << 20
MAX_PARTS = 1 << 14

_SCALE = 1024
_TERM = np.array([0] + [round(c * np.log2(c) * _SCALE) for c in range(1, WINDOW + 1)], np.int32)
_TOP = int(np.log2(WINDOW)) * WINDOW * _SCALE
_NEVER = np.int64(LEVELS)


def levels(b: np.ndarray) -> np.ndarray:
    """Entropy level (0 to 1000) of each window.  As the window moves on by one byte, only the counts of the byte that
    leaves and the byte that enters change; both are numbers of equal bytes nearby."""
    n = len(b)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for d in range(1, WINDOW):
        same = b[d:] == b[:-d]
        before[d:] += same
        after[:-d] += same
    first = _TERM[np.bincount(b[:WINDOW], minlength=256)].sum()
    enters = _TERM[before[WINDOW:].astype(np.intp) + 1] - _TERM[before[WINDOW:]]
    leaves = _TERM[after[:n - WINDOW].astype(np.intp) + 1] - _TERM[after[:n - WINDOW]]
    # the byte that enters is counted against the window without the byte that leaves, whose 63 others precede it
    s = np.concatenate(([first], enters - leaves)).astype(np.int64).cumsum()
    return (_TOP - s) * (LEVELS - 1) // _TOP


def levels_of(parts: list[np.ndarray]) -> list[np.ndarray]:
    """The levels of each of some byte arrays, computed over all of them at once."""
    whole = levels(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
    ends = np.cumsum([len(b) for b in parts])
    return [whole[e - len(b):e - WINDOW + 1] if len(b) >= WINDOW else whole[:0] for b, e in zip(parts, ends.tolist())]


def segments(text: bytes) -> list[np.ndarray]:
    """Pieces of a text of which each window belongs to exactly one."""
    b = np.frombuffer(text, np.uint8)
    return [b[at:at + SEGMENT + WINDOW - 1] for at in range(0, max(1, len(b) - WINDOW + 1), SEGMENT)]


def count_levels(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Number of windows of the whole table with each level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS, np.int64)
        for part in slices(batches, SLICE):
            for own in levels_of([b for text in as_bytes(part["text"]) for b in segments(text)]):
                total += np.bincount(own, minlength=LEVELS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS)), pa.array(total)], ["level", "n"])

    rows = (docs.select(docs[text_col].alias("text")).mapInArrow(run, "level long, n long").where("n > 0")
            .groupBy("level").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(LEVELS, np.int64)
    for r in rows:
        out[r["level"]] = r["n"]
    return out


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of each level, the rarest first; windows of levels below ``LOWEST`` are never selected."""
    order = np.lexsort((np.arange(LEVELS), counts))
    rank = np.empty(LEVELS, np.int64)
    rank[order] = np.arange(LEVELS)
    rank[:LOWEST] = _NEVER
    return rank


def _points(level: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, int]:
    """For each window of these levels the number of runs in which it is the leftmost rarest, and the number of runs."""
    key = rank[level] << 32 | np.arange(len(level))
    run, low = min(RUN, len(key)), key
    width = 1
    while width < run:  # least key of each run of neighbours, leftmost on a tie
        step = min(width, run - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    return np.bincount(low & 0xFFFFFFFF, minlength=len(key)), len(low)


def _selected(level: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Positions of the selected windows among windows of these levels, in order."""
    if not len(level):
        return np.zeros(0, np.int64)
    points, runs = _points(level, rank)
    return np.flatnonzero((points >= min(POINTS, runs)) & (rank[level] < _NEVER))


def _selected_long(text: np.ndarray, rank: np.ndarray) -> Iterator[np.ndarray]:
    """The same for a long text, some windows at a time: runs that start in one stretch may end in the next, whose first
    windows then keep their points."""
    windows = len(text) - WINDOW + 1
    left = np.zeros(0, np.int64)
    for at in range(0, windows, SEGMENT):
        end = at + SEGMENT if at + SEGMENT + RUN <= windows else windows
        level = levels(text[at:min(end + RUN - 1, windows) + WINDOW - 1])
        points, _ = _points(level, rank)
        points[:len(left)] += left
        yield at + np.flatnonzero((points[:end - at] >= POINTS) & (rank[level[:end - at]] < _NEVER))
        left = points[end - at:]
        if end == windows:
            return


def _hash_rows(rows: np.ndarray) -> np.ndarray:
    h = np.full(len(rows), rows.shape[1], np.uint64)
    for word in np.ascontiguousarray(rows).view("<u8").T:
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) ^ word)
    return h


def _hash_windows(parts: list[np.ndarray], at: list[np.ndarray]) -> list[np.ndarray]:
    """Hashes of the windows of each part that start at these places."""
    if not parts:
        return []
    start = np.cumsum([0] + [len(b) for b in parts[:-1]])
    rows = np.lib.stride_tricks.sliding_window_view(np.concatenate(parts), WINDOW)[np.concatenate([a + s for a, s in zip(at, start)])]
    return np.split(_hash_rows(rows), np.cumsum([len(a) for a in at])[:-1])


def features(texts: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """Distinct feature hashes of each text, in order of first occurrence."""
    usual = [k for k, text in enumerate(texts) if WINDOW <= len(text) <= SEGMENT]
    parts = [np.frombuffer(texts[k], np.uint8) for k in usual]
    found = dict(zip(usual, _hash_windows(parts, [_selected(level, rank) for level in levels_of(parts)])))
    result = []
    for k, text in enumerate(texts):
        if len(text) > SEGMENT:
            b = np.frombuffer(text, np.uint8)
            found[k] = np.concatenate([_hash_windows([b], [at])[0] for at in _selected_long(b, rank)])
        h = found.get(k, np.zeros(0, np.uint64))
        if text and not len(h):  # shorter than a window, or without a window that may be selected: the text itself is the feature
            h = np.array([xxhash.xxh3_64_intdigest(text)], np.uint64)
        _, first = np.unique(h, return_index=True)
        result.append(h[np.sort(first)])
    return result


class Digest:
    """Chained Bloom filters: ``n`` features, ``bits`` one row per filter."""

    def __init__(self, n: int, packed: np.ndarray):
        self.n, self.packed = n, packed

    @classmethod
    def of(cls, texts: list[bytes], rank: np.ndarray) -> list[Digest]:
        own = features(texts, rank)
        filters = [-(-len(h) // PER_FILTER) for h in own]
        first = np.cumsum([0, *filters])
        h = np.concatenate(own) if own else np.zeros(0, np.uint64)
        row = np.concatenate([f + np.arange(len(x)) // PER_FILTER for f, x in zip(first, own)]) if own else np.zeros(0, np.intp)
        bits = np.zeros((first[-1], BITS), np.uint8)
        for k in range(HASHES):
            bits[row, (h >> np.uint64(11 * k) & np.uint64(BITS - 1)).astype(np.intp)] = 1
        packed = np.packbits(bits, axis=1)
        return [cls(len(x), packed[f:f + n]) for x, f, n in zip(own, first, filters)]

    @classmethod
    def read(cls, text: str) -> Digest:
        if not text:
            return cls(0, np.zeros((0, BITS // 8), np.uint8))
        n, data = text.split(":")
        return cls(int(n), np.frombuffer(base64.b64decode(data), np.uint8).reshape(-1, BITS // 8))

    def __str__(self) -> str:
        return f"{self.n}:{base64.b64encode(self.packed.tobytes()).decode()}" if self.n else ""

    def like(self, other: Digest) -> float:
        if self.n == other.n and np.array_equal(self.packed, other.packed):
            return 1.0
        if not self.n or not other.n:
            return 0.0
        a, b = sorted((self, other), key=lambda d: (len(d.packed), d.n))
        y = np.unpackbits(b.packed, axis=1).astype(np.float32)
        ny = y.sum(1)
        sizes = np.minimum(PER_FILTER, a.n - PER_FILTER * np.arange(len(a.packed)))
        total = 0.0
        for at in range(0, len(a.packed), 256):
            x = np.unpackbits(a.packed[at:at + 256], axis=1).astype(np.float32)
            nx = x.sum(1)
            chance = nx[:, None] * ny / BITS
            room = np.minimum(nx[:, None], ny) - chance
            share = np.where(room > 0, (x @ y.T - chance) / np.maximum(room, 1e-6), 0)
            best = np.clip((share - CUT) / (1 - CUT), 0, 1).max(1)
            total += float((best * sizes[at:at + 256]).sum())
        return round(total / a.n, 6)


def in_order(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Rows (bucket, halo, doc_id, text) dealt to ranges of ids, each bucket sorted by id, then text, in one task, and
    followed by a copy (halo = 1) of the first row after it; the last bucket by the first row of all.  Ranges are
    cut at fixed ids, so a repeated task gets the same rows.  There are at most ``MAX_PARTS`` of them, whose ends are all that the
    driver and the tasks hold; a bucket is sorted by Spark and read as a stream, whatever its size.  Null ids come first."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType
    # a long that does not fall while ids rise; texts go by their first bytes
    number = (F.conv(F.rpad(F.hex(F.substring(F.encode("doc_id", "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("long") if isinstance(kind, T.StringType)
              else F.floor("doc_id").cast("long"))
    key = F.coalesce(number, F.lit(-(1 << 63)))
    ids = docs.select(key.alias("k"), F.length("text").alias("n"))
    rows, size = ids.select(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    parts = max(1, min(rows, -(-size // part_bytes), MAX_PARTS))
    cuts = (np.unique(np.array(ids.approxQuantile("k", [x / parts for x in range(1, parts)], 1 / (4 * parts))).astype(np.int64))
            if parts > 1 else np.zeros(0, np.int64))
    get = held(spark, cuts, lambda c: c)

    @F.pandas_udf("int")
    def bucket_of(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(get(), k.to_numpy(np.int64), "right").astype(np.int32))

    firsts = ids.select("k", bucket_of("k").alias("b")).groupBy("b").agg(F.min("k").alias("k")).orderBy("b").collect()
    before = {r["k"]: firsts[i - 1]["b"] for i, r in enumerate(firsts)}  # one entry per bucket
    ends = held(spark, before, lambda d: d)

    @F.pandas_udf("array<int>")
    def dealt(k: pd.Series) -> pd.Series:
        own = np.searchsorted(get(), k.to_numpy(np.int64), "right").tolist()
        d = ends()
        return pd.Series([[b, -1 - d[x]] if x in d else [b] for x, b in zip(k.tolist(), own)])

    to = docs.select("doc_id", "text", F.explode(dealt(key)).alias("to"))
    to = to.select(F.when(F.col("to") < 0, -1 - F.col("to")).otherwise(F.col("to")).alias("bucket"),
                   (F.col("to") < 0).cast("int").alias("halo"), "doc_id", "text")
    return to.repartitionById(len(cuts) + 1, F.col("bucket")).sortWithinPartitions("bucket", "halo", "doc_id", "text")  # a task per bucket


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row."""
    df = id_text(docs, id_col, text_col)
    rank = held(docs.sparkSession, rarity(count_levels(df)), lambda r: r)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    id_type = df.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, last = rank(), None
        for part in slices(batches, SLICE):
            rows = list(zip(part["bucket"].to_pylist(), part["halo"].to_pylist(), part["doc_id"].to_pylist(), as_bytes(part["text"])))
            pairs = []  # each document with the one after it
            for row, digest in zip(rows, Digest.of([x[3] for x in rows], r)):
                bucket, halo, own, text = row
                if last is not None and last[0] != bucket:
                    last = None  # further copies of the first row after a bucket
                now = (bucket, own, text, digest)
                if last is not None:
                    pairs.append((last, now))
                last = None if halo else now
            if not pairs:
                continue
            chars = [a[2].decode("utf-8", "replace") for a, _ in pairs]
            edited = [(c[:len(c) - len(c) // 4] + b[2].decode("utf-8", "replace")[:len(c) // 4]).encode()
                      for c, (_, b) in zip(chars, pairs)]
            out = [(a[1], len(c), sha256_hex(e), str(a[3]), str(d), a[3].like(d), a[3].like(b[3]))
                   for c, e, d, (a, b) in zip(chars, edited, Digest.of(edited, r), pairs)]
            kinds = [part.schema.field("doc_id").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return in_order(df).mapInArrow(run, f"doc_id {id_type.simpleString()}, n_chars long, edited_sha256 string, "
                                   "fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op8_fingerprints(docs: DataFrame) -> DataFrame:
    return fingerprints(docs)

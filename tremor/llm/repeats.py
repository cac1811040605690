"""Repeated-substring removal by a depth-limited radix sort of suffixes.

Every byte that lies in a ``LENGTH``-byte string which also starts earlier (in a document of
smaller id, or earlier in the same one) is removed.  Strings are judged on the input, matches
never cross documents, and every position counts.

Sorting all suffixes is not needed: of the positions inside each window of LENGTH bytes one is
its anchor, that of the least hash of the ``GRAM`` bytes there, leftmost on a tie.  Equal
windows have their anchor at the same offset, so windows are compared only among
the occurrences of an anchor's gram, and one occurrence stands for all the windows
that share the anchor; its context is the bytes that these cover.

1. Anchors (about 2.6 % of all positions) are shuffled by their gram's hash, each with a hash of its
   context.  Among occurrences with one context all but the earliest are repeats
   throughout, and a gram with a single context needs no more.  What is left are the earliest
   occurrences of contexts that share a gram and differ somewhere.
2. Those get their bytes.
3. Per gram, the suffixes that start at the anchors, and the reversed prefixes that end there, are
   sorted by most-significant-digit passes of eight bytes.  A pass orders only what is
   still equal, and no pass goes beyond LENGTH bytes.  The depth at which neighbours part gives
   the equal groups of every depth, so a window with d bytes before its anchor is equal
   to another exactly if both are in one group of prefixes of depth d and one group of
   suffixes of depth LENGTH - d.  All windows of a group but the earliest are repeats.
4. Covered bytes are gathered per document and removed.

Hashes that many documents share are found first (a bounded list).  Their occurrences are dealt
into blocks of about ``BLOCK``; each block reports its repeats and the earliest window of each
of its groups, and these meet by an aggregation on the window's content hash.  So no task and no
group grows with the number of copies, and no pairs are made.

Hashes have 64 bits.  Null and empty texts have no bytes.  Rows that share an id are one document: the same
position of the same id is no earlier occurrence.  Rows with a null id keep everything and are no earlier occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tremor.llm.common import (RunningHash, as_bytes, frequent_keys, held, id_text, map_batches, mix64, sha256_hex, slices,
                               union_runs)
from tremor.session import cut_lineage

LENGTH = 100
GRAM = 24
BLOCK = 256
PART = 512 << 10      # bytes that one vectorised step takes
CHUNK = 16_000        # occurrences that one radix sort takes
BEFORE = LENGTH - GRAM

_SHIFT = np.uint64(28)  # a hash is compared by its upper 36 bits, then by position
_MASK = np.uint64((1 << 28) - 1)
_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _finished(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= _C[3]
    h ^= h >> np.uint64(29)
    return h


class Anchors:
    """Anchors of some texts: text number, position, first and last window start, gram hash and context hash of each."""

    def __init__(self, texts: list[bytes]):
        data = b"".join(texts)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64) if texts else np.zeros(0, np.int64)
        n = len(data) - LENGTH + 1
        if n < 1:
            self.text = self.at = self.first = self.last = np.zeros(0, np.int64)
            self.hash = self.context = np.zeros(0, np.uint64)
            return
        w = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)).copy()  # the eight bytes at every position
        m = len(data) - GRAM + 1
        h = w[:m] * _C[0]
        for k in range(1, GRAM // 8):
            h += w[8 * k:8 * k + m] * _C[k]
        h = _finished(h)
        low = (h & ~_MASK) | np.arange(m, dtype=np.uint64)
        width = 1
        while width < BEFORE + 1:  # least key of each run of grams that a window holds
            step = min(width, BEFORE + 1 - width)
            low = np.minimum(low[:-step], low[step:])
            width += step
        at = (low & _MASK).astype(np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])[:n]
        inside = np.flatnonzero(np.arange(n) + LENGTH <= ends[owner])
        at, owner = at[inside], owner[inside]
        new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (inside[1:] != inside[:-1] + 1)))[:len(at)])
        last = inside[np.append(new[1:] - 1, len(at) - 1)[:len(new)]]
        first, at, self.text = inside[new], at[new], owner[new]
        self.hash = h[at]
        context = RunningHash(np.frombuffer(data, np.uint8)).of(first, last + LENGTH)
        self.context = mix64(context ^ (at - first).astype(np.uint64))
        start = np.append(0, ends[:-1])[self.text]
        self.at, self.first, self.last = at - start, first - start, last - start


def gram_hashes(rows: np.ndarray) -> np.ndarray:
    """The anchors' hash of rows of GRAM bytes."""
    w = np.ascontiguousarray(rows).view("<u8")
    h = w[:, 0] * _C[0]
    for k in range(1, GRAM // 8):
        h += w[:, k] * _C[k]
    return _finished(h)


def _pieces(part: pa.RecordBatch) -> Iterator[tuple[list, list[int], list[bytes], list[int]]]:
    """(ids, salts, texts, offset of each) in bounded steps; a longer text comes in pieces that overlap by LENGTH - 1."""
    ids, salts, texts, offsets, size = [], [], [], [], 0
    for own, salt, text in zip(part["doc_id"].to_pylist(), part["salt"].to_pylist(), as_bytes(part["text"])):
        if own is None or len(text) < LENGTH:
            continue
        for at in range(0, len(text) - LENGTH + 1, PART):
            piece = text[at:at + PART + LENGTH - 1] if len(text) > PART + LENGTH else text
            ids.append(own), salts.append(salt), texts.append(piece), offsets.append(at)
            size += len(piece)
            if size >= PART:
                yield ids, salts, texts, offsets
                ids, salts, texts, offsets, size = [], [], [], [], 0
            if piece is text:
                break
    if ids:
        yield ids, salts, texts, offsets


def _known(h: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(h), bool)
    return keys[np.minimum(np.searchsorted(keys, h), len(keys) - 1)] == h


def _blocks(h: np.ndarray, often: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes are frequent, and into how many blocks the occurrences of each are dealt."""
    keys, counts = often
    known, blocks = _known(h, keys), np.ones(len(h), np.int64)
    blocks[known] = -(-counts[np.searchsorted(keys, h[known])] // BLOCK)
    return known, blocks


def anchor_rows(docs: DataFrame, often: object) -> DataFrame:
    """(k, c, doc_id, m) of every anchor of (doc_id, salt, text).  k is the gram's hash, with the block for a frequent
    one; c the context's; m holds position, a mark of frequent ones, and the least and most bytes before the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            kind = part.schema.field("doc_id").type
            for ids, salts, texts, offsets in _pieces(part):
                a = Anchors(texts)
                if not len(a.at):
                    continue
                late, blocks = _blocks(a.hash, often())
                block = np.array(salts)[a.text] % blocks
                k = np.where(late, mix64(a.hash + block.astype(np.uint64) * _C[1]), a.hash)
                m = ((a.at + np.array(offsets)[a.text]) << 17) | (late << 16) | ((a.at - a.last) << 8) | (a.at - a.first)
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(a.context.view(np.int64)),
                                                  pa.array(ids, kind).take(pa.array(a.text)), pa.array(m)], ["k", "c", "doc_id", "m"])

    return docs.mapInArrow(run, f"k long, c long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, m long")


def occurrences(docs: DataFrame, often: object) -> DataFrame:
    """(g, block, blocks, doc_id, at, lo, hi, bytes) of the anchors ``sorts`` of (doc_id, salt, text, sorts):
    the windows with lo to hi bytes before the anchor, and the bytes they cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            kind = part.schema.field("doc_id").type
            ids, salts, ms, data = [], [], [], []
            for own, salt, text, sorts in zip(part["doc_id"].to_pylist(), part["salt"].to_pylist(), as_bytes(part["text"]),
                                              part["sorts"].to_pylist()):
                for m in sorts or ():
                    at, lo, hi = m >> 17, m >> 8 & 255, m & 255
                    piece = text[at - hi:at - lo + LENGTH]
                    if len(piece) == hi - lo + LENGTH:  # else this is another text of the same id
                        ids.append(own), salts.append(salt), ms.append(m), data.append(piece)
            for a in range(0, len(ms), CHUNK):
                m, piece = np.array(ms[a:a + CHUNK]), data[a:a + CHUNK]
                flat = np.frombuffer(b"".join(piece), np.uint8)
                start = np.cumsum([0] + [len(x) for x in piece[:-1]]) + (m & 255)
                h = gram_hashes(flat[start[:, None] + np.arange(GRAM)])
                _, blocks = _blocks(h, often())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(np.array(salts[a:a + CHUNK]) % blocks), pa.array(blocks),
                     pa.array(ids[a:a + CHUNK], kind), pa.array(m >> 17), pa.array((m >> 8 & 255).astype(np.int32)),
                     pa.array((m & 255).astype(np.int32)), pa.array(piece, pa.binary())],
                    ["g", "block", "blocks", "doc_id", "at", "lo", "hi", "bytes"])

    return docs.mapInArrow(run, f"g long, block long, blocks long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                                "at long, lo int, hi int, bytes binary")


def radix_sort(words: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Most-significant-digit sort of rows of big-endian 64-bit digits within ascending groups.

    Gives the order and, for each place in it, the number of leading bytes shared with the row before (-1 for the
    first of a group).  A pass looks only at rows that still have an equal neighbour.
    """
    m, digits = words.shape
    order = np.arange(m)
    shared = np.full(m, 8 * digits, np.int64)
    shared[np.concatenate(([True], group[1:] != group[:-1]))] = -1
    for k in range(digits):
        tied = shared == 8 * digits          # equal so far to the row before
        open_ = tied | np.append(tied[1:], False)
        places = np.flatnonzero(open_)
        if not len(places):
            break
        run = np.cumsum(~tied[places])       # number of the run of equal rows
        key = words[order[places], k]
        by = np.lexsort((key, run))
        order[places] = order[places][by]
        key = key[by]
        differ = np.flatnonzero(tied[places] & np.append(False, key[1:] != key[:-1]))
        bits = key[differ] ^ key[differ - 1]
        # leading equal bytes: eight less the place of the highest set byte
        top = np.zeros(len(bits), np.int64)
        for step in (4, 2, 1):
            big = bits >> np.uint64(8 * step) > 0
            top += step * big
            bits = np.where(big, bits >> np.uint64(8 * step), bits)
        shared[places[differ]] = 8 * k + 7 - top
    return order, shared


def repeats(group: np.ndarray, same: np.ndarray, lo: np.ndarray, hi: np.ndarray,
            data: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(d, rows, first): windows with d bytes before the anchor that equal an earlier one, by row, and the rows of the
    earliest of each group.  Rows are in order of occurrence within ascending groups; rows with one number in ``same``
    are one occurrence."""
    m = len(data)
    flat = np.frombuffer(b"".join(data) + bytes(LENGTH + 8), np.uint8)
    start = np.concatenate(([0], np.cumsum([len(x) for x in data])))
    anchor = start[:-1] + hi
    after = flat[anchor[:, None] + np.arange(LENGTH + 4)]
    after[np.arange(LENGTH + 4) >= (LENGTH - lo)[:, None]] = 0
    before = flat[np.maximum(anchor[:, None] - 1 - np.arange(BEFORE + 4), 0)]
    before[np.arange(BEFORE + 4) >= hi[:, None]] = 0
    sides = []
    for rows in (before, after):
        words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
        order, shared = radix_sort(words, group)
        rank = np.empty(m, np.int64)
        rank[order] = np.arange(m)
        sides.append((rank, shared))
    (rank_b, shared_b), (rank_a, shared_a) = sides
    for d in range(int(lo.min(initial=0)), int(hi.max(initial=-1)) + 1):
        rows = np.flatnonzero((lo <= d) & (d <= hi))
        if not len(rows):
            continue
        key = np.cumsum(shared_b < d)[rank_b[rows]] * m + np.cumsum(shared_a < LENGTH - d)[rank_a[rows]]
        _, first, own = np.unique(key, return_index=True, return_inverse=True)
        yield d, rows[same[rows] != same[rows[first]][own]], rows[first]


def _found(rows: DataFrame, id_type: str) -> DataFrame:
    """(doc_id, start, end, window): covered byte ranges; rows with a window hash are earliest windows of blocks."""

    def solve(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        g, block, at = (t[c].to_numpy() for c in ("g", "block", "at"))
        lo, hi = (t[c].to_numpy().astype(np.int64) for c in ("lo", "hi"))
        data, several = t["bytes"].to_pylist(), t["blocks"].to_numpy() > 1
        ids = t["doc_id"].combine_chunks()
        number = ids.dictionary_encode().indices.to_numpy()
        new = np.append(True, (g[1:] != g[:-1]) | (block[1:] != block[:-1]))
        group = np.cumsum(new)
        same = np.cumsum(new | np.append(True, (number[1:] != number[:-1]) | (at[1:] != at[:-1])))
        hit_row, hit_d, first_row, first_d = [], [], [], []
        for d, hits, first in repeats(group, same, lo, hi, data):
            hit_row.append(hits), hit_d.append(np.full(len(hits), d))
            own = first[several[first]]
            first_row.append(own), first_d.append(np.full(len(own), d))
        row, d = (np.concatenate(x or [np.zeros(0, np.int64)]) for x in (hit_row, hit_d))
        by = np.lexsort((-d, row))
        row, d = row[by], d[by]
        new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (d[1:] != d[:-1] - 1))[:len(row)])
        end = np.append(new[1:] - 1, len(row) - 1)[:len(new)]
        s, e, r = at[row[new]] - d[new], at[row[end]] - d[end] + LENGTH, row[new]
        frow, fd = (np.concatenate(x or [np.zeros(0, np.int64)]) for x in (first_row, first_d))
        fs = at[frow] - fd
        window = window_hashes(data, frow, hi[frow] - fd)
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(np.concatenate((r, frow)))), pa.array(np.concatenate((s, fs))),
             pa.array(np.concatenate((e, fs + LENGTH))),
             pa.array(np.concatenate((np.zeros(len(r), np.int64), window.view(np.int64))),
                      mask=np.arange(len(r) + len(frow)) < len(r))], ["doc_id", "start", "end", "window"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for part in slices(batches):
            if not part.num_rows:
                continue
            kept.append(part)
            size += part.num_rows
            if size >= CHUNK:  # solve all groups but the last, which may go on
                t = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
                g, block = t["g"].to_numpy(), t["block"].to_numpy()
                cut = len(g) - int(((g == g[-1]) & (block == block[-1])).sum())
                if cut:
                    yield solve([t.slice(0, cut)])
                    kept, size = [t.slice(cut)], len(g) - cut
        if kept:
            yield solve(kept)

    return (rows.repartition("g", "block").sortWithinPartitions("g", "block", "doc_id", "at")
            .mapInArrow(run, f"doc_id {id_type}, start long, end long, window long"))


def window_hashes(data: list[bytes], rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of LENGTH bytes of row ``rows`` from offset ``at``."""
    if not len(rows):
        return np.zeros(0, np.uint64)
    flat = np.frombuffer(b"".join(data), np.uint8)
    start = np.concatenate(([0], np.cumsum([len(x) for x in data])))[rows] + at
    out = np.full(len(rows), LENGTH, np.uint64)
    for a in range(0, len(rows), CHUNK):
        text = np.zeros((len(rows[a:a + CHUNK]), -(-LENGTH // 8) * 8), np.uint8)
        text[:, :LENGTH] = flat[start[a:a + CHUNK, None] + np.arange(LENGTH)]
        h = out[a:a + CHUNK]
        for word in text.view("<u8").T:
            h = mix64(h * _C[0] ^ word)
        out[a:a + CHUNK] = h
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256; with ``keep``
    also ``kept`` (the remaining bytes) and ``spans`` (list of start, end)."""
    # the salt is added behind the joins: both then read the same shuffled texts
    texts, salt = id_text(docs, id_col, text_col), F.abs(F.xxhash64("doc_id") % (1 << 40))
    df = texts.select("doc_id", salt.alias("salt"), "text")
    id_type = df.schema["doc_id"].dataType.simpleString()
    hashes = lambda part: np.concatenate([Anchors(t).hash for _, _, t, _ in _pieces(part)] or [np.zeros(0, np.uint64)])
    often = held(df.sparkSession, frequent_keys(df, hashes), lambda o: o)

    rows = anchor_rows(df, often)
    group = Window.partitionBy("k").orderBy("c", "doc_id", "m").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank = F.dense_rank().over(Window.partitionBy("k", "c").orderBy("doc_id", "m"))
    several = (F.min("c").over(group) != F.max("c").over(group)) | (F.col("m").bitwiseAND(1 << 16) != 0)
    rows = rows.select("k", "c", "doc_id", "m", several.alias("several"), rank.alias("rank")).where("rank > 1 OR several")
    # per document, at most its own anchors: those whose windows all repeat, and those to be sorted
    marks = cut_lineage(rows.groupBy("doc_id").agg(F.collect_list(F.when(F.col("rank") > 1, F.col("m"))).alias("whole"),
                                                   F.collect_list(F.when(F.col("rank") == 1, F.col("m"))).alias("sorts")))

    # left joins without a filter on both sides, so that the texts are shuffled once
    wanted = texts.join(marks.select("doc_id", "sorts"), "doc_id", "left").withColumn("salt", salt)
    found = _found(occurrences(wanted, often), id_type)
    # blocks of frequent hashes: of each window's earliest occurrences per block, all but the first are repeats
    firsts = found.where("window IS NOT NULL").select("window", F.struct("doc_id", "start").alias("place"))
    least = firsts.groupBy("window").agg(F.min("place").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = firsts.join(least, "window").where("place != least").select("place.doc_id", "place.start",
                                                                       (F.col("place.start") + LENGTH).alias("end"))
    gone = (found.where("window IS NULL").select("doc_id", "start", "end").union(later)
            .groupBy("doc_id").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")))
    joined = (texts.join(marks.select("doc_id", "whole"), "doc_id", "left").join(gone, "doc_id", "left")
              .select("doc_id", "text", "whole", "starts", "ends"))

    def run(part: pa.RecordBatch) -> dict:
        out: list[tuple] = []
        for text, m, s, e in zip(as_bytes(part["text"]), *(part[c].to_pylist() for c in ("whole", "starts", "ends"))):
            m = np.array(m or [], np.int64)
            s = np.append(np.array(s or [], np.int64), (m >> 17) - (m & 255))
            e = np.append(np.array(e or [], np.int64), (m >> 17) - (m >> 8 & 255) + LENGTH)
            s, e = union_runs(s, np.minimum(e, len(text)))
            edge = [0, *np.stack([s, e], 1).ravel().tolist(), len(text)]
            rest = b"".join([text[a:b] for a, b in zip(edge[::2], edge[1::2])])
            out.append((len(text), len(text) - len(rest), len(s), sha256_hex(rest), rest, list(zip(s.tolist(), e.tolist()))))
        n, removed, spans, sha, rest, where = zip(*out)
        cols = {"doc_id": part["doc_id"], "n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(sha, pa.string())}
        if keep:
            cols |= {"kept": pa.array(rest, pa.binary()), "spans": pa.array(where, pa.list_(pa.list_(pa.int64())))}
        return cols

    schema = f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return map_batches(joined, run, schema + (", kept binary, spans array<array<bigint>>" if keep else ""))


def op3_repeats(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs)

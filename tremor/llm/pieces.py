"""Encoding and decoding with a SentencePiece model file (byte-pair pieces with byte fallback).

Spaces become the marker U+2581, and a text that is not empty gets one in front.  No piece of such a model has
a marker after another character (checked when the file is read), so no piece crosses the place
before a run of markers: a text is a sequence of marked words, each segmented by itself.

**Distinct-chunk table.**  A word that the whole table holds a million times is segmented once:

1. Each task cuts its documents into slices of about ``SLICE`` bytes and numbers a slice's
   distinct words by their frequency; the documents are then rows of word numbers.
2. The distinct words go to the shard that their hash names, one packed row per slice and shard.
   A shard keeps the table of its words (word -> ids) and answers every slice with packed ids in the words' order.
3. Answers and word numbers meet at their slice, and ids are joined back by position.  Decoding joins the vocabulary
   strings of each distinct word once, and the words' strings by position.

What is shuffled are distinct words per slice and compressed word numbers, not texts or tokens; a frequent word is one entry
per slice, so no key is hot.  A shard's table keeps ``MEMO`` words at most, twice; words beyond that are segmented
again, with the same result.  Slices are named by their content, so a task that runs again gives the same rows.

Segmenting a word: adjacent symbols merge while their union is a piece, the best score first, the leftmost of
equal ones (a priority queue over a linked list, stale entries skipped); a symbol that is no piece becomes its bytes.

Null and empty texts have no words: only the end id.  Repeated rows and null ids are rows like others.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import Memo, as_text, cached, id_text, sha256_hex, slices

MODEL = "piece_bpe_32k.model"
SLICE = 32 << 20
PART = 2 << 20
MEMO = 400_000
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value

    while at < len(data):
        field, kind = divmod(varint(), 8)
        if kind == 0:
            yield field, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield field, data[at:at + size]
            at += size


class Pieces:
    """Segments marked words with one model file."""

    def __init__(self, data: bytes):
        self.strings: list[str] = []
        self.kinds: list[int] = []
        self.scores: list[float] = []
        trainer, norm = {}, {}
        for field, value in message(data):
            if field == 1:
                piece = dict(message(value))
                self.strings.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                self.kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer = dict(message(value))
            elif field == 3:
                norm = dict(message(value))
        wanted = {"byte-pair model": trainer.get(3) == 2, "byte fallback": trainer.get(35, 0) == 1, "no normalisation table": not norm.get(2),
                  "marker in front": norm.get(3, 1) == 1, "white space kept": norm.get(4, 1) == 0, "spaces as markers": norm.get(5, 1) == 1,
                  "marker as prefix": trainer.get(24, 0) == 0, "no own or unused pieces": not {USER_DEFINED, UNUSED} & set(self.kinds),
                  "no piece across markers": not any(MARK in s.lstrip(MARK) for s, k in zip(self.strings, self.kinds) if k == NORMAL)}
        if missing := [name for name, there in wanted.items() if not there]:
            raise ValueError(f"unsupported model: it lacks {', '.join(missing)}")
        self.end = trainer.get(42, 2)
        self.ids = {s: i for i, (s, k) in enumerate(zip(self.strings, self.kinds)) if k == NORMAL}
        self.bytes = {int(s[3:5], 16): i for i, (s, k) in enumerate(zip(self.strings, self.kinds)) if k == BYTE}
        byte_of = {i: b for b, i in self.bytes.items()}
        self.raw = [bytes([byte_of[i]]) if k == BYTE else b"" if k == CONTROL else s.replace(MARK, " ").encode()
                    for i, (s, k) in enumerate(zip(self.strings, self.kinds))]

    def segment(self, word: str) -> list[int]:
        """Ids of one marked word."""
        if (known := self.ids.get(word)) is not None and len(word) < 3:
            return [known]
        ids, scores = self.ids, self.scores
        sym: list[str] = list(word)
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            if (found := ids.get(sym[i] + sym[i + 1])) is not None:
                queue.append((-scores[found], i, 2))
        heapq.heapify(queue)
        while queue:
            _, i, size = heapq.heappop(queue)
            j = after[i]
            if not sym[i] or j >= n or len(sym[i]) + len(sym[j]) != size:
                continue  # stale: a symbol of this pair was merged since
            whole = sym[i] = sym[i] + sym[j]
            sym[j] = ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (found := ids.get(whole + sym[k])) is not None:
                    heapq.heappush(queue, (-scores[found], i, size + len(sym[k])))
            h = before[i]
            if h >= 0 and (found := ids.get(sym[h] + whole)) is not None:
                heapq.heappush(queue, (-scores[found], h, len(sym[h]) + size))
        out: list[int] = []
        for s in sym:
            if s:
                if (found := ids.get(s)) is not None:
                    out.append(found)
                else:
                    out.extend(self.bytes[b] for b in s.encode())
        return out

    def show(self, ids: list[int]) -> bytes:
        """The text that the ids of whole words stand for, as UTF-8."""
        return b"".join([self.raw[i] for i in ids])


_WORD = re.compile(f"{MARK}+[^{MARK}]*")


def words(text: str) -> list[str]:
    """The marked words of a text."""
    return _WORD.findall(MARK + text.replace(" ", MARK)) if text else []


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(MODEL)


def load(path: str) -> Pieces:
    def read() -> Pieces:
        with open(path, "rb") as f:
            return Pieces(f.read())

    return cached(f"pieces {path}", read)


#: Numbers are kept apart by size, so that the bytes of frequent (small) ones get short codes of their own.
_CLASSES = 4 ** np.arange(3, 16, dtype=np.uint64)


def _width(k: int) -> int:
    """Bytes of a number of size class k."""
    return min(4, (2 * k + 13) // 8)


def _pack(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers: their size classes, then class by class the low bytes, the next bytes and so on, zstd-compressed."""
    values = values.astype("<u4")
    kind = np.searchsorted(_CLASSES, values, side="right").astype(np.uint8)
    parts = [struct.pack("<I", len(values)), kind.tobytes()]
    for k in range(len(_CLASSES) + 1):
        own = values[kind == k].view(np.uint8).reshape(-1, 4)
        parts.append(np.ascontiguousarray(own[:, :_width(k)].T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack(data: bytes) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(data)
    n = struct.unpack_from("<I", data)[0]
    kind, at = np.frombuffer(data, np.uint8, n, 4), 4 + n
    out = np.zeros(n, "<u4")
    for k in range(len(_CLASSES) + 1):
        own = np.flatnonzero(kind == k)
        planes = np.frombuffer(data, np.uint8, len(own) * _width(k), at).reshape(_width(k), -1)
        at += len(own) * _width(k)
        wide = np.zeros((len(own), 4), np.uint8)
        wide[:, :_width(k)] = planes.T
        out[own] = wide.view("<u4").ravel()
    return out


def _pack_words(chunks: list[str]) -> bytes:
    sizes = np.fromiter(map(len, chunks), np.uint32, len(chunks))
    text = "".join(chunks).encode()
    return zstandard.ZstdCompressor(level=1).compress(struct.pack("<I", len(chunks)) + sizes.tobytes() + text)


def _unpack_words(data: bytes) -> list[str]:
    data = zstandard.ZstdDecompressor().decompress(data)
    n = struct.unpack_from("<I", data)[0]
    ends = np.cumsum(np.frombuffer(data, np.uint32, n, 4)).tolist()
    text = data[4 + 4 * n:].decode()
    return [text[a:b] for a, b in zip([0, *ends], ends)]


#: Rows of a slice: packed answers of the shards, the shard of each word number, documents as word numbers.
ANSWER, PLACES, DOCUMENTS = 0, 1, 2


def _ask(docs: DataFrame, shards: int, slice_bytes: int) -> DataFrame:
    """Words for the shards, and the documents as numbers, per slice."""
    id_type = docs.schema["doc_id"].dataType
    schema = f"slice binary, kind int, shard int, data binary, sizes binary, doc_ids array<{id_type.simpleString()}>"

    def rows_of(parts: list[tuple[pa.Array, list[np.ndarray]]], numbers: dict[str, int]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(numbers), np.int64)
        for _, texts in parts:
            if texts:
                t = np.concatenate(texts)
                seen += np.bincount(t, minlength=len(seen))
        order = np.argsort(-seen, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        by_number = list(numbers)
        ranked = [by_number[i] for i in order]
        shard = np.fromiter((xxhash.xxh3_64_intdigest(w) % shards for w in ranked), np.uint32, len(ranked))
        packed = [(_pack(rank[np.concatenate(t)] if t else rank[:0]), _pack(np.fromiter(map(len, t), np.uint32, len(t))), ids)
                  for ids, t in parts]
        name = xxhash.xxh3_128()
        for data, sizes, _ in packed:
            name.update(data + sizes)
        name.update("".join(ranked).encode())
        name = name.digest()
        out = []
        by_shard = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[by_shard], np.arange(shards + 1))
        for k in range(shards):
            if cuts[k] < cuts[k + 1]:
                out.append((ANSWER, k, _pack_words([ranked[i] for i in by_shard[cuts[k]:cuts[k + 1]]]), b"", None))
        home = int.from_bytes(name[:4], "little") % shards
        out.append((PLACES, home, _pack(shard), b"", None))
        out += [(DOCUMENTS, home, data, sizes, ids) for data, sizes, ids in packed]
        for kind, at, data, sizes, ids in out:
            ids = pa.array([], _arrow_type(id_type)) if ids is None else ids
            yield pa.RecordBatch.from_arrays(
                [pa.array([name], pa.binary()), pa.array([kind], pa.int32()), pa.array([at], pa.int32()), pa.array([data], pa.binary()),
                 pa.array([sizes], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)],
                ["slice", "kind", "shard", "data", "sizes", "doc_ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, numbers, size = [], {}, 0
        for part in slices(batches, PART):
            texts = []
            for text in as_text(part["text"]):
                texts.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words(text)), np.uint32))
            parts.append((part["doc_id"], texts))
            size += part.nbytes
            if size >= slice_bytes:
                yield from rows_of(parts, numbers)
                parts, numbers, size = [], {}, 0
        if parts:
            yield from rows_of(parts, numbers)

    return docs.mapInArrow(run, schema)


def _arrow_type(kind):  # noqa: ANN001, ANN202
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def _answer(asked: DataFrame, path: str | None) -> DataFrame:
    """Each shard's distinct words, segmented once; a slice's words become their ids, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path or default_path())
        known = Memo(lambda w: struct.pack(f"<{len(ids := coder.segment(w))}I", *ids), MEMO)
        for batch in batches:
            data = []
            for kind, one in zip(batch["kind"].to_pylist(), batch["data"]):
                if kind != ANSWER:
                    data.append(one.as_py())
                    continue
                ids = list(map(known.__getitem__, _unpack_words(one.as_py())))
                counts = np.fromiter(map(len, ids), np.uint32, len(ids)) // 4
                data.append(struct.pack("<I", len(packed := _pack(counts))) + packed + _pack(np.frombuffer(b"".join(ids), "<u4")))
            cols = {n: batch[n] for n in batch.schema.names} | {"data": pa.array(data, pa.binary())}
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return asked.mapInArrow(run, asked.schema)


def _join_back(answered: DataFrame, path: str | None, schema: str, id_type, keep: bool) -> DataFrame:  # noqa: ANN001
    """Ids by position, one row per document; ``answered`` is sorted by slice and kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path or default_path())
        end = [coder.end]
        name, answers, digits, shown, count, ids_of = None, {}, [], [], np.zeros(0, np.int64), []

        def place(shard: np.ndarray) -> None:
            """Strings, texts and counts of all words of the slice, by word number."""
            nonlocal digits, shown, count, ids_of
            n = len(shard)
            digits, shown, ids_of, count = [b""] * n, [b""] * n, [()] * n if keep else [], np.zeros(n, np.int64)
            by_shard = np.argsort(shard, kind="stable")
            at = 0
            for k in sorted(set(shard.tolist())):
                data = answers.get(k)
                if data is None:
                    raise RuntimeError("a slice's words were cut differently when a task ran again: checkpoint the documents first")
                size = struct.unpack_from("<I", data)[0]
                counts, ids = _unpack(data[4:4 + size]), _unpack(data[4 + size:]).tolist()
                numbers = by_shard[at:at + len(counts)]
                count[numbers] = counts
                ends = np.cumsum(counts).tolist()
                for i, a, b in zip(numbers.tolist(), [0, *ends], ends):
                    own = ids[a:b]
                    digits[i], shown[i] = " ".join(map(str, own)).encode(), coder.show(own)
                    if keep:
                        ids_of[i] = own
                at += len(counts)

        for batch in batches:
            for row in range(batch.num_rows):
                one = {n: batch[n][row] for n in ("slice", "kind", "shard", "data", "sizes")}
                if (own := one["slice"].as_py()) != name:
                    name, answers = own, {}
                kind, data = one["kind"].as_py(), one["data"].as_py()
                if kind == ANSWER:
                    answers[one["shard"].as_py()] = data
                elif kind == PLACES:
                    place(_unpack(data))
                    answers = {}
                else:
                    numbers, sizes = _unpack(data), _unpack(one["sizes"].as_py())
                    totals, ends = np.append(0, np.cumsum(count[numbers])), np.append(0, np.cumsum(sizes, dtype=np.int64)).tolist()
                    numbers, a, b, back, ids = numbers.tolist(), [], [], [], []
                    for s, e in zip(ends, ends[1:]):
                        inside = numbers[s:e]
                        a.append(sha256_hex(b" ".join([*map(digits.__getitem__, inside), str(coder.end).encode()])))
                        text = b"".join(map(shown.__getitem__, inside))[1:]  # the marker in front is no part of the text
                        b.append(sha256_hex(text))
                        if keep:
                            ids.append([x for i in inside for x in ids_of[i]] + end)
                            back.append(text.decode())
                    n = totals[ends[1:]] - totals[ends[:-1]] + 1 if len(ends) > 1 else np.zeros(0, np.int64)
                    out = {"doc_id": batch["doc_ids"][row].values, "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(a, pa.string()),
                           "decoded_sha256": pa.array(b, pa.string())}
                    out |= {"ids": pa.array(ids, pa.list_(pa.int64())), "decoded": pa.array(back, pa.string())} if keep else {}
                    yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return answered.mapInArrow(run, schema)


def pieces(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None,
           slice_bytes: int = SLICE, keep: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256; with ``keep`` also ``ids``
    (array of long) and ``decoded``.  ``path`` is the model file, at the same place on every machine (default: the installed
    public one); ``shards`` is the number of parts of the word table (default: the session's shuffle partitions)."""
    df = id_text(docs, id_col, text_col)
    id_type = df.schema["doc_id"].dataType
    shards = shards or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = _ask(df, shards, slice_bytes).repartitionById(shards, F.col("shard"))
    answered = _answer(asked, path).repartition(shards, "slice").sortWithinPartitions("slice", "kind")
    schema = f"doc_id {id_type.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _join_back(answered, path, schema + (", ids array<long>, decoded string" if keep else ""), id_type, keep)


def op13_pieces(docs: DataFrame) -> DataFrame:
    return pieces(docs)

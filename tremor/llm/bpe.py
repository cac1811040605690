"""Byte-pair encoding and decoding with a given vocabulary file.

Text becomes pieces the way the file says: special tokens are cut out of the
raw text; the rest is NFC-normalised, white space becomes a space, letters are
lower-cased one by one, and a pattern picks contractions, letter runs, single
digits and symbol runs.  White space is dropped.  A piece's UTF-8 bytes are
written in the printable byte alphabet, the last one with the word-end suffix.

Merging: the symbols of a piece form a doubly linked list; a priority queue
holds (rank, position) of every adjacent pair in the merge table.  The
smallest is applied, its neighbours get new entries, and entries whose symbols
have changed meanwhile are skipped.  A piece of n bytes takes O(n log n).

No piece holds white space, so a worker remembers the ids of white-space-free
chunks, with their decoded text, and of pieces it has met (``MEMO`` of each at most, twice).  Decoding looks up each id's
vocabulary string and joins them with a space, as the file's missing decoder
asks for.

Nulls and empty texts give no ids and an empty decoded text.
"""

from __future__ import annotations

import heapq
import json
import struct
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tremor.llm.common import Memo, as_text, cached, id_text, map_batches, sha256_hex

TOKENIZER = "word_bpe_49k.json"
MEMO = 200_000
_PLACE = 40  # bits of a position in a piece


def byte_alphabet() -> list[str]:
    """Printable stand-ins for the 256 byte values (byte-level alphabet): printable Latin-1 bytes
    stand for themselves, the others get code points from 256 on, in order."""
    keep = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


#: The letters and numbers that Unicode 16 added (first and last code point), which the library knows and Python's tables may not.
ADDED = {
    "L": [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
          (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1),
          (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF),
          (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)],
    "N": [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)],
}
#: Lower-case forms that Unicode 16 and 17 added (first and last code point, first lower-case one).
LOWER = [(0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3),
         (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B), (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB)]
_LATE = str.maketrans({c: to + c - first for first, last, to in LOWER for c in range(first, last + 1)})
_LATE_ONE = regex.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b, _ in LOWER) + "]")


def _inside(own: np.ndarray) -> str:
    """The inside of a character class of these code points."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).astype(np.int8)))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()))


@cache
def categories() -> tuple[dict[str, str], regex.Pattern]:
    """Character classes of the letters (L) and numbers (N) of Unicode 16, by Python's own tables and what is ``ADDED``; and a pattern of the
    code points for which the regex module's properties, of another version, say something else."""
    points = "".join(map(chr, range(0x110000)))
    classes, odd = {}, np.zeros(0x110000, bool)
    for kind in "LN":
        own = np.fromiter((unicodedata.category(c)[0] == kind for c in points), bool, len(points))
        for first, last in ADDED[kind]:
            own[first:last + 1] = True
        theirs = np.zeros(0x110000, bool)
        for m in regex.finditer(rf"\p{{{kind}}}+", points):
            theirs[m.start():m.end()] = True
        classes[kind], odd = _inside(own), odd | (own != theirs)
    return classes, regex.compile(f"[{_inside(odd)}]" if odd.any() else r"(?!)")


class Bpe:
    """Encoder and decoder for one tokenizer file (BPE with a word-end suffix, byte-level, no decoder)."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids = vocab
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        # a pair of ids as one number; its rank, room for a position, and the merged id as another
        self.bits = max(17, max(vocab.values()).bit_length())
        self.merges = {vocab[a] << self.bits | vocab[b]: rank << self.bits + _PLACE | vocab[a + b] for rank, (a, b) in enumerate(model["merges"])}
        self.letters = byte_alphabet()
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"]
        self.pieces = regex.compile(pattern)
        classes, self.odd = categories()
        for kind, inside in classes.items():
            pattern = pattern.replace(f"\\p{{{kind}}}", inside)
        self.exact = regex.compile(pattern)  # slower
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.chunks = Memo(self.chunk, MEMO)
        self.merged = Memo(self.merge, MEMO, 32)

    def merge(self, piece: str) -> bytes:
        """Ids of one piece, as little-endian 32-bit integers."""
        letters = [self.letters[b] for b in piece.encode()]
        letters[-1] += self.end
        sym = [self.ids[c] for c in letters if c in self.ids]
        n, bits, get = len(sym), self.bits, self.merges.get
        queue = [found | i << bits for i in range(n - 1) if (found := get(sym[i] << bits | sym[i + 1])) is not None]
        if not queue:
            return struct.pack(f"<{n}I", *sym)
        heapq.heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        low, place = (1 << bits) - 1, (1 << _PLACE) - 1
        while queue:
            entry = heapq.heappop(queue)
            i = entry >> bits & place
            j = after[i]
            if sym[i] < 0 or j >= n or (found := get(sym[i] << bits | sym[j])) is None or found | i << bits != entry:
                continue  # stale: a symbol of this pair was merged since
            whole = sym[i] = entry & low
            sym[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (found := get(whole << bits | sym[k])) is not None:
                    heapq.heappush(queue, found | i << bits)
            h = before[i]
            if h >= 0 and (found := get(sym[h] << bits | whole)) is not None:
                heapq.heappush(queue, found | h << bits)
        left = [s for s in sym if s >= 0]
        return struct.pack(f"<{len(left)}I", *left)

    def chunk(self, chunk: str) -> tuple[bytes, str]:
        """Ids of normalised text without white space, and their decoded text."""
        pieces = self.exact if not chunk.isascii() and self.odd.search(chunk) else self.pieces
        ids = b"".join(map(self.merged.__getitem__, pieces.findall(chunk)))
        return ids, self.show(ids)

    def plain(self, text: str) -> list[tuple[bytes, str]]:
        """Per chunk, the ids of text without special tokens, and their decoded text."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower-case by letter: no final sigma
            text = text.translate(_LATE) if _LATE_ONE.search(text) else text
        if regex.search("[\x1c-\x1f]", text):  # str.split would take these for white space
            chunks = [c for c in regex.sub(r"\s+", " ", text).lower().split(" ") if c]
        else:
            chunks = text.lower().split()
        return list(map(self.chunks.__getitem__, chunks))

    def encode(self, text: str) -> list[tuple[bytes, str]]:
        """The ids of a text in blocks of little-endian 32-bit integers, each with its decoded text."""
        if self.cut is None or "<|" not in text:
            return self.plain(text)
        out: list[tuple[bytes, str]] = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append((struct.pack("<I", self.special[part]), part))
            else:
                out += self.plain(part)
        return out

    def show(self, ids: bytes) -> str:
        """Vocabulary strings of ids, joined with a space."""
        return " ".join([self.strings[i] for i in struct.unpack(f"<{len(ids) // 4}I", ids)])


def load(path: str) -> Bpe:
    with open(path, encoding="utf-8") as f:
        return Bpe(json.load(f))


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def bpe(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
        keep: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256; with ``keep`` also
    ``ids`` (array of long) and ``decoded``.  ``path`` is the tokenizer file, at the same place on every
    machine (default: the installed public one)."""
    df = id_text(docs, id_col, text_col)
    schema = f"doc_id {df.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(part: pa.RecordBatch) -> dict:
        file = path or default_path()
        coder: Bpe = cached(f"bpe {file}", lambda: load(file))
        n, a, b, ids, decoded = [], [], [], [], []
        for text in as_text(part["text"]):
            blocks = coder.encode(text)
            data, back = b"".join([ids for ids, _ in blocks]), " ".join([shown for ids, shown in blocks if ids])
            n.append(len(data) // 4)
            a.append(sha256_hex(data))
            b.append(sha256_hex(back.encode()))
            if keep:
                ids.append(np.frombuffer(data, "<u4").astype(np.int64))
                decoded.append(back)
        out = {"doc_id": part["doc_id"], "n_tokens": pa.array(n, pa.int64()), "ids_sha256": a, "decoded_sha256": b}
        return out | ({"ids": pa.array(ids, pa.list_(pa.int64())), "decoded": pa.array(decoded, pa.string())} if keep else {})

    return map_batches(df, run, schema + (", ids array<long>, decoded string" if keep else ""))


def op10_bpe(docs: DataFrame) -> DataFrame:
    return bpe(docs)

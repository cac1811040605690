"""Benchmark decontamination: one Aho-Corasick automaton over the test items, one pass over each text.

Words are runs of letters, digits and non-ASCII characters after A-Z is
lower-cased.  An item's windows are its runs of ``width`` words (all its words
if it has fewer).  The automaton's alphabet is the items' vocabulary: a
document becomes one sequence of word numbers (0 for any other word), and the
automaton reports every window in it, overlapping ones included.  Matches are
word positions, mapped back to code points of the original text.

The items are a test set, so they are collected; their size is measured first,
and items beyond ``max_words`` words are dealt to further automata, each used in
a pass of its own, so no worker holds more than one bounded automaton.

Nulls: a null text has no words; items with a null id or without words give no
window.  Repeated items count once per id.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import as_bytes, held, id_text, map_batches, union_runs

WIDTH = 10
MAX_WORDS = 200_000

_FOLD = bytes(c if c >= 0x80 or chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz" else c + 32 if 65 <= c <= 90 else 32
              for c in range(256))


def split_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Matcher:
    """The automaton over the windows of some items."""

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        self.number: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            seq = [self.number.setdefault(w, len(self.number) + 1) for w in split_words(text)]
            for at in range(max(1, len(seq) - width + 1) if seq else 0):
                windows.setdefault(tuple(seq[at:at + width]), set()).add(item)
        self.auto = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE) if windows else None
        for key, ids in windows.items():
            self.auto.add_word(key, (len(key), ids))
        if self.auto is not None:
            self.auto.make_automaton()

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word intervals (end exclusive) of all occurrences, and the items they belong to."""
        if self.auto is None or not words:
            return [], set()
        get = self.number.get
        seq = tuple([get(w, 0) for w in words])
        spans, ids = [], set()
        for end, (n, own) in self.auto.iter(seq):
            spans.append((end + 1 - n, end + 1))
            ids |= own
        return spans, ids


def code_point_spans(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code-point offsets of runs of words in the original text."""
    at = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_FOLD))]
    raw = np.frombuffer(text, np.uint8)
    chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return [(int(chars[at[a][0]]), int(chars[at[b - 1][1]])) for a, b in runs]


def item_shards(items: DataFrame, id_col: str, text_col: str, max_words: int) -> list[list[tuple[str, bytes]]]:
    """The items in shards of about ``max_words`` words; one collect per shard."""
    rows = (items.select(items[id_col].cast("string").alias("id"), items[text_col].alias("text"))
            .where("id IS NOT NULL AND text IS NOT NULL"))
    size = rows.select(F.sum(F.size(F.split("text", " ")))).first()[0] or 0
    n = max(1, -(-size // max_words))
    part = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    return [[(r.id, r.text.encode()) for r in (rows if n == 1 else rows.where(part == k)).collect()] for k in range(n)]


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", width: int = WIDTH,
                  max_words: int = MAX_WORDS, keep: tuple[str, ...] = (), prefix: str = "") -> DataFrame:
    """One row per row of ``docs``: doc_id (or the columns ``keep`` in its place), n_words, n_hit, item_ids (list of
    strings, sorted), spans (list of code-point ``start:end`` runs of hit words), these four under ``prefix``."""
    kept = keep or ("doc_id",)
    df = docs if keep else id_text(docs, id_col, text_col)
    text = text_col if keep else "text"
    columns = dict.fromkeys([*kept, text])
    df = df.select(*columns, F.lit(b"").alias("__marks"), F.array().cast("array<string>").alias("__items"))
    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns]
    shards = item_shards(items, item_id, item_text, max_words)
    for k, shard in enumerate(shards):
        last = k == len(shards) - 1
        matcher = held(docs.sparkSession, shard, lambda own: Matcher(own, width))
        schema = ", ".join([*fields[:len(kept)], f"{prefix}n_words long, {prefix}n_hit long, {prefix}item_ids array<string>, {prefix}spans array<string>"] if last
                           else [*fields, "__marks binary, __items array<string>"])

        def scan(part: pa.RecordBatch, matcher=matcher, last=last) -> dict:
            m = matcher()
            n_words, n_hit, items, spans, marks = [], [], [], [], []
            for raw, before, found in zip(as_bytes(part[text]), part["__marks"].to_pylist(), part["__items"].to_pylist()):
                words = split_words(raw)
                hit, ids = m.find(words)
                at = np.concatenate([np.frombuffer(before, np.int64).reshape(-1, 2), np.array(hit, np.int64).reshape(-1, 2)])
                s, e = union_runs(at[:, 0], at[:, 1])
                items.append(sorted(ids.union(found)))
                if last:
                    n_words.append(len(words))
                    n_hit.append(int((e - s).sum()))
                    spans.append([f"{a}:{b}" for a, b in code_point_spans(raw, list(zip(s, e)))] if len(s) else [])
                else:
                    marks.append(np.stack([s, e], 1).tobytes())
            strings = pa.list_(pa.string())
            if last:
                return {c: part[c] for c in kept} | {
                    f"{prefix}n_words": pa.array(n_words, pa.int64()), f"{prefix}n_hit": pa.array(n_hit, pa.int64()),
                    f"{prefix}item_ids": pa.array(items, strings), f"{prefix}spans": pa.array(spans, strings)}
            return {c: part[c] for c in columns} | {"__marks": pa.array(marks, pa.binary()), "__items": pa.array(items, strings)}

        df = map_batches(df, scan, schema)
    return df


def op7_decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = decontaminate(docs, items)
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))

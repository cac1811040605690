"""Language identification by prediction by partial matching.

Per language, a tree of byte contexts up to order 3 holds symbol counts.  A
symbol's probability is that of the longest context that has it, times the
escape probabilities (method C: distinct symbols over distinct symbols plus
occurrences, symbols of longer contexts excluded) of the longer ones; below
order 0 all bytes are alike.  The statistics are frozen after training, so a
symbol's code length depends on its three predecessors only: a language is
a table of code lengths per context that it has seen, and a
text's length under a language is a sum of look-ups.  The shortest code wins;
the score is its share of the posterior under equal priors.

Text is lower-cased; runs of ASCII characters other than letters count as one
space.  Every byte is a symbol of its own, so scripts beside one another stay apart.

Training reads labelled rows of ``train`` only, about ``per_lang`` of each language
chosen by a hash of the id (that bound keeps the model small whatever the
input); their n-grams are counted in the tasks and added up by aggregation.

``und`` with score 0: null texts, texts without a letter (Unicode category L; number signs are none), or no training rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import fold_of, held, map_batches

PER_LANG = 400
ORDER = 3
MAX_LANGS = 1000
_STEP = 1 << 20
_HASH = 1 << 40

_FOLD = bytes(c if c >= 0x80 or 97 <= c <= 122 else 32 for c in range(256))


def prepare(text: str) -> bytes:
    """Folded bytes, after three spaces that stand for the start."""
    return b"   " + b" ".join(text.lower().encode("utf-8", "replace").translate(_FOLD).split()) + b" "


def grams(data: bytes) -> np.ndarray:
    """Each byte with its three predecessors, as a 32-bit number."""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    return b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]


def count_grams(train: DataFrame) -> DataFrame:
    """(lang, gram, n) of a table (lang, text)."""

    def run(part: pa.RecordBatch) -> dict:
        own: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(part["lang"].to_pylist(), part["text"].to_pylist()):
            own.setdefault(lang, []).append(grams(prepare(text)))
        rows = [(lang, *np.unique(np.concatenate(g), return_counts=True)) for lang, g in own.items()]
        return {"lang": pa.array(np.repeat([r[0] for r in rows], [len(r[1]) for r in rows]), pa.string()),
                "gram": np.concatenate([r[1] for r in rows]).astype(np.int64),
                "n": np.concatenate([r[2] for r in rows]).astype(np.int64)}

    return map_batches(train, run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Code lengths in bits.  Every byte of the training texts is a symbol of its own; symbol 0 stands for each byte that they lack.  A language
    has a row of code lengths for every context that it has seen (its longest ones, and those of order 2, 1 and 0 for the rest)."""

    def __init__(self, langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray):
        self.langs = langs
        self.symbol = np.zeros(256, np.int64)
        seen = np.unique(gram >> np.array([24, 16, 8, 0]).reshape(-1, 1) & 255) if len(gram) else np.zeros(0, np.int64)
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        self.q = q = len(seen) + 1
        s = [self.symbol[gram >> k & 255] for k in (24, 16, 8, 0)]
        context = (s[0] * q + s[1]) * q + s[2]
        self.contexts = np.unique(context)  # of order 3, seen in any language
        self.longest = np.empty((len(langs), len(self.contexts)), np.int32)
        self.shorter = np.empty((len(langs), q * q), np.int32)
        self.bits: list[np.ndarray] = []
        for k in range(len(langs)):
            own = lang == k
            three, place = np.unique(context[own], return_inverse=True)
            two, place2 = np.unique(context[own] % (q * q), return_inverse=True)
            c3, c2, c1 = (np.zeros((m, q)) for m in (len(three), len(two), q))
            for counts, at in ((c3, place), (c2, place2), (c1, s[2][own])):
                np.add.at(counts, (at, s[3][own]), n[own])
            c0 = c1.sum(0)
            below = np.searchsorted(two, three % (q * q))  # a context's end has been seen where it has
            rows = [self._lengths([c3, c2[below], c1[three % q], np.broadcast_to(c0, c3.shape)]),
                    self._lengths([c2, c1[two % q], np.broadcast_to(c0, c2.shape)]), self._lengths([c1, np.broadcast_to(c0, c1.shape)])]
            self.bits.append(np.concatenate(rows).astype(np.float32).ravel())
            self.shorter[k] = len(three) + len(two) + np.arange(q * q) % q  # a symbol without successors has the row of order 0
            self.shorter[k, two] = len(three) + np.arange(len(two))
            self.longest[k] = self.shorter[k, self.contexts % (q * q)]
            self.longest[k, np.searchsorted(self.contexts, three)] = np.arange(len(three))

    @staticmethod
    def _lengths(orders: list[np.ndarray]) -> np.ndarray:
        """-log2 of the probability of each symbol (column) in each context (row), longest order first."""
        p = np.zeros(orders[0].shape)
        left = np.ones((len(p), 1))
        out = np.zeros(p.shape, bool)
        for counts in orders:
            c = np.where(out, 0, counts)
            distinct, total = (c > 0).sum(1, keepdims=True), c.sum(1, keepdims=True)
            whole = np.maximum(distinct + total, 1)
            p += left * c / whole
            left = np.where(distinct > 0, left * distinct / whole, left)
            out |= c > 0
        rest = np.maximum(256 - out.sum(1, keepdims=True), 1)
        return -np.log2(np.where(out, p, left / rest))

    def lengths(self, text: str) -> np.ndarray:
        """Code length of a text under each language."""
        s = self.symbol[np.frombuffer(prepare(text), np.uint8)]
        total, q = np.zeros(len(self.langs)), self.q
        for at in range(0, len(s) - 3, _STEP):
            part = s[at:at + _STEP + 3]
            end = part[1:-2] * q + part[2:-1]
            context = part[:-3] * (q * q) + end
            place = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
            known = self.contexts[place] == context
            for k, bits in enumerate(self.bits):
                row = np.where(known, self.longest[k, place], self.shorter[k, end]).astype(np.int64)
                total[k] += bits[row * q + part[3:]].sum(dtype=np.float64)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.langs or not any(map(str.isalpha, text)):
            return "und", 0.0
        length = self.lengths(text)
        best = int(np.argmin(length))
        return self.langs[best], round(float(1 / np.exp2(np.minimum(length[best] - length, 0)).sum()), 6)


def fit(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_lang: int = PER_LANG) -> Model:
    """Fit on about ``per_lang`` rows of each language among the rows that ``train`` names."""
    rows = docs.where(train & docs[lang_col].isNotNull() & docs[text_col].isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang_col).count().limit(MAX_LANGS + 1).collect()}
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    langs = sorted(sizes)
    if not langs:
        return Model([], *[np.zeros(0, np.int64)] * 3)
    limits = F.create_map(*[x for lang in langs for x in (
        F.lit(lang), F.lit(min(_HASH, -(-per_lang * _HASH // sizes[lang]))).cast("long"))])
    chosen = rows.where(F.pmod(F.xxhash64(docs[id_col]), F.lit(_HASH)) < limits[docs[lang_col]])
    counts = count_grams(chosen.select(docs[lang_col].alias("lang"), docs[text_col].alias("text"))).orderBy("lang", "gram")
    found = counts.toPandas()
    number = {lang: k for k, lang in enumerate(langs)}
    return Model(langs, found["lang"].map(number).to_numpy(np.int64), found["gram"].to_numpy(np.int64),
                 found["n"].to_numpy(np.int64))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
             keep: tuple[str, ...] = (), prefix: str = "") -> DataFrame:
    """doc_id (or the columns ``keep`` in its place), lang_pred and lang_score of each row, these two under ``prefix``."""
    df = docs.select(*keep) if keep else docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kept = [f for f in df.schema.fields if keep or f.name == "doc_id"]
    text = text_col if keep else "text"
    get = held(docs.sparkSession, model, lambda m: m)

    def run(part: pa.RecordBatch) -> dict:
        m = get()
        found = [m.predict(t) for t in part[text].to_pylist()]
        return {f.name: part[f.name] for f in kept} | {
            f"{prefix}lang_pred": pa.array([x for x, _ in found], pa.string()),
            f"{prefix}lang_score": pa.array([x for _, x in found], pa.float64())}

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"{prefix}lang_pred string, {prefix}lang_score double"])
    return map_batches(df, run, schema)


def op4_langid(docs: DataFrame) -> DataFrame:
    model = fit(docs, fold_of(docs["doc_id"]) != 2)
    held_out = F.coalesce(fold_of(F.col("doc_id")) == 2, F.lit(False))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred",
                                        F.col("lang_score").alias("score"))

"""Toxicity: Levenshtein automata over a learned lexicon, scored by their context.

The lexicon is learned from labelled rows: words and word beginnings (stems of 4
to 8 letters) that occur in toxic documents far more often than chance explains; every
one that passes is kept, and texts of the same words count once.  A stem must pass in
its documents without such words and longer stems; it stands beside them and never
takes their place.  The lexicon is a trie.  Words are matched by one deterministic automaton, the product of the
trie with the Levenshtein automata of its terms (no error for short terms, one
from 5 letters, two from 9), whose states are made as words reach them; a word
that can match nothing stops early.  Stems match without error.

Every hit is scored in a window of words around it: quotation marks or a reporting
word next to it make it a quotation, otherwise it is abuse.  A document's
features are the strengths of its exact, misspelled and quoted hits; a logistic
model of them, fitted to the same rows, gives the score.

Labels are learned only from the rows the caller names, and of them from about
``max_labels`` chosen by a hash of the id; that bound keeps model and the label table
that is broadcast small whatever the input, and bounds the texts that the lexicon's
terms must pass the tests on.  Null and empty texts
have no hit and get the score of such texts.  Repeated labels of an id count once
(toxic if one says so); null labels do not count.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import Memo, as_text, fold_of, held, id_text, map_batches, slices
from tremor.session import cut_lineage

MAX_LABELS = 40_000
LEAST_TEXTS = 4       # distinct toxic texts of a term
LEAST_ODDS = 1.5      # log odds ratio of a term
MOST = 6.0            # of a feature
THRESHOLD = 0.3
STEMS = (4, 5, 6, 7, 8)
NEAR = 5
_MEMO = 300_000
_STATE_BYTES = 64 << 20
_HASH = 1 << 40

_WORD = re.compile(r"[^\W_]+")
_QUOTES = frozenset("\"'“”„‘’«»‹›`")
_REPORTS = frozenset("said says called calls quote quoted word term wrote sagte genannt wort dit mot appelle dijo palabra".split())


def errors_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """Lexicon trie times Levenshtein automata, made deterministic as words need it."""

    def __init__(self, lexicon: dict[str, float]):
        self.child: list[dict[str, int]] = [{}]
        self.room = [0]          # errors that some term below still allows
        self.word: dict[int, tuple[float, int]] = {}
        self.stem: dict[int, float] = {}
        for term, weight in lexicon.items():
            text, is_stem = term.removesuffix("*"), term.endswith("*")
            allowed, at = 0 if is_stem else errors_allowed(text), 0
            self.room[0] = max(self.room[0], allowed)
            for c in text:
                if c not in self.child[at]:
                    self.child[at][c] = len(self.child)
                    self.child.append({})
                    self.room.append(0)
                at = self.child[at][c]
                self.room[at] = max(self.room[at], allowed)
            if is_stem:
                self.stem[at] = weight
            else:
                self.word[at] = (weight, allowed)
        self.states: dict[bytes, int] = {}
        self.sets: list[bytes] = []  # 4 * node + errors of each state's items, as ints
        self.size = 0
        self.moves: list[dict[str, int]] = []
        self.ends: list[tuple[float | None, tuple[float, int] | None]] = []  # best stem and best word of a state
        self.match = Memo(self.find, _MEMO).__getitem__
        self.start = self._state({(0, 0)})

    def _state(self, items: set[tuple[int, int]]) -> int:
        """Number of the state with these (trie node, errors), closed under skipped letters."""
        todo = list(items)
        while todo:
            node, e = todo.pop()
            for down in self.child[node].values():
                if e < self.room[down] and (down, e + 1) not in items:
                    items.add((down, e + 1))
                    todo.append((down, e + 1))
        best: dict[int, int] = {}
        for node, e in items:
            best[node] = min(e, best.get(node, e))
        key = array("i", sorted(4 * node + e for node, e in best.items())).tobytes()
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.size += len(key)
            self.moves.append({})
            stems = [self.stem[node] for node, e in best.items() if e == 0 and node in self.stem]
            words = [(self.word[node][0] * 0.7 ** e, e) for node, e in best.items() if node in self.word and e <= self.word[node][1]]
            self.ends.append((max(stems, default=None), min(words, key=lambda w: (w[1], -w[0]), default=None)))
        return self.states[key]

    def _move(self, state: int, c: str) -> int:
        after: set[tuple[int, int]] = set()
        for item in array("i", self.sets[state]):
            node, e = item >> 2, item & 3
            if e < self.room[node]:
                after.add((node, e + 1))           # a letter too many
            for letter, down in self.child[node].items():
                if letter == c:
                    after.add((down, e))
                elif e < self.room[down]:
                    after.add((down, e + 1))       # another letter
        self.moves[state][c] = number = self._state(after)
        return number

    def find(self, word: str) -> tuple[float, int] | None:
        """Strength and errors of the best term, or None; ``match`` remembers the results."""
        state, stem = self.start, 0.0
        for c in word:
            step = self.moves[state].get(c)
            state = self._move(state, c) if step is None else step
            if not self.sets[state]:
                break
            if self.ends[state][0] is not None:
                stem = max(stem, self.ends[state][0])
        found = self.ends[state][1]
        if stem and (found is None or found[1] or stem > found[0]):
            found = (stem, 0)
        if len(self.sets) > _MEMO or self.size > _STATE_BYTES:
            self.states, self.sets, self.moves, self.ends, self.size = {}, [], [], [], 0
            self.start = self._state({(0, 0)})
        return found


def hits(auto: Automaton, text: str) -> list[tuple[int, int, float, int, bool]]:
    """(start, end, strength, errors, quoted) of every hit, in code points of the lower-cased text."""
    text = text.lower()
    match = auto.match
    if not any([match(w) for w in set(_WORD.findall(text))]):
        return []
    spans = [m.span() for m in _WORD.finditer(text)]
    out = []
    for k, (a, b) in enumerate(spans):
        if found := match(text[a:b]):
            before = {text[x:y] for x, y in spans[max(0, k - NEAR):k]}
            marks = text[max(0, a - 2):a], text[b:b + 2]
            quoted = bool(before & _REPORTS) or all(_QUOTES & set(m) for m in marks)
            out.append((a, b, *found, quoted))
    return out


def features(auto: Automaton, text: str) -> tuple[float, float, float]:
    """Summed strengths of exact, misspelled and quoted hits, each at most ``MOST``."""
    sums = [0.0, 0.0, 0.0]
    for _, _, strength, errors, quoted in hits(auto, text):
        sums[2 if quoted else 1 if errors else 0] += strength
    return tuple(min(MOST, s) for s in sums)  # type: ignore[return-value]


def terms(words: str, known: frozenset = frozenset()) -> set[str]:
    """Words and stems of words joined by spaces, without those of ``known`` words."""
    found = set(words.split()) - known
    return found | {w[:k] + "*" for w in found for k in STEMS if len(w) > k}


def _counted(df: DataFrame, known: Callable[[], frozenset] = frozenset) -> DataFrame:
    """(term, toxic, clean): rows with the term in a word that is not ``known``, of a table (words, toxic)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            keys = list(own[0] | own[1])
            part = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([own[1][k] for k in keys], pa.int64()),
                                               pa.array([own[0][k] for k in keys], pa.int64())], ["term", "toxic", "clean"])
            own[0].clear(), own[1].clear()
            return part

        for part in slices(batches):
            for words, toxic in zip(as_text(part["words"]), part["toxic"].to_pylist()):
                own[toxic].update(terms(words, known()))
                if len(own[0]) + len(own[1]) > 300_000:
                    yield out()
        yield out()

    return (df.mapInArrow(run, "term string, toxic long, clean long").groupBy("term")
            .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def log_tail(t: int, n: int, p: float) -> float:
    """log of the chance of t or more out of n at rate p (binomial)."""
    lg = math.lgamma
    parts = [lg(n + 1) - lg(k + 1) - lg(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p) for k in range(t, min(n, t + 400) + 1)]
    top = max(parts)
    return top + math.log(sum(math.exp(x - top) for x in parts))


def odds_of(t: int, c: int, toxic: int, clean: int, tests: int) -> float | None:
    """Log odds ratio of a term of t toxic and c clean documents, if it is far more frequent in toxic ones than
    chance explains (0.1 false terms in all ``tests``); else None."""
    rate = toxic / (toxic + clean)
    odds = math.log((t + 0.5) / (toxic - t + 0.5)) - math.log((c + 0.5) / (clean - c + 0.5))
    if odds >= LEAST_ODDS and t > (t + c) * rate and log_tail(t, t + c, rate) < math.log(0.1 / max(1, tests)):
        return odds
    return None


def _passing(counts: DataFrame, sizes: tuple[int, int], tests: int) -> list[tuple[str, int, float]]:
    """(term, toxic, odds) of the counted terms that pass both tests; the tests run in the tasks."""

    def run(part: pa.RecordBatch) -> dict:
        rows = zip(part["term"].to_pylist(), part["toxic"].to_pylist(), part["clean"].to_pylist())
        sure = [(w, t, odds) for w, t, c in rows if (odds := odds_of(t, c, *sizes, tests)) is not None]
        return {"term": pa.array([r[0] for r in sure], pa.string()), "toxic": pa.array([r[1] for r in sure], pa.int64()),
                "odds": pa.array([r[2] for r in sure], pa.float64())}

    return [tuple(r) for r in map_batches(counts, run, "term string, toxic long, odds double").collect()]


def choose_stems(groups: list[tuple[list[str], int, int]], candidates: list[str], sizes: tuple[int, int],
                 tests: int) -> dict[str, float]:
    """Stems and odds of those candidates that still pass in their documents without longer chosen ones, longest first.

    A group is (candidates that are the longest of some word of a document, toxic, clean documents)."""
    within: dict[str, dict[int, list[str]]] = {stem: {} for stem in candidates}
    for at, (longest, _, _) in enumerate(groups):
        for one in longest:
            for k in STEMS:
                if (stem := one[:-1][:k] + "*") in within and len(stem) <= len(one):
                    own = within[stem].setdefault(at, [])
                    if one not in own:
                        own.append(one)
    out: dict[str, float] = {}
    for stem in sorted(candidates, key=lambda s: (-len(s), s)):
        t = c = 0
        for at, ones in within[stem].items():
            if any(not any(one[:k] + "*" in out for k in range(len(stem), len(one))) for one in ones):
                t, c = t + groups[at][1], c + groups[at][2]
        if t >= LEAST_TEXTS and (odds := odds_of(t, c, *sizes, tests)) is not None:
            out[stem] = odds
    return out


def distinct_texts(rows: DataFrame) -> DataFrame:
    """(words, toxic): the distinct lower-case words of each text, joined by spaces.  Texts of the same words count
    once, as toxic if one of them is labelled so."""

    def run(part: pa.RecordBatch) -> dict:
        return {"words": pa.array([" ".join(sorted(set(_WORD.findall(t.lower())))) for t in as_text(part["text"])], pa.string()),
                "toxic": part["toxic"]}

    return map_batches(rows, run, "words string, toxic int").groupBy("words").agg(F.max("toxic").alias("toxic"))


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Lexicon of a table (text, toxic) with both kinds of rows: every word that passes the tests, and every stem that
    passes them in its documents without those words and without longer chosen stems."""
    spark = rows.sparkSession
    once = cut_lineage(distinct_texts(rows))
    sizes = {r[0]: r[1] for r in once.groupBy("toxic").count().collect()}
    if not sizes.get(0):
        return {}  # every clean text is also labelled toxic
    both = (sizes[1], sizes[0])
    often = cut_lineage(_counted(once).where(F.col("toxic") >= LEAST_TEXTS))
    tests = often.count()
    words = {w: odds for w, _, odds in _passing(often.where(~F.col("term").endswith("*")), both, tests)}
    known = held(spark, list(words), frozenset)
    rest = _counted(once, known).where(F.col("term").endswith("*") & (F.col("toxic") >= LEAST_TEXTS))
    stems = [s for s, _, _ in _passing(rest, both, tests)]
    if stems:
        wanted = held(spark, stems, frozenset)

        def longest(part: pa.RecordBatch) -> dict:
            out = []
            for text in as_text(part["words"]):
                own = {max(found, key=len) for w in set(text.split()) - known()
                       if (found := [w[:k] + "*" for k in STEMS if len(w) > k and w[:k] + "*" in wanted()])}
                out.append(" ".join(sorted(own)))
            return {"stems": pa.array(out, pa.string()), "toxic": part["toxic"]}

        groups = (map_batches(once, longest, "stems string, toxic int").where("stems <> ''").groupBy("stems")
                  .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")).collect())
        words |= choose_stems([(r[0].split(), r[1], r[2]) for r in groups], stems, both, tests)
    return {term: min(1.0, odds / 8) for term, odds in words.items()}


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    pull = np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (y - p) - pull * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_labels: int = MAX_LABELS) -> tuple[dict[str, float], np.ndarray]:
    """Lexicon and weights, learned from the rows of ``labels`` that ``train`` names."""
    spark = docs.sparkSession
    known = (labels.where(train & labels[label_col].isNotNull() & labels[id_col].isNotNull())
             .select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("toxic")))
    n = known.count()
    known = known.where(F.pmod(F.xxhash64("id"), F.lit(_HASH)) < min(_HASH, max_labels * _HASH // max(n, 1)))
    known = known.groupBy("id").agg(F.least(F.max("toxic"), F.lit(1)).alias("toxic"))
    texts = id_text(docs, id_col, text_col)
    rows = texts.join(F.broadcast(known), F.col("doc_id") == F.col("id")).select("text", "toxic")
    sizes = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        base = 0.5 if not sizes else 1 / 1000 if 0 in sizes else 1 - 1 / 1000
        return {}, np.array([0, 0, 0, math.log(base / (1 - base))])
    lexicon = learn_lexicon(rows)
    auto = held(spark, lexicon, Automaton)

    def run(part: pa.RecordBatch) -> dict:
        f = [features(auto(), t) for t in as_text(part["text"])]
        return {f"x{k}": pa.array([v[k] for v in f], pa.float64()) for k in range(3)} | {"toxic": part["toxic"]}

    x = (map_batches(rows, run, "x0 double, x1 double, x2 double, toxic int")
         .groupBy("x0", "x1", "x2", "toxic").count().orderBy("x0", "x1", "x2", "toxic").toPandas())
    x = x.loc[x.index.repeat(x["count"])]
    return lexicon, fit_logistic(x[["x0", "x1", "x2"]].to_numpy(), x["toxic"].to_numpy(float))


def toxicity(docs: DataFrame, lexicon: dict[str, float], weights: np.ndarray, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, score, hits (list of start, end, strength, errors, quoted) of each row."""
    df = id_text(docs, id_col, text_col)
    auto = held(docs.sparkSession, lexicon, Automaton)
    kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("strength", pa.float64()), ("errors", pa.int64()),
                      ("quoted", pa.bool_())])

    def run(part: pa.RecordBatch) -> dict:
        scores, found = [], []
        for text in as_text(part["text"]):
            own = hits(auto(), text)
            sums = [0.0, 0.0, 0.0, 1.0]
            for _, _, strength, errors, quoted in own:
                sums[2 if quoted else 1 if errors else 0] += strength
            z = float(np.dot(weights, [*(min(MOST, s) for s in sums[:3]), 1.0]))
            scores.append(round(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), 6))
            found.append([dict(zip(("start", "end", "strength", "errors", "quoted"), h)) for h in own])
        return {"doc_id": part["doc_id"], "score": pa.array(scores, pa.float64()), "hits": pa.array(found, pa.list_(kind))}

    return map_batches(df, run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, score double, "
                       "hits array<struct<start:bigint,end:bigint,strength:double,errors:bigint,quoted:boolean>>")


def op5_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    lexicon, weights = fit(docs, labels, fold_of(labels["doc_id"]) != 2)
    held_out = F.coalesce(fold_of(F.col("doc_id")) == 2, F.lit(False))
    return toxicity(docs, lexicon, weights).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("hits").cast("long").alias("n_hits"))

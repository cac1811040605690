"""The Jaccard join against all pairs, and its parts."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm.helpers import ODD, SF, documents, empty_documents, odd_documents
from tremor.llm import jaccard
from tremor.llm.components import components


def plain_sets(rows):
    out = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        s = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        out[i] = s
    return out


def plain_components(rows):
    sets = plain_sets(rows)
    ids = sorted(sets)
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = {}
    for i in ids:
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    shared = {}
    for own in holders.values():
        for x in range(len(own)):
            for y in range(x):
                shared[own[y], own[x]] = shared.get((own[y], own[x]), 0) + 1
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def group_rows(seed=1):
    """Chains of edits, many near copies of one text, a shared passage in different texts, exact copies."""
    rng = random.Random(seed)
    rows, passage = [], [f"p{k}" for k in range(60)]
    base = [f"b{k}" for k in range(150)]
    for k in range(260):
        rows.append((k, edited(rng, base, rng.randrange(0, 6))))
    for k in range(300, 340):
        rows.append((k, " ".join(passage + [f"z{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 40))])))
    text = [f"c{k}" for k in range(200)]
    for k in range(400, 430):
        text = edited(rng, text, 2).split()
        rows.append((k, " ".join(text)))
    rows += [(500 + k, "one two three") for k in range(5)] + [(510, "One  Two\tthree"), (511, "one two")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [192, 24])
def test_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "FEW", 200_000 if block == 192 else 0)
    rows = group_rows() + [(10**4 + i, t) for i, t in documents()] + [(10**5 + i, t) for i, t in ODD]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.op2_jaccard(odd_documents(spark, rows)).collect()}
    want = plain_components(rows)
    assert {i: got[i] for i in want} == want


def test_frequent_hashes_only_steer(spark, monkeypatch):
    rows = group_rows(2)
    monkeypatch.setattr(jaccard, "frequent_keys", lambda *a, **k: (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    none = {tuple(r) for r in jaccard.op2_jaccard(odd_documents(spark, rows)).collect()}
    monkeypatch.undo()
    assert none == {tuple(r) for r in jaccard.op2_jaccard(odd_documents(spark, rows)).collect()}


def test_tree_misses_no_pair():
    sizes = [5, 30, 31, 32, 33, 70, 500, 4000]
    assert all(jaccard.groups_for(n) * jaccard.PER_GROUP >= n for n in sizes)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, (6, 400)).astype(np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base[k % 6], rng.integers(300, 400), False),
                                      rng.integers(0, 2**63, rng.integers(0, 30)).astype(np.uint64)])) for k in range(150)]
    label = jaccard.solve(sets)
    want = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            o = len(np.intersect1d(sets[a], sets[b]))
            if 100 * o >= 80 * (len(sets[a]) + len(sets[b]) - o):
                x, y = sorted((want[a], want[b]))
                want = [x if v == y else v for v in want]
    assert label.tolist() == want


def test_screen_keeps_every_linked_set():
    rng = np.random.default_rng(4)
    sets = []
    for size in (6, 33, 65, 300, 1100):
        for _ in range(9):
            base = rng.integers(0, 2**63, size).astype(np.uint64)
            sets += [np.unique(base), np.unique(np.append(base[: int(size * 0.9)], rng.integers(0, 2**63, size // 12).astype(np.uint64)))]
    kept = jaccard.screen([jaccard.unpack(jaccard.pack(jaccard.point(s, jaccard.groups_for(len(s))))) for s in sets])
    linked = [any(k != j and jaccard.links(s, t) for j, t in enumerate(sets)) for k, s in enumerate(sets)]
    assert all(k for k, want in zip(kept, linked) if want) and sum(linked) > 40


def test_components(spark):
    edges = [(k, k + 1) for k in range(100, 130)] + [(7, k) for k in range(8, 40)] + [(39, 50), (3, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(100, 131)}, **{k: 7 for k in [*range(7, 40), 50]}}


def test_odd_rows(spark):
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.op2_jaccard(odd_documents(spark)).collect()}
    assert got[1, 0] == 1 and got[2, 0] == 2 and got[6, 1] == 6 and got[7, 1] == 6 and got[None, 1] is None
    assert jaccard.op2_jaccard(empty_documents(spark)).count() == 0
    assert SF

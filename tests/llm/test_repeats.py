"""Repeated substrings against a dictionary of all windows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tests.llm.helpers import ODD, documents, empty_documents, odd_documents
from tremor.llm import repeats


def plain(rows, length=100):
    seen, out = set(), {}
    for i, t in sorted((i, (t or "").encode()) for i, t in rows):
        gone = bytearray(len(t))
        for at in range(len(t) - length + 1):
            w = t[at:at + length]
            if w in seen:
                gone[at:at + length] = b"\1" * length
            seen.add(w)
        rest = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(t), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return out


def passages(seed=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh é", k=rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(n) for n in (14, 16, 17, 18, 19, 25, 60, 200)]
    rows = [(k, text(rng.randrange(0, 40)) + rng.choice(shared) + text(rng.randrange(0, 30))
             + (rng.choice(shared)[3:-2] if k % 3 else "")) for k in range(300)]
    rows += [(400 + k, "ab" * rng.randrange(40, 200)) for k in range(6)] + [(410, "x" * 2000), (411, "y" * 99), (412, "y" * 100)]
    rows += [(420, "q" + shared[5] * 3), (430, "z" * 99 + "w"), (431, "z" * 100 + "w")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block,part", [(256, 2 << 20), (7, 3000)])
def test_equals_all_windows(spark, monkeypatch, block, part):
    monkeypatch.setattr(repeats, "BLOCK", block)
    monkeypatch.setattr(repeats, "PART", part)
    rows = passages() + [(10**5 + i, t) for i, t in documents()] + [(10**6 + i, t) for i, t in ODD]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, at long")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.op3_repeats(df).collect()}
    assert got == plain(rows)


def test_radix_sort():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 2, (500, 24)).astype(np.uint8) * rng.integers(0, 2, (500, 1)).astype(np.uint8)
    rows[200:230] = rows[3]
    group = np.sort(rng.integers(0, 5, 500))
    order, shared = repeats.radix_sort(np.ascontiguousarray(rows).view(">u8").astype(np.uint64), group)
    keys = [(group[k], rows[k].tobytes()) for k in order]
    assert keys == sorted(keys)
    for k in range(1, 500):
        (g, a), (h, b) = keys[k - 1:k + 1]
        want = -1 if g != h else next((i for i in range(24) if a[i] != b[i]), 24)
        assert shared[k] == want


def test_odd_rows(spark):
    got = repeats.remove_repeats(odd_documents(spark), keep=True).collect()
    assert len(got) == odd_documents(spark).count()
    assert all(r.n_removed == 0 for r in got if r.doc_id in (1, 2, 3, 6, 7, None))
    assert all(len(r.kept) == r.n_bytes - r.n_removed for r in got)
    assert repeats.op3_repeats(empty_documents(spark)).count() == 0

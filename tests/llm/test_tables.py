"""Prefix trie, Merkle manifest and piece encoding against plain versions and the library."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.llm.helpers import ODD, SF, documents, empty_documents, odd_documents
from tremor.llm import manifest, pieces, trie


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- conversations -------------------------------------------------------------------------------

def plain_trie(rows):
    by = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            place = ((turn is not None, turn or 0), role.encode(), hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest())
            by.setdefault(c, []).append((*place, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in by.items()}
    full = {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:]
    members, kids, saved, leaves = {}, {}, {}, {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in kids.get(p, []))
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) if p in kids else 1
    return sorted(((m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p],
                    sha(",".join(str(c) for c in m if len(full[c]) == len(p)))) for p, m in members.items()), key=repr)


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS a", "2 AS b", "3 AS pos", "'x' AS sha", "4 AS depth")


def random_turns(seed):
    r = random.Random(seed)
    rows = []
    for c in [None, -25, -20, -3, *range(130)]:
        if r.random() < 0.9:
            rows += [(c, r.choice([t, t, t, None]), r.choice(["user", "assistant", None]), r.choice(["a b", "", "x\ty z é", None, " "]))
                     for t in range(r.choice([1, 1, 2, 3, 5, 9]))]
    rows += [(c, t, "user", "same") for c, n in ((140, 40), (300, 70)) for t in range(n)]
    return rows + rows[:5]


@pytest.mark.parametrize("piece,shard", [(trie.PIECE, trie.SHARD), (8, 64), (1, 16)])
def test_trie_equals_a_plain_one(spark, piece, shard):
    rows = random_turns(piece)
    assert sorted_rows(trie.prefix_trie(conversations(spark, rows), piece=piece, shard=shard)) == plain_trie(rows)


def test_trie_odd_tables(spark):
    assert trie.op11_prefix_trie(conversations(spark, [])).count() == 0
    assert trie.op11_prefix_trie(conversations(spark, [(None, 1, "user", "x")])).count() == 0
    long = [(1, 0, "user", "word " * 30_000), (1, 1, None, None), (2, 0, "user", "word " * 30_000), (7, None, None, "")]
    assert sorted_rows(trie.op11_prefix_trie(conversations(spark, long))) == plain_trie(long)


def test_trie_over_the_table(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in pq.read_table(f"{SF}/conversations.parquet").to_pylist()]
    assert sorted_rows(entry.queries()["op11_prefix_trie"](spark, SF)) == plain_trie(rows)


def test_slots_are_minimal_and_tell_foreign_keys_apart():
    keys = trie.distinct(np.arange(50_000, dtype=np.uint64) // np.uint64(3), np.arange(50_000, dtype=np.uint64) % np.uint64(7))
    table = trie.Slots(*keys)
    slot = table.find(*keys)
    assert sorted(slot.tolist()) == list(range(len(keys[0])))
    assert (table.find(keys[0], keys[1] + np.uint64(100)) == -1).all()
    assert len(trie.Slots(keys[0][:0], keys[1][:0]).find(*keys)) == len(keys[0])


# --- manifest ------------------------------------------------------------------------------------

def plain_manifest(rows):
    def leaf(r):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def tree(nodes):
        paths, where = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, w in enumerate(where):
                run = nodes[w - w % 16:w - w % 16 + 16]
                paths[i].append(("".join(run[:w % 16]), "".join(run[w % 16 + 1:])))
            nodes = [sha("".join(nodes[k:k + 16])) for k in range(0, len(nodes), 16)]
            where = [w // 16 for w in where]
        return nodes[0], paths

    by, out = {}, []
    for r in rows:
        by.setdefault(r[1], []).append(r)
    sources = sorted(by, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for k in sources:
        by[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[k] = tree([leaf(r) for r in by[k]])
    root, above = tree([trees[k][0] for k in sources])
    for k, up in zip(sources, above):
        for r, path in zip(by[k], trees[k][1]):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
            node = leaf((*r[:4], re.sub("[A-Z]", lambda m: m[0].lower(), r[4]))) if tampered else leaf(r)
            for a, b in path + up:
                node = sha(a + node + b)
            out.append((r[0], leaf(r), trees[k][0], root, sha("".join(a + b for a, b in path + up)), node, node == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n,sources,levels", [(1, 1, 3), (17, 1, 1), (300, 40, 1), (700, 3, 1), (700, 3, 2), (5000, 2, 3)])
def test_manifest_equals_a_plain_one(spark, n, sources, levels):
    r = random.Random(n)
    rows = [(r.choice([None, i, i]), r.choice([None, "s0é", "s0é", f"s{r.randrange(sources)}"]), r.choice([None, "en"]), r.choice([None, 5]),
             r.choice([None, "", "Abc É", "plain"])) for i in range(n)]
    rows += rows[:3]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").selectExpr(
        "*", "1 AS idx", "2 AS key", "3 AS block", "'x' AS node")
    tamper = F.coalesce(F.crc32(df["doc_id"].cast("string").cast("binary")) % 5 == 0, F.lit(False))
    assert sorted_rows(manifest.manifest(df, tamper=tamper, levels=levels)) == plain_manifest(rows)


@pytest.mark.parametrize("leaves", [1, 2, 15, 16, 17, 255, 256, 257, 4096, 4100])
def test_addresses_follow_completion_order(leaves):
    names = [f"{i}".encode().ljust(32) for i in range(leaves)]
    log = manifest.append_log(names)
    width = manifest.widths(leaves)
    places = np.concatenate([manifest.postorder(leaves, level, np.arange(w)) for level, w in enumerate(width)])
    assert sorted(places.tolist()) == list(range(sum(width))) and len(log) == 32 * sum(width)
    assert [log[32 * p:32 * p + 32] for p in manifest.postorder(leaves, 0, np.arange(leaves))] == names
    for path, name in zip(manifest.siblings(log, leaves), names):
        assert manifest.fold(name, path) == log[-32:].hex()


def test_manifest_odd_rows(spark):
    odd = odd_documents(spark)
    rows = [tuple(r[c] for c in manifest.FIELDS) for r in odd.collect()]
    assert sorted_rows(manifest.op12_manifest(odd)) == plain_manifest(rows)
    assert manifest.op12_manifest(empty_documents(spark)).count() == 0
    proof = manifest.manifest(odd, keep=True).collect()
    assert all(manifest.fold(bytes.fromhex(r.leaf), list(zip(r.left, r.right))) == r.root for r in proof)


# --- pieces --------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())


def test_pieces_equal_the_library_on_strings(library):
    coder, r = pieces.load(pieces.default_path()), random.Random(3)
    alphabet = [" ", "  ", "   ", "▁", "a", "b", "the", "ing", "\n", "\t", "é", "漢", "\U0001f600", "\0", "�", "<s>", "</s>", "<unk>", "<0x41>",
                "1", "2024", "​", "\x80", "हि"]
    texts = ["".join(r.choices(alphabet, k=r.randrange(15))) for _ in range(5000)]
    texts += [f"x{chr(c)}y" for c in (*range(0x3000), *range(0x3000, 0x110000, 97)) if not 0xD800 <= c < 0xE000]
    for text in texts:
        ids = [i for w in pieces.words(text) for i in coder.segment(w)]
        wanted = library.encode(text, add_eos=True)
        assert ids + [coder.end] == wanted, text
        assert coder.show(ids)[1:].decode() == library.decode(wanted), text


@pytest.mark.parametrize("size,shards", [(pieces.SLICE, None), (60_000, 5)])
def test_pieces_equal_the_library_on_tables(spark, library, size, shards):
    rows = documents() + ODD + [(10**6, "▁▁ x"), (10**6 + 1, "  two  spaces ")]
    df = odd_documents(spark, rows)
    got = pieces.pieces(df.repartition(3), slice_bytes=size, shards=shards, keep=True).collect()
    texts = [(r.doc_id, r.text) for r in df.collect()]
    assert len(got) == len(texts)
    found = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got}
    for i, text in texts:
        ids = library.encode(text or "", add_eos=True)
        assert (i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))) in found, (i, (text or "")[:80])
    assert all(r.ids_sha256 == sha(" ".join(map(str, r.ids))) and r.decoded_sha256 == sha(r.decoded) for r in got)
    assert pieces.op13_pieces(empty_documents(spark)).count() == 0


def test_other_models_are_refused():
    with pytest.raises(ValueError, match="byte-pair model"):
        pieces.Pieces(b"")


def test_queries_cover_their_tables(spark):
    for name in ("op12_manifest", "op13_pieces"):
        assert entry.queries()[name](spark, SF).count() == len(documents())

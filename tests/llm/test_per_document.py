"""PII, decontamination and BPE against plain versions."""

from __future__ import annotations

import hashlib
import re
import struct

import pytest

import __spark_entry__ as entry
from tests.llm.helpers import ODD, SF, documents, empty_documents, odd_documents
from tremor.llm import bpe, decontaminate, pii

sha = lambda b: hashlib.sha256(b).hexdigest()


# --- personal data -------------------------------------------------------------------------------

def plain_spans(text):
    def luhn(d):
        s = 0
        for k, c in enumerate(reversed(d)):
            v = int(c) * (1 + k % 2)
            s += v - 9 if v > 9 else v
        return s % 10 == 0

    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p[-9:]) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]
    return out


TRICKY = ["a@b.c+d@e.f x@@y.zz .@-.- a@b", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1 1.2.3", "4111 1111 1111 1111",
          "4111-1111--1111", "+1 (578) 555-6437 +1+23456789012", "é 4111111111111111 é@x.y ü a@é.x",
          "GB82 WEST 1234 5698 7654 32 and born 1980-02-03, ssn 123-45-6789, 123-45-6789"]


def test_pii_base_spans(spark):
    rows = documents() + [(10**6 + i, t) for i, t in enumerate(TRICKY)] + [(i, t) for i, t in ODD]
    got = {(r.doc_id, r.base_sha256) for r in pii.op1_pii(odd_documents(spark, rows)).collect()}
    want = {(i, sha(",".join(f"{k}:{a}:{b}" for k, a, b in plain_spans(t or "")).encode())) for i, t in rows}
    assert want <= got


def test_pii_method():
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765433")
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    kinds = [k for k, *_ in pii.find(TRICKY[-1])]
    assert kinds.count("iban") == 1 and kinds.count("ssn") == 2 and kinds.count("birth") == 1
    born = lambda day: [k for k, *_ in pii.find(f"she was born on {day} at home")]
    assert born("2001-02-28") == born("29.02.2000") == born("12/31/2030") == ["birth"]
    assert born("2001-02-31") == born("29.02.2001") == born("1899-01-01") == born("2001-13-01") == born("00/10/2001") == []
    assert [k for k, *_ in pii.find("IBAN DE89 3704 0044 0532 0130 00 and GB82 WEST 1234 5698 7654 32")] == ["iban", "iban"]
    assert pii.mod97("DE41370400440532013") and not pii._iban_ok("DE41370400440532013")
    assert not [k for k, *_ in pii.find("on 1980-02-03 the part 123-45-6789 was made") if k in ("birth", "ssn")]
    near, far = pii.find("my card 4111111111111111")[0][3], pii.find("test number 4111111111111111")[0][3]
    assert near > far


# --- benchmark passages --------------------------------------------------------------------------

def plain_hits(text, items, width=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                                 re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, ids = words(text), set(), set()
    for item, t in items:
        v = words(t)
        for k in range(max(1, len(v) - width + 1) if v else 0):
            x = v[k:k + width]
            for at in range(len(w) - len(x) + 1):
                if w[at] == x[0] and w[at:at + len(x)] == x:
                    hit |= set(range(at, at + len(x)))
                    ids.add(str(item))
    return len(w), len(hit), len(ids), sha(",".join(sorted(ids)).encode()), bool(hit)


@pytest.mark.parametrize("max_words", [decontaminate.MAX_WORDS, 300])
def test_decontaminate(spark, max_words):
    items = documents(columns=("doc_id", "text"))[:0]
    import pyarrow.parquet as pq
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    items += [(9001, "short Item"), (9002, None), (9003, ""), (None, "no id"), (9001, "short Item"), (9004, items[0][1])]
    long = re.findall(r"\w+", items[0][1])
    rows = documents()[:120] + [(10**6, "a SHORT, item! é"), (10**6 + 1, "x " + "-".join(long[:11]) + " y"),
                                (10**6 + 2, None), (10**6 + 3, " ".join(long[:9]))] + ODD
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS id", "2 AS doc_id")
    found = decontaminate.decontaminate(odd_documents(spark, rows), bench, max_words=max_words)
    got = {(r.doc_id, r.n_words, r.n_hit, len(r.item_ids), sha(",".join(r.item_ids).encode()), r.n_hit > 0)
           for r in found.collect()}
    assert {(i, *plain_hits(t, [x for x in items if x[0] is not None])) for i, t in rows} <= got
    spans = {r.doc_id: r.spans for r in found.collect()}
    a, b = map(int, spans[10**6][0].split(":"))
    assert "a SHORT, item! é"[a:b] == "SHORT, item"


# --- BPE -----------------------------------------------------------------------------------------

def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bpe.default_path())
    rows = documents() + ODD + [(10**6 + i, x) for i, x in enumerate([
        "Hello  wörld's <|endoftext|>x 12 Σας ΟΔΟΣ\x1cq\x85z İ  à", "<|startoftext|><|endoftext|><|", "é  x　y",
        "I'LL don't WE'VE 's'''s ´s 1234 ½²٣ नमस्ते ไทย 漢字かな", "a\x00b\x1f\x1e c​d ﻿", "\U0001f468‍\U0001f469 é̂ ﬁ ǅ",
        "aaaaaaaaaaaaaaaaaaaaaaaa " * 50, "q" * 3000])]
    rows = [(i, x) for i, x in rows if x is None or "\ud800" > max(x, default="")]
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op10_bpe(odd_documents(spark, rows)).collect()}
    for i, x in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        assert (i, len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(back.encode())) in got, (i, (x or "")[:80])


def test_bpe_equals_the_library_on_every_code_point():
    from tokenizers import Tokenizer
    t, coder = Tokenizer.from_file(bpe.default_path()), bpe.load(bpe.default_path())
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for form in ("x{}y", "1{0}{0}2"):
        texts = [form.format(c) for c in points]
        for text, found in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
            ids = b"".join([ids for ids, _ in coder.encode(text)])
            assert ids == struct.pack(f"<{len(found.ids)}I", *found.ids), ascii(text)


# --- every operator of this file -----------------------------------------------------------------

@pytest.mark.parametrize("name", ["op1_pii", "op10_bpe"])
def test_whole_table_and_odd_rows(spark, name):
    fn = {"op1_pii": pii.op1_pii, "op10_bpe": bpe.op10_bpe}[name]
    assert entry.queries()[name](spark, SF).count() == len(documents())
    odd = odd_documents(spark)
    assert fn(odd).count() == odd.count()
    assert fn(empty_documents(spark)).count() == 0

"""The pipeline against plain versions of its stages, on the whole small table."""

from __future__ import annotations

import hashlib
import re
import struct

import pyarrow.parquet as pq

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.helpers import SF, empty_documents, odd_documents
from tests.llm.test_near_duplicates import plain_components
from tests.llm.test_per_document import plain_hits
from tests.llm.test_scored import plain_lines
from tremor.llm import bpe, langid, lines
from tremor.llm.common import fold_of


def test_equals_plain_stages(spark):
    from tokenizers import Tokenizer
    got = {tuple(r) for r in entry.queries()["pipeline"](spark, SF).collect()}

    rows = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs, fold_of(docs["doc_id"]) != 2)  # its code lengths have a test of their own
    kept = [r for r in rows if re.search(r"[^\W\d_]", r["text"] or "") and model.predict(r["text"])[1] >= 0.5]
    texts = plain_lines([(r["doc_id"], r["text"], r["source"]) for r in kept], lines.MIN_SITES)
    group = plain_components(texts.items())
    texts = {i: t for i, t in texts.items() if group[i][1] == i}
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    texts = {i: t for i, t in texts.items() if not plain_hits(t, items)[4]}
    lib = Tokenizer.from_file(bpe.default_path())
    want = set()
    for i, t in texts.items():
        ids = lib.encode(t, add_special_tokens=False).ids
        want.add((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                  hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == want and 0 < len(want) < len(rows)


def test_stages_keep_columns_and_take_odd_rows(spark):
    for docs in (odd_documents(spark), empty_documents(spark)):
        now = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF)
            assert now.columns == docs.columns and now.dtypes == docs.dtypes
        now.count()
        assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "benchmark", "tokens"]

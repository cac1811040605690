"""Small tables for the operators' tests."""

from __future__ import annotations

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"

LONG = "word " * 30000

ODD = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "x" * 50_000), (6, "Same text here, twice over."),
       (7, "Same text here, twice over."), (8, "\x00\x01퟿ é ☃ \U0001f600"), (9, "a"), (10, "....,,,,")]


def odd_documents(spark, rows=None):
    """Nulls, empty and very long texts, repeated rows, null ids, and extra columns with clashing names."""
    rows = ODD if rows is None else rows
    data = [(i, t, None if i is None or i % 3 else "en", None if i is None or i % 4 == 0 else f"s{i % 5}", i)
            for i, t in rows]
    data += [data[5], (None, "no id", "en", "s1", 3)] if len(data) > 5 else []
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "1 AS n", "'k' AS k", "array(1) AS spans", "0 AS n_words", "'q' AS token", "5 AS site")


def empty_documents(spark):
    return odd_documents(spark, []).where("false")


def documents(sf=SF, columns=("doc_id", "text")):
    t = pq.read_table(f"{sf}/documents.parquet").to_pylist()
    return [tuple(r[c] for c in columns) for r in t]

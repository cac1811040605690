"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tremor.llm import bpe, decontaminate, fingerprint, jaccard, langid, lines, manifest, pieces, pii, repeats, secrets, toxicity, trie
from tremor.llm.common import table
from tremor.llm.twins import ORACLE_SQL  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]


def _over_documents(fn: Callable[..., DataFrame], *others: str) -> Query:
    return lambda spark, sf_dir: fn(*[table(spark, sf_dir, t) for t in ("documents", *others)])


QUERIES: dict[str, Query] = {
    "op1_pii": _over_documents(pii.op1_pii),
    "op2_jaccard": _over_documents(jaccard.op2_jaccard),
    "op3_repeats": _over_documents(repeats.op3_repeats),
    "op4_langid": _over_documents(langid.op4_langid),
    "op5_toxicity": _over_documents(toxicity.op5_toxicity, "labels"),
    "op6_secrets": _over_documents(secrets.op6_secrets),
    "op7_decontaminate": _over_documents(decontaminate.op7_decontaminate, "benchmark"),
    "op8_fingerprints": _over_documents(fingerprint.op8_fingerprints),
    "op9_lines": _over_documents(lines.op9_lines),
    "op10_bpe": _over_documents(bpe.op10_bpe),
    "op11_prefix_trie": lambda spark, sf_dir: trie.op11_prefix_trie(table(spark, sf_dir, "conversations")),
    "op12_manifest": _over_documents(manifest.op12_manifest),
    "op13_pieces": _over_documents(pieces.op13_pieces),
}

"""From documents to token counts: language, boilerplate lines, near duplicates, benchmark passages, tokens.

Each stage takes what the one before kept and returns the columns of documents,
the last one a row of token figures per document:

1. ``language``: documents without a letter, or without a clear language, go; a missing
   language is filled in.
2. ``lines``: lines that many sites share are cut out of the texts, n_chars follows.
3. ``near_duplicates``: of documents linked by shingle similarity the one with the least id stays.
4. ``benchmark``: documents with a passage of a benchmark item go.
5. ``tokens``: byte-pair encoding, decoded again; ids and decoded text as digests.

Rows with a null id pass stages 1 to 4 by their text alone (nothing links them).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.llm import bpe, decontaminate, jaccard, langid, lines
from tremor.llm.common import fold_of, table
from tremor.session import cut_lineage, ensure_checkpoint_dir, remove_folder

CLEAR = 0.5  # least share of the posterior


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs, fold_of(docs["doc_id"]) != 2)
    found = langid.identify(docs, model, keep=tuple(docs.columns), prefix="__")
    found = found.where((F.col("__lang_pred") != "und") & (F.col("__lang_score") >= CLEAR))
    return found.withColumn("lang", F.coalesce("lang", "__lang_pred")).select(*docs.columns)


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = lines.line_dedup(docs, prefix="__")
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cleaned.withColumn("n_chars", F.when(F.col("__lines_removed") > 0, length).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(docs)
    gone = cut_lineage(found.where("component_id != doc_id").select("doc_id").distinct())
    gone = F.broadcast(gone) if gone.count() <= jaccard.FEW else gone
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), keep=tuple(docs.columns),
                                         prefix="__")
    return found.where("__n_hit = 0").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.bpe(docs)


STAGES = [("language", language), ("lines", shared_lines), ("near_duplicates", near_duplicates),
          ("benchmark", benchmark), ("tokens", tokens)]

ORACLE_SQL = None  # language models and byte-pair merges have no SQL form; tests hold a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is a table in the cluster's shared folder, read by the next and then removed; the last
    one stays."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
        if k:
            remove_folder(spark, f"{folder}/{k - 1}-{STAGES[k - 1][0]}")
    return docs

"""Line dedup: lines that many sites share are boilerplate and go.

A line is the text between newlines, its key the hash of the line without white
space at its ends; blank lines have no key.  A line's spread is the number of
distinct sites (values of the source column) whose documents hold it.

A HyperLogLog sketch per key is built in the tasks and merged by aggregation.  Keys
whose estimate lies within three standard errors of ``min_sites`` get an exact
distinct count; the others are decided by the estimate.  Lines with a spread of
``min_sites`` or more are removed wherever they stand, the remaining lines keep
their order and bytes.

The boilerplate keys are counted before use: up to ``SMALL`` of them go to every
task, more are joined by key and gathered per document.

A null source counts for no site.  Null and empty texts keep what they are; a text
whose lines all go becomes empty.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import held, map_batches
from tremor.session import cut_lineage

MIN_SITES = 10
LG_K = 9
SMALL = 250_000
BLANK = " \t\r\x0b\x0c"
_SEED = 42  # of Spark's xxhash64


def line_keys(docs: DataFrame, *cols: str, text_col: str = "text") -> DataFrame:
    """``cols`` and the keys of the document's distinct lines, one row each."""
    lines = F.array_distinct(F.transform(F.split(docs[text_col], "\n"), lambda x: F.btrim(x, F.lit(BLANK))))
    return docs.select(*cols, F.explode(lines).alias("line")).where("line != ''").select(*cols, F.xxhash64("line").alias("key"))


def boilerplate_keys(docs: DataFrame, source_col: str = "source", text_col: str = "text",
                     min_sites: int = MIN_SITES) -> DataFrame:
    """(key) of the lines with a spread of at least ``min_sites``."""
    rows = line_keys(docs.select(docs[source_col].cast("string").alias("site"), docs[text_col].alias("text")), "site")
    rows = rows.where("site IS NOT NULL")
    margin = 3 * 0.8325 / 2 ** (LG_K / 2)
    spread = rows.groupBy("key").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"))
    spread = cut_lineage(spread.where(F.col("sites") >= F.lit(min_sites * (1 - margin))))
    near = F.col("sites") <= F.lit(min_sites * (1 + margin))
    # rows are never dealt by the line alone: few lines are sent to the rows; for more, the pairs of line and site are made distinct first
    doubtful = spread.where(near).select("key")
    pairs = rows.join(F.broadcast(doubtful), "key", "left_semi") if doubtful.count() <= SMALL else rows.distinct().join(doubtful, "key", "left_semi")
    exact = pairs.groupBy("key").agg(F.countDistinct("site").alias("sites")).where(F.col("sites") >= min_sites)
    return spread.where(~near).select("key").union(exact.select("key"))


def _strip(text: str, keys: set) -> tuple[str, int, int]:
    """Text without the lines of these keys, its number of lines, and of removed ones."""
    lines = text.split("\n")
    hashed = xxhash.xxh64_intdigest
    kept = [x for x in lines if not ((s := x.strip(BLANK)) and hashed(s.encode(), _SEED) in keys)]
    return ("\n".join(kept) if len(kept) < len(lines) else text), len(lines), len(lines) - len(kept)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               min_sites: int = MIN_SITES, small: int = SMALL, prefix: str = "") -> DataFrame:
    """The columns of ``docs`` with the text cleaned, then line_count and lines_removed, these two under ``prefix``."""
    keys = boilerplate_keys(docs, source_col, text_col, min_sites)
    few = [r[0] for r in keys.limit(small + 1).collect()]
    fields = docs.schema.fields
    if len(few) <= small:
        df, extra = docs, None
        get = held(docs.sparkSession, few, lambda own: {k % (1 << 64) for k in own})
    else:
        ids = docs.select(docs[id_col].alias("__id"), docs[text_col].alias("text"))
        found = (line_keys(ids, "__id").join(keys, "key", "left_semi").groupBy("__id")
                 .agg(F.collect_set("key").alias("__line_keys")))  # at most the document's own lines
        df, extra = docs.join(found, docs[id_col].eqNullSafe(found["__id"]), "left").drop("__id"), "__line_keys"

    def run(part: pa.RecordBatch) -> dict:
        texts = part[text_col].to_pylist()
        if extra is None:
            own = get()
            done = [None if t is None else _strip(t, own) for t in texts]
        else:
            done = [None if t is None else _strip(t, {k % (1 << 64) for k in k_ or ()})
                    for t, k_ in zip(texts, part[extra].to_pylist())]
        text = pa.array([None if d is None else d[0] for d in done], pa.string())
        return ({f.name: text if f.name == text_col else part[f.name] for f in fields}
                | {f"{prefix}line_count": pa.array([0 if d is None else d[1] for d in done], pa.int64()),
                   f"{prefix}lines_removed": pa.array([0 if d is None else d[2] for d in done], pa.int64())})

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"{prefix}line_count long, {prefix}lines_removed long"])
    return map_batches(df, run, schema)


def op9_lines(docs: DataFrame) -> DataFrame:
    df = line_dedup(docs.select("doc_id", "text", "source"))
    kept = F.coalesce("text", F.lit(""))
    return df.select("doc_id", F.col("line_count").alias("n_lines"), F.col("lines_removed").alias("n_removed"),
                     F.length(kept).cast("long").alias("n_kept_chars"),
                     F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))


OP9_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL),
keyed AS (SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS key FROM lines),
boilerplate AS (SELECT key FROM keyed WHERE key != '' AND source IS NOT NULL GROUP BY key HAVING count(DISTINCT source) >= {MIN_SITES}),
marked AS (SELECT k.*, b.key IS NOT NULL AS gone FROM keyed k LEFT JOIN boilerplate b USING (key)),
kept AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
  length(coalesce(k.text, '')) AS n_kept_chars, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

"""Merkle manifest of a dataset as append logs written in completion order, with proofs.

A leaf is the hash of a row's fields, each written as ``-`` (null) or as its
UTF-8 byte count, ``:`` and its value.  Inside a source the leaves ascend by id
(null first; rows of one id by their leaf); every 16 consecutive nodes, the last run
with fewer, become one node until one remains: the source's subroot.  The subroots,
by source (null first, then bytewise), make the root the same way.

* **Aligned builders.**  A source's leaves are cut at multiples of ``16 ** LEVELS``,
  so a hot source spreads over many builders and a builder's nodes are whole subtrees.  A builder writes
  its nodes in completion order: each node follows the last of its children
  (postorder).  Its log is one row of packed digests.  The tops of a source's blocks are the leaves of its
  next round, until one block is left: three rounds for 16 ** 9 leaves of one source.
* **Addresses.**  Where a node stands in its log follows from the number of leaves alone: a
  subtree that ends with leaf ``e`` stands after the ``ceil(e / 16^q)`` nodes of each level up
  to its own and after the ``ceil(e / 16^q) - 1`` nodes of each level above.  Siblings are
  fetched by address; no tree is kept.
* **Proofs** go from the last round to the first: a block's proof is handed down to its leaves, one row
  a block, and meets them by cogroup.

Groups are bounded by ``16 ** LEVELS`` rows of two digests.  Texts are read once and only digests are shuffled.

Nulls are part of the leaf, so no row is left out; repeated rows are leaves of their own.
A null id is never tampered with.  An empty table has no root and gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.operators.ordering import with_sample_index
from tremor.session import cut_lineage

FAN = 16
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

PATH = "left array<string>, right array<string>"


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()


def leaf_of(*fields: Column) -> Column:
    """Digest (32 bytes) of a row's fields."""
    texts = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[
        F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256))


def source_key(source: Column) -> Column:
    """A text per source that is never null and sorts null first, then bytewise."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), source.cast("string")))


def widths(leaves: int) -> list[int]:
    """Nodes per level of a tree, from its leaves to its top."""
    out = [leaves]
    while out[-1] > 1:
        out.append(-(-out[-1] // FAN))
    return out


def postorder(leaves: int, level: int, node: np.ndarray) -> np.ndarray:
    """Places in the log of nodes of one level."""
    end = np.minimum((node + 1) * FAN ** level, leaves)
    return sum(-(-end // FAN ** q) - (q > level) for q in range(len(widths(leaves)))) - 1


def append_log(leaves: list[bytes]) -> bytes:
    """All nodes in completion order, 32 bytes each; the top is last."""
    out, open_runs = [], [[] for _ in widths(len(leaves))]

    def add(level: int, node: bytes) -> None:
        out.append(node)
        open_runs[level].append(node.hex())
        if len(open_runs[level]) == FAN and level + 1 < len(open_runs):
            close(level)

    def close(level: int) -> None:
        run, open_runs[level] = open_runs[level], []
        add(level + 1, digest("".join(run).encode()))

    for leaf in leaves:
        add(0, leaf)
    for level in range(len(open_runs) - 1):
        if open_runs[level]:
            close(level)
    return b"".join(out)


def siblings(log: bytes, leaves: int) -> list[list[tuple[str, str]]]:
    """Per leaf and level the joined digests of the run's others before and after it, as hex."""
    width, text = widths(leaves), log.hex()
    paths: list[list[tuple[str, str]]] = [[] for _ in range(leaves)]
    for level, n in enumerate(width[:-1]):
        at = (postorder(leaves, level, np.arange(n)) * 64).tolist()
        nodes = [text[a:a + 64] for a in at]
        beside = []
        for j in range(n):
            start, whole = j - j % FAN, nodes[j - j % FAN:j - j % FAN + FAN]
            beside.append(("".join(whole[:j - start]), "".join(whole[j - start + 1:])))
        step = FAN ** level
        for i in range(leaves):
            paths[i].append(beside[i // step])
    return paths


def fold(leaf: bytes, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give, as hex."""
    node = leaf.hex()
    for left, right in path:
        node = hashlib.sha256(f"{left}{node}{right}".encode()).hexdigest()
    return node


def _build(nodes: DataFrame, levels: int) -> DataFrame:
    """(key, block, leaves, top, log) per aligned block of nodes (key, idx, node)."""

    def builder(part: pa.Table) -> pa.Table:
        part = part.sort_by("idx")
        log = append_log(part["node"].to_pylist())
        return pa.table({"key": part["key"][:1], "block": part["block"][:1], "leaves": pa.array([part.num_rows], pa.int64()),
                         "top": pa.array([log[-32:]], pa.binary()), "log": pa.array([log], pa.binary())})

    cut = nodes.select("key", "idx", "node", F.floor(F.col("idx") / FAN ** levels).cast("long").alias("block"))
    built = cut.groupBy("key", "block").applyInArrow(builder, "key string, block long, leaves long, top binary, log binary")
    return cut_lineage(built)


def _lifted(top: Column, leaves: Column, levels: int) -> tuple[Column, Column]:
    """The last block of a source may be lower than the others: single nodes are hashed up to their level."""
    missing = F.lit(0)
    for level in range(levels):
        missing = missing + (leaves <= FAN ** level).cast("int")
    for step in range(1, levels + 1):
        top = F.when(missing >= step, F.unhex(F.sha2(F.lower(F.hex(top)), 256))).otherwise(top)
    return top, missing


def logs(nodes: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """The append logs of every tree of nodes (key, idx, node), round by round: (key, block, leaves, top, log,
    blocks of the key, lift).  The last round has one block per key."""
    rounds = []
    while True:
        built = _build(nodes, levels)
        counts = built.groupBy("key").agg(F.count(F.lit(1)).alias("blocks"))
        joined = built.join(counts, "key")
        top, lift = _lifted(F.col("top"), F.col("leaves"), levels)
        joined = joined.withColumns({"top": F.when(F.col("blocks") > 1, top).otherwise(F.col("top")),
                                     "lift": F.when(F.col("blocks") > 1, lift).otherwise(F.lit(0))})
        rounds.append(joined)
        if not joined.where("blocks > 1").limit(1).count():
            return rounds
        nodes = joined.where("blocks > 1").select("key", F.col("block").alias("idx"), F.col("top").alias("node"))


def tops(rounds: list[DataFrame]) -> DataFrame:
    """(key, node): the top of every tree."""
    found = [r.where("blocks = 1").select("key", F.col("top").alias("node")) for r in rounds]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _proofs(nodes: DataFrame, blocks: DataFrame, levels: int, schema: str, out) -> DataFrame:  # noqa: ANN001
    """``out(rows of a block in order, their paths up to the root, its row)`` for blocks with their own path."""

    def extract(rows: pa.Table, block: pa.Table) -> pa.Table:
        block = block.to_pylist()[0]
        above = [("", "")] * block["lift"] + list(zip(block["left"], block["right"]))
        rows = rows.sort_by("idx")
        return out(rows, [p + above for p in siblings(block["log"], block["leaves"])], block)

    cut = nodes.withColumn("block", F.floor(F.col("idx") / FAN ** levels).cast("long"))
    return cut.groupBy("key", "block").cogroup(blocks.groupBy("key", "block")).applyInArrow(extract, schema)


def _paths(rounds: list[DataFrame], nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """The first round's blocks with (left, right, subroot, root); ``above`` gives them per key."""

    def out(rows: pa.Table, paths: list, block: dict) -> pa.Table:
        n = rows.num_rows
        return pa.table({"key": rows["key"], "block": rows["idx"],
                         "left": pa.array([[a for a, _ in p] for p in paths], pa.list_(pa.string())),
                         "right": pa.array([[b for _, b in p] for p in paths], pa.list_(pa.string())),
                         "subroot": pa.array([block["subroot"]] * n, pa.string()), "root": pa.array([block["root"]] * n, pa.string())})

    schema = f"key string, block long, {PATH}, subroot string, root string"
    down: DataFrame | None = None
    for k in range(len(rounds) - 1, -1, -1):
        found = rounds[k].where("blocks = 1").join(above, "key")
        if down is not None:
            found = found.unionByName(rounds[k].where("blocks > 1").join(down, ["key", "block"]).select(*found.columns))
        if k:
            lower = rounds[k - 1].where("blocks > 1").select("key", F.col("block").alias("idx"))
            down = _proofs(lower, found, levels, schema, out)
        else:
            return found
    raise AssertionError


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", source_col: str = "source",
             text_col: str = "text", tamper: Column | None = None, levels: int = LEVELS, keep: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified; with ``keep`` also
    source and the proof (``left`` and ``right`` siblings per level).  The root is folded from the leaf as it is now: where
    ``tamper`` holds, from the row with its text's A-Z lower-cased."""
    cols = [docs[c] for c in fields]
    now = [F.translate(docs[c], _AZ, _AZ.lower()) if c == text_col else docs[c] for c in fields]
    tamper = F.lit(False) if tamper is None else tamper
    doc_type = docs.schema[id_col].dataType.simpleString()
    source_type = docs.schema[source_col].dataType.simpleString()
    rows = docs.select(source_key(docs[source_col]).alias("key"), docs[id_col].alias("doc_id"), docs[source_col].alias("source"),
                       leaf_of(*cols).alias("node"), F.when(tamper, leaf_of(*now)).alias("now"))
    leaves = with_sample_index(rows, ["key"], ["doc_id", "node"], name="idx")
    # per source; then the sources' tops, in order, as one more tree
    rounds = logs(leaves, levels)
    sources = cut_lineage(with_sample_index(tops(rounds).withColumnRenamed("key", "of"), [], ["of"], name="idx")
                          .withColumn("key", F.lit("")))
    over = logs(sources, levels)
    top, none = F.lower(F.hex("node")), F.array().cast("array<string>")
    whole = tops(over).select("key", none.alias("left"), none.alias("right"), top.alias("subroot"), top.alias("root"))

    def for_sources(part: pa.Table, paths: list, block: dict) -> pa.Table:
        return pa.table({"key": part["of"], "left": pa.array([[a for a, _ in p] for p in paths], pa.list_(pa.string())),
                         "right": pa.array([[b for _, b in p] for p in paths], pa.list_(pa.string())),
                         "subroot": pa.array([x.hex() for x in part["node"].to_pylist()], pa.string()),
                         "root": pa.array([block["root"]] * part.num_rows, pa.string())})

    per_source = cut_lineage(_proofs(sources, _paths(over, sources, whole, levels), levels,
                                     f"key string, {PATH}, subroot string, root string", for_sources))

    def for_rows(part: pa.Table, paths: list, block: dict) -> pa.Table:
        old, new = part["node"].to_pylist(), part["now"].to_pylist()
        folded = [fold(b or a, p) for a, b, p in zip(old, new, paths)]
        n, out = part.num_rows, {"doc_id": part["doc_id"]}
        out |= {"leaf": pa.array([x.hex() for x in old], pa.string()),
                "subroot": pa.array([block["subroot"]] * n, pa.string()), "root": pa.array([block["root"]] * n, pa.string()),
                "proof_sha256": pa.array([digest("".join(a + b for a, b in p).encode()).hex() for p in paths], pa.string()),
                "folded_root": pa.array(folded, pa.string()),
                "verified": pa.array([x == block["root"] for x in folded], pa.bool_())}
        if keep:
            out |= {"source": part["source"], "left": pa.array([[a for a, _ in p] for p in paths], pa.list_(pa.string())),
                    "right": pa.array([[b for _, b in p] for p in paths], pa.list_(pa.string()))}
        return pa.table(out)

    schema = (f"doc_id {doc_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
              "verified boolean" + (f", source {source_type}, {PATH}" if keep else ""))
    return _proofs(leaves, _paths(rounds, leaves, per_source, levels), levels, schema, for_rows)


def op12_manifest(docs: DataFrame) -> DataFrame:
    tampered = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0
    return manifest(docs, tamper=F.coalesce(tampered, F.lit(False)))

"""Prefix trie of conversations: which turns they share, and what sharing saves.

A conversation is its turns (role, text), by turn number (null first; rows of one number by role, then by the SHA-256 of
role and text).  Null role or text is empty.  Rows without conv_id belong to no conversation.  Conversations are
first rebuilt: the head of ``conv_id - conv_id % group`` (its first h turns, h from the checksum of the
conv_id), then their own turns after the first h.

* **Prefix digests.**  A turn is its SHA-256; a prefix's digest is 128 bits of the sums, over its turns, of hashes of
  (position, turn).  Sums go on from piece to piece, so a conversation of any length is cut into pieces of ``PIECE`` turns.
* **Node tables.**  A task takes whole pieces, ``SHARD`` rows or the last piece beyond them, as a shard.  The shard's
  distinct digests get the slots of a minimal perfect hash (:class:`Slots`); a slot holds its digest, and each row's digest, parent and turn
  are compared with the slot's.  Members and least conv_ids are scattered into flat arrays by slot, and the shards' arrays
  are merged by aggregation, which compares parent and turn again: equal digests of different prefixes raise an error
  (another ``salt`` then gives others).
* **Subtree sums.**  A node belongs to its least member.  Its value (tokens saved, childless or not) is sent to that member's piece,
  looked up in the shard's table, and added up through the array of parent slots, deepest level first.  What later pieces of the
  same conversation hold is added at a piece's last node.  The sum over all shards is the sum over the subtree, since a
  node's least member passes through each of its ancestors.
* **Members' digests.**  The conv_ids that end at a node are sorted by range and joined to texts of at most ``CHUNK``
  ids; only such texts meet for the running SHA-256 of a node.

A common first turn, a group of copies or one long conversation is pre-aggregated per shard or cut into pieces, so no
key's rows meet in one task.  Repeated turns are turns like others; an empty table has no root and gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm.common import mix64
from tremor.operators.ordering import with_sample_index
from tremor.session import cut_lineage

PIECE = 1 << 16
SHARD = 1 << 18
CHUNK = 1 << 16
GROUP, HEADS = 20, 4
WORD = r"[^\x20\x09-\x0D]+"


class Slots:
    """Minimal perfect hash of distinct 128-bit keys: level by level, keys alone in their cell take it, the others go on to the
    next level; a key's slot is the number of taken cells before its own.  Every slot holds its key, so foreign keys are told apart."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.a, self.b = np.empty_like(a), np.empty_like(b)
        base = 0
        while len(a):
            at = self._cell(a, b, len(self.levels), 2 * len(a))
            taken = np.bincount(at, minlength=2 * len(a)) == 1
            slot = base + np.cumsum(taken) - 1
            alone = taken[at]
            self.a[slot[at[alone]]], self.b[slot[at[alone]]] = a[alone], b[alone]
            self.levels.append((taken, slot))
            base += int(alone.sum())
            a, b = a[~alone], b[~alone]

    @staticmethod
    def _cell(a: np.ndarray, b: np.ndarray, level: int, cells: int) -> np.ndarray:
        return (mix64(a ^ mix64(b + np.uint64(level + 1))) % np.uint64(cells)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 if it has none."""
        out, open_ = np.full(len(a), -1, np.int64), np.arange(len(a))
        for level, (taken, slot) in enumerate(self.levels):
            at = self._cell(a[open_], b[open_], level, len(taken))
            here = taken[at]
            out[open_[here]] = slot[at[here]]
            open_ = open_[~here]
        same = out >= 0
        same[same] = (self.a[out[same]] == a[same]) & (self.b[out[same]] == b[same])
        return np.where(same, out, -1)


def distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])) if len(a) else np.zeros(0, bool)
    return a[new], b[new]


def _numbers(batch: pa.Table, *names: str) -> list[np.ndarray]:
    return [batch[n].to_numpy().astype(np.int64).view(np.uint64) for n in names]


def _shards(batches: Iterator[pa.RecordBatch], whole: tuple[str, ...], limit: int) -> Iterator[pa.Table]:
    """Tables of at least ``limit`` rows (the last one may be smaller), cut where a ``whole`` group ends."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < limit:
            continue
        cut = 0
        if whole:
            ends = np.zeros(batch.num_rows, bool)
            for name in whole:
                x = batch[name].to_numpy()
                ends[1:] |= x[1:] != x[:-1]
            starts = np.flatnonzero(ends)
            if not len(starts):
                continue  # the group goes on
            cut = int(starts[-1])
        rest = held.pop()
        if cut:
            held.append(rest.slice(0, cut))
            rest = rest.slice(cut)
        else:
            held.append(rest)
            rest = None
        yield pa.Table.from_batches(held)
        held = [rest] if rest is not None else []
        size = rest.num_rows if rest is not None else 0
    if held:
        yield pa.Table.from_batches(held)


def _emit(cols: dict[str, np.ndarray | pa.Array]) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in cols.values()]
    return pa.RecordBatch.from_arrays(arrays, list(cols))


def _count(batches: Iterator[pa.RecordBatch], shard: int) -> Iterator[pa.RecordBatch]:
    """Members and least member per distinct prefix of a shard."""
    for part in _shards(batches, (), shard):
        a, b, up_a, up_b = _numbers(part, "a", "b", "up_a", "up_b")
        table = Slots(*distinct(a, b))
        slot = table.find(a, b)
        n = np.bincount(slot, minlength=len(table.a))
        least = np.full(len(table.a), np.iinfo(np.int64).max)
        np.minimum.at(least, slot, part["conv_id"].to_numpy())
        row = np.zeros(len(table.a), np.int64)
        row[slot] = np.arange(len(slot))
        turn = np.frombuffer(b"".join(part["sha"].to_pylist()), "S32") if len(slot) else np.zeros(0, "S32")
        if not ((up_a == up_a[row][slot]) & (up_b == up_b[row][slot]) & (turn == turn[row][slot])).all():
            raise RuntimeError("two prefixes have one digest: use another salt")
        yield _emit({"a": table.a, "b": table.b, "up_a": up_a[row], "up_b": up_b[row], "depth": part["depth"].to_numpy()[row],
                     "sha": part["sha"].combine_chunks().take(pa.array(row)), "words": part["words"].to_numpy()[row], "n": n, "conv_id": least})


def _accumulate(batches: Iterator[pa.RecordBatch], shard: int, piece: int) -> Iterator[pa.RecordBatch]:
    """Sums of a shard's values over the subtrees of its nodes, as far as their piece goes."""
    for part in _shards(batches, ("conv_id", "piece"), shard):
        path = part.filter(pc.equal(part["kind"], 0))
        value = part.filter(pc.equal(part["kind"], 1))
        a, b, up_a, up_b = _numbers(path, "a", "b", "up_a", "up_b")
        table = Slots(*distinct(a, b))
        slot = table.find(a, b)
        up = np.full(len(table.a), -1, np.int64)
        depth = np.zeros(len(table.a), np.int64)
        depth[slot] = path["depth"].to_numpy()
        up[slot] = table.find(up_a, up_b)
        up[(depth == 0) | (depth > 1) & ((depth - 1) % piece == 0)] = -1  # the root, and the first nodes of later pieces
        sums = {"saved": np.zeros(len(table.a), np.int64), "leaves": np.zeros(len(table.a), np.int64)}
        home = table.find(*_numbers(value, "a", "b"))
        for name, total in sums.items():
            np.add.at(total, home, value[name].to_numpy())
        order = np.argsort(-depth, kind="stable")
        cuts = np.append(0, np.cumsum(np.unique(-depth, return_counts=True)[1]))
        for s, e in zip(cuts, cuts[1:]):  # deepest first
            level = order[s:e]
            level = level[up[level] >= 0]
            for total in sums.values():
                np.add.at(total, up[level], total[level])
        some = (sums["saved"] != 0) | (sums["leaves"] != 0)
        yield _emit({"a": table.a[some], "b": table.b[some]} | {k: v[some] for k, v in sums.items()})


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of conv_ids that end at one node, joined; rows are sorted by node and conv_id."""
    for part in _shards(batches, (), CHUNK):
        a, b = _numbers(part, "a", "b")
        ids = part["conv_id"].to_numpy()
        start = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        texts = [",".join(map(str, ids[s:e].tolist())) for s, e in zip(start, np.append(start[1:], len(ids)))]
        yield _emit({"a": a[start], "b": b[start], "first": ids[start], "ids": pa.array(texts, pa.string())})


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of all texts of a node, in order."""
    key, running = None, None
    for batch in batches:
        out = []
        for a, b, ids in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), batch["ids"].to_pylist()):
            if (a, b) == key:
                running.update(b",")
            else:
                out += [(*key, running.hexdigest())] if key else []
                key, running = (a, b), hashlib.sha256()
            running.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["a", "b", "ends"])
    if key:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, running.hexdigest())], ["a", "b", "ends"])


def rebuilt(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, pos, sha, words, last) of the rebuilt conversations, and (conv_id, length) of each.

    A head has fewer than ``heads`` turns, so a group's head is one small array."""
    role, text = (F.coalesce(turns[c].cast("string"), F.lit("")) for c in ("role", "text"))
    own = turns.where(turns["conv_id"].isNotNull()).select(
        turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].alias("turn"), role.alias("role"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("sha"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    own = with_sample_index(own, ["conv_id"], ["turn", "role", "sha"], name="i")
    head = (own.where((F.col("conv_id") % group == 0) & (F.col("i") < heads - 1)).groupBy(F.col("conv_id").alias("donor"))
            .agg(F.sort_array(F.collect_list(F.struct("i", "sha", "words"))).alias("head")))
    convs = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % group).alias("donor"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"))
    taken = F.least(F.col("h"), F.coalesce(F.size("head"), F.lit(0)).cast("long"))
    convs = cut_lineage(convs.join(head, "donor", "left").withColumn("taken", F.greatest(taken, F.lit(0).cast("long")))
                        .withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long"))))
    first = (convs.where("taken > 0").withColumn("t", F.explode(F.slice("head", F.lit(1), F.col("taken").cast("int"))))
             .select("conv_id", F.col("t.i").alias("pos"), "t.sha", "t.words", "length"))
    after = (own.join(convs.select("conv_id", "h", "taken", "length"), "conv_id").where(F.col("i") >= F.col("h"))
             .select("conv_id", (F.col("i") - F.col("h") + F.col("taken")).alias("pos"), "sha", "words", "length"))
    rows = first.unionByName(after).withColumn("last", F.col("pos") == F.col("length") - 1).drop("length")
    return rows, convs.select("conv_id", "length")


def _node(salt: int, depth: Column, sums: list[Column]) -> list[Column]:
    return [F.xxhash64(F.lit(salt + k), depth.cast("long"), *sums) for k in (0, 1)]


def paths(rows: DataFrame, convs: DataFrame, salt: int, piece: int) -> DataFrame:
    """One row per conversation and prefix (the empty one too): (conv_id, piece, depth, a, b, up_a, up_b, sha, words, last)."""
    hashes = [F.xxhash64(F.lit(salt + k), "pos", "sha") for k in (0, 1)]
    halves = {f"x{2 * k + s}": F.shiftrightunsigned(x, 32 * s).bitwiseAND(F.lit(0xFFFFFFFF)) for k, x in enumerate(hashes) for s in (0, 1)}
    rows = rows.withColumns({"piece": F.floor(F.col("pos") / piece).cast("long"), **halves})
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    done = (rows.groupBy("conv_id", "piece").agg(*[F.sum(x).alias(x) for x in halves])
            .select("conv_id", "piece", *[F.sum(x).over(before).alias(f"o{x}") for x in halves]).where("piece > 0"))
    rows = rows.join(done, ["conv_id", "piece"], "left")
    so_far = Window.partitionBy("conv_id", "piece").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"s{x}": F.sum(x).over(so_far) + F.coalesce(f"o{x}", F.lit(0).cast("long")) for x in halves})
    depth, sums = F.col("pos") + 1, [F.col(f"s{x}") for x in halves]
    a, b = _node(salt, depth, sums)
    up_a, up_b = _node(salt, F.col("pos"), [F.col(f"s{x}") - F.col(x) for x in halves])
    found = rows.select("conv_id", "piece", depth.alias("depth"), a.alias("a"), b.alias("b"), up_a.alias("up_a"), up_b.alias("up_b"),
                        "sha", "words", "last")
    zero = F.lit(0).cast("long")
    root_a, root_b = _node(salt, zero, [zero] * 4)
    roots = convs.select("conv_id", zero.alias("piece"), zero.alias("depth"), root_a.alias("a"), root_b.alias("b"), zero.alias("up_a"),
                         zero.alias("up_b"), F.unhex(F.lit("00" * 32)).alias("sha"), zero.alias("words"), (F.col("length") == 0).alias("last"))
    return found.unionByName(roots)


def _one(name: str) -> Column:
    """The one value of a group, or an error."""
    wrong = F.raise_error(F.lit("two prefixes have one digest: use another salt"))
    return F.when(F.min(name) == F.max(name), F.min(name)).otherwise(wrong.cast("binary" if name == "sha" else "long")).alias(name)


def prefix_trie(turns: DataFrame, group: int = GROUP, heads: int = HEADS, salt: int = 0, piece: int = PIECE,
                shard: int = SHARD) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    path = cut_lineage(paths(*rebuilt(turns, group, heads), salt, piece))
    counted = path.mapInArrow(partial(_count, shard=shard), "a long, b long, up_a long, up_b long, depth long, sha binary, words long, n long, conv_id long")
    nodes = cut_lineage(counted.groupBy("a", "b").agg(
        F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), *[_one(x) for x in ("up_a", "up_b", "depth", "sha", "words")]))
    inner = nodes.where("depth > 0")
    children = inner.groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = cut_lineage(nodes.join(children, ["a", "b"], "left").fillna(0, ["n_children"]).drop("sha"))

    # values go to the piece of the node's least member
    zero = F.lit(0).cast("long")
    at = F.floor(F.greatest(F.col("depth") - 1, zero) / piece).cast("long")
    keys = ["conv_id", "piece", "depth", "a", "b"]
    values = nodes.withColumn("piece", at).select(*keys, ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
                                                  (F.col("n_children") == 0).cast("long").alias("leaves")).where("saved <> 0 or leaves <> 0")
    later = Window.partitionBy("conv_id").orderBy(F.desc("piece")).rowsBetween(Window.unboundedPreceding, -1)
    edge = path.where(F.col("depth") == (F.col("piece") + 1) * piece).select(*keys)  # a piece's last node, if it is full
    per_piece = values.select("conv_id", "piece", "saved", "leaves").unionByName(edge.select("conv_id", "piece", zero.alias("saved"), zero.alias("leaves")))
    tails = (per_piece.groupBy("conv_id", "piece").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
             .select("conv_id", "piece", F.sum("saved").over(later).alias("saved"), F.sum("leaves").over(later).alias("leaves")))
    handed = edge.join(tails.where("saved <> 0 or leaves <> 0"), ["conv_id", "piece"])
    none = {"up_a": zero, "up_b": zero}
    rows = (path.select(*keys, "up_a", "up_b").withColumns({"saved": zero, "leaves": zero, "kind": F.lit(0)})
            .unionByName(values.unionByName(handed.select(*values.columns)).withColumns(none | {"kind": F.lit(1)})))
    sums = (rows.repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece")
            .mapInArrow(partial(_accumulate, shard=shard, piece=piece), "a long, b long, saved long, leaves long")
            .groupBy("a", "b").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves")))

    ended = path.where("last").select("a", "b", "conv_id")
    texts = (ended.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
             .mapInArrow(_join_ids, "a long, b long, first long, ids string"))
    ends = (texts.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(_hash_ids, "a long, b long, ends string"))

    parents = nodes.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"), F.lit(True).alias("inner"))
    joined = (nodes.join(sums, ["a", "b"], "left").join(ends, ["a", "b"], "left")
              .withColumn("inner", F.col("depth") > 0).join(parents, ["up_a", "up_b", "inner"], "left"))
    empty = hashlib.sha256(b"").hexdigest()
    return joined.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", zero).alias("n_leaves"),
                         F.coalesce("saved_tokens", zero).alias("saved_tokens"), F.coalesce("ends", F.lit(empty)).alias("ends_sha256"))


def op11_prefix_trie(turns: DataFrame) -> DataFrame:
    return prefix_trie(turns)

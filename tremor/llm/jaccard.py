"""N-gram Jaccard join: near-duplicate documents by shingle sets, found with R-trees of count vectors.

A document's set holds its distinct runs of ``WIDTH`` words (its whole word sequence
if it has fewer), as 64-bit hashes.  Two documents link when intersection over union
reaches 80 %.

Point and bound: the hashes fall into groups, a power of two of them so that a group holds
``PER_GROUP`` at most on average; the counts per group are a point.  (Points of different
lengths are compared at the shorter one, the longer one folded.)  The sum over groups of the smaller count bounds the overlap of two sets, and
with a box's upper corner in place of a point, that of a set with every set in
the box.  An R-tree packs the points by size and first coordinates; a query walks
down the boxes whose bound reaches the overlap it needs, and the pairs that survive
at the leaves are verified on the hashes.

Spreading the work without losing a link:

1. Documents with equal sets are one class, represented by the least id.
2. Each set is ordered by one global order, frequent hashes last.  Sets that link
   share a hash among the first n - ceil(0.8 n) + 1 of both (prefix filter).  The
   holders of a hash belong together; they are gathered under the smallest holder, the
   hub, so that hashes with the same holders give one group and not many.
   Frequent hashes (a bounded list) get their hub by a partial aggregation and a
   broadcast of at most that many rows; the others are rare by construction.
3. Groups are searched twice, each with an R-tree: first on the points alone, which
   drops the documents that no other one of the group can link with (groups of more than
   ``SCREEN`` documents skip this), then, for those left, with their texts, verifying.
4. A large group is dealt into blocks of at most ``BLOCK`` documents;
   each block also holds the group's center (its smallest document) and is solved by itself.
   Documents that are not joined to the center there meet every other block in a second
   step.  Documents that are joined to it need no further comparison with one another, so copies and near
   copies cost in proportion to their number.
5. Within a task, pairs already joined are skipped: the links that come out
   keep the components (a spanning set), not every pair.

Components come from the links by distributed star contraction; nothing of the
size of the corpus reaches the driver.

Null and empty texts and texts without words have an empty set and link with
nothing.  Rows that share an id are one document; rows with a null id link with nothing and
have a null component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from tremor.llm.common import RunningHash, as_bytes, frequent_keys, held, id_text, map_batches, mix64, slices, tidy
from tremor.llm.components import components
from tremor.session import cut_lineage

WIDTH = 5
SHARE = 80           # per cent
PER_GROUP = 8
LEAF = 32
SCREEN = 1024        # documents of a group that one task screens together
BLOCK = 192          # documents of a group that one task solves together
BLOCK_HASHES = 1_000_000
PART = 1 << 20       # bytes that one vectorised step takes
FEW = 200_000        # rows that are broadcast at most

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of the texts in order, and the number of words of each text.

    Words are runs of bytes other than ASCII white space; A-Z count as a-z.  A word's hash is taken from one
    running sum over all texts.
    """
    data = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
    blank = _BLANK[data]
    start = np.flatnonzero(np.append(True, blank[:-1]) & ~blank)
    end = np.flatnonzero(np.append(False, ~blank[:-1]) & blank)
    h = RunningHash(data).of(start, end)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return h, np.diff(np.searchsorted(start, ends), prepend=0)


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        size, to = 0, at
        while to < len(texts) and (to == at or size + len(texts[to]) <= PART):
            size += len(texts[to])
            to += 1
        h, n = word_hashes(texts[at:to])
        whole = _joined(h, width)
        first = 0
        for k in n.tolist():
            out.append(np.unique(whole[first:first + k - width + 1]) if k >= width else _joined(h[first:first + k], max(k, 1)))
            first += k
        at = to
    return out


def _joined(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` word hashes."""
    m = max(0, len(h) - size + 1)
    out = np.full(m, size, np.uint64)
    for k in range(size if m else 0):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) ^ h[k:k + m])
    return out


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    return shingle_sets([text], width)[0]


def groups_for(n: int) -> int:
    """Number of groups for sets of n hashes."""
    return 1 << max(3, (max(n, 1) - 1) // PER_GROUP).bit_length()


def point(h: np.ndarray, groups: int) -> np.ndarray:
    """Hashes per group."""
    return np.bincount((h & np.uint64(groups - 1)).astype(np.intp), minlength=groups).astype(np.int32)


def fold(p: np.ndarray, groups: int) -> np.ndarray:
    """The point for fewer groups."""
    return p.reshape(-1, groups).sum(0) if len(p) > groups else p


def pack(p: np.ndarray) -> bytes:
    """A point in the smallest integers that hold its largest count, after their width."""
    top = p.max()
    kind = np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32
    return bytes([np.dtype(kind).itemsize]) + p.astype(kind).tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, {1: np.uint8, 2: np.uint16, 4: np.uint32}[data[0]], offset=1).astype(np.int32)


def prefix(h: np.ndarray, often: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first n - ceil(0.8 n) + 1 hashes in the global order, the rare and the frequent ones."""
    size = len(h) - -(-SHARE * len(h) // 100) + 1 if len(h) else 0
    at = np.minimum(np.searchsorted(often, h), max(len(often) - 1, 0))
    known = often[at] == h if len(often) else np.zeros(len(h), bool)
    rare = h[~known]
    if len(rare) >= size:
        return rare[:size], h[:0]
    late = h[known]
    return rare, late[np.lexsort((late, counts[at[known]]))][:size - len(rare)]


def profiles(docs: DataFrame) -> DataFrame:
    """doc_id, n (set size), digest and point of the set, rare and frequent prefix hashes."""
    often = frequent_keys(docs.select("text"), lambda part: np.concatenate(shingle_sets(as_bytes(part["text"]))))
    get = held(docs.sparkSession, often, lambda o: o)

    def run(part: pa.RecordBatch) -> dict:
        n, digest, points, rare, late = [], [], [], [], []
        for h in shingle_sets(as_bytes(part["text"])):
            a, b = prefix(h, *get())
            n.append(len(h))
            digest.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
            points.append(pack(point(h, groups_for(len(h)))) if len(h) else None)
            rare.append(a.view(np.int64))
            late.append(b.view(np.int64))
        longs = pa.list_(pa.int64())
        return {"doc_id": part["doc_id"], "n": pa.array(n, pa.int64()), "digest": pa.array(digest, pa.binary()),
                "point": pa.array(points, pa.binary()), "rare": pa.array(rare, longs), "late": pa.array(late, longs)}

    return map_batches(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, digest binary, "
                                  "point binary, rare array<long>, late array<long>")


def hub_pairs(sets: DataFrame) -> DataFrame:
    """(hub, doc, n): documents that share a prefix hash with the hub, the hub itself included."""
    rare = sets.select("doc_id", "n", F.explode("rare").alias("h"))
    by = Window.partitionBy("h").orderBy("n", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    rare = rare.select(F.first("doc_id").over(by).alias("hub"), "doc_id", "n", F.first("n").over(by).alias("hub_n"))
    late = sets.select("doc_id", "n", F.explode("late").alias("h"))
    least = (late.groupBy("h").agg(F.min(F.struct("n", "doc_id")).alias("hub"), F.count("*").alias("c"))
             .where("c > 1").select("h", "hub"))  # at most as many rows as there are frequent hashes
    late = late.join(F.broadcast(least), "h").select(F.col("hub.doc_id").alias("hub"), "doc_id", "n",
                                                     F.col("hub.n").alias("hub_n"))
    pairs = rare.union(late).where("hub != doc_id").distinct()
    hubs = pairs.select("hub", F.col("hub").alias("doc_id"), F.col("hub_n").alias("n")).distinct()
    return pairs.select("hub", "doc_id", "n").union(hubs)


class Tree:
    """R-tree over count vectors, packed from points in order of size and first coordinates."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.levels = []
        hi, low, high = points, sizes, sizes
        while len(hi) > 1 or not self.levels:
            cut = np.arange(0, len(hi), LEAF)
            hi, low, high = (np.maximum.reduceat(hi, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut))
            self.levels.append((hi, low, high))

    def leaves(self, point: np.ndarray, size: int, wanted: np.ndarray) -> np.ndarray:
        """Leaves with a wanted point that a set with this point could reach."""
        marks = [np.logical_or.reduceat(wanted, np.arange(0, len(wanted), LEAF))]
        while len(marks) < len(self.levels):
            marks.append(np.logical_or.reduceat(marks[-1], np.arange(0, len(marks[-1]), LEAF)))
        nodes = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            hi, low, high = self.levels[depth]
            nodes = nodes[marks[depth][nodes]]
            need = needed(size, np.maximum(low[nodes], -(-SHARE * size // 100)))
            fits = (100 * high[nodes] >= SHARE * size) & (100 * size >= SHARE * low[nodes])
            nodes = nodes[fits & (np.minimum(hi[nodes], point).sum(1) >= need)]
            if depth:
                down = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
                nodes = down[down < len(self.levels[depth - 1][0])]
        return nodes


def needed(size: int, others: np.ndarray) -> np.ndarray:
    """Least overlap with which sets of these sizes link: 100 o >= 80 (a + b - o)."""
    return -(-SHARE * (size + others) // (100 + SHARE))


def packed_order(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Order in which points are packed into leaves: by size, then by the first coordinates."""
    slab = np.argsort(np.argsort(sizes, kind="stable")) // (LEAF * LEAF)
    return np.lexsort((points[:, 2], points[:, 1], points[:, 0], slab))


def reachable(tree: Tree, p: np.ndarray, n: np.ndarray, i: int, wanted: np.ndarray) -> np.ndarray:
    """Wanted places whose set might link with that of place i."""
    found = tree.leaves(p[i], int(n[i]), wanted)
    at = (found[:, None] * LEAF + np.arange(LEAF)).ravel()
    at = at[at < len(p)]
    at = at[wanted[at]]
    return at[np.minimum(p[at], p[i]).sum(1) >= needed(int(n[i]), n[at])]


def screen(points: list[np.ndarray]) -> np.ndarray:
    """Which points of a group have another one that they might link with.  Sets that link differ in size by a
    quarter at most, so their points have the same length, or one has twice the other's."""
    length, keep = np.array([len(p) for p in points]), np.zeros(len(points), bool)
    for g in np.unique(length):
        at = np.flatnonzero((length == g) | (length == 2 * g))
        if len(at) > 1:
            keep[at] |= _screen(np.stack([fold(points[k], g) for k in at]), length[at] == g)
    return keep


def _screen(points: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The same for points of one length; pairs without one of ``own`` do not count."""
    sizes = points.sum(1)
    if len(points) <= LEAF:  # one leaf: its points are compared directly
        both = np.minimum(points[:, None], points[None]).sum(2) >= needed(sizes[:, None], sizes[None])
        both &= own[:, None] | own[None]
        np.fill_diagonal(both, False)
        return both.any(1)
    order = packed_order(points, sizes)
    p, n, mine = points[order], sizes[order], own[order]
    tree, keep = Tree(p, n), np.zeros(len(p), bool)
    for i in range(len(p)):
        if not keep[i]:
            wanted = np.ones(len(p), bool) if mine[i] else mine.copy()
            wanted[i] = False
            partners = reachable(tree, p, n, i, wanted) if wanted.any() else []
            if len(partners):
                keep[i] = True
                keep[partners] = True
    out = np.zeros(len(p), bool)
    out[order] = keep
    return out


def solve(sets: list[np.ndarray], queries: np.ndarray | None = None) -> np.ndarray:
    """Component labels (least position) of sets of one group; links between queries and all others count, or
    between all sets if ``queries`` is None.  The first set is the hub."""
    m = len(sets)
    label = np.arange(m)
    if m == 2:
        if links(sets[0], sets[1]):
            label[1] = 0
        return label
    sizes = np.array([len(s) for s in sets])
    points = np.stack([point(s, groups_for(int(sizes.max()))) for s in sets])
    order = packed_order(points, sizes)
    back = np.empty(m, np.intp)
    back[order] = np.arange(m)
    p, n, lab = points[order], sizes[order], np.arange(m)
    tree = Tree(p, n)
    asked = order if queries is None else order[queries[order]]
    for i in back[np.concatenate((asked[asked == 0], asked[asked != 0]))]:  # the hub first: copies join it at once
        wanted = lab != lab[i]
        if not wanted.any():
            continue
        for j in reachable(tree, p, n, i, wanted):
            if lab[j] != lab[i] and links(sets[order[i]], sets[order[j]]):
                a, b = sorted((lab[i], lab[j]))
                lab[lab == b] = a
    for own in np.unique(lab):
        group = order[lab == own]
        label[group] = group.min()
    return label


def links(a: np.ndarray, b: np.ndarray) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= SHARE * (len(a) + len(b) - both)


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], column: str, make) -> Iterator[tuple]:
    """(key, ids, roles, values) of each group of rows sorted by the keys; ``make`` turns a batch's column into values."""
    key, ids, roles, values = None, [], [], []
    for part in slices(batches):
        if not part.num_rows:
            continue
        rows = zip(zip(*(part[c].to_pylist() for c in keys)), part["doc_id"].to_pylist(), part["role"].to_pylist(), make(part[column]))
        for now, own, role, value in rows:
            if now != key:
                if key is not None:
                    yield key, ids, roles, values
                key, ids, roles, values = now, [], [], []
            ids.append(own), roles.append(role), values.append(value)
    if key is not None:
        yield key, ids, roles, values


def _emitted(rows: Iterator[tuple], kind: pa.DataType, names: list[str]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c in zip(*out)], names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c in zip(*out)], names)


def _screened(members: DataFrame, points: DataFrame, id_type: str, kind: pa.DataType) -> DataFrame:
    """(hub, doc_id) of the members of groups of up to SCREEN documents that have a possible partner in the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def kept() -> Iterator[tuple]:
            for (hub,), ids, _, values in _groups(batches, ("hub",), "point", lambda c: [unpack(x) for x in c.to_pylist()]):
                for own, keep in zip(ids, screen(values)):
                    if keep:
                        yield hub, own

        yield from _emitted(kept(), kind, ["hub", "doc_id"])

    rows = members.join(points, "doc_id").select("hub", F.lit(0).alias("role"), "doc_id", "point")
    return rows.repartition("hub").sortWithinPartitions("hub").mapInArrow(tidy(run), f"hub {id_type}, doc_id {id_type}")


def _solved(rows: DataFrame, id_type: str, kind: pa.DataType) -> DataFrame:
    """Solve the groups of rows (hub, center, block, other, role, doc_id, text); (a, b, hub): links, and rows with b
    null for documents that are not joined to the center."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for (hub, center, _, _), ids, roles, sets in _groups(batches, ("hub", "center", "block", "other"), "text",
                                                                 lambda c: shingle_sets(as_bytes(c))):
                order = sorted(range(len(ids)), key=lambda k: (ids[k] != center, ids[k], roles[k]))
                asked = np.array([roles[k] == 1 for k in order])
                label = solve([sets[k] for k in order], asked if asked.any() else None)
                names = [ids[k] for k in order]
                for k, own in enumerate(label):
                    if own != k:
                        yield names[k], names[own], hub
                    if own != 0 and not asked.any() and names[k] != center:
                        yield names[k], None, hub

        yield from _emitted(found(), kind, ["a", "b", "hub"])

    return (rows.select("hub", "center", "block", "other", "role", "doc_id", "text").repartition("hub", "block", "other")
            .sortWithinPartitions("hub", "center", "block", "other").mapInArrow(tidy(run), f"a {id_type}, b {id_type}, hub {id_type}"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, class_id (least id with the same set) and component_id of each row of ``docs``."""
    df = id_text(docs, id_col, text_col)
    id_type = df.schema["doc_id"].dataType.simpleString()
    kind = to_arrow_type(df.schema["doc_id"].dataType)
    own = cut_lineage(profiles(df))
    classes = own.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("class_id"))
    copies = (own.join(classes, "digest").where("doc_id != class_id").select("doc_id").distinct()
              .join(classes.select(F.col("class_id").alias("doc_id")), "doc_id", "left_anti"))
    # more than FEW copies: the prefix lists are shuffled too
    sets = own.where("digest IS NOT NULL AND doc_id IS NOT NULL").join(_few(copies), "doc_id", "left_anti")

    members = cut_lineage(hub_pairs(sets))
    # large groups are told apart by the list of their hubs, a thousandth of the members at most, so that members need not meet by hub
    huge = _few(members.groupBy("hub").agg(F.count("*").alias("m")).where(F.col("m") > SCREEN).select("hub"))
    likely = _screened(members.join(huge, "hub", "left_anti"), own.select("doc_id", "point").dropDuplicates(["doc_id"]), id_type, kind)
    members = cut_lineage(members.join(huge, "hub", "left_semi").unionByName(
        members.join(huge, "hub", "left_anti").join(likely, ["hub", "doc_id"], "left_semi")))

    # the hub may have been dropped; the center of those left stands in every block
    sizes = members.groupBy("hub").agg(F.count("*").alias("m"), F.sum("n").alias("hashes"),
                                       F.min(F.struct("n", "doc_id"))["doc_id"].alias("center"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("hashes") / BLOCK_HASHES)).cast("int")
    members = cut_lineage(members.join(_few(sizes.select("hub", "center", blocks.alias("blocks"))), "hub")
                          .select("hub", "center", "doc_id", "blocks"))

    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    everywhere = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = members.withColumn("block", F.explode(F.when(F.col("center") == F.col("doc_id"), everywhere).otherwise(F.array(block))))
    first = dealt.select("hub", "center", "block", F.lit(0).alias("other"), F.lit(0).alias("role"), "doc_id")
    texts = df.where("doc_id IS NOT NULL")
    found = cut_lineage(_solved(_with_texts(first, texts), id_type, kind))
    links_found = found.where("b IS NOT NULL").select("a", "b")

    # documents of large groups that are not joined to the center: each set of up to BLOCK of them meets every block
    large = members.where("blocks > 1")
    loose = found.where("b IS NULL").select("hub", F.col("a").alias("doc_id")).join(_few(large.select("hub", "center", "blocks").distinct()), "hub")
    counted = _few(loose.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("sets")))
    if not counted.isEmpty():
        loose = loose.join(counted, "hub").withColumn("other", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("sets")).cast("int"))
        asked = loose.select("hub", "center", F.explode(everywhere).alias("block"), "other", F.lit(1).alias("role"), "doc_id")
        against = (large.where("center != doc_id").join(counted, "hub")
                   .select("hub", "center", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("sets") - 1)).alias("other"),
                           F.lit(0).alias("role"), "doc_id"))
        more = _solved(_with_texts(asked.union(against), texts), id_type, kind)
        links_found = links_found.union(more.where("b IS NOT NULL").select("a", "b"))

    joined = components(links_found)
    named = classes.join(joined, F.col("class_id") == F.col("node"), "left").select(
        "digest", "class_id", F.coalesce("component", "class_id").alias("component_id"))
    return own.select("doc_id", "n", "digest").join(named, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def _few(rows: DataFrame) -> DataFrame:
    """The rows, computed once, and to be broadcast if there are at most FEW of them."""
    rows = cut_lineage(rows)
    return F.broadcast(rows) if rows.count() <= FEW else rows


def _with_texts(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows with the texts of their documents.  Up to FEW rows are broadcast, so that only texts that are wanted
    are shuffled; more are joined."""
    rows = cut_lineage(rows)
    if rows.count() <= FEW:
        return texts.join(F.broadcast(rows), "doc_id")
    ids = rows.select("doc_id").distinct()
    return rows.join(texts.join(ids, "doc_id", "left_semi"), "doc_id")


def op2_jaccard(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)

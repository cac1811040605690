"""Forests of the grid search grown by tasks, whole trees at a time (M4).

Spark's fit grows a forest level by level: for every level the statistics of all its nodes go once per partition through a shuffle, and the trees
come to the driver.  For thousands of deep trees on a middling table that is nearly all of the time.  Here the table is turned into bin codes, a
byte a value, and each task gets all of its rows and grows some trees of one forest by itself; it puts them to the held-out rows and returns only sums.
Nothing but split points comes to the driver.  A task holds all rows, so this is for tables of up to ``HELD`` of them.

The trees follow Spark's rules: up to 32 bins at quantiles weighted by class, Poisson(1) copies of the rows, ceil(sqrt(features)) features drawn
for each node, the split of the largest Gini gain that leaves the least rows of a leaf on both sides, no split without gain, twin leaves of the same class
joined.  Draws depend on seed, leaf size, fold and tree alone, not on how the rows are dealt out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.session import cut_lineage

BINS = 32
POINTS = 128     # values that stand for a batch's rows of one class, fold and feature when split points are sought
EACH = 50        # trees of a task, at most
HELD = 2_000_000  # rows that one task may hold
CHUNK = 2_048    # nodes whose statistics a task holds at once
CLASS_1 = 2.0 ** 26  # in a sum, a row of class 1 counts for this beside its 1
UNIT = 2.0 ** 40  # sums of shares are whole numbers of this part, so their order does not matter


def split_points(values: np.ndarray, weights: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Midpoints between neighbouring values: all of them if there are few, else those nearest to equal weights (Spark's rule)."""
    values, at = np.unique(values, return_inverse=True)
    middle = (values[1:] + values[:-1]) / 2
    if len(values) <= bins:
        return middle
    total = np.cumsum(np.bincount(at, weights))
    half, stride = (total[1:] + total[:-1]) / 2, total[-1] / bins
    found, last = [], -1
    for k in range(1, bins):
        last = max(np.searchsorted(half, k * stride, "right"), last + 1)
        if last >= len(half):
            break
        found.append(last)
    return middle[found]


@dataclass
class Tree:
    """Nodes in the order of their levels; a leaf is its own child.  Rows with codes up to ``bin`` go left."""

    level: list[int]       # first node of each level, and the end
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray      # share of class 1
    rows: np.ndarray

    def join_twins(self) -> None:
        """Two leaves of the same class are taken back into their parent, from the bottom up."""
        one = self.value > 0.5
        for lo, hi in zip(self.level[-2::-1], self.level[:0:-1]):
            a, b = self.left[lo:hi], self.right[lo:hi]
            twins = (self.left[a] == a) & (self.left[b] == b) & (one[a] == one[b])
            own = np.arange(lo, hi)[twins]
            self.left[own] = self.right[own] = own

    def values_from(self, min_split: int) -> np.ndarray:
        """What each node says if nodes of fewer than ``min_split`` rows are leaves: the value of the first such node on its way."""
        says = np.arange(len(self.left))
        for lo, hi in zip(self.level[:-1], self.level[1:]):
            own = np.arange(lo, hi)
            own = own[(self.left[lo:hi] != own) & (self.rows[says[lo:hi]] < min_split)]
            says[self.left[own]] = says[self.right[own]] = says[own]
        return self.value[says]

    def places(self, codes: np.ndarray, depths: Sequence[int]) -> Iterator[np.ndarray]:
        """The nodes of the rows of codes at each depth limit (ascending)."""
        n, d = codes.shape
        flat, place, moving, done = codes.ravel(), np.zeros(n, np.int64), np.arange(n), 0
        for depth in depths:
            for _ in range(done, depth):
                at = place[moving]
                inner = self.left[at] != at
                moving, at = moving[inner], at[inner]
                if not len(moving):
                    break
                place[moving] = np.where(flat[moving * d + self.feature[at]] <= self.bin[at], self.left[at], self.right[at])
            done = depth
            yield place


def grow(codes: np.ndarray, y: np.ndarray, weights: tuple[float, float], leaf: int, depth: int, rng: np.random.Generator) -> Tree:
    """One tree on a Poisson(1) draw of the rows.  ``weights`` of the rows of class 0 and 1."""
    n, d = codes.shape
    wanted, flat = math.ceil(math.sqrt(d)), codes.ravel()
    drawn = rng.poisson(1.0, n)
    row = np.flatnonzero(drawn)
    copies, base = drawn[row].astype(float), row * d
    mark = copies * (1.0 + CLASS_1 * y[row])
    total, ones = np.array([copies.sum()]), np.array([(copies * y[row]).sum()])
    slot, parts, level = np.zeros(len(row), np.int64), [], [0]
    for at_depth in range(depth + 1):
        k, first = len(total), level[-1]
        left, feature, cut = np.arange(first, first + k), np.zeros(k, np.int64), np.zeros(k, np.int64)
        right = left.copy()
        parts.append((left, right, feature, cut, total, ones))
        level.append(first + k)
        active = np.flatnonzero((ones > 0) & (ones < total) & (total >= 2 * leaf)) if at_depth < depth else np.zeros(0, np.int64)
        if not len(active):
            break
        place = np.full(k, -1)
        place[active] = np.arange(len(active))
        slot = place[slot]
        kept = slot >= 0
        slot, base, mark = slot[kept], base[kept], mark[kept]
        if len(active) > CHUNK:
            order = np.argsort(slot, kind="stable")
            slot, base, mark = slot[order], base[order], mark[order]
        splits, lefts = np.zeros(len(active), bool), np.zeros((len(active), 2))
        for lo in range(0, len(active), CHUNK):
            some = active[lo:lo + CHUNK]
            rows = slice(None) if len(active) <= CHUNK else slice(*np.searchsorted(slot, [lo, lo + len(some)]))
            good, chosen, bin_, counts = _best(flat, base[rows], slot[rows] - lo, mark[rows], total[some], ones[some], weights, leaf, d, wanted, rng)
            feature[some], cut[some], splits[lo:lo + CHUNK], lefts[lo:lo + CHUNK] = chosen, bin_, good, counts
        inner = active[splits]
        if not len(inner):
            break
        child = 2 * np.arange(len(inner))
        left[inner], right[inner] = level[-1] + child, level[-1] + child + 1
        kept = splits[slot]
        slot, base, mark = slot[kept], base[kept], mark[kept]
        node = active[slot]
        slot = left[node] + (flat[base + feature[node]] > cut[node]) - level[-1]
        lefts = lefts[splits]
        total, ones = (np.column_stack([lefts[:, i], whole[inner] - lefts[:, i]]).ravel() for i, whole in enumerate((total, ones)))
    left, right, feature, cut, total, ones = (np.concatenate(x) for x in zip(*parts))
    one, whole = weights[1] * ones, weights[0] * (total - ones) + weights[1] * ones
    tree = Tree(level, left, right, feature, cut, np.divide(one, whole, out=np.zeros(len(one)), where=whole > 0), total)
    tree.join_twins()
    return tree


def _best(flat, base, slot, mark, total, ones, weights, leaf, d, wanted, rng):  # noqa: ANN001, ANN202, PLR0913
    """Per node: is there a split with gain, its feature and bin, and the (rows, rows of class 1) on its left."""
    k = len(total)
    drawn = rng.random((k, d)).argpartition(wanted - 1, axis=1)[:, :wanted] if wanted < d else np.tile(np.arange(d), (k, 1))
    sums, start = np.empty((k, wanted, BINS)), slot * BINS
    for j in range(wanted):
        sums[:, j] = np.bincount(start + flat[base + drawn[:, j][slot]], mark, k * BINS).reshape(k, BINS)
    sums = sums.cumsum(2)[:, :, :-1]
    one = np.floor(sums / CLASS_1)
    all_ = sums - one * CLASS_1
    w0, w1 = weights
    a, b = w0 * (all_ - one), w1 * one
    whole_a, whole_b = (w0 * (total - ones))[:, None, None], (w1 * ones)[:, None, None]
    fits = (all_ >= leaf) & (total[:, None, None] - all_ >= leaf)
    with np.errstate(divide="ignore", invalid="ignore"):
        rest = a * b / (a + b) + (whole_a - a) * (whole_b - b) / (whole_a - a + whole_b - b)
    rest = np.where(fits, rest, np.inf).reshape(k, -1)
    best, own = rest.argmin(1), np.arange(k)
    whole = (whole_a + whole_b).ravel()
    gain = 2 * ((whole_a * whole_b).ravel() / whole - rest[own, best]) / whole
    j, bin_ = best // (BINS - 1), best % (BINS - 1)
    return gain > 1e-14, drawn[own, j], bin_, np.column_stack([all_[own, j, bin_], one[own, j, bin_]])


def _checked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, label and fold of a batch."""
    if batch["x"].null_count or batch["y"].null_count:
        raise ValueError("features and labels must not be null")
    x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    if not np.isfinite(x).all():
        raise ValueError("features must not be NaN or infinite")
    return x, batch["y"].to_numpy(), batch["fold"].to_numpy()


def _fold_points(rows: DataFrame, folds: int) -> list[list[np.ndarray]]:
    """The split points of every feature over the training rows of each fold."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, fold = _checked(batch)
            cells = []
            for f, label in sorted(set(zip(fold.tolist(), y.tolist()))):
                own = np.sort(x[(fold == f) & (y == label)], axis=0)
                start = np.unique(np.arange(POINTS) * len(own) // POINTS)
                size = np.diff(np.append(start, len(own)))
                for j in range(x.shape[1]):
                    values, n = np.unique(own[:, j], return_counts=True)
                    if len(values) > POINTS:
                        values, n = own[start + size // 2, j], size
                    cells.append((j, f, label, values, n.astype(float)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cells), (pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64())))],
                                             ["feature", "fold", "y", "value", "n"])

    def merged(table: pa.Table) -> pa.Table:
        feature, out = table["feature"][0].as_py(), []
        cells = [(f, y, np.array(v), np.array(n)) for f, y, v, n in zip(*(table[c].to_pylist() for c in ("fold", "y", "value", "n")))]
        for held in range(folds):
            own = [c for c in cells if c[0] != held]
            weight = _class_weights(*(sum(c[3].sum() for c in own if c[1] == label) for label in (0, 1)))
            values = np.concatenate([c[2] for c in own] or [np.zeros(0)])
            out.append(split_points(values, np.concatenate([c[3] * weight[c[1]] for c in own] or [np.zeros(0)])) if own else values)
        return pa.table({"feature": pa.array([feature] * folds, pa.int32()), "fold": pa.array(range(folds), pa.int32()), "points": pa.array(out, pa.list_(pa.float64()))})

    cells = rows.mapInArrow(summed, "feature int, fold int, y int, value array<double>, n array<double>")
    found = cells.groupBy("feature").applyInArrow(merged, "feature int, fold int, points array<double>").collect()
    points: list = [[None] * (1 + max(r.feature for r in found)) for _ in range(folds)]
    for r in found:
        points[r.fold][r.feature] = np.array(r.points)
    return points


def _class_weights(n0: float, n1: float) -> tuple[float, float]:
    """Balanced weights: rows over classes times rows of the class."""
    present = (n0 > 0) + (n1 > 0)
    return tuple((n0 + n1) / (present * n) if n else 0.0 for n in (n0, n1))


def _keys(spark, n: int) -> list[int]:  # noqa: ANN001
    """n numbers that ``repartition(n, number)`` deals to a partition each."""
    place = F.pmod(F.hash("id"), F.lit(n))
    found = [r.id for r in spark.range(64 * n).groupBy(place.alias("place")).agg(F.min("id").alias("id")).collect()]
    return found + list(range(64 * n, 65 * n - len(found)))


def search(folded: DataFrame, folds: int, grid: dict, deepest: int, seed: int, depth_limits: dict) -> DataFrame:
    """The scores of :func:`tremor.operators.forest.search_forest`."""
    spark, splits, depths, sizes = folded.sparkSession, list(grid["min_samples_split"]), sorted(set(depth_limits.values())), sorted(set(grid["n_estimators"]))
    rows = folded.select(vector_to_array("features").alias("x"), F.col("label").cast("int").alias("y"), F.col("fold").cast("int").alias("fold"))
    points = _fold_points(rows, folds)
    width = len(points[0])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, fold = _checked(batch)
            for f, own in enumerate(points):
                codes = np.column_stack([np.searchsorted(p, x[:, j], "left") for j, p in enumerate(own)]).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), *[pa.array([v.astype(np.uint8).tobytes()], pa.binary()) for v in (codes, y, fold == f)]],
                                                 ["fold", "codes", "y", "held"])

    parts = [(i, a, min(a + EACH, hi)) for i, (lo, hi) in enumerate(zip([0, *sizes], sizes)) for a in range(lo, hi, EACH)]
    jobs = [(leaf, fold, *part) for leaf in grid["min_samples_leaf"] for fold in range(folds) for part in parts]
    keys = _keys(spark, len(jobs))
    job_of = dict(zip(keys, jobs))

    def grown(table: pa.Table) -> pa.Table:
        leaf, fold, size, start, end = job_of[table["job"][0].as_py()]
        y, held = (np.concatenate([np.frombuffer(v.as_buffer(), np.uint8) for v in table[c]]) for c in ("y", "held"))
        words, at = np.zeros((len(y), -(-width // 8) * 8), np.uint8), 0
        for v in table["codes"]:
            some = np.frombuffer(v.as_buffer(), np.uint8).reshape(-1, width)
            words[at:at + len(some), :width] = some
            at += len(some)
        # the same order in every task, whatever order the rows came in; rows alike in all codes and the class are interchangeable
        order = np.lexsort((*words.view(np.uint64).T, y, held))
        codes, y, cut = np.ascontiguousarray(words[order][:, :width]), y[order], len(y) - int(held.sum())
        del words, order
        train, own, tests = codes[:cut], y[:cut].astype(float), codes[cut:]
        if not cut:
            raise ValueError(f"fold {fold} leaves no rows to train on")
        weights = _class_weights(cut - own.sum(), own.sum())
        sums = np.zeros((len(splits), len(depths), len(tests)), np.int64)
        for tree in range(start, end):
            t = grow(train, own, weights, leaf, deepest, np.random.default_rng([seed, leaf, fold, tree]))
            values = [np.rint(t.values_from(s) * UNIT).astype(np.int64) for s in splits]
            for k, place in enumerate(t.places(tests, depths)):
                for i, v in enumerate(values):
                    sums[i, k] += v[place]
        flat = np.ascontiguousarray(sums.reshape(-1, len(tests)).T).ravel()
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(tests) + 1) * len(splits) * len(depths), pa.int32()), pa.array(flat, pa.int64()))
        same = lambda v: pa.array(np.full(len(tests), v), pa.int32())
        return pa.table({"leaf": same(leaf), "fold": same(fold), "size": same(size), "row": pa.array(np.arange(len(tests)), pa.int64()), "y": pa.array(y[cut:], pa.int32()), "sums": lists})

    of_fold = F.array(*[F.array(*[F.lit(k).cast("long") for k, j in job_of.items() if j[1] == f]) for f in range(folds)])
    dealt = rows.mapInArrow(coded, "fold int, codes binary, y binary, held binary").withColumn("job", F.explode(F.get(of_fold, F.col("fold"))))
    sums = cut_lineage(dealt.repartition(len(jobs), "job").groupBy("job").applyInArrow(grown, "leaf int, fold int, size int, row long, y int, sums array<long>"))
    per = [(t, s, d, F.sum(F.when(F.col("size") <= i, F.get("sums", j * len(depths) + depths.index(limit)))))
           for i, t in enumerate(sizes) for j, s in enumerate(splits) for d, limit in depth_limits.items()]
    whole = sums.groupBy("leaf", "fold", "row").agg(F.first("y").alias("y"), *[p[-1].alias(f"s{k}") for k, p in enumerate(per)])
    found = [F.struct(F.lit(t).alias("n_estimators"), F.lit(d).cast("int").alias("max_depth"), F.lit(s).alias("min_samples_split"), (F.col(f"s{k}") / (UNIT * t)).alias("p1"))
             for k, (t, s, d, _) in enumerate(per)]
    return whole.select("leaf", "fold", "y", F.explode(F.array(*found)).alias("s")).select(
        "s.n_estimators", "s.max_depth", "s.min_samples_split", F.col("leaf").alias("min_samples_leaf"), "fold", "y", "s.p1")

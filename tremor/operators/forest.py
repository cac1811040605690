"""Fitted trees as rows: node tables, scoring from them, importances, and a grid search that reads many settings off one fit.

A fitted tree ensemble is a table of nodes (tree, node, prediction, class weights, rows, gain, children, split).  Rows are scored by walking flat node
arrays, sent to the tasks once; a model's size is bounded by its settings.

The search over number of trees, depth, least rows to split and least rows of a leaf needs one fit per leaf size and
fold.  A greedy tree with a smaller depth, or with a larger least number of rows to split, is the large tree with its
nodes beyond that turned into leaves, and a smaller forest is the first trees of a large one.  So every fit grows the largest
forest, and one walk scores the held-out rows under all settings of the other three.  (The usual grid search fits each setting
anew, from other random draws; here the settings of one leaf size share their draws.)  Class weights come from each
fold's own training rows.

A fit keeps its trees on the driver, and on noisy data their size grows with the rows.  So a forest that may have more than ``NODES``
nodes is grown some trees at a time (:func:`grown`): each part is turned into rows, or put to the held-out rows, whose sums over the
trees so far travel with them, and let go before the next.  The forests of the search go through Spark's fit only on tables that are small or
too large for a task; between, tasks grow their trees (:mod:`tremor.operators.groves`), by the same rules and from draws of their own.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremor.operators import groves
from tremor.operators.prepare import with_class_weight
from tremor.session import cut_lineage, ensure_checkpoint_dir, remove_folder

#: The grid of the forest search (no depth means as deep as Spark allows, 30) and its scoring.
FOREST_GRID = {"n_estimators": [100, 200, 300], "max_depth": [10, 15, 20, None], "min_samples_split": [5, 10, 15], "min_samples_leaf": [1, 2, 4]}
#: The grid of the search over boosted trees.
BOOSTED_GRID = {"max_depth": [5, 6, 7, 8], "learning_rate": [0.01, 0.05, 0.1, 0.15], "subsample": [0.7, 0.8, 0.9], "colsample_bytree": [0.7, 0.8, 0.9]}
DEEPEST = 30
SEED = 42
NODES = 100_000  # nodes that one fit grows, about
GROVES = 1_000  # from so many rows on, tasks grow the trees of the search


def node_table(spark: SparkSession, model) -> DataFrame:  # noqa: ANN001
    """The nodes of a fitted ensemble of the trees of Spark ML, read from its saved form: tree, node, prediction, stats (class
    weights), rows, gain, left, right, feature, threshold (-1 and null where there is none)."""
    path = f"{ensure_checkpoint_dir(spark)}/forest-{uuid.uuid4().hex}"
    model.write().save(path)
    n = F.col("nodeData")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["prediction"].alias("prediction"), n["impurityStats"].alias("stats"),
        n["rawCount"].alias("rows"), n["gain"].alias("gain"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["split"]["featureIndex"].alias("feature"), F.get(n["split"]["leftCategoriesOrThreshold"], 0).alias("threshold"))
    kept = cut_lineage(nodes)
    remove_folder(spark, path)
    return kept


def importances(nodes: DataFrame, names: Sequence[str], top_n: int | None = None) -> DataFrame:
    """Feature, importance, rank.  Gains times class weights of the splits, shares per tree, then of all trees; ties by name."""
    gains = nodes.where("left >= 0").groupBy("tree", "feature").agg(
        F.sum(F.col("gain") * F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)).alias("g"))
    share = gains.withColumn("s", F.try_divide("g", F.sum("g").over(Window.partitionBy("tree"))))
    found = share.groupBy("feature").agg(F.sum("s").alias("s"))
    spark = nodes.sparkSession
    named = spark.createDataFrame(list(enumerate(names)), "feature int, name string").join(found, "feature", "left").fillna(0.0, ["s"])
    whole = Window.partitionBy(F.lit(0))  # one row per feature
    out = named.select(F.col("name").alias("feature"), F.coalesce(F.try_divide("s", F.sum("s").over(whole)), F.lit(0.0)).alias("importance"))
    out = out.withColumn("rank", F.row_number().over(whole.orderBy(F.desc("importance"), "feature")))
    return out.where(F.col("rank") <= top_n) if top_n else out


@dataclass
class Forest:
    """Nodes of all trees in flat arrays; a leaf is its own child."""

    start: np.ndarray      # first node of each tree
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray      # share of class 1, or a boosted tree's prediction
    rows: np.ndarray

    @classmethod
    def of(cls, nodes: DataFrame, shares: bool = True) -> Forest:
        share = F.when(F.size("stats") > 1, F.try_divide(F.get("stats", 1), F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)))
        value = F.coalesce(share, F.lit(0.0)) if shares else F.col("prediction")
        # Arrow and not rows of objects: the driver holds one part of a forest for each fit that runs
        t = nodes.select("tree", "node", "left", "right", "feature", "threshold", "rows", value.alias("value")).orderBy("tree", "node").toArrow().to_pandas()
        start = np.flatnonzero(np.append(True, np.diff(t["tree"]) != 0)) if len(t) else np.zeros(0, np.int64)
        own, first = np.arange(len(t)), np.repeat(start, np.diff(np.append(start, len(t))))
        inner = t["left"].to_numpy() >= 0
        return cls(start, np.where(inner, first + t["left"].to_numpy(), own), np.where(inner, first + t["right"].to_numpy(), own),
                   np.where(inner, t["feature"].to_numpy(), 0), np.where(inner, t["threshold"].to_numpy(float), 0.0), t["value"].to_numpy(float), t["rows"].to_numpy())

    def cut(self, min_split: int) -> Forest:
        """Nodes of fewer than ``min_split`` rows become leaves."""
        own, small = np.arange(len(self.left)), self.rows < min_split
        return Forest(self.start, np.where(small, own, self.left), np.where(small, own, self.right), self.feature, self.threshold, self.value, self.rows)

    def walk(self, x: np.ndarray, depths: Sequence[int]) -> Iterator[np.ndarray]:
        """Per tree the values of the rows of x at each depth limit (ascending): shape (depths, rows)."""
        at = np.arange(len(x))
        for node in self.start:
            place, out, done = np.full(len(x), node), np.empty((len(depths), len(x))), 0
            for k, depth in enumerate(depths):
                for _ in range(done, depth):
                    down = np.where(x[at, self.feature[place]] <= self.threshold[place], self.left[place], self.right[place])
                    if (down == place).all():
                        break
                    place = down
                done = depth
                out[k] = self.value[place]
            yield out

    def probability(self, x: np.ndarray, depth: int = DEEPEST) -> np.ndarray:
        """Share of class 1, averaged over the trees."""
        return sum(v[0] for v in self.walk(x, [depth])) / len(self.start)


def score_forest(df: DataFrame, features: str, forest: Forest, depth: int = DEEPEST, name: str = "p1") -> DataFrame:
    """Adds the probability of class 1 from the node arrays; ``features`` is an array column."""
    sent = df.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def probability(v):  # noqa: ANN001, ANN202
        import pandas as pd
        return pd.Series(sent.value.probability(np.stack(v.to_numpy()), depth))

    return df.withColumn(name, probability(features))


def grown(train: DataFrame, build: Callable, trees: int, depth: int, seed: int = SEED, nodes: int = NODES) -> Iterator[tuple[int, DataFrame]]:
    """(trees before, node table) of the parts of a forest on (features vector, label, weight), one after another; the parts number their trees
    on.  ``build(trees, seed)`` is an estimator.  A forest that should stay below ``nodes`` nodes is one fit; else the first part is sized by the smaller
    class, as leaves come from telling its rows apart, and the others by the largest trees so far."""
    few = train.groupBy("label").count().agg(F.min("count")).first()[0] or 1
    each, done = min(2 * few, 2 ** (min(depth, DEEPEST) + 1)), 0
    while done < trees:
        n = min(trees - done, max(1, nodes // each))
        model = build(n, seed + 1_000_003 * done).fit(train)
        forest = getattr(model, "stages", [model])[-1]
        each, size = max(each if done else 1, -(-forest.totalNumNodes // n)), done
        table = node_table(train.sparkSession, forest)
        del model, forest
        done += n
        yield size, table.withColumn("tree", (F.col("tree") + size).cast("int"))


def forest_nodes(train: DataFrame, build: Callable, trees: int, depth: int, seed: int = SEED, nodes: int = 4 * NODES) -> DataFrame:
    """The node table of a whole forest, grown in parts if it is large."""
    tables = [t for _, t in grown(train, build, trees, depth, seed, nodes)]
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _balanced_forest(depth: int, leaf: int) -> Callable:
    return lambda trees, seed: RandomForestClassifier(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, featureSubsetStrategy="sqrt", seed=seed, weightCol="weight", cacheNodeIds=True)


def _lists(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel()))


def _added(state: DataFrame, part: Forest, before: int, splits: Sequence[int], depths: Sequence[int], trees: Sequence[int]) -> DataFrame:
    """``total`` (sums over the trees so far, by split and depth) goes on over the trees of a part; ``taken`` gets its values at the wanted numbers of trees."""
    sent = state.sparkSession.sparkContext.broadcast(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x, total, taken = (batch[c].flatten().to_numpy(zero_copy_only=False).reshape(n, -1) for c in ("x", "total", "taken"))
            total, more = total.copy(), []
            for i, split in enumerate(splits):
                own, at = total[:, i * len(depths):(i + 1) * len(depths)], []
                for t, values in enumerate(sent.value.cut(split).walk(x, depths), before + 1):
                    own += values.T
                    if t in trees:
                        at.append(own.copy())
                more.append(at)
            taken = np.concatenate([taken, *[m for at in zip(*more) for m in at]], axis=1)  # by trees, split, depth
            yield pa.RecordBatch.from_arrays([batch["y"], batch["x"], _lists(total), _lists(taken)], ["y", "x", "total", "taken"])

    out = cut_lineage(state.mapInArrow(run, "y int, x array<double>, total array<double>, taken array<double>"))
    sent.destroy()
    return out


def forest_scores(held_out: DataFrame, parts: Iterator[tuple[int, DataFrame]], leaf: int, fold: int, grid: dict) -> DataFrame:
    """One row per held-out row and setting: n_estimators, max_depth, min_samples_split, min_samples_leaf, fold, y, p1.  The parts of the
    forest (trees before, node table) are put to the rows as they come."""
    limits = {d: min(d or DEEPEST, DEEPEST) for d in grid["max_depth"]}
    splits, depths, trees = list(grid["min_samples_split"]), sorted(set(limits.values())), sorted(set(grid["n_estimators"]))
    state = held_out.select(F.col("label").cast("int").alias("y"), vector_to_array("features").alias("x"),
                            F.array_repeat(F.lit(0.0), len(splits) * len(depths)).alias("total"), F.array().cast("array<double>").alias("taken"))
    for before, nodes in parts:
        state = _added(state, Forest.of(nodes), before, splits, depths, trees)
    whole = [F.struct(F.lit(t).alias("n_estimators"), F.lit(d).cast("int").alias("max_depth"), F.lit(split).alias("min_samples_split"),
                      (F.get("taken", (i * len(splits) + j) * len(depths) + depths.index(limit)) / t).alias("p1"))
             for i, t in enumerate(trees) for j, split in enumerate(splits) for d, limit in limits.items()]
    return state.select("y", F.explode(F.array(*whole)).alias("s")).select(
        "s.n_estimators", "s.max_depth", "s.min_samples_split", F.lit(leaf).alias("min_samples_leaf"), F.lit(fold).alias("fold"), "y", "s.p1")


def _all_folds(folded: DataFrame, folds: int, settings: Sequence, fit: Callable, parallel: int) -> DataFrame:
    """The long table of ``fit(training rows, held-out rows, setting, fold)`` for every setting and fold; fits run side by side."""
    jobs = list(itertools.product(settings, range(folds)))

    def one(job: tuple) -> DataFrame:
        setting, fold = job
        train = with_class_weight(folded.where(F.col("fold") != fold), "label", "weight")
        return fit(train, folded.where(F.col("fold") == fold), setting, fold)

    with ThreadPoolExecutor(parallel) as pool:
        parts = list(pool.map(one, jobs))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def search_forest(folded: DataFrame, folds: int, grid: dict = FOREST_GRID, parallel: int = 4, seed: int = SEED, nodes: int = NODES,
                  least: int = GROVES, most: int = groves.HELD) -> DataFrame:
    """Scores of every setting on every fold's held-out rows; ``folded`` has features (vector), label (0 or 1) and fold.  Whole grid, one forest per
    leaf size and fold.  From ``least`` to ``most`` rows, tasks grow whole trees (:mod:`tremor.operators.groves`); else Spark fits the forests, in parts
    of about ``nodes`` nodes."""
    limits = {d: min(d or DEEPEST, DEEPEST) for d in grid["max_depth"]}
    deepest = max(limits.values())
    if least <= folded.count() <= most:
        return groves.search(folded, folds, grid, deepest, seed, limits)

    def fit(train: DataFrame, held_out: DataFrame, leaf: int, fold: int) -> DataFrame:
        parts = grown(train, _balanced_forest(deepest, leaf), max(grid["n_estimators"]), deepest, seed, nodes)
        return forest_scores(held_out, parts, leaf, fold, grid)

    return _all_folds(folded, folds, grid["min_samples_leaf"], fit, parallel)


def search_boosted(folded: DataFrame, folds: int, grid: dict = BOOSTED_GRID, rounds: int = 100, parallel: int = 4, seed: int = SEED) -> DataFrame:
    """The same for boosted trees: one fit per setting and fold, the rows of class 1 weighing as much as the others of the fold's training rows."""
    from tremor.operators.models import boosted_trees, positive_probability, positive_weight
    settings = [dict(zip(grid, v)) for v in itertools.product(*grid.values())]

    def fit(train: DataFrame, held_out: DataFrame, s: dict, fold: int) -> DataFrame:
        pipe = boosted_trees(rounds, s["max_depth"], s["learning_rate"], s["subsample"], s["colsample_bytree"], positive_weight(train), seed)
        scored = positive_probability(pipe.fit(train).transform(held_out))
        return scored.select(*[F.lit(v).alias(k) for k, v in s.items()], F.lit(fold).alias("fold"), F.col("label").cast("int").alias("y"), "p1")

    return _all_folds(folded, folds, settings, fit, parallel)


def recall_per_setting(scores: DataFrame, settings: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """M4: mean over the folds of the recall of class 1 (folds without class 1 do not count), least and greatest fold, best first; ties keep the
    order of the settings."""
    hit = F.count(F.when((F.col("y") == 1) & (F.col("p1") > threshold), 1))
    per_fold = scores.groupBy(*settings, "fold").agg(F.try_divide(hit.cast("double"), F.count(F.when(F.col("y") == 1, 1))).alias("recall"))
    mean = per_fold.groupBy(*settings).agg(F.avg("recall").alias("cv_recall"), F.min("recall").alias("least"), F.max("recall").alias("greatest"),
                                           F.count("recall").alias("folds"))
    # one row per setting; no depth limit is the largest
    order = [F.col(c).asc_nulls_last() for c in settings]
    return mean.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("cv_recall"), *order)))

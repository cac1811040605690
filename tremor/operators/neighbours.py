"""Exact nearest neighbours of every point of a table, by metric cells.

Points belong to the nearest of a bounded number of centres (distributed k-means; ``CELL`` points per cell, ``MAX_CELLS`` cells at most).
A cell has its centre, its radius and its points; a cell of more than ``CELL`` points is split into parts.  No point of a
cell is nearer to a query than the query's distance to the centre less the radius (triangle inequality).

A query visits cells in order of that bound: first one, then ``GROWTH`` times as many more each round, and stops as
soon as the next bound exceeds its k-th best distance.  Every round is one join of queries with the parts of the cells that they
visit; parts and the queries sent to one of them are cut, so that a task holds ``CELL`` points and a slice of queries, however
popular a cell is.  Nothing is left out: the result equals that of all pairs.  How many distances that takes depends
on the data, and is counted (``compared``): few on clustered data, nearly all pairs where the points have no clusters in many dimensions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tremor.session import cut_lineage

CELL = 4096
MAX_CELLS = 4096
GROWTH = 4
QUERIES = 16_384   # queries that a task puts to one part of a cell
SAMPLE = 200_000   # points that the centres are fitted to; only the cost depends on them
STEP = 512         # queries of one matrix product
_SLACK = 1e-9      # bounds give way by this share, so that rounding never closes a cell too early


def _matrix(col: pa.Array) -> np.ndarray:
    flat = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _centres(points: DataFrame, cells: int, seed: int) -> np.ndarray:
    n = points.count()
    some = points.where(F.pmod(F.xxhash64("id"), F.lit(n)) < SAMPLE) if n > SAMPLE else points
    model = KMeans(k=cells, seed=seed, initMode="random", maxIter=8, featuresCol="f").fit(some.select(array_to_vector("v").alias("f")))
    return np.array(model.clusterCenters())


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distances of rows to centres, a little inexact."""
    square = (x * x).sum(1)[:, None] + (centres * centres).sum(1)[None] - 2 * x @ centres.T
    return np.sqrt(np.maximum(square, 0))


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of rows of a to the same rows of b, summed from left to right as a SQL expression does."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += (a[:, j] - b[:, j]) * (a[:, j] - b[:, j])
    return np.sqrt(total)


def _homes(batches: Iterator[pa.RecordBatch], centres: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch["v"])
            home = _distances(x, centres).argmin(1)
            far = _exact(x, centres[home])
            yield pa.RecordBatch.from_arrays([batch["id"], batch["v"], pa.array(home.astype(np.int32)), pa.array(far)], ["id", "v", "cell", "far"])


def _visits(batches: Iterator[pa.RecordBatch], centres: np.ndarray, radius: np.ndarray, done: int, more: int) -> Iterator[pa.RecordBatch]:
    """(id, cell): the next cells of each query whose bound does not exceed its k-th best distance."""
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            part = batch.slice(at, STEP)
            far = _distances(_matrix(part["v"]), centres)
            bound = np.maximum(far * (1 - _SLACK) - radius * (1 + _SLACK) - _SLACK * radius.max(), 0)
            order = np.lexsort((far, bound), axis=1)[:, done:done + more]
            kth = part["kth"].to_numpy(zero_copy_only=False).astype(float)
            row, col = np.nonzero(np.take_along_axis(bound, order, 1) <= np.where(np.isnan(kth), np.inf, kth)[:, None])
            yield pa.RecordBatch.from_arrays([part["id"].take(pa.array(row)), pa.array(order[row, col].astype(np.int32))], ["id", "cell"])


def _nearest(ids: np.ndarray, points: np.ndarray, asked: np.ndarray, x: np.ndarray, k: int) -> list[tuple[list, list]]:
    """Per query the distances and ids of the k nearest points, by (distance, id); a point of the query's own id is not one."""
    out = []
    norm, square = (x * x).sum(1), (points * points).sum(1)
    near = norm[:, None] + square[None] - 2 * x @ points.T
    near[asked[:, None] == ids[None]] = np.inf
    error = 1e-10 * (norm + square.max())
    if len(ids) > k:
        limit = np.partition(near, k - 1, axis=1)[:, k - 1] + error
    else:
        limit = np.full(len(x), np.inf)
    row, col = np.nonzero((near <= limit[:, None]) & np.isfinite(near))
    exact = _exact(x[row], points[col])
    order = np.lexsort((ids[col], exact, row))
    row, col, exact = row[order], col[order], exact[order]
    start = np.searchsorted(row, np.arange(len(x) + 1))
    for s, e in zip(start, start[1:]):
        e = min(e, s + k)
        out.append((exact[s:e].tolist(), ids[col[s:e]].tolist()))
    return out


def _search(batches: Iterator[pa.RecordBatch], k: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Answers of the queries of each group (cell, part, slice); a group's points come before its queries."""
    key, ids, points = None, [], []
    best = pa.list_(pa.struct([("dist", pa.float64()), ("nb", kind)]))
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch[c].to_numpy() for c in ("cell", "part", "slice", "kind")], 1)
        cuts = np.append(np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1))), len(keys))
        for s, e in zip(cuts, cuts[1:]):
            if tuple(keys[s, :3]) != key:
                key, ids, points = tuple(keys[s, :3]), [], []
            own, x = batch["id"].slice(s, e - s).to_numpy(zero_copy_only=False), _matrix(batch["v"].slice(s, e - s))
            if keys[s, 3] == 0:
                ids.append(own), points.append(x)
                continue
            ids, points = [np.concatenate(ids)], [np.concatenate(points)]
            for at in range(0, len(own), STEP):
                found = _nearest(ids[0], points[0], own[at:at + STEP], x[at:at + STEP], k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[at:at + STEP], kind), pa.array([[{"dist": d, "nb": i} for d, i in zip(*f)] for f in found], best),
                     pa.array(np.full(len(found), len(ids[0]), np.int64))], ["id", "best", "compared"])


def nearest_neighbours(points: DataFrame, id_col: str, vec: str, k: int, cell: int = CELL, seed: int = 42) -> DataFrame:
    """The k nearest other points of every point, by (distance, id): columns ``id, slot (0..k-1), nb_id, dist, compared``
    (distances computed for this point in all).

    Vectors have one length and no nulls.  Ids are unique.  With fewer than k + 1 points all others are neighbours.
    """
    spark = points.sparkSession
    pts = cut_lineage(points.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("v")))
    n = pts.count()
    kind, name = to_arrow_type(pts.schema["id"].dataType), pts.schema["id"].dataType.simpleString()
    state_type = f"array<struct<dist:double,nb:{name}>>"
    if not n:
        return spark.createDataFrame([], f"id {name}, slot int, nb_id {name}, dist double, compared long")
    cells = min(MAX_CELLS, math.ceil(n / cell))
    centres = _centres(pts, cells, seed) if cells > 1 else np.zeros((1, len(pts.first()["v"])))
    homes = cut_lineage(pts.mapInArrow(lambda b: _homes(b, centres), f"id {name}, v array<double>, cell int, far double"))
    # at most MAX_CELLS rows
    sizes = {r["cell"]: (r["m"], r["far"]) for r in homes.groupBy("cell").agg(F.count(F.lit(1)).alias("m"), F.max("far").alias("far")).collect()}
    kept = sorted(sizes)
    centres, radius = centres[kept], np.array([sizes[c][1] for c in kept])
    number = {c: i for i, c in enumerate(kept)}
    parts = {number[c]: math.ceil(m / cell) for c, (m, _) in sizes.items()}
    numbers = spark.createDataFrame([(c, i, parts[i]) for c, i in number.items()], "cell int, number int, parts int")
    homes = homes.join(F.broadcast(numbers), "cell").select("id", "v", F.col("number").alias("cell"),
                                                            F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"))
    state = pts.select("id", "v", F.array().cast(state_type).alias("best"), F.lit(None).cast("double").alias("kth"), F.lit(0).cast("long").alias("compared"))
    done, more = 0, 1
    while done < len(kept):
        visits = cut_lineage(state.mapInArrow(lambda b, d=done, m=more: _visits(b, centres, radius, d, m), f"id {name}, cell int"))
        asked = {r["cell"]: r["c"] for r in visits.groupBy("cell").agg(F.count(F.lit(1)).alias("c")).collect()}
        if not asked:
            break
        plan = F.broadcast(spark.createDataFrame([(c, parts[c], math.ceil(a / QUERIES)) for c, a in asked.items()], "cell int, parts int, slices int"))
        held = homes.join(plan, "cell").select("cell", "part", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(0).alias("kind"), "id", "v")
        queries = (visits.join(state.select("id", "v"), "id").join(plan, "cell")
                   .select("cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                           F.pmod(F.xxhash64("id", F.lit(1)), F.col("slices")).cast("int").alias("slice"), F.lit(1).alias("kind"), "id", "v"))
        found = (held.unionByName(queries).repartition("cell", "part", "slice").sortWithinPartitions("cell", "part", "slice", "kind")
                 .mapInArrow(lambda b: _search(b, k, kind), f"id {name}, best {state_type}, compared long"))
        found = found.groupBy("id").agg(F.flatten(F.collect_list("best")).alias("b"), F.sum("compared").alias("c"))
        best = F.slice(F.array_sort(F.concat("best", F.coalesce("b", F.array().cast(state_type)))), 1, k)
        state = (state.join(found, "id", "left").withColumn("best", best)
                 .select("id", "v", "best", F.get("best", k - 1)["dist"].alias("kth"), (F.col("compared") + F.coalesce("c", F.lit(0))).alias("compared")))
        state = cut_lineage(state)
        done, more = done + more, more * GROWTH
    return state.select("id", "compared", F.posexplode("best").alias("slot", "e")).select(
        "id", "slot", F.col("e.nb").alias("nb_id"), F.col("e.dist").alias("dist"), "compared")

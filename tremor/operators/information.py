"""Mutual information of numeric features with a class, by nearest neighbours in one dimension.

For a row with value x of a class with n_c rows, k = min(``NEIGHBOURS``, n_c - 1) and d is the distance to its k-th nearest
other row of the class; m is the number of rows of all classes nearer than d (its own included; with d = 0 the rows of
equal value).  The information of a feature, in nats and at least 0, is

    digamma(n) + mean(digamma(k)) - mean(digamma(n_c)) - mean(digamma(m))

over the rows of classes with more than one row.  A NULL value counts as 0; rows without a class are left out.  (The
usual library adds a noise of 1e-10 to the values first, which breaks ties at random; here ties stay ties.)

Everything works on the counts of distinct values.  Neighbours of a value are at most k distinct values
away in its class, so they are found in blocks of the class's order with k rows of the blocks beside; m comes from two
prefix counts over all classes' values, one at each end of the open interval.  No key's rows meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.operators.ordering import DEFAULT_BLOCK_ROWS, prefix_sums, with_sample_index
from tremor.session import cut_lineage

NEIGHBOURS = 3
_SHIFT = 6
#: B(2j) / 2j of the asymptotic series of digamma, j = 1, 2, ...
_SERIES = (1 / 12, -1 / 120, 1 / 252, -1 / 240, 1 / 132)


def digamma(x: Column) -> Column:
    """Digamma of a number of at least 1: recurrence up to x + 6, then the asymptotic series (error below 1e-11)."""
    x = x.cast("double")
    z = x + _SHIFT
    out, power = F.log(z) - 0.5 / z, F.lit(1.0)
    for c in _SERIES:
        power = power / (z * z)
        out = out - c * power
    for i in range(_SHIFT):
        out = out - 1.0 / (x + i)
    return out


def digamma_sql(x: str) -> str:
    """The same for DuckDB."""
    z, power = f"(({x}) + {_SHIFT}.0)", "1.0"
    out = f"ln({z}) - 0.5 / {z}"
    for c in _SERIES:
        power = f"({power} / ({z} * {z}))"
        out += f" - ({c!r}) * {power}"
    return f"({out}" + "".join(f" - 1.0 / (({x}) + {i}.0)" for i in range(_SHIFT)) + ")"


def _ordinal(x: np.ndarray) -> np.ndarray:
    """Doubles as whole numbers in the same order; its own inverse on them is :func:`_double`."""
    bits = x.view(np.int64)
    return np.where(bits < 0, np.int64(-(1 << 63)) - bits, bits)


def _double(n: np.ndarray) -> np.ndarray:
    return np.where(n < 0, np.int64(-(1 << 63)) - n, n).view(np.float64)


def interval_ends(x: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest double whose computed distance to x is below d (x itself where d is 0)."""
    x = x + 0.0  # no negative zero
    ends = []
    for side in (-1, 1):
        inside, outside = _ordinal(x), _ordinal(x + side * 2 * d)
        while True:
            # halves without overflow; the two have one sign or are apart by less than 2^63 after halving
            middle = (inside >> 1) + (outside >> 1) + (inside & outside & 1)
            open_ = (middle != inside) & (middle != outside)
            if not open_.any():
                break
            near = np.abs(_double(middle) - x) < d
            inside, outside = np.where(open_ & near, middle, inside), np.where(open_ & ~near, middle, outside)
        if side > 0:  # halving rounds down: the double above the last one may still be inside
            above = np.minimum(inside + 1, np.maximum(outside, inside))
            inside = np.where(np.abs(_double(above) - x) < d, above, inside)
        else:
            below = np.maximum(inside - 1, np.minimum(outside, inside))
            inside = np.where(np.abs(_double(below) - x) < d, below, inside)
        ends.append(_double(inside))
    return ends[0], ends[1]


def _with_neighbours(cells: DataFrame, by: list[str], k: int, block_rows: int) -> DataFrame:
    """Arrays ``near`` of (value, n) of the k distinct values on either side."""
    d = with_sample_index(cells, by, ["value"], name="__i")
    block, at = F.floor(F.col("__i") / block_rows).cast("long"), F.col("__i") % block_rows
    homes = F.array_compact(F.array(block, F.when(at >= block_rows - k, block + 1), F.when((at < k) & (block > 0), block - 1)))
    d = d.withColumn("__own", block).withColumn("__block", F.explode(homes))
    w = Window.partitionBy(*by, "__block").orderBy("value")
    cell = F.struct("value", "n")
    near = F.array_compact(F.array(*[f(cell, j).over(w) for f in (F.lag, F.lead) for j in range(1, k + 1)]))
    return d.withColumn("near", near).where("__own = __block").drop("__own", "__block", "__i")


def mutual_information(df: DataFrame, cols: Sequence[str], label: str, neighbours: int = NEIGHBOURS,
                       block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``feature, mutual_info`` of every column with ``label``."""
    if block_rows < 2 * neighbours:
        raise ValueError("a block must hold the neighbours of both sides")
    rows = df.where(F.col(label).isNotNull()).withColumn("__class", F.col(label))
    # the rows are read once, for the counts; all the rest reads those.  Counting by numbers is cheaper than by a name in a long table
    counted = None
    for c in cols:
        value = F.coalesce(F.col(c).cast("double"), F.lit(0.0)) + F.lit(0.0)
        own = rows.groupBy("__class", value.alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("feature"), "__class", "value", "n")
        counted = own if counted is None else counted.unionByName(own)
    cells = cut_lineage(counted)
    # class sizes: as many rows as there are classes and features
    sizes = cells.groupBy("feature", "__class").agg(F.sum("n").alias("n_c")).where("n_c > 1")
    cells = cells.join(sizes, ["feature", "__class"])
    near = _with_neighbours(cells, ["feature", "__class"], neighbours, block_rows)
    k = F.least(F.lit(neighbours), F.col("n_c") - 1).cast("int")
    own = F.array_repeat(F.lit(0.0), F.least(F.col("n") - 1, F.lit(neighbours)).cast("int"))
    others = F.flatten(F.transform("near", lambda x: F.array_repeat(F.abs(x["value"] - F.col("value")), F.least(x["n"], F.lit(neighbours)).cast("int"))))
    distance = F.get(F.array_sort(F.concat(own, others)), k - 1)
    asked = near.select("feature", "__class", "value", "n", "n_c", k.alias("k"), distance.alias("d"))

    @F.pandas_udf("lo double, hi double")
    def ends(x: pd.Series, d: pd.Series) -> pd.DataFrame:
        lo, hi = interval_ends(x.to_numpy(np.float64), d.to_numpy(np.float64))
        return pd.DataFrame({"lo": lo, "hi": hi})

    asked = asked.withColumn("e", ends("value", "d"))
    # one order of all values and interval ends: a lower end stands before equal values, an upper end after them
    none, zero = F.lit(None), F.lit(0).cast("long")
    kind = cells.schema["__class"].dataType
    points = cells.groupBy("feature", F.col("value").alias("at")).agg(F.sum("n").alias("c")).select(
        "feature", "at", F.lit(1).alias("kind"), "c", none.cast(kind).alias("__class"), none.cast("double").alias("value"),
        zero.alias("n"), zero.alias("n_c"), F.lit(0).alias("k"))
    marks = asked.select("feature", F.explode(F.array(F.struct(F.col("e.lo").alias("at"), F.lit(0).alias("kind")),
                                                      F.struct(F.col("e.hi").alias("at"), F.lit(2).alias("kind")))).alias("m"),
                         "__class", "value", "n", "n_c", "k").select("feature", "m.at", "m.kind", zero.alias("c"), "__class", "value", "n", "n_c", "k")
    counted = prefix_sums(points.unionByName(marks), ["feature"], ["at", "kind"], ["c"], prefix="upto_").where("kind <> 1")
    found = counted.groupBy("feature", "__class", "value").agg(
        F.sum(F.when(F.col("kind") == 2, F.col("upto_c")).otherwise(-F.col("upto_c"))).alias("m"),
        F.max("n").alias("n"), F.max("n_c").alias("n_c"), F.max("k").alias("k"))
    total = found.groupBy("feature").agg(F.sum("n").alias("rows"), F.sum(
        F.col("n") * (digamma(F.col("k")) - digamma(F.col("n_c")) - digamma(F.col("m")))).alias("s"))
    return total.select("feature", F.greatest(F.lit(0.0), digamma(F.col("rows")) + F.col("s") / F.col("rows")).alias("mutual_info"))

"""Whole-table statistics.

Wide feature tables are turned long (``feature, value``) so that one grouped
aggregate covers every column, and each statistic is partial-aggregated
map-side.  Quantiles come from :func:`tremor.operators.ordering.quantiles`
(exact, no whole-group value map).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremor.functions import fitted, safe_corr
from tremor.operators.cleaning import unpivot
from tremor.operators.selection import quantiles


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """G1: rows per class."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Class 0 / 1 counts, percentages and imbalance ratio n1 / n0 (0 if n0 = 0)."""
    n0 = F.count(F.when(F.col(label) == 0, 1))
    n1 = F.count(F.when(F.col(label) == 1, 1))
    total = n0 + n1
    return df.agg(
        n0.alias("class_0_count"),
        n1.alias("class_1_count"),
        (F.try_divide(n0 * F.lit(100.0), total)).alias("class_0_percentage"),
        (F.try_divide(n1 * F.lit(100.0), total)).alias("class_1_percentage"),
        F.when(n0 > 0, n1 / n0).otherwise(F.lit(0.0)).alias("imbalance_ratio"),
    )


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Table size and remaining NULLs per column (one row)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"n_null_{c}") for c in cols],
    )


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles (linear), max per column.

    One row per column (long form), unlike ``DataFrame.summary`` whose
    quartiles are approximate.
    """
    long = unpivot(df, cols)
    moments = long.groupBy("feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    q = quantiles(long, ["feature"], "value", [0.25, 0.5, 0.75], names=["q25", "q50", "q75"]).drop("n")
    return moments.join(q, "feature", "left").select(
        "feature", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every pair a < b of ``cols`` (lower triangle), pairwise
    complete rows, NULL for a constant column (no ANSI error).

    One pass: all pair statistics are columns of a single aggregate, so the
    data is scanned once whatever the number of pairs.
    """
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    agg = df.agg(*[safe_corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    stacked = agg.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"`{a}|{b}`").alias("corr"))
        for a, b in pairs
    ])).alias("p"))
    return stacked.select("p.*")


def _bounds_iqr(long: DataFrame, k: float = 1.5) -> DataFrame:
    q = quantiles(long, ["feature"], "value", [0.25, 0.75], names=["q1", "q3"])
    return q.select(
        "feature", "q1", "q3",
        (F.col("q1") - F.lit(k) * (F.col("q3") - F.col("q1"))).alias("lo"),
        (F.col("q3") + F.lit(k) * (F.col("q3") - F.col("q1"))).alias("hi"),
    )


def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Per column Q1, Q3, bounds and the count strictly outside them.

    The bounds table has one row per column and is broadcast.
    """
    long = unpivot(df, cols).where(F.col("value").isNotNull())
    b = _bounds_iqr(long, k)
    flagged = long.join(F.broadcast(b.select("feature", "lo", "hi")), "feature")
    counts = flagged.groupBy("feature").agg(
        F.count(F.when((F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi")), 1)).alias("n_outliers"))
    return b.join(counts, "feature")


def zscore_outliers(df: DataFrame, cols: Sequence[str], z: float = 3.0) -> DataFrame:
    """Count of |(x - mean) / std_pop| > z per column (strict)."""
    long = unpivot(df, cols).where(F.col("value").isNotNull())
    st = long.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    flagged = long.join(F.broadcast(st), "feature")
    zz = F.abs(F.try_divide(F.col("value") - F.col("mean"), F.col("std")))
    return flagged.groupBy("feature", "mean", "std").agg(
        F.count(F.when(zz > z, 1)).alias("n_outliers"))


def clip_iqr(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Clip each column to its IQR bounds (the reference's stated strategy)."""
    long = unpivot(df, cols).where(F.col("value").isNotNull())
    b = _bounds_iqr(long, k)
    wide = b.groupBy().pivot("feature", list(cols)).agg(F.first(F.struct("lo", "hi")))
    bounds = fitted(wide.select(*[F.col(f"`{c}`").alias(f"__b_{c}") for c in cols]))
    return df.select(*[
        F.least(F.greatest(F.col(c), bounds.getField(f"__b_{c}").getField("lo")),
                bounds.getField(f"__b_{c}").getField("hi")).alias(c) if c in cols
        else F.col(c) for c in df.columns
    ])


def with_bin(df: DataFrame, x: str, lo: str, hi: str, bins: int, name: str = "bin") -> DataFrame:
    """Adds the NumPy ``histogram`` bin of column ``x`` for ``bins`` equal bins
    over [lo, hi] (edges ``lo + i * (hi - lo) / bins``, last bin closed);
    NULL outside.

    The float index is computed once (its own projection) and then corrected
    against the actual edges, as NumPy does, so values on an edge land where
    NumPy puts them.
    """
    xx, lc, hc = F.col(x), F.col(lo), F.col(hi)
    width = (hc - lc) / F.lit(float(bins))
    raw = F.floor((xx - lc) * F.try_divide(F.lit(float(bins)), hc - lc)).cast("int")
    d = df.withColumn("__k", F.least(raw, F.lit(bins - 1)))
    k = F.col("__k")

    def edge(i):
        return F.when(i >= bins, hc).otherwise(lc + i.cast("double") * width)

    inside = (xx >= lc) & (xx <= hc)
    b = (F.when(~inside, F.lit(None).cast("int"))
         .when(xx < edge(k), k - 1)
         .when((k != bins - 1) & (xx >= edge(k + 1)), k + 1)
         .otherwise(k))
    return d.withColumn(name, b).drop("__k")


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Equal-width counts over each column's own [min, max], every bin
    present (empty bins count 0), plus the density form count / (n * width)."""
    long = unpivot(df, cols).where(F.col("value").isNotNull())
    rng = long.groupBy("feature").agg(F.min("value").alias("mn"), F.max("value").alias("mx"),
                                      F.count("value").alias("n"))
    # NumPy widens a zero-width range to [v - 0.5, v + 0.5]
    rng = rng.select("feature", "n",
                     F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
                     F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi"))
    binned = with_bin(long.join(F.broadcast(rng), "feature"), "value", "lo", "hi", bins).select("feature", "bin")
    counts = binned.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select("feature", "n", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return grid.join(counts, ["feature", "bin"], "left").select(
        "feature", "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
        F.when(F.col("bin") == bins - 1, F.col("hi")).otherwise(F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce(F.col("count"), F.lit(0)).alias("count"),
        (F.coalesce(F.col("count"), F.lit(0)) / (F.col("n") * width)).alias("density"),
    )


def rank_top(df: DataFrame, score: str, k: int, by: Sequence[str] = (), tie: str | None = None) -> DataFrame:
    """K1-K3: the top ``k`` rows by ``score`` (per ``by`` groups when given)."""
    order = [F.col(score).desc()] + ([F.col(tie)] if tie else [])
    if not by:
        return df.orderBy(*order).limit(k)
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

"""Drift between a base and a current sample, per feature.

Input is long form ``(feature, value, side)`` with side 0 = base, 1 =
current (:func:`long_samples` builds it from two wide tables).  Values are
counted per side once (ties collapse, partial aggregation shrinks the data);
sizes, ranges, the KS statistic and both histograms all come from that one
table, whose running sums use the skew-safe
:func:`tremor.operators.ordering.prefix_sums`.  A feature with an empty side
has NULL statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.functions import fitted
from tremor.operators.cleaning import unpivot
from tremor.operators.ordering import prefix_sums
from tremor.operators.stats import with_bin

# PSI status limits (> 0.2 Major, > 0.1 Moderate, else Stable),
# alert level p < 0.05, bins 10 (PSI) and 20 (JS), smoothing 1e-6, 4-decimal report.
PSI_MAJOR, PSI_MODERATE = 0.2, 0.1
ALPHA = 0.05
PSI_BINS, JS_BINS = 10, 20
PSI_EPS = 1e-6


def long_samples(base: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Stack two wide tables into ``(feature, value, side)``; NULLs dropped."""
    b = unpivot(base, cols).withColumn("side", F.lit(0))
    c = unpivot(current, cols).withColumn("side", F.lit(1))
    return b.unionByName(c).where(F.col("value").isNotNull())


def sided_samples(df: DataFrame, cols: Sequence[str], side: Column) -> DataFrame:
    """One wide table as ``(feature, value, side)`` in one scan; rows whose ``side`` is NULL are in neither sample."""
    long = unpivot(df.withColumn("side", side.cast("int")), cols, keys=["side"])
    return long.where(F.col("value").isNotNull() & F.col("side").isNotNull()).select("feature", "value", "side")


def value_counts(long: DataFrame) -> DataFrame:
    """(feature, value, c0, c1) with running sums ``cum_c0``, ``cum_c1`` in value order and the sizes ``n_c0``, ``n_c1``."""
    counts = long.where(F.col("value").isNotNull() & F.col("side").isNotNull()).groupBy("feature", "value").agg(
        F.count(F.when(F.col("side") == 0, 1)).alias("c0"),
        F.count(F.when(F.col("side") == 1, 1)).alias("c1"),
    )
    return prefix_sums(counts, ["feature"], ["value"], ["c0", "c1"], prefix="cum_", total_prefix="n_")


def _profile(run: DataFrame) -> DataFrame:
    """One row per feature: sizes, value ranges (base, all) and the KS statistic."""
    gap = F.abs(F.try_divide(F.col("cum_c0").cast("double"), F.col("n_c0"))
                - F.try_divide(F.col("cum_c1").cast("double"), F.col("n_c1")))
    base = F.when(F.col("c0") > 0, F.col("value"))
    return run.groupBy("feature").agg(
        F.max(gap).alias("ks_stat"), F.max("n_c0").alias("n_base"), F.max("n_c1").alias("n_current"),
        F.min(base).alias("bmin"), F.max(base).alias("bmax"), F.min("value").alias("amin"), F.max("value").alias("amax"))


def ks_statistic(long: DataFrame) -> DataFrame:
    """Two-sample KS statistic D = max |F_base - F_current| per feature,
    with the sample sizes n_base, n_current."""
    return _profile(value_counts(long)).select("feature", "ks_stat", "n_base", "n_current")


def _gcd(a: int, b: int) -> int:
    while b:
        a, b = b, a % b
    return a


def ks_pvalue_exact(d: float, n1: int, n2: int) -> float:
    """P(D >= d) for two samples of sizes n1, n2 (two-sided, exact).

    d is first put on the lattice of attainable values (h / lcm).  A random
    path of n1 right and n2 up steps is tracked along anti-diagonals with
    transition probabilities (each path equally likely); the probability of
    staying strictly inside |i/n1 - j/n2| < d is accumulated, p = 1 - that.
    Only the cells inside that band are visited on each diagonal (integer
    bounds), so the work is about (n1 + n2) * d * n2 instead of n1 * n2.
    """
    if n1 <= 0 or n2 <= 0:
        return float("nan")
    g = _gcd(n1, n2)
    lcm = (n1 // g) * n2
    h = int(round(d * lcm))
    if h == 0:
        return 1.0
    # inside <=> |i * n2 - j * n1| < h * g  (integers)
    lim = h * g
    m, n = n1, n2
    tot = m + n
    # band values of the previous diagonal: prev[j - plo] for j in [plo, phi]
    prev = np.ones(1)
    plo, phi = 0, 0
    for s in range(1, tot + 1):
        # j on diagonal s with |s * n - j * (m + n)| < lim, and 0 <= i = s - j <= m
        jlo = max(max(0, s - m), (s * n - lim) // tot + 1)
        jhi = min(min(n, s), -((-(s * n + lim)) // tot) - 1)
        if jlo > jhi:
            return 1.0
        j = np.arange(jlo, jhi + 1)
        i = s - j
        val = np.zeros(len(j))
        # from (i - 1, j): a step in the first sample (previous diagonal, same j)
        ok = (i >= 1) & (j >= plo) & (j <= phi)
        ip, jp = i[ok] - 1, j[ok]
        val[ok] += prev[jp - plo] * (m - ip) / (tot - ip - jp)
        # from (i, j - 1): a step in the second sample
        ok2 = (j >= 1) & (j - 1 >= plo) & (j - 1 <= phi)
        ip2, jp2 = i[ok2], j[ok2] - 1
        val[ok2] += prev[jp2 - plo] * (n - jp2) / (tot - ip2 - jp2)
        prev, plo, phi = val, jlo, jhi
    inside = prev[n - plo] if plo <= n <= phi else 0.0
    return float(min(1.0, max(0.0, 1.0 - inside)))


def ks_pvalue_limit(d: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Kolmogorov's limit with the small-sample term, as a built-in expression:
    2 sum_k (-1)^(k-1) exp(-2 k^2 L^2), L = (sqrt(e) + 0.12 + 0.11 / sqrt(e)) D, e = n1 n2 / (n1 + n2)."""
    e = F.sqrt(F.try_divide(n1.cast("double") * n2.cast("double"), n1.cast("double") + n2.cast("double")))
    lam = (e + 0.12 + F.try_divide(F.lit(0.11), e)) * d

    def term(acc: Column, k: Column) -> Column:
        sign = F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        return acc + sign * F.exp(F.lit(-2.0) * k * k * lam * lam)

    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), term)
    p = F.when(lam < 0.05, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * series)))
    return F.when(d.isNotNull() & (n1 > 0) & (n2 > 0), p)


@F.pandas_udf(T.DoubleType())
def ks_pvalue_udf(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) or not b or not c else ks_pvalue_exact(float(a), int(b), int(c))
                      for a, b, c in zip(d, n1, n2)], dtype="float64")


def _with_pvalue(ks: DataFrame, method: str) -> DataFrame:
    if method == "limit":
        return ks.withColumn("p_value", ks_pvalue_limit(F.col("ks_stat"), F.col("n_base"), F.col("n_current")))
    if method != "exact":
        raise ValueError(f"unknown p-value method {method!r}")
    # one feature per task: the path counts of many features run in parallel
    n = int(ks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ks.repartition(n, "feature").withColumn("p_value", ks_pvalue_udf("ks_stat", "n_base", "n_current"))


def ks_test(long: DataFrame, method: str = "limit") -> DataFrame:
    """D1 + D2: statistic and p-value.  ``method`` is the caller's choice at any
    size: ``limit`` (the series above) or ``exact`` (path counting, work in
    proportion to n1 n2 D, one task per feature)."""
    return _with_pvalue(ks_statistic(long), method)


def _widen(lo, hi):
    """NumPy widens an empty range [v, v] to [v - 0.5, v + 0.5]."""
    return (F.when(lo == hi, lo - 0.5).otherwise(lo), F.when(lo == hi, hi + 0.5).otherwise(hi))


def _grid_counts(run: DataFrame, profile: DataFrame, bins: int, low: str, high: str) -> DataFrame:
    """(feature, n_base, n_current, bin, b, c): counts of each side over a full bin grid on [low, high]."""
    lo, hi = _widen(F.col(low), F.col(high))
    # one row per feature; the number of features comes from the data, so the join is left to AQE
    rng = profile.select("feature", "n_base", "n_current", lo.alias("lo"), hi.alias("hi"))
    binned = with_bin(run.select("feature", "value", "c0", "c1").join(rng, "feature"), "value", "lo", "hi", bins)
    counts = binned.where(F.col("bin").isNotNull()).groupBy("feature", "bin").agg(
        F.sum("c0").alias("b"), F.sum("c1").alias("c"))
    grid = rng.select("feature", "n_base", "n_current", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counts, ["feature", "bin"], "left").na.fill(0, subset=["b", "c"])


def _both(value: Column) -> Column:
    """NULL where a side is empty."""
    return F.when((F.max("n_base") > 0) & (F.max("n_current") > 0), value)


def _psi(run: DataFrame, profile: DataFrame, bins: int) -> DataFrame:
    g = _grid_counts(run, profile, bins, "bmin", "bmax")
    eps = F.lit(PSI_EPS)
    bp = (F.col("b") + eps) / (F.col("n_base") + eps * bins)
    cp = (F.col("c") + eps) / (F.col("n_current") + eps * bins)
    return g.groupBy("feature").agg(_both(F.sum((cp - bp) * F.log(cp / bp))).alias("psi"))


def _js(run: DataFrame, profile: DataFrame, bins: int) -> DataFrame:
    g = _grid_counts(run, profile, bins, "amin", "amax")  # every value has a bin
    p = F.try_divide(F.col("b").cast("double"), F.col("n_base"))
    q = F.try_divide(F.col("c").cast("double"), F.col("n_current"))
    m = (p + q) / 2

    def kl(a):
        return F.when(a > 0, a * F.log(F.try_divide(a, m))).otherwise(F.lit(0.0))

    return g.groupBy("feature").agg(
        _both(F.sqrt(F.greatest(F.sum(0.5 * kl(p) + 0.5 * kl(q)), F.lit(0.0)))).alias("js_distance"))


def _sides(long: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows as counts of the two sides, and each feature's sizes and ranges: all that binned measures need, without an order of the values."""
    rows = long.where(F.col("value").isNotNull() & F.col("side").isNotNull()).select(
        "feature", "value", (F.col("side") == 0).cast("long").alias("c0"), (F.col("side") == 1).cast("long").alias("c1"))
    base = F.when(F.col("c0") > 0, F.col("value"))
    return rows, rows.groupBy("feature").agg(F.sum("c0").alias("n_base"), F.sum("c1").alias("n_current"), F.min(base).alias("bmin"),
                                             F.max(base).alias("bmax"), F.min("value").alias("amin"), F.max("value").alias("amax"))


def psi(long: DataFrame, bins: int = PSI_BINS) -> DataFrame:
    """Population stability index per feature.

    ``bins`` equal bins over the base range; current values outside it fall
    out of the counts but stay in the denominator; both shares are smoothed:
    (count + 1e-6) / (n + 1e-6 * bins).  PSI = sum (c - b) * ln(c / b); NULL
    if a side is empty.
    """
    return _psi(*_sides(long), bins)


def psi_status(p) -> Column:
    """D6."""
    return (F.when(p > PSI_MAJOR, "Major").when(p > PSI_MODERATE, "Moderate").when(p.isNotNull(), "Stable"))


def js_distance(long: DataFrame, bins: int = JS_BINS) -> DataFrame:
    """Jensen-Shannon distance (square root of the divergence, natural log)
    of the two ``bins``-bin histograms over the joint range; NULL if a side is empty."""
    return _js(*_sides(long), bins)


def drift_report(long: DataFrame, min_values: int = 5, digits: int = 4, method: str = "limit") -> DataFrame:
    """KS statistic, p-value, PSI, JS distance, alert and PSI status per
    feature, numbers rounded to ``digits`` decimals (status uses the unrounded PSI).

    A feature with fewer than ``min_values`` values on a side is not judged: its
    statistics are NULL and ``Skipped`` says why.  The input is read once.
    """
    run = value_counts(long)
    profile = _profile(run)
    few = (F.col("n_base") < min_values) | (F.col("n_current") < min_values)
    r = _with_pvalue(profile, method).join(_psi(run, profile, PSI_BINS), "feature").join(_js(run, profile, JS_BINS), "feature")
    shown = lambda c: F.when(~few, c)
    return r.select(
        F.col("feature").alias("Feature"),
        shown(F.round("ks_stat", digits)).alias("KS_Stat"),
        shown(F.round("p_value", digits)).alias("P_Value"),
        shown(F.round("psi", digits)).alias("PSI"),
        shown(F.round("js_distance", digits)).alias("JS_Divergence"),
        shown(F.when(F.col("p_value") < ALPHA, "YES").otherwise("NO")).alias("Drift_Alert"),
        shown(psi_status(F.col("psi"))).alias("PSI_Status"),
        F.when(few, F.lit(f"fewer than {min_values} values on a side")).alias("Skipped"),
    )


def drift_counts(report: DataFrame) -> DataFrame:
    """Features judged, drifting and skipped (one row)."""
    return report.agg(F.count("Drift_Alert").alias("n_features"),
                      F.count(F.when(F.col("Drift_Alert") == "YES", 1)).alias("n_drifting"),
                      F.count("Skipped").alias("n_skipped"))


def drift_check(long: DataFrame, features: Sequence[str] | None = None, method: str = "limit") -> DataFrame:
    """D3: the short check: p-value and alert of ``features`` (default: all)."""
    d = long if features is None else long.where(F.col("feature").isin(list(features)))
    return ks_test(d, method).select("feature", "ks_stat", "p_value", (F.col("p_value") < ALPHA).alias("drift"))


def mutual_information(df: DataFrame, cols: Sequence[str], label: str, bins: int = 10) -> DataFrame:
    """D8 (re-aimed): mutual information of each feature with the label (NULL values count as 0) from
    an equal-width ``bins``-bin discretisation, natural log:
    sum p(x, y) ln(p(x, y) / (p(x) p(y)))."""
    long = unpivot(df, cols, keys=[label]).withColumn("value", F.coalesce("value", F.lit(0.0)))
    rng = long.groupBy("feature").agg(F.min("value").alias("mn"), F.max("value").alias("mx"),
                                      F.count(F.lit(1)).alias("n"))
    lo, hi = _widen(F.col("mn"), F.col("mx"))
    rng = rng.select("feature", "n", lo.alias("lo"), hi.alias("hi"))
    b = with_bin(long.join(F.broadcast(rng), "feature"), "value", "lo", "hi", bins).select(
        "feature", label, "n", "bin")
    joint = b.groupBy("feature", "bin", label).agg(F.count(F.lit(1)).alias("nxy"), F.max("n").alias("n"))
    px = joint.groupBy("feature", "bin").agg(F.sum("nxy").alias("nx"))
    py = joint.groupBy("feature", label).agg(F.sum("nxy").alias("ny"))
    j = joint.join(px, ["feature", "bin"]).join(py, ["feature", label])
    nxy, n, nx, ny = (F.col(c).cast("double") for c in ("nxy", "n", "nx", "ny"))  # products exceed a long
    term = (nxy / n) * F.log(nxy * n / (nx * ny))
    return j.groupBy("feature").agg(F.sum(term).alias("mutual_info"))


def top_drift(report: DataFrame, k: int = 10) -> DataFrame:
    """K2: the ``k`` features with the largest KS statistic (ties: feature name)."""
    return report.where(F.col("KS_Stat").isNotNull()).orderBy(F.col("KS_Stat").desc(), F.col("Feature")).limit(k)


def drift_focus(report: DataFrame, feature_order: Sequence[str], k: int = 4) -> DataFrame:
    """K4: the first ``k`` drifting features in table order, or the first ``k``
    features when none drifts."""
    pos = F.array_position(F.array(*[F.lit(c) for c in feature_order]), F.col("Feature"))
    r = report.withColumn("__pos", pos)
    drifts = F.col("Drift_Alert") == "YES"
    any_alert = fitted(report.agg(F.coalesce(F.max(drifts), F.lit(False)).alias("any"))).getField("any")
    return r.where(drifts | ~any_alert).orderBy("__pos").limit(k).drop("__pos")

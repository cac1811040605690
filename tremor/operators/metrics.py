"""Classification metrics, curves and threshold selection.

Inputs are tables of ``(y, score)`` (optionally with group columns ``by``,
e.g. a model name).  Everything is a grouped aggregate or runs on tables
with one row per distinct score / grid point; running sums over scores use
:func:`tremor.operators.ordering.prefix_sums`, so a huge model or class is
never one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.functions import fitted
from tremor.operators.ordering import prefix_sums


def confusion(df: DataFrame, y: str, pred: Column, by: Sequence[str] = ()) -> DataFrame:
    """M5: TN, FP, FN, TP (right with one class present too)."""
    yy = F.col(y)
    return df.groupBy(*by).agg(
        F.count(F.when((yy == 0) & ~pred, 1)).alias("tn"),
        F.count(F.when((yy == 0) & pred, 1)).alias("fp"),
        F.count(F.when((yy == 1) & ~pred, 1)).alias("fn"),
        F.count(F.when((yy == 1) & pred, 1)).alias("tp"),
    )


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0 on zero division (sklearn ``zero_division=0``)."""
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def from_confusion(cm: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """M6: accuracy, precision, recall, f1, specificity, sensitivity from counts."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    precision = _ratio(tp, tp + fp)
    recall = _ratio(tp, tp + fn)
    return cm.select(
        *keep, "tn", "fp", "fn", "tp",
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _ratio(tn, tn + fp).alias("specificity"),
        recall.alias("sensitivity"),
    )


def binary_metrics(df: DataFrame, y: str, score: str, threshold: float | Column,
                   by: Sequence[str] = ()) -> DataFrame:
    """M5 + M6 at a threshold: predicted positive when ``score >= threshold``."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return from_confusion(confusion(df, y, F.col(score) >= t, by), keep=by)


def _score_counts(df: DataFrame, y: str, score: str, by: Sequence[str]) -> DataFrame:
    return df.where(F.col(score).isNotNull()).groupBy(*by, F.col(score).alias("__s")).agg(
        F.count(F.when(F.col(y) == 1, 1)).alias("__pos"),
        F.count(F.when(F.col(y) == 0, 1)).alias("__neg"),
    )


def roc_auc(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """M7: area under the ROC curve (rank statistic, ties count one half).

    NULL when only one class is present (the reference logs and stores None).
    """
    by = list(by)
    counts = _score_counts(df, y, score, by)
    if not by:
        counts = counts.withColumn("__g", F.lit(0))
    keys = by or ["__g"]
    ranked = prefix_sums(counts, keys, ["__s"], ["__neg"], prefix="__cum", total_prefix="__n")
    below = F.col("__cum__neg") - F.col("__neg")
    agg = ranked.groupBy(*keys).agg(
        F.sum(F.col("__pos") * (below.cast("double") + 0.5 * F.col("__neg"))).alias("__u"),
        F.sum("__pos").alias("n_pos"),
        F.sum("__neg").alias("n_neg"),
    )
    auc = F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                 F.col("__u") / (F.col("n_pos").cast("double") * F.col("n_neg")))
    return agg.select(*by, "n_pos", "n_neg", auc.alias("roc_auc"))


def _desc_curve(df: DataFrame, y: str, score: str, by: Sequence[str]) -> DataFrame:
    by = list(by)
    counts = _score_counts(df, y, score, by)
    if not by:
        counts = counts.withColumn("__g", F.lit(0))
    keys = by or ["__g"]
    return prefix_sums(counts, keys, [F.col("__s").desc()], ["__pos", "__neg"], prefix="__cum",
                       total_prefix="__n"), keys


def roc_curve(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """M8: one point per distinct score (descending), plus the (0, 0) start
    with threshold +inf; collinear points are kept."""
    c, keys = _desc_curve(df, y, score, by)
    pts = c.select(
        *keys, F.col("__s").alias("threshold"),
        F.try_divide(F.col("__cum__neg").cast("double"), F.col("__n__neg")).alias("fpr"),
        F.try_divide(F.col("__cum__pos").cast("double"), F.col("__n__pos")).alias("tpr"),
    )
    start = c.groupBy(*keys).agg(F.lit(0)).select(
        *keys, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    out = pts.unionByName(start)
    return out.drop("__g") if not by else out


def pr_curve(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """M9: precision and recall at every distinct score, plus the end point
    (precision 1, recall 0, threshold NULL)."""
    c, keys = _desc_curve(df, y, score, by)
    tp, fp = F.col("__cum__pos").cast("double"), F.col("__cum__neg").cast("double")
    pts = c.select(
        *keys, F.col("__s").alias("threshold"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, F.col("__n__pos")).alias("recall"),
    )
    end = c.groupBy(*keys).agg(F.lit(0)).select(
        *keys, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"))
    out = pts.unionByName(end)
    return out.drop("__g") if not by else out


def classification_report(df: DataFrame, y: str, pred: Column) -> DataFrame:
    """Precision, recall, f1 and support per class, then accuracy, macro
    and weighted averages (sklearn ``classification_report`` rows)."""
    cm = confusion(df, y, pred)
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    p1, r1 = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    p0, r0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp)
    f1 = _ratio(2 * p1 * r1, p1 + r1)
    f0 = _ratio(2 * p0 * r0, p0 + r0)
    s0, s1 = tn + fp, tp + fn
    n = s0 + s1
    def row(name, p, r, f, sup):
        return F.struct(F.lit(name).alias("class"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1"),
                        sup.cast("double").alias("support"))

    none = F.lit(None).cast("double")
    rows = F.array(
        row("0", p0, r0, f0, s0),
        row("1", p1, r1, f1, s1),
        row("accuracy", none, none, _ratio(tp + tn, n), n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", _ratio(p0 * s0 + p1 * s1, n), _ratio(r0 * s0 + r1 * s1, n),
            _ratio(f0 * s0 + f1 * s1, n), n),
    )
    return cm.select(F.explode(rows).alias("r")).select("r.*").withColumn(
        "support", F.col("support").cast("long"))


def threshold_sweep(
    df: DataFrame,
    y: str,
    score: str,
    lo: int = 10,
    hi: int = 90,
    scale: int = 100,
    min_precision: float = 0.5,
    by: Sequence[str] = (),
) -> DataFrame:
    """Precision / recall / f1 at thresholds ``i / scale`` for i in [lo, hi].

    Integer grid (a float ``arange`` drifts).  Each score is binned once to
    the number of grid points it clears (``score >= i / scale``, checked
    against the exact grid values), counts per bin are tiny, and suffix sums
    over the bins give every threshold: one pass over the data.
    ``valid`` = precision >= ``min_precision``.
    """
    by = list(by)
    s = F.col(score)
    k0 = F.floor(s * F.lit(float(scale))).cast("int")
    k1 = F.when(s >= (k0 + 1).cast("double") / F.lit(float(scale)), k0 + 1).otherwise(k0)
    k = F.when(s < k1.cast("double") / F.lit(float(scale)), k1 - 1).otherwise(k1)
    # bin b = the largest grid index whose threshold the score clears, clamped
    b = F.greatest(F.least(k, F.lit(hi)), F.lit(lo - 1))
    binned = df.where(s.isNotNull()).groupBy(*by, b.alias("__b")).agg(
        F.count(F.when(F.col(y) == 1, 1)).alias("__pos"),
        F.count(F.when(F.col(y) == 0, 1)).alias("__neg"),
    )
    # full bin grid lo-1 .. hi per group (empty bins count 0), then suffix sums:
    # predicted positive at threshold i <=> bin >= i
    groups = binned.groupBy(*by).agg(F.sum("__pos").alias("__P"), F.sum("__neg").alias("__N"))
    grid = groups.select(*by, "__P", "__N", F.explode(F.sequence(F.lit(lo - 1), F.lit(hi))).alias("__b"))
    full = grid.join(binned, on=[*by, "__b"], how="left").na.fill(0, subset=["__pos", "__neg"])
    w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy(F.col("__b").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    agg = full.select(*by, "__P", "__N", F.col("__b").alias("__i"),
                      F.sum("__pos").over(w).alias("tp"), F.sum("__neg").over(w).alias("fp")) \
        .where(F.col("__i") >= lo)
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    precision = _ratio(tp, tp + fp)
    recall = _ratio(tp, F.col("__P").cast("double"))
    return agg.select(
        *by,
        (F.col("__i") / F.lit(float(scale))).alias("threshold"),
        F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"),
        (F.col("__P") - F.col("tp")).cast("long").alias("fn"),
        (F.col("__N") - F.col("fp")).cast("long").alias("tn"),
        precision.alias("precision"), recall.alias("recall"),
        _ratio(2 * precision * recall, precision + recall).alias("f1"),
        (precision >= F.lit(min_precision)).alias("valid"),
    )


def optimal_threshold(sweep: DataFrame, target_recall: float = 0.95, by: Sequence[str] = ()) -> DataFrame:
    """Among valid points, the smallest |recall - target|, then the
    highest precision, then the lowest threshold.  With no valid point the
    reference crashes; we take the highest recall of the whole sweep.

    Works on the sweep table (one row per grid point).
    """
    by = list(by)
    w_all = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    any_valid = F.max(F.col("valid").cast("int")).over(w_all)
    d = sweep.withColumn("__any", any_valid)
    cand = d.where((F.col("__any") == 0) | F.col("valid"))
    gap = F.abs(F.col("recall") - F.lit(target_recall))
    key1 = F.when(F.col("__any") == 1, gap).otherwise(-F.col("recall"))
    key2 = F.when(F.col("__any") == 1, -F.col("precision")).otherwise(F.lit(0.0))
    w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy(key1, key2, F.col("threshold"))
    best = cand.withColumn("__rk", F.row_number().over(w)).where(F.col("__rk") == 1)
    return best.select(*by, "threshold", "precision", "recall", "f1",
                       (F.col("__any") == 1).alias("found_valid"))


def threshold_compare(df: DataFrame, y: str, score: str, chosen: DataFrame, default: float = 0.5) -> DataFrame:
    """Metrics at the default threshold and at the chosen one, side by side
    (the chosen threshold, a one-row table, is read as a scalar subquery)."""
    t = fitted(chosen.select(F.col("threshold").alias("__t")).limit(1))
    d = df.withColumn("__t", t.getField("__t"))
    a = binary_metrics(d.withColumn("__name", F.lit("default")).withColumn("__thr", F.lit(float(default))),
                       y, score, F.col("__thr"), by=["__name", "__thr"])
    b = binary_metrics(d.withColumn("__name", F.lit("optimal")), y, score, F.col("__t"), by=["__name", "__t"])
    b = b.withColumnRenamed("__t", "__thr")
    return a.unionByName(b).withColumnRenamed("__name", "setting").withColumnRenamed("__thr", "threshold")

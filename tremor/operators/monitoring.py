"""Monitoring of predictions over time.

Predictions and outcomes are joined on machine and time; rates are grouped
by day windows; the score distribution of each day is compared with a base
period by PSI; a retrain flag combines both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.functions import fitted
from tremor.operators.drift import PSI_EPS, _widen
from tremor.operators.metrics import _ratio
from tremor.operators.stats import with_bin

# Recall floor 0.80 for alerts, PSI 0.2 for a distribution shift.
RECALL_FLOOR = 0.80
PSI_SHIFT = 0.2


def feedback_label(pred: Column, actual: Column) -> Column:
    """O1: CORRECT_POSITIVE, FALSE_POSITIVE, FALSE_NEGATIVE, CORRECT_NEGATIVE."""
    return (F.when(pred & actual, "CORRECT_POSITIVE")
            .when(pred & ~actual, "FALSE_POSITIVE")
            .when(~pred & actual, "FALSE_NEGATIVE")
            .otherwise("CORRECT_NEGATIVE"))


def daily_rates(df: DataFrame, ts: str, pred: str, actual: str, floor: float = RECALL_FLOOR,
                period: str = "1 day") -> DataFrame:
    """O2: per period recall, precision, false-positive and false-negative
    rates, and ``recall_alert`` when recall < ``floor``."""
    p, a = F.col(pred), F.col(actual)
    g = df.groupBy(F.window(ts, period).alias("w")).agg(
        F.count(F.when(p & a, 1)).alias("tp"), F.count(F.when(p & ~a, 1)).alias("fp"),
        F.count(F.when(~p & a, 1)).alias("fn"), F.count(F.when(~p & ~a, 1)).alias("tn"))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    recall = _ratio(tp, tp + fn)
    return g.select(
        F.col("w.start").alias("day"), "tp", "fp", "fn", "tn",
        recall.alias("recall"), _ratio(tp, tp + fp).alias("precision"),
        _ratio(fp, fp + tn).alias("fp_rate"), _ratio(fn, fn + tp).alias("fn_rate"),
        (recall < F.lit(floor)).alias("recall_alert"))


def psi_by_period(df: DataFrame, ts: str, score: str, base_end: str, bins: int = 10,
                  period: str = "1 day") -> DataFrame:
    """O3: PSI of the score distribution of each period from ``base_end`` on
    against the base period before it.  The base histogram is computed once
    (one row per bin) and joined to every period's counts; nothing of the
    base is copied per period."""
    is_base = F.col(ts) < F.lit(base_end).cast(df.schema[ts].dataType)
    base = df.where(is_base & F.col(score).isNotNull())
    cur = df.where(~is_base & F.col(score).isNotNull())
    rng = base.agg(F.min(score).alias("mn"), F.max(score).alias("mx"), F.count(F.lit(1)).alias("n0"))
    lo, hi = _widen(F.col("mn"), F.col("mx"))
    rng = fitted(rng.select(lo.alias("lo"), hi.alias("hi"), "n0"))

    def with_range(d):
        return d.withColumns({"lo": rng.getField("lo"), "hi": rng.getField("hi"), "n0": rng.getField("n0")})

    bb = with_bin(with_range(base), score, "lo", "hi", bins).select("bin")
    bcount = bb.where(F.col("bin").isNotNull()).groupBy("bin").agg(F.count(F.lit(1)).alias("b"))
    cc = with_bin(with_range(cur), score, "lo", "hi", bins).select(
        F.window(ts, period).start.alias("day"), "bin")
    days = cc.groupBy("day").agg(F.count(F.lit(1)).alias("n1"))
    ccount = cc.where(F.col("bin").isNotNull()).groupBy("day", "bin").agg(F.count(F.lit(1)).alias("c"))
    grid = with_range(days).select("day", "n1", "n0",
                                              F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    g = grid.join(F.broadcast(bcount), "bin", "left").join(ccount, ["day", "bin"], "left") \
        .na.fill(0, subset=["b", "c"])
    eps = F.lit(PSI_EPS)
    bp = (F.col("b") + eps) / (F.col("n0") + eps * bins)
    cp = (F.col("c") + eps) / (F.col("n1") + eps * bins)
    return g.groupBy("day").agg(F.sum((cp - bp) * F.log(cp / bp)).alias("psi"))


def retrain_trigger(rates: DataFrame, shift: DataFrame, floor: float = RECALL_FLOOR,
                    psi_limit: float = PSI_SHIFT) -> DataFrame:
    """Retrain when recall is below the floor or the score distribution moved."""
    j = rates.select("day", "recall").join(shift, "day", "left")
    return j.select("day", "recall", "psi",
                    ((F.col("recall") < floor) | (F.coalesce(F.col("psi"), F.lit(0.0)) > psi_limit)).alias("retrain"))

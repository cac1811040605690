"""Queries: statistics, scaling / split / balancing, metrics, thresholds, drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from tremor.operators import drift, features, information, metrics, prepare, stats
from tremor.plans import bindings as B
from tremor.plans.registry import register

CH = B.LINEITEM_CHANNELS


def _union_long(table: str, cols, extra: str = "") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {extra}'{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {table}" for c in cols)


# ---------------------------------------------------------------- statistics

@register("class_distribution", sql="""
SELECT count(*) FILTER (WHERE quality = 0) AS class_0_count,
       count(*) FILTER (WHERE quality = 1) AS class_1_count,
       100.0 * count(*) FILTER (WHERE quality = 0) / count(*) AS class_0_percentage,
       100.0 * count(*) FILTER (WHERE quality = 1) / count(*) AS class_1_percentage,
       CASE WHEN count(*) FILTER (WHERE quality = 0) > 0
            THEN count(*) FILTER (WHERE quality = 1) * 1.0 / count(*) FILTER (WHERE quality = 0)
            ELSE 0.0 END AS imbalance_ratio
FROM labels""", dbl=["class_0_percentage", "class_1_percentage", "imbalance_ratio"])
def q_class_distribution(spark, sf_dir):
    """Class counts, percentages and imbalance ratio of labels.quality."""
    return stats.class_distribution(B.table(spark, sf_dir, "labels"), "quality")


_DESCRIBE_SQL = f"""
WITH l AS ({_union_long("lineitem", CH)})
SELECT feature, count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
  quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75,
  max(value) AS max
FROM l GROUP BY feature"""


@register("describe", sql=_DESCRIBE_SQL, dbl=["mean", "std", "min", "q25", "q50", "q75", "max"])
def q_describe(spark, sf_dir):
    """Count, mean, sample std, min, exact quartiles, max of the lineitem channels."""
    return stats.describe(B.lineitem_recordings(spark, sf_dir), CH)


def _feat_sql() -> str:
    from tremor.plans.q_features import _sql_features
    return _sql_features("lineitem", "l_suppkey", CH)


_MEANS = [f"{c}_mean" for c in CH]
_CORR_SQL = f"""
WITH f AS ({_feat_sql()})
""" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS corr FROM f"
    for i, a in enumerate(_MEANS) for b in _MEANS[i + 1:])


@register("correlation_matrix", sql=_CORR_SQL, dbl=["corr"], absr=["corr"])
def q_correlation_matrix(spark, sf_dir):
    """Pearson r between the ``_mean`` features of the supplier recordings."""
    f = features.recording_features(B.lineitem_recordings(spark, sf_dir), ["l_suppkey"], CH)
    return stats.correlation_matrix(f, _MEANS)


_IQR_SQL = f"""
WITH l AS ({_union_long("lineitem", CH)}),
q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM l GROUP BY feature),
b AS (SELECT feature, q1, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT b.feature, b.q1, b.q3, b.lo, b.hi, count(*) FILTER (WHERE l.value < b.lo OR l.value > b.hi) AS n_outliers
FROM l JOIN b USING (feature) GROUP BY b.feature, b.q1, b.q3, b.lo, b.hi"""


@register("iqr_outliers", sql=_IQR_SQL, dbl=["q1", "q3", "lo", "hi"])
def q_iqr_outliers(spark, sf_dir):
    """IQR bounds and strict outlier counts per lineitem channel."""
    return stats.iqr_outliers(B.lineitem_recordings(spark, sf_dir), CH).select(
        "feature", "q1", "q3", "lo", "hi", "n_outliers")


_Z_SQL = f"""
WITH l AS ({_union_long("lineitem", CH)}),
s AS (SELECT feature, avg(value) AS mean, stddev_pop(value) AS std FROM l GROUP BY feature)
SELECT s.feature, s.mean, s.std, count(*) FILTER (WHERE abs((l.value - s.mean) / nullif(s.std, 0)) > 3) AS n_outliers
FROM l JOIN s USING (feature) GROUP BY s.feature, s.mean, s.std"""


@register("zscore_outliers", sql=_Z_SQL, dbl=["mean", "std"])
def q_zscore_outliers(spark, sf_dir):
    """|z| > 3 outlier counts (population std) per lineitem channel."""
    return stats.zscore_outliers(B.lineitem_recordings(spark, sf_dir), CH)


_CLIP_SQL = f"""
WITH l AS ({_union_long("lineitem", CH)}),
q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM l GROUP BY feature),
b AS (SELECT feature, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q),
w AS (SELECT {", ".join(f"max(lo) FILTER (WHERE feature = '{c}') AS lo_{c}, max(hi) FILTER (WHERE feature = '{c}') AS hi_{c}" for c in CH)} FROM b)
SELECT l_suppkey, {", ".join(f"least(greatest({c}, lo_{c}), hi_{c}) AS {c}" for c in CH)}
FROM lineitem, w"""


@register("clip_iqr", sql=_CLIP_SQL, dbl=CH)
def q_clip_iqr(spark, sf_dir):
    """Every lineitem channel clipped to its IQR bounds."""
    return stats.clip_iqr(B.lineitem_recordings(spark, sf_dir), CH)


_HIST_SQL = f"""
WITH l AS ({_union_long("lineitem", CH)}),
r AS (SELECT feature, count(value) AS n,
        CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
        CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi
      FROM l GROUP BY feature),
i AS (SELECT l.feature, l.value, r.lo, r.hi, CAST(floor((l.value - r.lo) * (10.0 / (r.hi - r.lo))) AS INTEGER) AS k0
      FROM l JOIN r USING (feature)),
i1 AS (SELECT *, CASE WHEN k0 >= 10 THEN 9 ELSE k0 END AS k1 FROM i),
i2 AS (SELECT *, CASE WHEN value < (CASE WHEN k1 = 10 THEN hi ELSE lo + k1 * ((hi - lo) / 10.0) END)
                      THEN k1 - 1 ELSE k1 END AS k2 FROM i1),
i3 AS (SELECT feature, CASE WHEN value >= (CASE WHEN k2 + 1 = 10 THEN hi ELSE lo + (k2 + 1) * ((hi - lo) / 10.0) END)
                             AND k2 <> 9 THEN k2 + 1 ELSE k2 END AS bin FROM i2),
c AS (SELECT feature, bin, count(*) AS cnt FROM i3 GROUP BY feature, bin),
g AS (SELECT r.feature, r.n, r.lo, r.hi, CAST(b.bin AS INTEGER) AS bin FROM r, range(0, 10) b(bin))
SELECT g.feature, g.bin, g.lo + g.bin * ((g.hi - g.lo) / 10.0) AS bin_lo,
  CASE WHEN g.bin = 9 THEN g.hi ELSE g.lo + (g.bin + 1) * ((g.hi - g.lo) / 10.0) END AS bin_hi,
  coalesce(c.cnt, 0) AS count, coalesce(c.cnt, 0) / (g.n * ((g.hi - g.lo) / 10.0)) AS density
FROM g LEFT JOIN c USING (feature, bin)"""


@register("histogram", sql=_HIST_SQL, dbl=["bin_lo", "bin_hi", "density"])
def q_histogram(spark, sf_dir):
    """10-bin equal-width histogram (NumPy edges, empty bins kept) per lineitem channel."""
    return stats.histogram(B.lineitem_recordings(spark, sf_dir), CH, bins=10)


# ---------------------------------------------------------------- scaling, split, balance

_FEATS = [f"{c}_{s}" for c in CH for s in features.STATS[:-1]]


def _scale_sql(method: str) -> str:
    cols = _FEATS
    if method == "standard":
        stat = ", ".join(f"avg({c}) AS c_{c}, coalesce(nullif(stddev_pop({c}), 0), 1.0) AS s_{c}" for c in cols)
    elif method == "minmax":
        stat = ", ".join(f"min({c}) AS c_{c}, coalesce(nullif(max({c}) - min({c}), 0), 1.0) AS s_{c}" for c in cols)
    else:
        stat = ", ".join(
            f"quantile_cont({c}, 0.5) AS c_{c}, "
            f"coalesce(nullif(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 0), 1.0) AS s_{c}"
            for c in cols)
    return f"""
WITH f AS ({_feat_sql()}), st AS (SELECT {stat} FROM f)
SELECT l_suppkey, {", ".join(f"({c} - c_{c}) / s_{c} AS {c}" for c in cols)} FROM f, st"""


def _scale_q(method):
    def q(spark, sf_dir):
        f = features.recording_features(B.lineitem_recordings(spark, sf_dir), ["l_suppkey"], CH)
        f = f.select("l_suppkey", *_FEATS)
        return prepare.scale(f, _FEATS, method)
    q.__doc__ = f"B1-B4: {method} scaling of supplier features (fitted on the table, zero scale -> 1)."
    return q


register("scale_robust", sql=_scale_sql("robust"), dbl=_FEATS, absr=_FEATS)(_scale_q("robust"))
register("scale_standard", sql=_scale_sql("standard"), dbl=_FEATS, absr=_FEATS)(_scale_q("standard"))
register("scale_minmax", sql=_scale_sql("minmax"), dbl=_FEATS, absr=_FEATS)(_scale_q("minmax"))

_H_DOC = "CAST('0x' || substr(md5(concat_ws('|', CAST(doc_id AS VARCHAR), '42')), 1, 15) AS BIGINT)"

_SPLIT_SQL = f"""
WITH s AS (SELECT quality, count(*) AS nc FROM labels GROUP BY quality),
t AS (SELECT *, sum(nc) OVER () AS n, ceil(0.2 * sum(nc) OVER ()) AS nt FROM s),
e AS (SELECT *, nt * nc / n AS ex, floor(nt * nc / n) AS fl FROM t),
a AS (SELECT *, row_number() OVER (ORDER BY ex - fl DESC, quality) AS rk, nt - sum(fl) OVER () AS lft FROM e),
k AS (SELECT quality, fl + CASE WHEN rk <= lft THEN 1 ELSE 0 END AS take FROM a),
r AS (SELECT doc_id, quality, toxic,
        row_number() OVER (PARTITION BY quality ORDER BY {_H_DOC}, doc_id) AS rn FROM labels)
SELECT r.doc_id, r.quality, r.toxic, r.rn <= k.take AS is_test FROM r JOIN k USING (quality)"""


@register("stratified_split", sql=_SPLIT_SQL)
def q_stratified_split(spark, sf_dir):
    """Exact, repeatable stratified 80/20 split of labels by quality (md5 order, seed 42)."""
    lab = B.table(spark, sf_dir, "labels")
    return prepare.stratified_split(lab, "quality", "doc_id", test_size=0.2, seed=42)


@register("class_weights", sql="""
SELECT quality, count(*) AS n_c, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight
FROM labels GROUP BY quality""", dbl=["weight"])
def q_class_weights(spark, sf_dir):
    """Balanced class weights n / (k * n_c) for labels.quality."""
    return prepare.class_weights(B.table(spark, sf_dir, "labels"), "quality")


@register("pos_weight", sql="""
SELECT count(*) FILTER (WHERE quality = 0) * 1.0 / nullif(count(*) FILTER (WHERE quality = 1), 0)
  AS scale_pos_weight FROM labels""", dbl=["scale_pos_weight"])
def q_pos_weight(spark, sf_dir):
    """Positive-class weight n0 / n1."""
    return prepare.pos_weight(B.table(spark, sf_dir, "labels"), "quality")


_OVER_SQL = f"""
WITH c AS (SELECT quality, count(*) AS nc FROM labels GROUP BY quality),
m AS (SELECT max(nc) AS nmax FROM c),
r AS (SELECT doc_id, quality, toxic,
        row_number() OVER (PARTITION BY quality ORDER BY {_H_DOC}, doc_id) - 1 AS rk FROM labels),
d AS (SELECT quality, nc, unnest(range(nmax - nc)) AS draw FROM c, m WHERE nc < nmax),
dr AS (SELECT quality, draw,
         CAST('0x' || substr(md5(concat_ws('|', CAST(quality AS VARCHAR), CAST(draw AS VARCHAR), '42')), 1, 15) AS BIGINT) % nc AS rk
       FROM d)
SELECT doc_id, quality, toxic, false AS synthetic, CAST(NULL AS BIGINT) AS draw FROM labels
UNION ALL
SELECT r.doc_id, r.quality, r.toxic, true, dr.draw FROM dr JOIN r USING (quality, rk)"""


@register("oversample_random", sql=_OVER_SQL)
def q_oversample_random(spark, sf_dir):
    """Random oversampling with replacement of labels up to the majority class."""
    return prepare.oversample_random(B.table(spark, sf_dir, "labels"), "quality", "doc_id", seed=42)


# ---------------------------------------------------------------- metrics

_SCORED = "SELECT event_id, ts, user_id, CAST(event_type = 'error' AS INTEGER) AS y, value / (value + 50.0) AS score FROM events"
_DOCS = ("SELECT l.doc_id, l.quality AS y, d.n_chars / (d.n_chars + 1000.0) AS score "
         "FROM labels l JOIN documents d USING (doc_id)")

_CM = """count(*) FILTER (WHERE y = 0 AND score < {t}) AS tn, count(*) FILTER (WHERE y = 0 AND score >= {t}) AS fp,
  count(*) FILTER (WHERE y = 1 AND score < {t}) AS fn, count(*) FILTER (WHERE y = 1 AND score >= {t}) AS tp"""

_MET = """tn, fp, fn, tp,
  CASE WHEN tp + tn + fp + fn > 0 THEN (tp + tn) * 1.0 / (tp + tn + fp + fn) ELSE 0.0 END AS accuracy,
  CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0.0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1,
  CASE WHEN tn + fp > 0 THEN tn * 1.0 / (tn + fp) ELSE 0.0 END AS specificity,
  CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0.0 END AS sensitivity"""
_MET_COLS = ["accuracy", "precision", "recall", "f1", "specificity", "sensitivity"]


@register("confusion_matrix", sql=f"SELECT {_CM.format(t='0.5')} FROM ({_SCORED}) s")
def q_confusion_matrix(spark, sf_dir):
    """M5: TN, FP, FN, TP at threshold 0.5 (y = error event, score = value / (value + 50))."""
    s = B.scored_events(spark, sf_dir)
    return metrics.confusion(s, "y", F.col("score") >= 0.5)


@register("metrics", sql=f"SELECT {_MET} FROM (SELECT {_CM.format(t='0.5')} FROM ({_SCORED}) s) c",
          dbl=_MET_COLS)
def q_metrics(spark, sf_dir):
    """M6: accuracy, precision, recall, f1, specificity, sensitivity at 0.5."""
    return metrics.binary_metrics(B.scored_events(spark, sf_dir), "y", "score", 0.5)


def _auc_sql(src: str) -> str:
    return f"""
WITH c AS (SELECT score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg
           FROM ({src}) s WHERE score IS NOT NULL GROUP BY score),
r AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS below FROM c)
SELECT sum(pos) AS n_pos, sum(neg) AS n_neg,
  CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) END AS roc_auc
FROM r"""


@register("roc_auc", sql=f"SELECT CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg, roc_auc FROM ({_auc_sql(_DOCS)}) a",
          dbl=["roc_auc"])
def q_roc_auc(spark, sf_dir):
    """M7: ROC-AUC of y = labels.quality by score = n_chars / (n_chars + 1000)."""
    return metrics.roc_auc(B.scored_documents(spark, sf_dir), "y", "score")


_CURVE_BASE = """
WITH c AS (SELECT score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg
           FROM ({src}) s WHERE score IS NOT NULL GROUP BY score),
r AS (SELECT score,
        sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
        sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
        sum(pos) OVER () AS np, sum(neg) OVER () AS nn FROM c)"""

_ROC_SQL = _CURVE_BASE.format(src=_SCORED) + """
SELECT score AS threshold, fp * 1.0 / nullif(nn, 0) AS fpr, tp * 1.0 / nullif(np, 0) AS tpr FROM r
UNION ALL SELECT 'inf'::DOUBLE, 0.0, 0.0"""


@register("roc_curve", sql=_ROC_SQL, dbl=["threshold", "fpr", "tpr"])
def q_roc_curve(spark, sf_dir):
    """M8: ROC points at every distinct score of the scored events."""
    return metrics.roc_curve(B.scored_events(spark, sf_dir), "y", "score")


_PR_SQL = _CURVE_BASE.format(src=_SCORED) + """
SELECT score AS threshold, tp * 1.0 / nullif(tp + fp, 0) AS precision, tp * 1.0 / nullif(np, 0) AS recall FROM r
UNION ALL SELECT NULL::DOUBLE, 1.0, 0.0"""


@register("pr_curve", sql=_PR_SQL, dbl=["threshold", "precision", "recall"])
def q_pr_curve(spark, sf_dir):
    """M9: precision-recall points at every distinct score, plus (1, 0)."""
    return metrics.pr_curve(B.scored_events(spark, sf_dir), "y", "score")


_REPORT_SQL = f"""
WITH c AS (SELECT {_CM.format(t='0.5')} FROM ({_SCORED}) s),
v AS (SELECT *,
  CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) ELSE 0.0 END AS p1,
  CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0.0 END AS r1,
  CASE WHEN tn + fn > 0 THEN tn * 1.0 / (tn + fn) ELSE 0.0 END AS p0,
  CASE WHEN tn + fp > 0 THEN tn * 1.0 / (tn + fp) ELSE 0.0 END AS r0,
  tn + fp AS s0, tp + fn AS s1 FROM c),
f AS (SELECT *, CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1,
               CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0, s0 + s1 AS n FROM v)
SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, CAST(s0 AS BIGINT) AS support FROM f
UNION ALL SELECT '1', p1, r1, f1, s1 FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, CASE WHEN n > 0 THEN (tp + tn) * 1.0 / n ELSE 0.0 END, n FROM f
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM f
UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n FROM f"""


@register("classification_report", sql=_REPORT_SQL, dbl=["precision", "recall", "f1"])
def q_classification_report(spark, sf_dir):
    """Per-class precision / recall / f1 / support plus averages at 0.5."""
    return metrics.classification_report(B.scored_events(spark, sf_dir), "y", F.col("score") >= 0.5)


_SWEEP_SQL = f"""
WITH g AS (SELECT CAST(i AS INTEGER) AS i FROM range(10, 91) t(i)),
s AS ({_SCORED}),
c AS (SELECT g.i, count(*) FILTER (WHERE s.y = 1 AND s.score >= g.i / 100.0) AS tp,
             count(*) FILTER (WHERE s.y = 0 AND s.score >= g.i / 100.0) AS fp,
             count(*) FILTER (WHERE s.y = 1) AS np, count(*) FILTER (WHERE s.y = 0) AS nn
      FROM g, s GROUP BY g.i),
m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) ELSE 0.0 END AS precision,
               CASE WHEN np > 0 THEN tp * 1.0 / np ELSE 0.0 END AS recall FROM c)
SELECT i / 100.0 AS threshold, tp, fp, np - tp AS fn, nn - fp AS tn, precision, recall,
  CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1,
  precision >= 0.5 AS valid
FROM m"""


@register("threshold_sweep", sql=_SWEEP_SQL, dbl=["threshold", "precision", "recall", "f1"])
def q_threshold_sweep(spark, sf_dir):
    """Precision / recall / f1 at thresholds 0.10 .. 0.90 step 0.01 (81 points)."""
    return metrics.threshold_sweep(B.scored_events(spark, sf_dir), "y", "score", 10, 90, 100, 0.5)


_OPT_SQL = f"""
WITH sw AS ({_SWEEP_SQL}),
a AS (SELECT *, max(CAST(valid AS INTEGER)) OVER () AS anyv FROM sw),
c AS (SELECT * FROM a WHERE anyv = 0 OR valid)
SELECT threshold, precision, recall, f1, anyv = 1 AS found_valid FROM c
ORDER BY CASE WHEN anyv = 1 THEN abs(recall - 0.95) ELSE -recall END,
         CASE WHEN anyv = 1 THEN -precision ELSE 0.0 END, threshold
LIMIT 1"""


@register("optimal_threshold", sql=_OPT_SQL, dbl=["threshold", "precision", "recall", "f1"])
def q_optimal_threshold(spark, sf_dir):
    """Threshold closest to recall 0.95 with the highest precision
    among thresholds of precision >= 0.5 (else the highest recall)."""
    sweep = metrics.threshold_sweep(B.scored_events(spark, sf_dir), "y", "score", 10, 90, 100, 0.5)
    return metrics.optimal_threshold(sweep, 0.95)


_CMP_SQL = f"""
WITH o AS (SELECT threshold FROM ({_OPT_SQL}) x),
s AS ({_SCORED})
SELECT 'default' AS setting, 0.5 AS threshold, {_MET} FROM (SELECT {_CM.format(t='0.5')} FROM s) c
UNION ALL
SELECT 'optimal', (SELECT threshold FROM o), {_MET}
FROM (SELECT {_CM.format(t='(SELECT threshold FROM o)')} FROM s) c"""


@register("threshold_compare", sql=_CMP_SQL, dbl=["threshold"] + _MET_COLS)
def q_threshold_compare(spark, sf_dir):
    """Metrics at the default 0.5 and at the optimal threshold."""
    s = B.scored_events(spark, sf_dir)
    sweep = metrics.threshold_sweep(s, "y", "score", 10, 90, 100, 0.5)
    return metrics.threshold_compare(s, "y", "score", metrics.optimal_threshold(sweep, 0.95))


# ---------------------------------------------------------------- drift

_DRIFT_LONG = (f"SELECT event_type AS feature, value, CAST(ts >= TIMESTAMP '{B.EVENTS_SPLIT_DAY}' AS INTEGER) AS side "
               "FROM events WHERE value IS NOT NULL")

def _ks_sql(long_sql: str) -> str:
    return f"""
WITH l AS ({long_sql}),
c AS (SELECT feature, value, count(*) FILTER (WHERE side = 0) AS c0, count(*) FILTER (WHERE side = 1) AS c1
      FROM l GROUP BY feature, value),
r AS (SELECT feature,
        sum(c0) OVER w AS k0, sum(c1) OVER w AS k1,
        sum(c0) OVER (PARTITION BY feature) AS n0, sum(c1) OVER (PARTITION BY feature) AS n1
      FROM c WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT feature, max(abs(k0 / nullif(n0, 0) - k1 / nullif(n1, 0))) AS ks_stat, CAST(max(n0) AS BIGINT) AS n_base,
       CAST(max(n1) AS BIGINT) AS n_current
FROM r GROUP BY feature"""


_KS_SQL = _ks_sql(_DRIFT_LONG)


@register("ks_statistic", sql=_KS_SQL, dbl=["ks_stat"])
def q_ks_statistic(spark, sf_dir):
    """Two-sample KS statistic per event type, events before / from 2024-01-16."""
    return drift.ks_statistic(B.events_drift_samples(spark, sf_dir))


def _pvalue_sql(ks_sql: str) -> str:
    """The limit p-value (small-sample term included) of a KS query's rows."""
    return f"""
WITH ks AS ({ks_sql}),
e AS (SELECT *, sqrt(n_base * 1.0 * n_current / (n_base + n_current)) AS e FROM ks),
l AS (SELECT *, (e + 0.12 + 0.11 / nullif(e, 0)) * ks_stat AS lam FROM e)
SELECT feature, ks_stat, n_base, n_current,
  CASE WHEN n_base = 0 OR n_current = 0 THEN NULL WHEN lam < 0.05 THEN 1.0
       ELSE greatest(0.0, least(1.0, 2.0 * sum(CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * lam * lam)))) END AS p_value
FROM l, range(1, 101) t(k) GROUP BY feature, ks_stat, n_base, n_current, lam"""


@register("ks_pvalue", sql=_pvalue_sql(_KS_SQL), dbl=["ks_stat", "p_value"], absr=["p_value"])
def q_ks_pvalue(spark, sf_dir):
    """D1 + D2: KS statistic and p-value (limit form) per event type."""
    return drift.ks_test(B.events_drift_samples(spark, sf_dir))


def _psi_sql(bins: int = 10, long_sql: str = _DRIFT_LONG) -> str:
    return f"""
WITH l AS ({long_sql}),
z AS (SELECT feature, count(*) FILTER (WHERE side = 0) AS n0, count(*) FILTER (WHERE side = 1) AS n1,
        min(value) FILTER (WHERE side = 0) AS bmin, max(value) FILTER (WHERE side = 0) AS bmax FROM l GROUP BY feature),
r AS (SELECT feature, n0, n1, CASE WHEN bmin = bmax THEN bmin - 0.5 ELSE bmin END AS lo,
        CASE WHEN bmin = bmax THEN bmax + 0.5 ELSE bmax END AS hi FROM z),
{_bin_ctes(bins)}
SELECT feature, sum(((c + 1e-6) / (n1 + 1e-6 * {bins}) - (b + 1e-6) / (n0 + 1e-6 * {bins}))
                    * ln(((c + 1e-6) / (n1 + 1e-6 * {bins})) / ((b + 1e-6) / (n0 + 1e-6 * {bins}))))
                FILTER (WHERE n0 > 0 AND n1 > 0) AS psi
FROM gc GROUP BY feature"""


def _bin_ctes(bins: int) -> str:
    e = "CASE WHEN {k} = {B} THEN hi ELSE lo + {k} * ((hi - lo) / {B}.0) END"
    return f"""
i AS (SELECT l.feature, l.side, l.value, r.lo, r.hi,
        CAST(floor((l.value - r.lo) * ({bins}.0 / (r.hi - r.lo))) AS INTEGER) AS k0
      FROM l JOIN r USING (feature)),
i1 AS (SELECT *, CASE WHEN k0 >= {bins} THEN {bins - 1} ELSE k0 END AS k1 FROM i),
i2 AS (SELECT *, CASE WHEN value < {e.format(k="k1", B=bins)} THEN k1 - 1 ELSE k1 END AS k2 FROM i1),
i3 AS (SELECT feature, side, CASE WHEN value >= lo AND value <= hi THEN
          CASE WHEN value >= {e.format(k="(k2 + 1)", B=bins)} AND k2 <> {bins - 1} THEN k2 + 1 ELSE k2 END END AS bin
       FROM i2),
cc AS (SELECT feature, bin, count(*) FILTER (WHERE side = 0) AS b, count(*) FILTER (WHERE side = 1) AS c
       FROM i3 WHERE bin IS NOT NULL GROUP BY feature, bin),
gg AS (SELECT r.feature, r.n0, r.n1, CAST(t.bin AS INTEGER) AS bin FROM r, range(0, {bins}) t(bin)),
gc AS (SELECT gg.feature, gg.n0, gg.n1, gg.bin, coalesce(cc.b, 0) AS b, coalesce(cc.c, 0) AS c
       FROM gg LEFT JOIN cc USING (feature, bin))"""


@register("psi", sql=_psi_sql(10), dbl=["psi"], absr=["psi"])
def q_psi(spark, sf_dir):
    """PSI per event type, 10 bins over the base (before 2024-01-16) range."""
    return drift.psi(B.events_drift_samples(spark, sf_dir))


def _js_sql(long_sql: str) -> str:
    return f"""
WITH l AS ({long_sql}),
z AS (SELECT feature, count(*) FILTER (WHERE side = 0) AS n0, count(*) FILTER (WHERE side = 1) AS n1,
        min(value) AS amin, max(value) AS amax FROM l GROUP BY feature),
r AS (SELECT feature, n0, n1, CASE WHEN amin = amax THEN amin - 0.5 ELSE amin END AS lo,
        CASE WHEN amin = amax THEN amax + 0.5 ELSE amax END AS hi FROM z),
{_bin_ctes(20)},
pq AS (SELECT feature, n0, n1, b * 1.0 / nullif(n0, 0) AS p, c * 1.0 / nullif(n1, 0) AS q FROM gc)
SELECT feature, CASE WHEN max(n0) > 0 AND max(n1) > 0 THEN sqrt(greatest(sum(
    0.5 * CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END +
    0.5 * CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END), 0)) END AS js_distance
FROM pq GROUP BY feature"""


_JS_SQL = _js_sql(_DRIFT_LONG)


@register("js_distance", sql=_JS_SQL, dbl=["js_distance"], absr=["js_distance"])
def q_js_distance(spark, sf_dir):
    """Jensen-Shannon distance per event type, 20 bins over the joint range."""
    return drift.js_distance(B.events_drift_samples(spark, sf_dir))


def _report_sql(long_sql: str, min_values: int = 5) -> str:
    few = f"(n_base < {min_values} OR n_current < {min_values})"
    return f"""
WITH pv AS ({_pvalue_sql(_ks_sql(long_sql))}), ps AS ({_psi_sql(10, long_sql)}), js AS ({_js_sql(long_sql)}),
a AS (SELECT *, {few} AS few FROM pv JOIN ps USING (feature) JOIN js USING (feature))
SELECT feature AS Feature, CASE WHEN NOT few THEN round(ks_stat, 4) END AS KS_Stat,
  CASE WHEN NOT few THEN round(p_value, 4) END AS P_Value, CASE WHEN NOT few THEN round(psi, 4) END AS PSI,
  CASE WHEN NOT few THEN round(js_distance, 4) END AS JS_Divergence,
  CASE WHEN NOT few THEN CASE WHEN p_value < 0.05 THEN 'YES' ELSE 'NO' END END AS Drift_Alert,
  CASE WHEN NOT few THEN CASE WHEN psi > 0.2 THEN 'Major' WHEN psi > 0.1 THEN 'Moderate' ELSE 'Stable' END END AS PSI_Status,
  CASE WHEN few THEN 'fewer than {min_values} values on a side' END AS Skipped
FROM a"""


_REPORT_DBL = ["KS_Stat", "P_Value", "PSI", "JS_Divergence"]


@register("drift_report", sql=_report_sql(_DRIFT_LONG), dbl=_REPORT_DBL, absr=_REPORT_DBL)
def q_drift_report(spark, sf_dir):
    """KS, p-value, PSI, JS, alert and PSI status per event type."""
    return drift.drift_report(B.events_drift_samples(spark, sf_dir))


# groups 0 to 2 of users have no base values
_ONE_SIDED = ("SELECT CAST(user_id % 50 AS VARCHAR) AS feature, value, CAST(CASE WHEN user_id % 50 < 3 THEN 1 "
              f"ELSE CAST(ts >= TIMESTAMP '{B.EVENTS_SPLIT_DAY}' AS INTEGER) END AS INTEGER) AS side FROM events WHERE value IS NOT NULL")


@register("drift_one_sided", sql=_report_sql(_ONE_SIDED), dbl=_REPORT_DBL, absr=_REPORT_DBL)
def q_drift_one_sided(spark, sf_dir):
    """D1, D4, D5, D7 with features that have no base values: they are reported as skipped."""
    e = B.table(spark, sf_dir, "events")
    group = F.col("user_id") % 50
    long = e.select(group.cast("string").alias("feature"), "value", F.when(group < 3, F.lit(1)).otherwise(
        (F.col("ts") >= F.lit(B.EVENTS_SPLIT_DAY).cast("timestamp_ntz")).cast("int")).alias("side"))
    return drift.drift_report(long)


@register("drift_counts", sql=f"""
WITH r AS ({_report_sql(_ONE_SIDED)})
SELECT count(Drift_Alert) AS n_features, count(*) FILTER (WHERE Drift_Alert = 'YES') AS n_drifting, count(Skipped) AS n_skipped FROM r""")
def q_drift_counts(spark, sf_dir):
    """How many features were judged, drift, or were skipped."""
    return drift.drift_counts(q_drift_one_sided(spark, sf_dir))


_MI_SQL = f"""
WITH l AS (
  {_union_long("lineitem", CH, extra="CAST(l_returnflag = 'R' AS INTEGER) AS y, ")}),
r AS (SELECT feature, count(*) AS n, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
        CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi FROM l GROUP BY feature),
i AS (SELECT l.feature, l.y, l.value, r.lo, r.hi, r.n,
        CAST(floor((l.value - r.lo) * (10.0 / (r.hi - r.lo))) AS INTEGER) AS k0 FROM l JOIN r USING (feature)),
i1 AS (SELECT *, CASE WHEN k0 >= 10 THEN 9 ELSE k0 END AS k1 FROM i),
i2 AS (SELECT *, CASE WHEN value < (CASE WHEN k1 = 10 THEN hi ELSE lo + k1 * ((hi - lo) / 10.0) END) THEN k1 - 1 ELSE k1 END AS k2 FROM i1),
i3 AS (SELECT feature, y, n, CASE WHEN value >= (CASE WHEN k2 + 1 = 10 THEN hi ELSE lo + (k2 + 1) * ((hi - lo) / 10.0) END)
                             AND k2 <> 9 THEN k2 + 1 ELSE k2 END AS bin FROM i2),
j AS (SELECT feature, bin, y, count(*) AS nxy, max(n) AS n FROM i3 GROUP BY feature, bin, y),
px AS (SELECT feature, bin, sum(nxy) AS nx FROM j GROUP BY feature, bin),
py AS (SELECT feature, y, sum(nxy) AS ny FROM j GROUP BY feature, y)
SELECT j.feature, sum(nxy * 1.0 / n * ln(nxy * n * 1.0 / (nx * ny))) AS mutual_info
FROM j JOIN px USING (feature, bin) JOIN py USING (feature, y) GROUP BY j.feature"""


@register("mutual_information", sql=_MI_SQL, dbl=["mutual_info"], absr=["mutual_info"])
def q_mutual_information(spark, sf_dir):
    """D8 (binned): mutual information of each lineitem channel with returnflag = 'R'."""
    li = B.table(spark, sf_dir, "lineitem").select(*CH, (F.col("l_returnflag") == "R").cast("int").alias("y"))
    return drift.mutual_information(li, CH, "y", bins=10)


def _knn_mi_sql(features: Sequence[str], k: int = information.NEIGHBOURS) -> str:
    """All pairs of distinct values, one join per feature (DuckDB then sorts for the range)."""
    beside = ", ".join(f"list_transform(range(least({side}(n, {j}, 0) OVER w, {k})), lambda i: abs({side}(value, {j}) OVER w - value))"
                       for side in ("lag", "lead") for j in range(1, k + 1))
    near = " UNION ALL ".join(
        f"SELECT a.y, a.value, a.feature, sum(b.n) AS m FROM (SELECT * FROM d WHERE feature = '{f}') a JOIN (SELECT * FROM v WHERE feature = '{f}') b "
        f"ON b.value BETWEEN a.value - 2 * a.d AND a.value + 2 * a.d AND (abs(b.value - a.value) < a.d OR b.value = a.value) GROUP BY ALL" for f in features)
    return f"""
WITH l AS (
  {_union_long("lineitem", features, extra="CAST(l_returnflag = 'R' AS INTEGER) AS y, ")}),
c AS (SELECT feature, y, coalesce(value, 0.0) + 0.0 AS value, count(*) AS n FROM l WHERE y IS NOT NULL GROUP BY ALL),
s AS (SELECT *, sum(n) OVER (PARTITION BY feature, y) AS n_c FROM c),
t AS MATERIALIZED (SELECT *, least({k}, n_c - 1) AS k FROM s WHERE n_c > 1),
b AS (SELECT *, list_concat(list_transform(range(least(n - 1, {k})), lambda i: 0.0), {beside}) AS near
  FROM t WINDOW w AS (PARTITION BY feature, y ORDER BY value)),
d AS MATERIALIZED (SELECT feature, y, value, n, n_c, k, list_sort(near)[k::BIGINT] AS d FROM b),
v AS MATERIALIZED (SELECT feature, value, sum(n) AS n FROM t GROUP BY ALL),
m AS ({near}),
g AS (SELECT feature, sum(n) AS rows, sum(n * ({information.digamma_sql("k")} - {information.digamma_sql("n_c")} - {information.digamma_sql("m")})) AS s
  FROM d JOIN m USING (feature, y, value) GROUP BY feature)
SELECT feature, greatest(0.0, {information.digamma_sql("rows")} + s / rows) AS mutual_info FROM g"""


@register("mutual_information_knn", sql=_knn_mi_sql(CH), dbl=["mutual_info"], absr=["mutual_info"])
def q_mutual_information_knn(spark, sf_dir):
    """Nearest-neighbour mutual information of each lineitem channel with returnflag = 'R'."""
    li = B.table(spark, sf_dir, "lineitem").select(*CH, (F.col("l_returnflag") == "R").cast("int").alias("y"))
    return information.mutual_information(li, CH, "y")

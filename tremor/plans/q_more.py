"""Queries: rankings (K1, K2, K4), short drift check (D3), balance counts (M15),
and the drift report over the lineitem channels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tremor.operators import drift, prepare, stats
from tremor.plans import bindings as B
from tremor.plans.q_analysis import _DRIFT_LONG, _MI_SQL, _REPORT_DBL, _ks_sql, _pvalue_sql, _report_sql, _SPLIT_SQL
from tremor.plans.registry import register

CH = B.LINEITEM_CHANNELS


@register("top_features", sql=f"SELECT feature, mutual_info FROM ({_MI_SQL}) m ORDER BY mutual_info DESC, feature LIMIT 3",
          dbl=["mutual_info"], absr=["mutual_info"])
def q_top_features(spark, sf_dir):
    """K1: the top 3 lineitem channels by mutual information with returnflag = 'R'."""
    li = B.table(spark, sf_dir, "lineitem").select(*CH, (F.col("l_returnflag") == "R").cast("int").alias("y"))
    mi = drift.mutual_information(li, CH, "y", bins=10)
    return mi.orderBy(F.col("mutual_info").desc(), F.col("feature")).limit(3)


_LI_LONG = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, CAST(year(l_shipdate) >= 1998 AS INTEGER) AS side "
    f"FROM lineitem WHERE {c} IS NOT NULL AND l_shipdate IS NOT NULL" for c in CH)
_LI_LINES = _LI_LONG.replace("' AS feature", "' || '|' || l_linenumber AS feature")
_LI_REPORT_SQL = _report_sql(_LI_LONG)


@register("drift_report_lineitem", sql=_LI_REPORT_SQL, dbl=_REPORT_DBL, absr=_REPORT_DBL)
def q_drift_report_lineitem(spark, sf_dir):
    """The drift report of the four lineitem channels, shipped before 1998 vs from 1998."""
    return drift.drift_report(B.lineitem_drift_samples(spark, sf_dir))


@register("top_drift", sql=f"SELECT * FROM ({_report_sql(_LI_LINES)}) r WHERE KS_Stat IS NOT NULL ORDER BY KS_Stat DESC, Feature LIMIT 10",
          dbl=_REPORT_DBL, absr=_REPORT_DBL)
def q_top_drift(spark, sf_dir):
    """K2: the top 10 by KS statistic of the lineitem channels per line number."""
    return drift.top_drift(drift.drift_report(B.lineitem_drift_samples(spark, sf_dir, by_line=True)), 10)


_ORDER = "list_position([" + ", ".join(f"'{c}'" for c in CH) + "], Feature)"


@register("drift_focus", sql=f"""
WITH r AS ({_LI_REPORT_SQL}), m AS (SELECT coalesce(bool_or(Drift_Alert = 'YES'), false) AS drifts FROM r)
SELECT r.* FROM r, m WHERE Drift_Alert = 'YES' OR NOT drifts ORDER BY {_ORDER} LIMIT 4""", dbl=_REPORT_DBL, absr=_REPORT_DBL)
def q_drift_focus(spark, sf_dir):
    """K4: the first 4 drifting lineitem channels in table order (else the first 4)."""
    rep = drift.drift_report(B.lineitem_drift_samples(spark, sf_dir))
    return drift.drift_focus(rep, CH, 4)


_CHECK_SQL = f"SELECT feature, ks_stat, p_value, p_value < 0.05 AS drift FROM ({_pvalue_sql(_ks_sql(_DRIFT_LONG))}) p"


@register("drift_check", sql=_CHECK_SQL, dbl=["ks_stat", "p_value"], absr=["p_value"])
def q_drift_check(spark, sf_dir):
    """D3: KS p-value and alert (p < 0.05) of every feature (event type)."""
    return drift.drift_check(B.events_drift_samples(spark, sf_dir))


_BAL_SQL = """
WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality)
SELECT quality, n, 'before' AS stage FROM c
UNION ALL
SELECT quality, max(n) OVER (), 'after' FROM c"""


@register("balance_counts", sql=_BAL_SQL)
def q_balance_counts(spark, sf_dir):
    """Class counts of labels.quality before and after random oversampling."""
    lab = B.table(spark, sf_dir, "labels")
    bal = prepare.oversample_random(lab, "quality", "doc_id", seed=42)
    return prepare.balanced_counts(lab, bal, "quality")


@register("class_counts", sql="SELECT quality, count(*) AS n FROM labels GROUP BY quality")
def q_class_counts(spark, sf_dir):
    """G1: rows per class of labels.quality."""
    return stats.class_counts(B.table(spark, sf_dir, "labels"), "quality")


@register("split_files", sql=f"""
SELECT doc_id, quality, toxic, CASE WHEN is_test THEN 'test' ELSE 'train' END AS part FROM ({_SPLIT_SQL}) s""")
def q_split_files(spark, sf_dir):
    """A stratified split written as files (train as CSV, test as JSON), read back and checked."""
    import uuid

    from tremor.session import ensure_checkpoint_dir
    from tremor.sources.recordings import load_table, write_table
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/split-{uuid.uuid4().hex}"
    split = prepare.stratified_split(B.table(spark, sf_dir, "labels"), "quality", "doc_id", test_size=0.2, seed=42)
    parts = []
    for part, fmt, keep in (("train", "csv", ~F.col("is_test")), ("test", "json", F.col("is_test"))):
        write_table(split.where(keep).drop("is_test"), f"{root}/{part}", fmt)
        back = load_table(spark, f"{root}/{part}", target="quality", fmt=fmt, schema=split.drop("is_test").schema)
        parts.append(back.withColumn("part", F.lit(part)))
    return parts[0].unionByName(parts[1])


@register("drift_report_file", sql=_report_sql(_DRIFT_LONG), dbl=_REPORT_DBL, absr=_REPORT_DBL)
def q_drift_report_file(spark, sf_dir):
    """The drift report per event type, written as CSV with a header and read back."""
    import uuid

    from tremor.session import ensure_checkpoint_dir
    from tremor.sources.recordings import load_table, write_table
    report = drift.drift_report(B.events_drift_samples(spark, sf_dir))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/report-{uuid.uuid4().hex}"
    write_table(report, path, "csv")
    return load_table(spark, path, target="Feature", schema=report.schema)

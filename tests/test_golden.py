"""Golden values from the reference's stored outputs and worked examples."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tremor.operators import cleaning, drift, features, metrics, monitoring, stats, windows
from tremor.operators.ordering import with_sample_index
from tests.conftest import SF01


#: KS statistic and p-value of the 80 features in the stored drift report, in its order (532 balanced train rows, 77 test rows).
STORED = [
    (0.0906, 0.6041), (0.1336, 0.1641), (0.1162, 0.2983), (0.1077, 0.3869), (0.1336, 0.1641), (0.0803, 0.745), (0.1336, 0.1641),
    (0.1336, 0.1641), (0.1302, 0.1858), (0.0757, 0.805), (0.0766, 0.7942), (0.1411, 0.1235), (0.1507, 0.0841), (0.1849, 0.0173),
    (0.1411, 0.1235), (0.1406, 0.126), (0.1348, 0.157), (0.1557, 0.0682), (0.1427, 0.1163), (0.113, 0.3302), (0.182, 0.0201),
    (0.3336, 0.0), (0.2471, 0.0004), (0.2298, 0.0013), (0.3336, 0.0), (0.2579, 0.0002), (0.2319, 0.0012), (0.2227, 0.0021),
    (0.196, 0.0097), (0.1581, 0.0615), (0.228, 0.0015), (0.2698, 0.0001), (0.1425, 0.1171), (0.2343, 0.001), (0.2698, 0.0001),
    (0.1854, 0.0169), (0.2244, 0.0019), (0.2355, 0.0009), (0.1357, 0.1521), (0.141, 0.1243), (0.2057, 0.0056), (0.3132, 0.0),
    (0.3319, 0.0), (0.2948, 0.0), (0.3004, 0.0), (0.3172, 0.0), (0.0952, 0.5414), (0.2642, 0.0001), (0.1519, 0.08), (0.326, 0.0),
    (0.1671, 0.041), (0.1516, 0.0812), (0.2114, 0.0041), (0.1304, 0.1847), (0.1466, 0.0995), (0.1699, 0.0361), (0.2635, 0.0001),
    (0.0936, 0.562), (0.1627, 0.0502), (0.2948, 0.0), (0.136, 0.1502), (0.3577, 0.0), (0.3129, 0.0), (0.3098, 0.0),
    (0.3539, 0.0), (0.339, 0.0), (0.2532, 0.0003), (0.12, 0.2642), (0.3267, 0.0), (0.1593, 0.0584), (0.1861, 0.0163),
    (0.2247, 0.0018), (0.1897, 0.0135), (0.2006, 0.0075), (0.2247, 0.0018), (0.1897, 0.0135), (0.2532, 0.0003), (0.1878, 0.0149),
    (0.1916, 0.0122), (0.2006, 0.0075),
]


def test_ks_pvalues_match_the_stored_report(spark):
    assert len(STORED) == 80
    off = [(d, p) for d, p in STORED if abs(drift.ks_pvalue_exact(d, 532, 77) - p) > 1.01e-4]  # both are rounded to four decimals
    assert not off
    assert sum(p < drift.ALPHA for _, p in STORED) == 47  # alerts of the stored report
    near = spark.createDataFrame(STORED, "d double, p double").select(
        "p", drift.ks_pvalue_limit(F.col("d"), F.lit(532), F.lit(77)).alias("limit")).collect()
    assert max(abs(r.limit - r.p) for r in near) < 0.02 and sum(r.limit < drift.ALPHA for r in near) == 47


def test_ks_pvalue_bounds():
    assert drift.ks_pvalue_exact(0.0, 10, 12) == 1.0
    assert drift.ks_pvalue_exact(1.0, 10, 12) < 1e-4


def test_metrics_readme_matrix(spark):
    # TN 49, FP 4, FN 7, TP 46 -> 89.6 / 92.0 / 86.8 / 92.5 / 89.3 %
    cm = spark.createDataFrame([(49, 4, 7, 46)], "tn long, fp long, fn long, tp long")
    r = metrics.from_confusion(cm).first()
    assert round(r.accuracy, 3) == 0.896
    assert round(r.precision, 3) == 0.920
    assert round(r.recall, 3) == 0.868
    assert round(r.specificity, 3) == 0.925
    assert round(r.f1, 3) == 0.893


def test_psi_status(spark):
    df = spark.createDataFrame([(0.0351,), (0.1119,), (0.4458,)], "p double")
    got = [r.s for r in df.select(drift.psi_status(F.col("p")).alias("s")).collect()]
    assert got == ["Stable", "Moderate", "Major"]


def test_moments(spark):
    df = spark.createDataFrame([(1, float(x)) for x in (1, 2, 4, 9)], "k int, x double")
    r = features.recording_features(df, ["k"], ["x"]).first()
    assert r.x_kurt == pytest.approx(-1.0)
    assert r.x_skew == pytest.approx(0.768417, abs=1e-6)
    assert r.x_std == pytest.approx(3.082207, abs=1e-6)
    d = stats.describe(df, ["x"]).first()
    assert d.q25 == pytest.approx(1.75) and d.q50 == pytest.approx(3.0)


def test_constant_recording(spark):
    df = spark.createDataFrame([(1, 1.0)] * 3, "k int, x double")
    r = features.recording_features(df, ["k"], ["x"]).first()
    assert r.x_kurt is None and r.x_skew is None
    assert r.x_std == 0 and r.x_crest == pytest.approx(1.0)
    z = spark.createDataFrame([(1, 0.0)] * 3, "k int, x double")
    assert features.recording_features(z, ["k"], ["x"]).first().x_crest == 0.0


def test_threshold_grid_has_81_points(spark):
    df = spark.createDataFrame([(1, 0.3), (0, 0.2), (1, 0.95)], "y int, score double")
    sw = metrics.threshold_sweep(df, "y", "score")
    th = sorted(r.threshold for r in sw.collect())
    assert len(th) == 81 and th[0] == 0.1 and th[-1] == 0.9


def test_threshold_equal_score_counts_as_failure(spark):
    df = spark.createDataFrame([(1, 0.3), (0, 0.29)], "y int, score double")
    sw = {round(r.threshold, 2): r for r in metrics.threshold_sweep(df, "y", "score").collect()}
    assert sw[0.3].tp == 1 and sw[0.3].fp == 0
    assert sw[0.29].fp == 1


def _ordered(spark, vals):
    rows = [(1, i, v) for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "k int, sample_idx long, x double")


def test_linear_interpolation(spark):
    df = _ordered(spark, [None, None, 1.0, None, None, 4.0, None])
    out = cleaning.fill_gaps(df, ["k"], "sample_idx", ["x"], how="linear", block_rows=2)
    got = [r.x for r in out.orderBy("sample_idx").collect()]
    assert got == [1.0, 1.0, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_fill_edge_cases(spark):
    df = _ordered(spark, [None, 5.0, None, None, 7.0, None])
    ff = [r.x for r in cleaning.fill_gaps(df, ["k"], "sample_idx", ["x"], how="ffill_bfill", block_rows=2)
          .orderBy("sample_idx").collect()]
    assert ff == [5.0, 5.0, 5.0, 5.0, 7.0, 7.0]
    allnull = _ordered(spark, [None, None, None])
    assert [r.x for r in cleaning.fill_gaps(allnull, ["k"], "sample_idx", ["x"]).collect()] == [None] * 3


def test_pct_change_inf_to_zero(spark):
    df = _ordered(spark, [0.0, 0.0, 2.0, 0.0, 1.0])
    out = windows.rate_of_change(df, ["k"], "sample_idx", "x", block_rows=2)
    got = [r.x_pct_change for r in out.orderBy("sample_idx").collect()]
    assert got == [None, None, 0.0, -1.0, 0.0]


def test_psi_and_ks_on_events(spark):
    from tremor.plans import bindings as B
    e = B.table(spark, SF01, "events").select(
        F.lit("value").alias("feature"), "value",
        (F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")).cast("int").alias("side"))
    assert drift.psi(e).first().psi == pytest.approx(0.001252, abs=1e-6)
    ks = drift.ks_statistic(e).first()
    assert ks.ks_stat == pytest.approx(0.012956, abs=1e-6)
    assert (ks.n_base, ks.n_current) == (4985, 5015)


def test_roc_auc_on_labels(spark):
    from tremor.plans import bindings as B
    r = metrics.roc_auc(B.scored_documents(spark, SF01), "y", "score").first()
    assert r.roc_auc == pytest.approx(0.512109, abs=1e-6)
    assert (r.n_pos, r.n_neg) == (341, 58)


def test_auc_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.4)], "y int, score double")
    assert metrics.roc_auc(df, "y", "score").first().roc_auc is None


def test_no_valid_threshold_falls_back_to_highest_recall(spark):
    df = spark.createDataFrame([(0, 0.95), (0, 0.9), (1, 0.05)], "y int, score double")
    sw = metrics.threshold_sweep(df, "y", "score", min_precision=0.5)
    best = metrics.optimal_threshold(sw, 0.95).first()
    assert best.found_valid is False


def test_js_distance_bounds_and_self(spark):
    rows = [("f", float(i % 17), 0) for i in range(200)] + [("f", float(i % 17), 1) for i in range(200)]
    df = spark.createDataFrame(rows, "feature string, value double, side int")
    assert drift.js_distance(df).first().js_distance == pytest.approx(0.0, abs=1e-12)
    assert drift.psi(df).first().psi == pytest.approx(0.0, abs=1e-9)
    rows2 = [("f", float(i), 0) for i in range(50)] + [("f", float(i + 1000), 1) for i in range(50)]
    js = drift.js_distance(spark.createDataFrame(rows2, "feature string, value double, side int")).first().js_distance
    assert 0 < js <= math.sqrt(math.log(2)) + 1e-12


def test_feedback_labels(spark):
    df = spark.createDataFrame([(True, True), (True, False), (False, True), (False, False)], "p boolean, a boolean")
    got = [r.f for r in df.select(monitoring.feedback_label(F.col("p"), F.col("a")).alias("f")).collect()]
    assert got == ["CORRECT_POSITIVE", "FALSE_POSITIVE", "FALSE_NEGATIVE", "CORRECT_NEGATIVE"]


def test_histogram_matches_numpy(spark):
    vals = [0.1 * i for i in range(37)] + [3.6]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    h = {r.bin: r["count"] for r in stats.histogram(df, ["x"], bins=10).collect()}
    ref, _ = np.histogram(vals, bins=10)
    assert [h[i] for i in range(10)] == list(ref)


def test_rolling_std_survives_large_offsets(spark):
    import pandas as pd
    rng = np.random.default_rng(0)
    x = np.concatenate(([0.0], 1e8 + rng.uniform(size=499)))
    df = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate(x)], "k int, sample_idx long, x double")
    got = [r.x_roll_std_100 for r in windows.rolling_std_rows(df, ["k"], "sample_idx", "x", 100, block_rows=128).orderBy("sample_idx").collect()]
    want = pd.Series(x - 1e8).rolling(100).apply(lambda w: np.std(w, ddof=1)).to_numpy()
    assert all(g is None for g in got[:99])
    assert np.allclose(got[99:], want[99:], rtol=1e-6)


def test_rolling_windows_with_nulls(spark):
    vals = [1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(vals)], "k int, sample_idx long, x double")
    out = windows.rolling_stats(df, ["k"], "sample_idx", "x", (3,)).orderBy("sample_idx").collect()
    assert [r.roll_mean_3 for r in out] == [None, None, None, None, None, 5.0, 6.0, 7.0, 8.0]
    rows = windows.rolling_std_rows(df, ["k"], "sample_idx", "x", 3).orderBy("sample_idx").collect()
    assert [r.x_roll_std_3 for r in rows] == [None] * 5 + [1.0] * 4


def test_one_sided_feature_has_null_statistics(spark):
    long = spark.createDataFrame([("a", float(i), i % 2) for i in range(40)] + [("b", float(i), 1) for i in range(9)],
                                 "feature string, value double, side int")
    assert {r.feature: r.ks_stat is None for r in drift.ks_statistic(long).collect()} == {"a": False, "b": True}
    assert {r.feature: r.psi is None for r in drift.psi(long).collect()} == {"a": False, "b": True}
    assert {r.feature: r.js_distance is None for r in drift.js_distance(long).collect()} == {"a": False, "b": True}
    report = {r.Feature: r for r in drift.drift_report(long).collect()}
    assert report["b"].Skipped and report["b"].Drift_Alert is None and report["a"].Skipped is None


def test_ks_methods(spark):
    long = spark.createDataFrame([("a", float(i * i % 97), int(i % 3 == 0)) for i in range(400)], "feature string, value double, side int")
    exact, limit = (drift.ks_test(long, m).first().p_value for m in ("exact", "limit"))
    assert abs(exact - limit) < 0.02
    row = spark.createDataFrame([(0.15, 10001, 50), (0.2, 10001, 50)], "d double, a long, b long")
    got = [r.p for r in row.select(drift.ks_pvalue_limit(F.col("d"), F.col("a"), F.col("b")).alias("p")).collect()]
    assert got == pytest.approx([0.1952, 0.0320], abs=2e-4)


def test_counts_beyond_long_products(spark):
    big = spark.range(2).selectExpr("CAST(id AS double) AS __s", "5000000000 AS __pos", "5000000000 AS __neg")
    import tremor.operators.metrics as M
    old = M._score_counts
    M._score_counts = lambda *a: big
    try:
        assert metrics.roc_auc(big, "y", "s").first().roc_auc == pytest.approx(0.5)
    finally:
        M._score_counts = old

"""Property tests against brute force on small random inputs (with ties and nulls)."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tremor.operators import drift, metrics, prepare
from tremor.operators.selection import quantiles

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
vals = st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float)), min_size=1, max_size=40)


@SETTINGS
@given(a=vals, b=vals)
def test_quantiles_match_numpy(spark, a, b):
    rows = [("a", v) for v in a] + [("b", v) for v in b]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r.k: r for r in quantiles(df, ["k"], "x", [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    for k, xs in (("a", a), ("b", b)):
        xs = [v for v in xs if v is not None]
        if not xs:
            assert k not in got
            continue
        ref = np.quantile(xs, [0.0, 0.25, 0.5, 0.9, 1.0])
        r = got[k]
        assert np.allclose([r.q_0, r.q_25, r.q_50, r.q_90, r.q_100], ref)


@SETTINGS
@given(a=st.lists(st.integers(0, 8).map(float), min_size=1, max_size=30),
       b=st.lists(st.integers(0, 8).map(float), min_size=1, max_size=30))
def test_ks_statistic_brute_force(spark, a, b):
    rows = [("f", v, 0) for v in a] + [("f", v, 1) for v in b]
    df = spark.createDataFrame(rows, "feature string, value double, side int")
    d = drift.ks_statistic(df).first().ks_stat
    grid = sorted(set(a) | set(b))
    ref = max(abs(np.mean(np.array(a) <= g) - np.mean(np.array(b) <= g)) for g in grid)
    assert d == pytest.approx(ref)


@SETTINGS
@given(data=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6).map(lambda v: v / 6)), min_size=2, max_size=40))
def test_auc_and_sweep_brute_force(spark, data):
    df = spark.createDataFrame(data, "y int, score double")
    pos = [s for y, s in data if y == 1]
    neg = [s for y, s in data if y == 0]
    auc = metrics.roc_auc(df, "y", "score").first().roc_auc
    if pos and neg:
        ref = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
        assert auc == pytest.approx(ref)
    else:
        assert auc is None
    sweep = {round(r.threshold, 2): r for r in metrics.threshold_sweep(df, "y", "score").collect()}
    for i in (10, 17, 33, 50, 67, 90):
        t = i / 100
        tp = sum(1 for y, s in data if y == 1 and s >= t)
        fp = sum(1 for y, s in data if y == 0 and s >= t)
        assert (sweep[t].tp, sweep[t].fp) == (tp, fp)


@SETTINGS
@given(labels=st.lists(st.integers(0, 2), min_size=5, max_size=60))
def test_split_sizes_exact(spark, labels):
    df = spark.createDataFrame(list(enumerate(labels)), "id long, y int")
    s = prepare.stratified_split(df, "y", "id", 0.2, 42)
    n_test = s.where("is_test").count()
    assert n_test == int(np.ceil(0.2 * len(labels)))
    per = {r.y: r.c for r in s.where("is_test").groupBy("y").agg(F.count("*").alias("c")).collect()}
    for c in set(labels):
        share = n_test * labels.count(c) / len(labels)
        assert np.floor(share) <= per.get(c, 0) <= np.ceil(share)


@SETTINGS
@given(xs=st.lists(st.integers(-50, 50).map(float), min_size=3, max_size=30))
def test_robust_scaled_median_is_zero(spark, xs):
    df = spark.createDataFrame([(v,) for v in xs], "x double")
    out = [r.x for r in prepare.scale(df, ["x"], "robust").collect()]
    assert np.median(out) == pytest.approx(0.0, abs=1e-12)

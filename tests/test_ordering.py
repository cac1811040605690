"""Skew safety: a hot key cut over many tasks gives the same answer as one task."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tremor.operators import cleaning, windows
from tremor.operators.ordering import prefix_sums, with_sample_index
from tremor.operators.selection import quantiles


@pytest.fixture(scope="module")
def hot(spark):
    # one key holds most rows
    rows = [("hot", i, float((i * 7919) % 101)) for i in range(3000)] + \
           [(f"k{j}", i, float(i)) for j in range(5) for i in range(30)]
    return spark.createDataFrame(rows, "k string, t long, x double")


def test_sample_index_dense_and_ordered(hot):
    out = with_sample_index(hot, ["k"], ["t"], num_partitions=16)
    w = Window.partitionBy("k").orderBy("t")
    bad = out.withColumn("ref", F.row_number().over(w) - 1).where(F.col("ref") != F.col("sample_idx")).count()
    assert bad == 0 and out.count() == hot.count()


def test_prefix_sums_match_window(hot):
    out = prefix_sums(hot, ["k"], ["t"], ["x"], prefix="c_", total_prefix="n_", num_partitions=16)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    chk = out.withColumn("ref", F.sum("x").over(w)).where(F.abs(F.col("ref") - F.col("c_x")) > 1e-9).count()
    assert chk == 0
    tot = out.groupBy("k").agg(F.max("n_x").alias("n"), F.sum("x").alias("s")).where("n != s").count()
    assert tot == 0


def test_blocked_windows_match_plain_windows(hot):
    rec = with_sample_index(hot, ["k"], ["t"], num_partitions=8)
    small = windows.rolling_stats(rec, ["k"], "sample_idx", "x", (5, 20), block_rows=37)
    big = windows.rolling_stats(rec, ["k"], "sample_idx", "x", (5, 20), block_rows=1 << 20)
    cols = ["roll_mean_5", "roll_std_20", "roll_min_20", "roll_max_5"]
    a = {(r.k, r.sample_idx): tuple(r[c] for c in cols) for r in small.collect()}
    b = {(r.k, r.sample_idx): tuple(r[c] for c in cols) for r in big.collect()}
    assert a.keys() == b.keys()
    for key in a:
        for u, v in zip(a[key], b[key]):
            assert (u is None and v is None) or abs(u - v) < 1e-9


def test_rolling_std_running_sums_vs_pandas(hot):
    import pandas as pd
    rec = with_sample_index(hot.where("k = 'hot'"), ["k"], ["t"], num_partitions=8)
    out = windows.rolling_std_rows(rec, ["k"], "sample_idx", "x", 100, block_rows=150)
    got = [r.x_roll_std_100 for r in out.orderBy("sample_idx").collect()]
    ref = pd.Series([float((i * 7919) % 101) for i in range(3000)]).rolling(100).std().tolist()
    for u, v in zip(got, ref):
        assert (u is None and np.isnan(v)) or abs(u - v) < 1e-8
    m = windows.rolling_std_mean(rec, ["k"], "sample_idx", ["x"], 100, block_rows=150).first()
    assert m.x_roll_std_w == pytest.approx(np.nanmean(ref), rel=1e-10)


def test_carry_fill_across_many_blocks(spark):
    vals = [None] * 5 + [1.0] + [None] * 23 + [7.0] + [None] * 4
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(vals)], "k int, sample_idx long, x double")
    out = cleaning.fill_gaps(df, ["k"], "sample_idx", ["x"], how="linear", block_rows=4)
    got = [r.x for r in out.orderBy("sample_idx").collect()]
    import pandas as pd
    ref = pd.Series(vals, dtype="float64").interpolate("linear").bfill().ffill().tolist()
    assert np.allclose(got, ref)


def test_quantiles_match_numpy(hot):
    q = quantiles(hot, ["k"], "x", [0.25, 0.5, 0.75, 0.1])
    for r in q.collect():
        vals = [row.x for row in hot.where(F.col("k") == r.k).collect()]
        ref = np.quantile(vals, [0.25, 0.5, 0.75, 0.1])
        assert np.allclose([r.q_25, r.q_50, r.q_75, r.q_10], ref)


def test_prefix_sums_carry_other_columns_unchanged(spark):
    big = 2**53
    rows = [(None if i % 5 == 0 else i % 3, i, big + i if i % 4 else None, float("nan") if i % 6 == 0 else 1.5, [i, None], 1)
            for i in range(200)]
    df = spark.createDataFrame(rows, "k int, t int, id long, x double, a array<int>, one long")
    out = prefix_sums(df, ["k"], ["t"], ["one"], prefix="c_", total_prefix="n_", num_partitions=7).collect()
    kept = sorted((tuple(map(repr, r[:6])) for r in out))
    assert kept == sorted(tuple(map(repr, r)) for r in rows)
    for k in (None, 0, 1, 2):
        own = sorted((r.t, r.c_one, r.n_one) for r in out if r.k == k)
        assert [c for _, c, _ in own] == list(range(1, len(own) + 1)) and {n for *_, n in own} == {len(own)}

"""Raw CSV recordings end to end, and the streaming forms."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tremor.operators.features import CHANNELS
from tremor.plans import flows
from tremor.sources.recordings import load_table, read_recordings, write_table
from tremor.streaming import monitor
from tests.conftest import SF001


def _write_recordings(root, n_files=6, n_rows=150):
    """Headerless CSV recordings built from the events values, some junk cells."""
    ev = pd.read_parquet(f"{SF001}/events.parquet").sort_values(["ts", "event_id"])
    vals = ev["value"].to_numpy()
    files = {}
    for f in range(n_files):
        folder = "normal" if f % 2 == 0 else os.path.join("imbalance", "10g")
        os.makedirs(os.path.join(root, folder), exist_ok=True)
        block = np.stack([np.roll(vals, f * 13 + c)[:n_rows] for c in range(len(CHANNELS))], axis=1)
        frame = pd.DataFrame(block).astype(object)
        frame.iloc[3, 0] = "junk"
        frame.iloc[7, 2] = ""
        path = os.path.join(root, folder, f"rec{f}.CSV" if f == 1 else f"rec{f}.csv")
        frame.to_csv(path, header=False, index=False)
        files[path] = frame
    os.makedirs(os.path.join(root, "other"), exist_ok=True)
    pd.DataFrame([[1] * 8]).to_csv(os.path.join(root, "other", "x.csv"), header=False, index=False)
    return files


def test_read_recordings_order_labels_nulls(spark, scratch):
    files = _write_recordings(scratch)
    rec = read_recordings(spark, scratch)
    assert rec.select("file_path").distinct().count() == len(files)
    assert rec.where("label = 1").select("file_path").distinct().count() == 3
    one = [p for p in files if p.endswith("rec0.csv")][0]
    got = rec.where(F.col("file_path").endswith("rec0.csv")).orderBy("sample_idx").collect()
    frame = files[one]
    assert len(got) == len(frame)
    assert got[3].current is None and got[7].vib_y is None
    assert got[10].vib_x == pytest.approx(float(frame.iloc[10, 1]))
    first = read_recordings(spark, scratch, max_rows=20)
    assert first.groupBy("file_path").count().where("count != 20").count() == 0


def test_feature_table_matches_pandas(spark, scratch):
    files = _write_recordings(scratch)
    table = flows.feature_table(spark, scratch)
    assert table.count() == len(files)
    path = [p for p in files if p.endswith("rec2.csv")][0]
    raw = files[path].apply(pd.to_numeric, errors="coerce")
    raw = raw.interpolate(method="linear").bfill().ffill()
    v = raw[1].to_numpy(dtype=float)
    row = table.where(F.col("file_path").endswith("rec2.csv")).first()
    assert row.vib_x_mean == pytest.approx(v.mean())
    assert row.vib_x_std == pytest.approx(v.std())
    assert row.vib_x_roll_std == pytest.approx(pd.Series(v).rolling(100).std().dropna().mean())
    c = raw[0].to_numpy(dtype=float)
    assert row.current_mean == pytest.approx(c.mean())


def test_prepare_splits_and_reports(spark, scratch):
    _write_recordings(scratch, n_files=30, n_rows=120)
    table = flows.feature_table(spark, scratch)
    train, test, report = flows.prepare_splits(table)
    assert test.count() == 6
    c = {r.fault_label: r.c for r in train.groupBy("fault_label").agg(F.count("*").alias("c")).collect()}
    assert c[0] == c[1]
    assert report.where("Skipped IS NULL").groupBy("base").count().where("count <> 80").isEmpty()  # 8 channels x 10 statistics, 6 test values each
    assert {r.base for r in report.collect()} == {"train", "balanced"}
    assert train.columns[:len(table.columns)] == table.columns and train.where("synthetic AND severity IS NOT NULL").isEmpty()
    drawn, _, _ = flows.prepare_splits(table, balance="random")
    assert {r["count"] for r in drawn.groupBy("fault_label").count().collect()} == set(c.values())
    with pytest.raises(ValueError):
        flows.prepare_splits(table, balance="none")
    write_table(report, f"{scratch}/out/drift", fmt="csv")
    back = load_table(spark, f"{scratch}/out/drift", target="Feature")
    assert back.count() == report.count()
    with pytest.raises(ValueError):
        load_table(spark, f"{scratch}/out/drift", target="nope")


def test_streaming_decisions_and_daily_rates(spark, scratch):
    src = f"{scratch}/src"
    ev = spark.read.parquet(f"{SF001}/events.parquet").select(
        "event_id", "ts", (F.col("value") / (F.col("value") + 50.0)).alias("score"),
        (F.col("event_type") == "error").alias("actual"))
    ev.repartition(4).write.parquet(src)
    stream = monitor.read_stream(spark, src, ev.schema, max_files=1)
    dec = monitor.decision_stream(stream, "score", 0.5)
    q = monitor.start(dec, "memory", f"{scratch}/ck1", query_name="dec_out")
    q.processAllAvailable()
    q.stop()
    assert spark.table("dec_out").count() == ev.count()
    rates = monitor.daily_rate_stream(stream.withColumn("pred", F.col("score") >= 0.5), "ts", "pred", "actual",
                                      delay="1 hour")
    q2 = monitor.start(rates, "memory", f"{scratch}/ck2", query_name="rates_out")
    q2.processAllAvailable()
    q2.stop()
    assert spark.table("rates_out").count() >= 1

"""Streams against the batch operators: late, missing and repeated rows, restarts, replays; and the split-wise scan of raw files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tremor.operators import monitoring
from tremor.sources import recordings
from tremor.streaming import monitor

T0 = dt.datetime(2024, 1, 1)
PRED = "machine string, ts timestamp, p double, predicted boolean"
OUT = "machine string, seen timestamp, actual boolean"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def put(spark, folder, rows, schema):
    """One more file of a stream's folder."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def drain(query):
    try:
        query.processAllAvailable()
    finally:
        query.stop()


@pytest.fixture()
def feedback(spark, scratch):
    pred, out = f"{scratch}/pred", f"{scratch}/out"

    def run():
        p = monitor.read_stream(spark, pred, spark.createDataFrame([], PRED).schema)
        o = monitor.read_stream(spark, out, spark.createDataFrame([], OUT).schema)
        f = monitor.feedback_stream(p, o, ["machine"], "ts", "seen", "predicted", "actual", "30 minutes", "10 minutes", "10 minutes")
        drain(monitor.start(f, "parquet", f"{scratch}/ck", path=f"{scratch}/feedback"))
        return sorted((r.machine, r.ts, r.observed_at, r.actual, r.feedback) for r in spark.read.parquet(f"{scratch}/feedback").collect())

    return pred, out, run


def test_feedback_late_missing_repeated_and_restarted(spark, feedback):
    pred, out, run = feedback
    put(spark, pred, [("a", at(0), 0.9, True), ("a", at(0), 0.9, True), ("b", at(1), 0.2, False), ("c", at(2), 0.8, True), ("d", at(3), 0.7, True)], PRED)
    put(spark, out, [("a", at(5), True), ("a", at(5), True), ("b", at(31), True), ("c", at(33), True)], OUT)  # c: a minute past the horizon
    first = run()
    hit = [("a", at(0), at(5), True, "CORRECT_POSITIVE"), ("b", at(1), at(31), True, "FALSE_NEGATIVE")]
    assert first == hit
    # a restart from the checkpoint goes on: times far ahead close the first hour, then d's outcome comes too late
    put(spark, pred, [("z", at(500), 0.1, False)], PRED)
    put(spark, out, [("z", at(505), False)], OUT)
    run()
    put(spark, out, [("d", at(4), True)], OUT)
    put(spark, pred, [("y", at(900), 0.1, False)], PRED)
    put(spark, out, [("x", at(900), False)], OUT)
    got = run()
    gone = [("c", at(2), None, None, None), ("d", at(3), None, None, None)]
    assert got == sorted(hit + gone + [("z", at(500), at(505), False, "CORRECT_NEGATIVE")])


def test_feedback_equals_the_batch_join(spark, feedback):
    pred, out, run = feedback
    e = spark.read.parquet(f"{SF001}/events.parquet").dropDuplicates(["user_id", "ts"]).selectExpr(
        "CAST(user_id AS string) machine", "CAST(ts AS timestamp) ts", "value / (value + 50) AS p", "event_type = 'error' AS actual")
    p = e.selectExpr("machine", "ts", "p", "p >= 0.5 AS predicted")
    o = e.selectExpr("machine", "ts AS seen", "actual")
    for k in range(2):
        p.where(f"pmod(hash(ts), 2) = {k}").coalesce(1).write.mode("append").parquet(pred)
        o.where(f"pmod(hash(ts), 2) = {k}").coalesce(1).write.mode("append").parquet(out)
    end = e.agg(F.max("ts")).first()[0] + dt.timedelta(days=9)
    batch = (p.join(o.withColumnRenamed("machine", "m"), F.expr("m = machine AND seen >= ts AND seen <= ts + INTERVAL 30 MINUTES"))
             .withColumn("feedback", monitoring.feedback_label(F.col("predicted"), F.col("actual"))))
    wanted = sorted((r.machine, r.ts, r.seen, r.actual, r.feedback) for r in batch.collect())
    run()
    put(spark, pred, [("end", end, 0.1, False)], PRED)
    put(spark, out, [("end", end, False)], OUT)
    got = [r for r in run() if r[0] != "end"]
    assert got == wanted and len(got) >= e.count()


def test_retrain_stream_equals_the_batch_queries(spark, scratch):
    ev = spark.read.parquet(f"{SF001}/events.parquet").selectExpr(
        "CAST(ts AS timestamp) ts", "value / (value + 50) AS score", "value >= 50 AS pred", "event_type = 'error' AS actual")
    start = "2024-01-08"
    base = monitor.base_histogram(ev.where(F.col("ts") < F.lit(start)), "score")
    shift = monitoring.psi_by_period(ev, "ts", "score", start)
    rates = monitoring.daily_rates(ev.where(F.col("ts") >= F.lit(start)), "ts", "pred", "actual")
    wanted = {r.day: r for r in monitoring.retrain_trigger(rates, shift).collect()}
    last = max(wanted)
    folder = f"{scratch}/scores"
    days = ev.where(F.col("ts") >= F.lit(start))
    ends = [dt.datetime(2024, 1, 12), dt.datetime(2024, 1, 20), dt.datetime(2030, 1, 1)]
    got = {}
    for lo, hi in zip([dt.datetime(2000, 1, 1), *ends], ends):  # the query is stopped and started again twice, within an open day's state
        days.where((F.col("ts") >= F.lit(lo)) & (F.col("ts") < F.lit(hi))).coalesce(1).write.mode("append").parquet(folder)
        s = monitor.retrain_stream(monitor.read_stream(spark, folder, ev.schema), "ts", "pred", "actual", "score", base, "1 hour")
        drain(monitor.start(s, "parquet", f"{scratch}/ck", path=f"{scratch}/out"))
        got = {r.day: r for r in spark.read.parquet(f"{scratch}/out").collect()}
    assert set(wanted) - set(got) <= {last} and len(got) >= len(wanted) - 1
    for day, r in got.items():
        assert r.recall == pytest.approx(wanted[day].recall) and r.psi == pytest.approx(wanted[day].psi) and r.retrain == wanted[day].retrain


def test_base_without_scores(spark):
    with pytest.raises(ValueError):
        monitor.base_histogram(spark.createDataFrame([(None,)], "s double"), "s")


def test_invalid_readings_are_written_once(spark, scratch):
    src, good, bad = (f"{scratch}/{x}" for x in ("src", "good", "bad"))
    schema = "id int, r map<string,double>"
    put(spark, src, [(1, {"a": 1.0, "b": 2.0}), (2, {"a": 1.0}), (3, {"a": 1.0, "b": 2.0, "c": 3.0}), (4, {"b": 5.0, "a": None})], schema)
    write = monitor.split_valid("r", ["a", "b"], good, bad)

    def run():
        stream = monitor.read_stream(spark, src, spark.createDataFrame([], schema).schema)
        q = monitor.start_batches(stream, write, f"{scratch}/ck", trigger_once=True)
        q.awaitTermination()
        assert q.exception() is None
        return (sorted((r.id, r.vector) for r in spark.read.parquet(good).collect()),
                sorted((r.id, r.missing, r.extra) for r in spark.read.parquet(bad).collect()))

    first = run()
    assert first == ([(1, [1.0, 2.0]), (4, [None, 5.0])], [(2, ["b"], []), (3, [], ["c"])])
    # the batch runs again after a failure between its writes and its commit
    write(spark.read.schema(schema).parquet(src), 0)
    assert run() == first
    put(spark, src, [(5, {"a": 0.0, "b": 0.0}), (6, {})], schema)
    again = run()
    assert [i for i, _ in again[0]] == [1, 4, 5] and [i for i, *_ in again[1]] == [2, 3, 6]


def lines(n, cols=8):
    return "".join(",".join(str(i * 10 + c) for c in range(cols)) + "\n" for i in range(n)).encode()


def test_scan_in_many_splits_leaves_broken_files_out(spark, scratch):
    os.makedirs(f"{scratch}/normal/x")
    os.makedirs(f"{scratch}/imbalance")
    whole, broken = lines(20_000), lines(20_000)
    middle = broken.index(b"\n", len(broken) // 2)
    data = {"normal/whole.csv": whole, "imbalance/broken.csv": broken[:middle] + b",\xff\xfe" + broken[middle:], "normal/empty.csv": b"",
            "normal/x/short.csv": lines(3), "imbalance/tail.csv": lines(50) + b"1,2,\xc3"}
    for name, content in data.items():
        with open(f"{scratch}/{name}", "wb") as f:
            f.write(content)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        scanned = recordings.scan_csv(spark, scratch)
        assert scanned.rdd.getNumPartitions() > 40  # one file is read in many splits
        counts = {os.path.basename(r.file_path): r["count"] for r in scanned.groupBy("file_path").count().collect()}
        assert counts == {"whole.csv": 20_000, "short.csv": 3}
        skipped = {os.path.basename(r.file_path): r.reason for r in recordings.skipped_files(spark, scratch).collect()}
        assert skipped == {"broken.csv": "not text", "tail.csv": "not text", "empty.csv": "empty"}
        rec = recordings.read_recordings(spark, scratch).where(F.col("file_path").endswith("whole.csv"))
        assert rec.where("current <> sample_idx * 10").isEmpty() and rec.count() == 20_000
        first = recordings.read_recordings(spark, scratch, max_rows=5)
        assert {r["count"] for r in first.groupBy("file_path").count().collect()} == {5, 3}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert "binaryFile" not in scanned._jdf.queryExecution().toString()

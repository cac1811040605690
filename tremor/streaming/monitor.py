"""Streaming scoring and monitoring.

* :func:`decision_stream`: a file source of scored (or scoreable) rows ->
  decision columns -> any sink, exactly once with a checkpoint.
* :func:`daily_rate_stream`: watermark on the event time, daily tumbling
  windows of the confusion counts, appended once a day is closed.
* :func:`feedback_stream`: predictions meet their outcomes in a stream-stream
  interval join with two watermarks.
* :func:`retrain_stream`: per closed day the recall, the drift of the scores from a base
  histogram and the retrain flag.
* :func:`split_valid`: valid and invalid readings of a micro-batch to two tables, once each.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.operators.cleaning import readings_to_vector, validate_readings
from tremor.operators.drift import PSI_EPS, _widen
from tremor.operators.metrics import _ratio
from tremor.operators.monitoring import PSI_SHIFT, RECALL_FLOOR, feedback_label
from tremor.operators.scoring import decisions
from tremor.operators.stats import with_bin


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.load(path)


def decision_stream(stream: DataFrame, prob: str, threshold: float) -> DataFrame:
    """R1 on a stream: the decision record for every incoming row."""
    return decisions(stream, prob, threshold)


def daily_rate_stream(stream: DataFrame, ts: str, pred: str, actual: str, delay: str = "1 day",
                      floor: float = RECALL_FLOOR) -> DataFrame:
    """O2 on a stream: daily confusion counts and rates; a day is emitted
    (append mode) when the watermark passes its end."""
    p, a = F.col(pred), F.col(actual)
    if isinstance(stream.schema[ts].dataType, T.TimestampNTZType):
        # watermarks need TIMESTAMP; days are cut in the session time zone
        stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    g = stream.withWatermark(ts, delay).groupBy(F.window(ts, "1 day").alias("w")).agg(
        F.count(F.when(p & a, 1)).alias("tp"), F.count(F.when(p & ~a, 1)).alias("fp"),
        F.count(F.when(~p & a, 1)).alias("fn"), F.count(F.when(~p & ~a, 1)).alias("tn"))
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    recall = _ratio(tp, tp + fn)
    return g.select(F.col("w.start").alias("day"), "tp", "fp", "fn", "tn", recall.alias("recall"),
                    _ratio(tp, tp + fp).alias("precision"), (recall < F.lit(floor)).alias("recall_alert"))


def _timed(stream: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP; a time without zone is one of the session's zone."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")) if isinstance(stream.schema[ts].dataType, T.TimestampNTZType) else stream


def feedback_stream(predictions: DataFrame, outcomes: DataFrame, keys: Sequence[str], predicted_at: str, observed_at: str, pred: str, actual: str,
                    horizon: str = "1 hour", prediction_delay: str = "1 hour", outcome_delay: str = "1 hour") -> DataFrame:
    """O1 on streams: each prediction with the outcome of its machine that is observed within ``horizon`` from it, and the feedback
    label.  Both sides have a watermark, so state is held for the horizon and the delays only.

    A prediction whose outcome is missing is emitted with NULL once the watermarks rule one out (label NULL); an outcome later than its
    watermark is not taken up.  Repeated rows of one machine and time count once within the watermark, the first to come.
    Several outcomes at different times within the horizon give a row each.
    """
    p = _timed(predictions, predicted_at).withWatermark(predicted_at, prediction_delay).dropDuplicatesWithinWatermark([*keys, predicted_at])
    o = _timed(outcomes, observed_at).select(*keys, observed_at, actual).withWatermark(observed_at, outcome_delay) \
        .dropDuplicatesWithinWatermark([*keys, observed_at])
    o = o.withColumnsRenamed({k: f"__{k}" for k in keys} | {observed_at: "__observed"})
    on = (F.col("__observed") >= F.col(predicted_at)) & (F.col("__observed") <= F.col(predicted_at) + F.expr(f"INTERVAL {horizon}"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"__{k}"))
    joined = p.join(o, on, "leftOuter")
    return joined.select(*p.columns, F.col("__observed").alias("observed_at"), actual,
                         F.when(F.col(actual).isNotNull(), feedback_label(F.col(pred), F.col(actual))).alias("feedback"))


@dataclass
class Base:
    """Histogram of the base period's scores: range, rows and counts per bin."""

    lo: float
    hi: float
    rows: int
    counts: list[int]


def base_histogram(scores: DataFrame, score: str, bins: int = 10) -> Base:
    """The base of :func:`retrain_stream` from a batch of scores: ``bins`` numbers."""
    s = scores.where(F.col(score).isNotNull())
    lo, hi = _widen(F.col("mn"), F.col("mx"))
    r = s.agg(F.min(score).alias("mn"), F.max(score).alias("mx"), F.count(F.lit(1)).alias("n")).select(lo.alias("lo"), hi.alias("hi"), "n").first()
    if not r["n"]:
        raise ValueError("no base scores")
    binned = with_bin(s.withColumns({"__lo": F.lit(r["lo"]), "__hi": F.lit(r["hi"])}), score, "__lo", "__hi", bins)
    found = {x["bin"]: x["n"] for x in binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect()}
    return Base(r["lo"], r["hi"], r["n"], [found.get(i, 0) for i in range(bins)])


def retrain_stream(stream: DataFrame, ts: str, pred: str, actual: str, score: str, base: Base, delay: str = "1 day", floor: float = RECALL_FLOOR,
                   psi_limit: float = PSI_SHIFT) -> DataFrame:
    """O3 and O4 on a stream: per day recall, PSI of the scores against ``base``, and the retrain flag; a day is emitted when the watermark
    passes its end.  The state of an open day is its four rates and one count per bin; it goes when the day closes."""
    d = _timed(stream, ts).withWatermark(ts, delay).withColumns({"__lo": F.lit(base.lo), "__hi": F.lit(base.hi)})
    d = with_bin(d, score, "__lo", "__hi", len(base.counts), "__bin")
    p, a, n = F.col(pred), F.col(actual), len(base.counts)
    g = d.groupBy(F.window(ts, "1 day").alias("w")).agg(
        F.count(F.when(p & a, 1)).alias("tp"), F.count(F.when(~p & a, 1)).alias("fn"), F.count(score).alias("n"),
        *[F.count(F.when(F.col("__bin") == i, 1)).alias(f"__c{i}") for i in range(n)])
    psi = F.lit(0.0)
    for i, b in enumerate(base.counts):
        was = (b + PSI_EPS) / (base.rows + PSI_EPS * n)
        now = (F.col(f"__c{i}") + PSI_EPS) / (F.col("n") + PSI_EPS * n)
        psi = psi + (now - was) * F.log(now / was)
    tp, fn = F.col("tp").cast("double"), F.col("fn").cast("double")
    recall, shift = _ratio(tp, tp + fn), F.when(F.col("n") > 0, psi)
    return g.select(F.col("w.start").alias("day"), recall.alias("recall"), shift.alias("psi"),
                    ((recall < floor) | (F.coalesce(shift, F.lit(0.0)) > psi_limit)).alias("retrain"))


def split_valid(readings: str, names: Sequence[str], good: str, bad: str) -> Callable[[DataFrame, int], None]:
    """R5 for ``foreachBatch``: rows whose readings have exactly ``names`` go to ``good`` with their vector, the others to ``bad`` with the
    error.  A micro-batch owns the folder ``batch=<number>`` of both tables and overwrites it, so a batch that is run again after a
    failure adds nothing."""

    def write(batch: DataFrame, number: int) -> None:
        checked = validate_readings(batch, readings, names).persist()
        try:
            ok = checked.where("error IS NULL").drop("missing", "extra", "error").withColumn("vector", readings_to_vector(readings, names))
            ok.write.mode("overwrite").parquet(f"{good}/batch={number}")
            checked.where("error IS NOT NULL").write.mode("overwrite").parquet(f"{bad}/batch={number}")
        finally:
            checked.unpersist()

    return write


def start_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger_once: bool = False):  # noqa: ANN201
    """Start a streaming query that hands each micro-batch to ``write``."""
    w = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if trigger_once else w).start()


def start(df: DataFrame, sink: str, checkpoint: str, mode: str = "append", path: str | None = None,
          query_name: str | None = None, trigger_once: bool = False):
    """Start a streaming query with a checkpoint (restartable after a failure)."""
    w = df.writeStream.outputMode(mode).format(sink).option("checkpointLocation", checkpoint)
    if path:
        w = w.option("path", path)
    if query_name:
        w = w.queryName(query_name)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()

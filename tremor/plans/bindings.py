"""Stand-in inputs built from the driver's tables.

These only reshape the given tables into the schemas the operators expect
(recordings, feature tables, label / score pairs, two drift samples); they
do none of the operators' work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.operators.cleaning import inject_nulls, unpivot
from tremor.operators.ordering import with_sample_index

# The lineitem columns used as the channels of a multi-channel recording.
LINEITEM_CHANNELS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# The first day of the "current" half of the events table in drift checks.
EVENTS_SPLIT_DAY = "2024-01-16"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lineitem_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-channel recordings keyed by supplier (aggregates only: no order)."""
    return table(spark, sf_dir, "lineitem").select("l_suppkey", *LINEITEM_CHANNELS)


def events_recordings(spark: SparkSession, sf_dir: str, key: str = "event_type") -> DataFrame:
    """One-channel recordings of ``value`` keyed by ``key``, ordered by (ts, event_id),
    with the dense sample index ``sample_idx``."""
    e = table(spark, sf_dir, "events").select(key, "event_id", "ts", "value")
    return with_sample_index(e, [key], ["ts", "event_id"])


def events_with_gaps(spark: SparkSession, sf_dir: str, key: str = "user_id",
                     rate: float = 0.05, seed: int = 42) -> DataFrame:
    """Recordings by ``key`` with about 5% of ``value`` blanked (P7, md5 mask)."""
    rec = events_recordings(spark, sf_dir, key)
    return inject_nulls(rec, ["value"], rate=rate, seed=seed, id_cols=["event_id"])


def gappy_events(spark: SparkSession, sf_dir: str, rate: float = 0.05, seed: int = 42) -> DataFrame:
    """events with about 5% of ``value`` blanked, in no order."""
    return inject_nulls(table(spark, sf_dir, "events"), ["value"], rate=rate, seed=seed, id_cols=["event_id"])


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label / score pairs: y = (event_type = 'error'), score = value / (value + 50)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "ts", "user_id",
        (F.col("event_type") == "error").cast("int").alias("y"),
        (F.col("value") / (F.col("value") + F.lit(50.0))).alias("score"),
    )


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label / score pairs: y = labels.quality, score = n_chars / (n_chars + 1000)."""
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y"))
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return lab.join(doc, "doc_id").select(
        "doc_id", "y", (F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0))).alias("score")
    )


def events_drift_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form (feature, value, side): feature = event_type, side 0 = before the
    split day, 1 = from it."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("feature"),
        F.col("value"),
        (F.col("ts") >= F.lit(EVENTS_SPLIT_DAY).cast("timestamp_ntz")).cast("int").alias("side"),
    )


def lineitem_drift_samples(spark: SparkSession, sf_dir: str, split_year: int = 1998, by_line: bool = False) -> DataFrame:
    """Long form (feature, value, side) of the lineitem channels: side 0 =
    shipped before ``split_year``, 1 = from it.  With ``by_line`` each channel of
    each line number is a feature."""
    from tremor.operators.drift import sided_samples
    li = table(spark, sf_dir, "lineitem")
    side = F.year("l_shipdate") >= split_year
    if not by_line:
        return sided_samples(li, LINEITEM_CHANNELS, side)
    long = unpivot(li.withColumn("side", side.cast("int")), LINEITEM_CHANNELS, keys=["side", "l_linenumber"])
    return long.where("value IS NOT NULL AND side IS NOT NULL").select(
        F.concat_ws("|", "feature", F.col("l_linenumber").cast("string")).alias("feature"), "value", "side")


def events_csv_recordings(spark: SparkSession, sf_dir: str) -> str:
    """Write ``events`` as raw recordings and return their root folder.

    Layout ``<root>/class=<normal|imbalance>/severity=<event type>/week=<number>/part-*.csv``:
    headerless CSV, channels ``value`` and ``k`` (the number in ``props``),
    rows in (ts, event_id) order, one file per event type and calendar week; ``error`` events
    form the ``imbalance`` class.  The root is a new folder under the
    session's checkpoint folder (shared storage on a cluster).
    """
    import uuid

    from tremor.session import ensure_checkpoint_dir
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/recordings-{uuid.uuid4().hex}"
    e = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", "imbalance").otherwise("normal").alias("class"),
        F.col("event_type").alias("severity"), F.weekofyear("ts").alias("week"), "ts", "event_id", "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"))
    (e.repartition("class", "severity", "week")
      .sortWithinPartitions("class", "severity", "week", "ts", "event_id")
      .select("class", "severity", "week", "value", "k")
      .write.partitionBy("class", "severity", "week").option("header", "false").csv(root))
    return root

"""End-to-end flow A: raw recording files -> feature table -> prepared splits.

Each step is one of the library's operators; nothing is collected except
the two class counts that SMOTE needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.operators import cleaning, drift, features, prepare
from tremor.operators.features import CHANNELS
from tremor.session import cut_lineage
from tremor.sources.recordings import read_recordings


def feature_table(spark: SparkSession, root: str, channels: Sequence[str] = CHANNELS,
                  target: str = "fault_label") -> DataFrame:
    """Scan, interpolate (linear, then back / forward fill), summarise each
    recording into the 10 statistics per channel, add the label (and the
    severity folder) from the path and fill remaining NULLs with the column
    median."""
    rec = read_recordings(spark, root, channels)
    filled = cleaning.fill_gaps(rec, ["file_path"], "sample_idx", list(channels), how="linear")
    summ = features.recording_summary(filled, ["file_path"], "sample_idx", list(channels))
    labels = rec.groupBy("file_path").agg(F.first("label").alias(target), F.first("severity").alias("severity"))
    table = summ.join(labels, "file_path").drop("n_samples")
    feats = [c for c in table.columns if c not in ("file_path", target, "severity")]
    return cleaning.impute_median(cut_lineage(table), feats)  # one row per recording; read for the medians and their use


def prepare_splits(table: DataFrame, target: str = "fault_label", id_col: str = "file_path",
                   method: str = "robust", test_size: float = 0.2, seed: int = 42, balance: str = "smote"):
    """Split first (stratified, exact), fit the scaler on the train part only,
    balance the train part by SMOTE (``balance="random"``: by drawing rows); returns (train, test, drift)
    where drift reports the scaled test part against the train part and against the balanced one (column ``base``)."""
    feats = [c for c in table.columns if c not in (target, id_col, "severity")]
    split = cut_lineage(prepare.stratified_split(table, target, id_col, test_size, seed))
    train = split.where(~F.col("is_test")).drop("is_test")
    test = split.where(F.col("is_test")).drop("is_test")
    fitted = prepare.fit_scaler(train, feats, method)
    train_s = prepare.apply_scaler(train, fitted, feats)
    test_s = prepare.apply_scaler(test, fitted, feats)
    if balance == "smote":
        balanced = prepare.smote_columns(train_s, feats, target, id_col, seed=seed)
    elif balance == "random":
        balanced = prepare.oversample_random(train_s, target, id_col, seed)
    else:
        raise ValueError(f"Unknown balancing: {balance}")
    balanced = cut_lineage(balanced)
    return balanced, test_s, drift_on_bases({"train": train_s, "balanced": balanced}, test_s, feats)


def drift_on_bases(bases: dict[str, DataFrame], test: DataFrame, feats: Sequence[str]) -> DataFrame:
    """The drift report of a test part against several bases, e.g. the train part before and after balancing."""
    out = None
    for name, base in bases.items():
        report = drift.drift_report(drift.long_samples(base, test, feats)).withColumn("base", F.lit(name))
        out = report if out is None else out.unionByName(report)
    return out

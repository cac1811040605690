"""Scoring and maintenance decisions.

Scoring is a batch (or streaming) ``transform`` of a fitted pipeline; the
decision record is plain column arithmetic on the failure probability.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.operators.cleaning import pad_vector, readings_to_vector, validate_readings

# Decision texts and risk levels of the maintenance record.
URGENT = "\U0001F534 URGENT: Schedule maintenance immediately!"
NORMAL = "\U0001F7E2 NORMAL: Continue monitoring"
RISK_HIGH, RISK_LOW = "HIGH", "LOW"
STATUS_FAILURE, STATUS_NORMAL = "Failure", "Normal"


def decisions(df: DataFrame, prob: str | Column, threshold: float | Column) -> DataFrame:
    """R2: will_fail (prob >= threshold), confidence (p or 1 - p), its
    percentage, risk level, the threshold and a recommendation; R1 status."""
    p = F.col(prob) if isinstance(prob, str) else prob
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    fail = p >= t
    conf = F.when(fail, p).otherwise(F.lit(1.0) - p)
    return df.withColumns({
        "failure_probability": p.cast("double"),
        "will_fail": fail,
        "prediction": fail.cast("int"),
        "status": F.when(fail, STATUS_FAILURE).otherwise(STATUS_NORMAL),
        "confidence": conf,
        "confidence_percentage": conf * 100.0,
        "risk_level": F.when(fail, RISK_HIGH).otherwise(RISK_LOW),
        "decision_threshold": t.cast("double"),
        "recommendation": F.when(fail, URGENT).otherwise(NORMAL),
    })


def maintenance_count(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Machines needing maintenance (and the total scored)."""
    return scored.groupBy(*by).agg(
        F.count_if(F.col("will_fail")).alias("n_maintenance"),
        F.count(F.lit(1)).alias("n_scored"),
    )


def score_vectors(df: DataFrame, model, vec: str, n_features: int, threshold: float,
                  prob_col: str = "probability") -> DataFrame:
    """Pad or cut ``vec`` to the model width (P16), turn it into an ML
    vector, run the fitted pipeline, then the decision columns."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    d = df.withColumn("features", array_to_vector(pad_vector(vec, n_features)))
    out = model.transform(d)
    p1 = vector_to_array(F.col(prob_col))[1]
    return decisions(out.drop("rawPrediction", "prediction"), p1, threshold).drop(prob_col, "features")


def score_readings(df: DataFrame, readings: str, names: Sequence[str], model, threshold: float) -> DataFrame:
    """R3 / R5 for named readings: rows whose key set differs from ``names``
    get an ``error`` and no score; the others are reordered (P15) and scored."""
    v = validate_readings(df, readings, names)
    ok = v.where(F.col("error").isNull()).withColumn("__vec", readings_to_vector(readings, names))
    bad = v.where(F.col("error").isNotNull())
    scored = score_vectors(ok, model, "__vec", len(names), threshold).drop("__vec")
    return scored.unionByName(bad, allowMissingColumns=True)

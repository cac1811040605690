"""Queries: spectrum, scoring and decisions, models, monitoring."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tremor.operators import cleaning, forest, metrics, models, monitoring, prepare, scoring, spectrum
from tremor.plans import bindings as B
from tremor.plans.registry import register

# ---------------------------------------------------------------- spectrum

def _dft_sql(value: str) -> str:
    return f"""
WITH v AS (SELECT event_type, ts, event_id, {value} AS value FROM events),
e AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS idx
      FROM v WHERE value IS NOT NULL),
b AS (SELECT event_type, idx // 256 AS block, idx % 256 AS pos, value AS x FROM e),
k AS (SELECT CAST(k AS INTEGER) AS bin FROM range(0, 128) t(k)),
s AS (SELECT event_type, block, bin, CAST(count(*) AS INTEGER) AS n_samples, sum(x * cos(2 * pi() * bin * pos / 256.0)) AS re,
        sum(x * sin(2 * pi() * bin * pos / 256.0)) AS im FROM b, k GROUP BY event_type, block, bin)
SELECT event_type, CAST(block AS BIGINT) AS block, n_samples, bin, bin / 256.0 AS freq, sqrt(re * re + im * im) AS magnitude FROM s"""


_GAPPY = "CASE WHEN event_id % 37 = 5 THEN NULL ELSE value END"
_DFT_SQL = _dft_sql(_GAPPY)


def _gappy_events(spark, sf_dir):
    """events with every 37th value missing (nulls are skipped before blocks are cut)."""
    e = B.table(spark, sf_dir, "events").select("event_type", "ts", "event_id", "value")
    return e.withColumn("value", F.when(F.col("event_id") % 37 != 5, F.col("value")))


@register("spectrum", sql=_DFT_SQL, dbl=["freq", "magnitude"], digits=7)
def q_spectrum(spark, sf_dir):
    """|FFT| bins 0-127 of every 256-sample block of every event-type recording, the last short one included."""
    return spectrum.spectrum(_gappy_events(spark, sf_dir), ["event_type"], ["ts", "event_id"], "value")


_SUMMARY_SQL = f"""
WITH sp AS ({_DFT_SQL}),
t AS (SELECT event_type, block, any_value(n_samples) AS n_samples, sum(magnitude * magnitude) AS energy FROM sp GROUP BY event_type, block),
t2 AS (SELECT event_type, block, max(magnitude) AS mx FROM sp GROUP BY event_type, block),
d AS (SELECT sp.event_type, sp.block, min(sp.bin) / 256.0 AS dominant_freq FROM sp JOIN t2 USING (event_type, block)
      WHERE sp.magnitude = t2.mx GROUP BY sp.event_type, sp.block),
e AS (SELECT sp.event_type, sp.block,
        sum(-(sp.magnitude * sp.magnitude / (t.energy + 1e-10)) * ln(sp.magnitude * sp.magnitude / (t.energy + 1e-10) + 1e-10)) AS entropy
      FROM sp JOIN t USING (event_type, block) GROUP BY sp.event_type, sp.block)
SELECT t.event_type, t.block, t.n_samples, d.dominant_freq, t.energy, e.entropy
FROM t JOIN d USING (event_type, block) JOIN e USING (event_type, block)"""


@register("spectral_summary", sql=_SUMMARY_SQL, dbl=["dominant_freq", "energy", "entropy"], digits=7)
def q_spectral_summary(spark, sf_dir):
    """Dominant frequency, spectral energy and entropy per 256-sample block."""
    blocks = spectrum.spectrum_blocks(_gappy_events(spark, sf_dir), ["event_type"], ["ts", "event_id"], "value")
    return spectrum.spectral_summary(blocks, ["event_type"])


# ---------------------------------------------------------------- scoring and decisions

_SCORED = "SELECT event_id, ts, user_id, CAST(event_type = 'error' AS INTEGER) AS y, value / (value + 50.0) AS score FROM events"

_DEC_SQL = f"""
SELECT event_id, user_id, score AS failure_probability, score >= 0.5 AS will_fail,
  CAST(score >= 0.5 AS INTEGER) AS prediction,
  CASE WHEN score >= 0.5 THEN 'Failure' ELSE 'Normal' END AS status,
  CASE WHEN score >= 0.5 THEN score ELSE 1.0 - score END AS confidence,
  CASE WHEN score >= 0.5 THEN score ELSE 1.0 - score END * 100.0 AS confidence_percentage,
  CASE WHEN score >= 0.5 THEN 'HIGH' ELSE 'LOW' END AS risk_level,
  0.5 AS decision_threshold,
  CASE WHEN score >= 0.5 THEN '{scoring.URGENT}' ELSE '{scoring.NORMAL}' END AS recommendation
FROM ({_SCORED}) s"""


@register("score_decisions", sql=_DEC_SQL,
          dbl=["failure_probability", "confidence", "confidence_percentage", "decision_threshold"])
def q_score_decisions(spark, sf_dir):
    """Failure decision record per scored event at threshold 0.5."""
    s = B.scored_events(spark, sf_dir).select("event_id", "user_id", "score")
    return scoring.decisions(s, "score", 0.5).drop("score")


@register("maintenance_count", sql=f"""
SELECT user_id, count(*) FILTER (WHERE score >= 0.5) AS n_maintenance, count(*) AS n_scored
FROM ({_SCORED}) s GROUP BY user_id""")
def q_maintenance_count(spark, sf_dir):
    """Decisions needing maintenance per machine (user)."""
    s = scoring.decisions(B.scored_events(spark, sf_dir), "score", 0.5)
    return scoring.maintenance_count(s, ["user_id"])


_PAD_SQL = """
SELECT vec_id,
  CAST(embedding AS DOUBLE[]) || list_transform(range(80 - len(embedding)), lambda x: 0.0::DOUBLE) AS padded,
  CAST(embedding AS DOUBLE[])[1:32] AS cut
FROM embeddings"""


@register("pad_vector", sql=_PAD_SQL)
def q_pad_vector(spark, sf_dir):
    """Embeddings padded with zeros to 80 and cut to 32 elements."""
    e = B.table(spark, sf_dir, "embeddings")
    return e.select("vec_id", cleaning.pad_vector("embedding", 80).alias("padded"),
                    cleaning.pad_vector("embedding", 32).alias("cut"))


_VAL_SQL = """
WITH r AS (SELECT event_id, json_keys(props) AS ks, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events),
c AS (SELECT event_id, k,
        list_sort(list_filter(['k'], lambda x: NOT list_contains(ks, x))) AS missing,
        list_sort(list_filter(ks, lambda x: NOT list_contains(['k'], x))) AS extra FROM r)
SELECT event_id, missing, extra,
  CASE WHEN len(missing) > 0 OR len(extra) > 0 THEN
    'names differ from the model''s; absent: ' || array_to_string(missing, ',') || '; unknown: ' || array_to_string(extra, ',') END AS error,
  CASE WHEN len(missing) = 0 AND len(extra) = 0 THEN [k] END AS vector
FROM c"""


@register("validate_readings", sql=_VAL_SQL)
def q_validate_readings(spark, sf_dir):
    """Named readings (events.props as map) checked against the
    expected names; valid rows reordered into a vector, others get an error."""
    e = B.table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "map<string,double>").alias("readings"))
    v = cleaning.validate_readings(e, "readings", ["k"])
    return v.select("event_id", "missing", "extra", "error",
                    F.when(F.col("error").isNull(), cleaning.readings_to_vector("readings", ["k"])).alias("vector"))


# ---------------------------------------------------------------- models (no SQL twin)

def _vectors(spark, sf_dir):
    """embeddings as a feature table: y = (label = 5), vector as array<double>."""
    e = B.table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"),
                    (F.col("label") == 5).cast("int").alias("y"))


def _split(table):
    s = prepare.stratified_split(table, "y", "vec_id", 0.2, 42).withColumn("features", array_to_vector("vec"))
    # balanced weights from the training part only; read by every stage of every fit, so kept
    train = models.packed(models.prepare_training(s.where(~F.col("is_test")), "y"))
    test = s.where(F.col("is_test")).withColumn("label", F.col("y").cast("double"))
    return train, test


@register("model_compare", note="Spark ML fits at the full settings: behaviour checked in tests")
def q_model_compare(spark, sf_dir):
    """Logistic regression, random forest and boosted trees on the
    same stratified split; metrics on the test part at threshold 0.5 and AUC."""
    train, test = _split(_vectors(spark, sf_dir))
    fits = {"logistic_regression": models.logistic_regression(), "random_forest": models.random_forest(),
            "boosted_trees": models.boosted_trees(pos_weight=models.positive_weight(train))}
    return models.compare(models.fit_all(fits, train), test)


@register("model_threshold", note="Spark ML fit: behaviour checked in tests")
def q_model_threshold(spark, sf_dir):
    """Train, choose the threshold on a validation part, evaluate on the test part at 0.5 and at the choice."""
    train, test = _split(_vectors(spark, sf_dir))
    folds = models.packed(models.stratified_folds(train, "y", "vec_id", 5))  # read by every iteration of the fit
    fitted = models.logistic_regression().fit(folds.where("fold > 0"))
    valid = models.positive_probability(fitted.transform(folds.where("fold = 0")))
    sweep = metrics.threshold_sweep(valid, "y", "p1", 10, 90, 100, 0.5)
    scored = models.positive_probability(fitted.transform(test))
    return metrics.threshold_compare(scored, "y", "p1", metrics.optimal_threshold(sweep, 0.95))


@register("model_tuning", note="forest fits: tests recompute the scores from the node tables")
def q_model_tuning(spark, sf_dir):
    """M4: grid search over the whole forest grid with stratified folds, balanced inside each fold and scored by the recall of
    class 1; the mean CV recall of all settings."""
    train, _ = _split(_vectors(spark, sf_dir))
    folds = models.packed(models.stratified_folds(train.drop("weight"), "y", "vec_id", models.FOLDS).select("features", "label", "fold"))
    scores = forest.search_forest(folds, models.FOLDS, least=1)  # a small table asks for as many trees, so they are grown by tasks too
    return forest.recall_per_setting(scores, list(forest.FOREST_GRID))


@register("feature_importance", note="forest fit: tests recompute the importances")
def q_feature_importance(spark, sf_dir):
    """Random-forest importances of the 64 embedding dimensions (NULL counts as 0), fitted to all rows, top 20."""
    table = _vectors(spark, sf_dir).withColumn("vec", F.transform("vec", lambda x: F.coalesce(x, F.lit(0.0))))
    rows = models.packed(models.prepare_training(table.withColumn("features", array_to_vector("vec")), "y"))
    nodes = forest.forest_nodes(rows, lambda trees, seed: models.random_forest(trees, seed=seed), models.RF_TREES, models.RF_DEPTH)
    return forest.importances(nodes, [f"dim_{i}" for i in range(64)], top_n=20)


@register("model_scoring", note="Spark ML fit: behaviour checked in tests")
def q_model_scoring(spark, sf_dir):
    """Batch scoring of every embedding (padded / cut to the model
    width) with the fitted logistic pipeline, saved and loaded as a bundle with its threshold, and its decision record."""
    import uuid

    from tremor.session import ensure_checkpoint_dir
    train, _ = _split(_vectors(spark, sf_dir))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bundle-{uuid.uuid4().hex}"
    models.save_bundle(models.logistic_regression().fit(train), 0.5, [f"dim_{i}" for i in range(64)], path)
    fitted, threshold, names = models.load_bundle(path)
    allv = _vectors(spark, sf_dir)
    return scoring.score_vectors(allv, fitted, "vec", len(names), threshold).select(
        "vec_id", "y", "failure_probability", "will_fail", "status", "risk_level", "confidence")


# ---------------------------------------------------------------- monitoring

_FEEDBACK_SQL = f"""
WITH p AS (SELECT user_id, ts, score >= 0.5 AS predicted_failure, score FROM ({_SCORED}) s),
o AS (SELECT user_id, ts, y = 1 AS actual_failure FROM ({_SCORED}) s)
SELECT p.user_id, p.ts, p.score AS predicted_probability, p.predicted_failure, o.actual_failure,
  CASE WHEN p.predicted_failure AND o.actual_failure THEN 'CORRECT_POSITIVE'
       WHEN p.predicted_failure AND NOT o.actual_failure THEN 'FALSE_POSITIVE'
       WHEN NOT p.predicted_failure AND o.actual_failure THEN 'FALSE_NEGATIVE'
       ELSE 'CORRECT_NEGATIVE' END AS feedback
FROM p JOIN o USING (user_id, ts)"""


def _pred_outcome(spark, sf_dir):
    s = B.scored_events(spark, sf_dir)
    pred = s.select("user_id", "ts", F.col("score").alias("predicted_probability"),
                    (F.col("score") >= 0.5).alias("predicted_failure"))
    out = s.select("user_id", "ts", (F.col("y") == 1).alias("actual_failure"))
    return pred.join(out, ["user_id", "ts"])


@register("feedback_label", sql=_FEEDBACK_SQL, dbl=["predicted_probability"])
def q_feedback_label(spark, sf_dir):
    """O1: predictions joined with outcomes on machine and time, labelled."""
    j = _pred_outcome(spark, sf_dir)
    return j.withColumn("feedback", monitoring.feedback_label(F.col("predicted_failure"), F.col("actual_failure")))


_DAILY_SQL = f"""
WITH p AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, score >= 0.5 AS pr, y = 1 AS ac FROM ({_SCORED}) s),
c AS (SELECT day, count(*) FILTER (WHERE pr AND ac) AS tp, count(*) FILTER (WHERE pr AND NOT ac) AS fp,
        count(*) FILTER (WHERE NOT pr AND ac) AS fn, count(*) FILTER (WHERE NOT pr AND NOT ac) AS tn FROM p GROUP BY day),
m AS (SELECT *, CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0.0 END AS recall FROM c)
SELECT day, tp, fp, fn, tn, recall,
  CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN fp + tn > 0 THEN fp * 1.0 / (fp + tn) ELSE 0.0 END AS fp_rate,
  CASE WHEN fn + tp > 0 THEN fn * 1.0 / (fn + tp) ELSE 0.0 END AS fn_rate,
  recall < 0.8 AS recall_alert
FROM m"""


@register("daily_recall", sql=_DAILY_SQL, dbl=["recall", "precision", "fp_rate", "fn_rate"])
def q_daily_recall(spark, sf_dir):
    """O2: daily recall / precision / FP and FN rates with a recall < 0.8 alert."""
    j = _pred_outcome(spark, sf_dir)
    return monitoring.daily_rates(j, "ts", "predicted_failure", "actual_failure")


_BASE_END = "2024-01-08"
_PDRIFT_SQL = f"""
WITH s AS ({_SCORED}),
base AS (SELECT score FROM s WHERE ts < TIMESTAMP '{_BASE_END}'),
cur AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, score FROM s WHERE ts >= TIMESTAMP '{_BASE_END}'),
r0 AS (SELECT min(score) AS mn, max(score) AS mx, count(*) AS n0 FROM base),
r AS (SELECT CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi, n0 FROM r0),
l AS (SELECT NULL AS day, score AS value, 0 AS side FROM base UNION ALL SELECT day, score, 1 FROM cur),
i AS (SELECT l.day, l.side, l.value, r.lo, r.hi, CAST(floor((l.value - r.lo) * (10.0 / (r.hi - r.lo))) AS INTEGER) AS k0 FROM l, r),
i1 AS (SELECT *, CASE WHEN k0 >= 10 THEN 9 ELSE k0 END AS k1 FROM i),
i2 AS (SELECT *, CASE WHEN value < (CASE WHEN k1 = 10 THEN hi ELSE lo + k1 * ((hi - lo) / 10.0) END) THEN k1 - 1 ELSE k1 END AS k2 FROM i1),
i3 AS (SELECT day, side, CASE WHEN value >= lo AND value <= hi THEN
          CASE WHEN value >= (CASE WHEN k2 + 1 = 10 THEN hi ELSE lo + (k2 + 1) * ((hi - lo) / 10.0) END) AND k2 <> 9
               THEN k2 + 1 ELSE k2 END END AS bin FROM i2),
bc AS (SELECT bin, count(*) AS b FROM i3 WHERE side = 0 AND bin IS NOT NULL GROUP BY bin),
cc AS (SELECT day, bin, count(*) AS c FROM i3 WHERE side = 1 AND bin IS NOT NULL GROUP BY day, bin),
days AS (SELECT day, count(*) AS n1 FROM cur GROUP BY day),
g AS (SELECT days.day, days.n1, r.n0, CAST(t.bin AS INTEGER) AS bin FROM days, r, range(0, 10) t(bin)),
gc AS (SELECT g.*, coalesce(bc.b, 0) AS b, coalesce(cc.c, 0) AS c FROM g LEFT JOIN bc USING (bin) LEFT JOIN cc USING (day, bin))
SELECT day, sum(((c + 1e-6) / (n1 + 1e-6 * 10) - (b + 1e-6) / (n0 + 1e-6 * 10))
                * ln(((c + 1e-6) / (n1 + 1e-6 * 10)) / ((b + 1e-6) / (n0 + 1e-6 * 10)))) AS psi
FROM gc GROUP BY day"""


@register("prediction_drift", sql=_PDRIFT_SQL, dbl=["psi"], absr=["psi"])
def q_prediction_drift(spark, sf_dir):
    """O3: PSI of each day's score distribution against the first week."""
    s = B.scored_events(spark, sf_dir)
    return monitoring.psi_by_period(s, "ts", "score", _BASE_END)


_RETRAIN_SQL = f"""
WITH d AS ({_DAILY_SQL}), p AS ({_PDRIFT_SQL})
SELECT d.day, d.recall, p.psi, (d.recall < 0.8 OR coalesce(p.psi, 0.0) > 0.2) AS retrain
FROM d LEFT JOIN p USING (day)"""


@register("retrain_trigger", sql=_RETRAIN_SQL, dbl=["recall", "psi"], absr=["psi"])
def q_retrain_trigger(spark, sf_dir):
    """Retrain flag per day: recall below 0.8 or score PSI above 0.2."""
    s = B.scored_events(spark, sf_dir)
    j = _pred_outcome(spark, sf_dir)
    rates = monitoring.daily_rates(j, "ts", "predicted_failure", "actual_failure")
    shift = monitoring.psi_by_period(s, "ts", "score", _BASE_END)
    return monitoring.retrain_trigger(rates, shift)


# ---------------------------------------------------------------- SMOTE

_H = "CAST('0x' || substr(md5(concat_ws('|', {cols}, '{seed}')), 1, 15) AS BIGINT)"
_SMOTE_SQL = f"""
WITH e AS (SELECT vec_id, CAST(label = 5 AS INTEGER) AS y, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
c AS (SELECT y, count(*) AS n FROM e GROUP BY y),
mn AS (SELECT y AS cmin, n AS nmin FROM c ORDER BY n, y LIMIT 1),
mj AS (SELECT max(n) AS nmaj FROM c),
kk AS (SELECT least(5, nmin - 1) AS k, nmin, nmaj - nmin AS need FROM mn, mj),
m AS (SELECT e.vec_id AS id, e.v AS x FROM e, mn WHERE e.y = mn.cmin),
d AS (SELECT a.id, b.id AS nb_id,
        sqrt(list_reduce(list_transform(range(1, len(a.x) + 1), lambda i: (a.x[i] - b.x[i]) * (a.x[i] - b.x[i])),
                         lambda p, q: p + q)) AS dist
      FROM m a JOIN m b ON a.id <> b.id),
nn AS (SELECT id, nb_id, row_number() OVER (PARTITION BY id ORDER BY dist, nb_id) - 1 AS slot FROM d),
hr AS (SELECT id, x, row_number() OVER (ORDER BY {_H.format(cols="CAST(id AS VARCHAR)", seed=42)}, id) - 1 AS hrank FROM m),
dr0 AS (SELECT unnest(range(need)) AS draw, k, nmin FROM kk),
dr AS (SELECT draw, {_H.format(cols="CAST(draw AS VARCHAR)", seed=42)} % (nmin * k) AS pick,
         k, {_H.format(cols="CAST(draw AS VARCHAR)", seed=43)} / 1152921504606846976.0 AS u FROM dr0),
j AS (SELECT dr.draw, dr.u, hr.id AS base_id, hr.x, nn.nb_id, nb.x AS nbx
      FROM dr JOIN hr ON hr.hrank = dr.pick // dr.k
      JOIN nn ON nn.id = hr.id AND nn.slot = dr.pick % dr.k
      JOIN m nb ON nb.id = nn.nb_id)
SELECT vec_id, y, list_transform(v, lambda t: round(t, 9)) AS vec, false AS synthetic, CAST(NULL AS BIGINT) AS draw,
       CAST(NULL AS BIGINT) AS base_id, CAST(NULL AS BIGINT) AS nb_id, CAST(NULL AS DOUBLE) AS u FROM e
UNION ALL
SELECT NULL, (SELECT cmin FROM mn),
       list_transform(range(1, len(x) + 1), lambda i: round(x[i] + u * (nbx[i] - x[i]), 9)),
       true, draw, base_id, nb_id, u FROM j"""


@register("smote", sql=_SMOTE_SQL, dbl=["u"])
def q_smote(spark, sf_dir):
    """SMOTE of the embeddings with y = (label = 5), k = 5, with the exact
    nearest neighbours; the balanced table with synthetic
    rows (vector elements rounded to 9 decimals)."""
    e = B.table(spark, sf_dir, "embeddings").select(
        "vec_id", (F.col("label") == 5).cast("int").alias("y"), F.col("embedding").cast("array<double>").alias("vec"))
    out = prepare.smote(e, "y", "vec_id", "vec", k=5, seed=42)
    return out.withColumn("vec", F.transform("vec", lambda t: F.round(t, 9)))

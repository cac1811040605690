"""Training, tuning, importance and the model bundle.

All fits are Spark ML estimators (distributed tree aggregation); parameter
names follow the reference's intent:
n_estimators -> numTrees / maxIter, max_depth -> maxDepth (None -> 30, Spark's
cap), min_samples_leaf -> minInstancesPerNode, learning_rate -> stepSize,
subsample -> subsamplingRate, class_weight='balanced' -> weightCol.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.functions import hash_bigint
from tremor.operators import metrics
from tremor.operators.prepare import pos_weight, with_class_weight
from tremor.session import cut_lineage

# Seed 42, LR 1000 iterations, RF 100 trees of depth 15 with 2 rows per leaf, boosting 100
# rounds of depth 6, step 0.1, row and column samples 0.8, 5 folds, recall of class 1 as the CV score.
SEED = 42
LR_MAX_ITER = 1000
RF_TREES, RF_DEPTH, RF_LEAF = 100, 15, 2
GBT_ROUNDS, GBT_DEPTH, GBT_STEP, GBT_ROWS, GBT_COLUMNS = 100, 6, 0.1, 0.8, 0.8
FOLDS = 5


def _scaler():
    # population-free standardisation inside the pipeline (mean / std), as the
    # reference fits StandardScaler on the training features
    return StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)


def logistic_regression(weight_col: str | None = "weight", max_iter: int = LR_MAX_ITER) -> Pipeline:
    """M1: balanced logistic regression (L2, C = 1 -> regParam = 1 / n is data
    dependent; a small fixed regParam is used)."""
    lr = LogisticRegression(featuresCol="scaled", labelCol="label", maxIter=max_iter, regParam=0.01,
                            **({"weightCol": weight_col} if weight_col else {}))
    return Pipeline(stages=[_scaler(), lr])


def random_forest(num_trees: int = RF_TREES, max_depth: int = RF_DEPTH, min_leaf: int = RF_LEAF,
                  weight_col: str | None = "weight", seed: int = SEED) -> Pipeline:
    """M2: random forest (balanced weights)."""
    rf = RandomForestClassifier(featuresCol="scaled", labelCol="label", numTrees=num_trees, maxDepth=max_depth,
                                minInstancesPerNode=min_leaf, seed=seed, cacheNodeIds=True,  # else every level walks every tree again for every row
                                **({"weightCol": weight_col} if weight_col else {}))
    return Pipeline(stages=[_scaler(), rf])


def positive_weight(train: DataFrame, label: str = "label") -> float:
    """B9 as a number: negatives over positives (1 if a class is missing)."""
    return pos_weight(train, label).first()["scale_pos_weight"] or 1.0


def boosted_trees(max_iter: int = GBT_ROUNDS, max_depth: int = GBT_DEPTH, step: float = GBT_STEP,
                  subsample: float = GBT_ROWS, columns: float = GBT_COLUMNS, pos_weight: float = 1.0,
                  seed: int = SEED) -> Pipeline:
    """M3: gradient-boosted trees (the reference's boosting role); rows of class 1 weigh ``pos_weight``."""
    weigh = SQLTransformer(statement=f"SELECT *, CASE WHEN label = 1 THEN {float(pos_weight)!r} ELSE 1.0D END AS pos_weight FROM __THIS__")
    gbt = GBTClassifier(featuresCol="scaled", labelCol="label", maxIter=max_iter, maxDepth=max_depth,
                        stepSize=step, subsamplingRate=subsample, featureSubsetStrategy=str(columns), seed=seed,
                        weightCol="pos_weight")
    return Pipeline(stages=[_scaler(), weigh, gbt])


def compare(fitted: dict[str, PipelineModel], test: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Metrics and AUC of every model on the same rows, from one table of scores (model, y, p1)."""
    scored = None
    for name, model in fitted.items():
        own = positive_probability(model.transform(test)).select(F.lit(name).alias("model"), "y", "p1")
        scored = own if scored is None else scored.union(own)
    scored = cut_lineage(scored)
    return metrics.binary_metrics(scored, "y", "p1", threshold, by=["model"]).join(
        metrics.roc_auc(scored, "y", "p1", by=["model"]).select("model", "roc_auc"), "model")


def packed(df: DataFrame, rows: int = 50_000, least: int = 8_000, parts: int = 16) -> DataFrame:
    """Kept in memory in as many partitions as the rows ask for: a fit reads its table hundreds of times, and on a small one the tasks
    cost more than the rows.  Partitions of ``least`` rows, up to ``parts`` of them; beyond, of up to ``rows`` rows (a level of a forest sums
    the statistics of all its nodes once per partition)."""
    kept = df.persist()
    n = kept.count()
    wanted = max(1, -(-n // rows), min(parts, -(-n // least)))
    if wanted == kept.rdd.getNumPartitions():
        return kept
    dealt = (kept.coalesce(1) if wanted == 1 else kept.repartition(wanted)).persist()
    dealt.count()
    kept.unpersist()
    return dealt


def fit_all(pipelines: dict[str, Pipeline], train: DataFrame) -> dict[str, PipelineModel]:
    """Fit several pipelines on the same rows, side by side."""
    with ThreadPoolExecutor(len(pipelines)) as pool:
        return dict(zip(pipelines, pool.map(lambda p: p.fit(train), pipelines.values())))


def tune(pipeline: Pipeline, grid: dict, folds: int = FOLDS, parallelism: int = 4,
         fold_col: str | None = "fold") -> CrossValidator:
    """M4: Spark's own grid search with stratified folds (``fold_col``), scored by the
    recall of class 1, refit on all rows.  :mod:`tremor.operators.forest` has the search that balances inside each fold."""
    est = pipeline.getStages()[-1]
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(est.getParam(name), list(values))
    ev = MulticlassClassificationEvaluator(labelCol="label", metricName="recallByLabel", metricLabel=1.0)
    return CrossValidator(estimator=pipeline, estimatorParamMaps=b.build(), evaluator=ev, numFolds=folds,
                          parallelism=parallelism, seed=SEED, **({"foldCol": fold_col} if fold_col else {}))


def stratified_folds(df: DataFrame, label: str, id_col: str, folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """Fold number 0..folds-1, dealt round-robin inside each class in md5
    order, so every fold has the class shares of the whole table."""
    from tremor.operators.ordering import prefix_sums
    r = prefix_sums(df.withColumn("__one", F.lit(1).cast("long")), [label],
                    [hash_bigint([id_col], seed), id_col], ["__one"], prefix="__r")
    return r.withColumn("fold", ((F.col("__r__one") - 1) % folds).cast("int")).drop("__one", "__r__one")


def prepare_training(df: DataFrame, label: str) -> DataFrame:
    """label -> double ``label`` and the balanced ``weight`` column."""
    d = df.withColumn("label", F.col(label).cast("double"))
    return with_class_weight(d, "label", "weight")


def positive_probability(scored: DataFrame) -> DataFrame:
    return scored.withColumn("p1", vector_to_array("probability")[1])


def save_bundle(model: PipelineModel, threshold: float, names: Sequence[str], path: str) -> None:
    """The fitted pipeline plus a one-row table of threshold and feature names."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(float(threshold), list(names), json.dumps({"n_features": len(names)}))],
                          "threshold double, feature_names array<string>, meta string") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def load_bundle(path: str):
    """(model, threshold, feature names)."""
    spark = SparkSession.getActiveSession()
    model = PipelineModel.load(f"{path}/model")
    meta = spark.read.parquet(f"{path}/meta").first()
    return model, meta["threshold"], list(meta["feature_names"])

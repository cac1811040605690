"""Training, tuning, scoring and the model bundle (behaviour, not the reference's numbers)."""

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tremor.operators import cleaning, models, prepare, scoring
from tests.conftest import SF01


@pytest.fixture(scope="module")
def split(spark):
    e = spark.read.parquet(f"{SF01}/embeddings.parquet").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vec"), (F.col("label") == 5).cast("int").alias("y"))
    s = prepare.stratified_split(e, "y", "vec_id", 0.2, 42).withColumn("features", array_to_vector("vec"))
    train = models.prepare_training(s.where(~F.col("is_test")), "y")
    test = s.where(F.col("is_test")).withColumn("label", F.col("y").cast("double"))
    return train, test


def test_split_sizes_exact(split):
    train, test = split
    n = train.count() + test.count()
    assert test.count() == -(-n * 2 // 10)  # ceil(0.2 * n)
    pos = test.where("y = 1").count()
    assert abs(pos - 0.2 * 44) <= 1


def test_balanced_weights_sum_per_class(split):
    train, _ = split
    w = train.groupBy("y").agg(F.sum("weight").alias("w")).collect()
    a, b = (r.w for r in w)
    assert a == pytest.approx(b)


def test_logistic_model_fits_and_bundle_roundtrip(spark, split, scratch):
    train, test = split
    m = models.logistic_regression().fit(train)
    sc = models.positive_probability(m.transform(test))
    from tremor.operators import metrics
    # the driver's embeddings carry no label signal: check the fit on the training part
    fit_auc = metrics.roc_auc(models.positive_probability(m.transform(train)), "y", "p1").first().roc_auc
    assert fit_auc is not None and fit_auc > 0.6
    models.save_bundle(m, 0.42, [f"d{i}" for i in range(64)], f"{scratch}/bundle")
    m2, thr, names = models.load_bundle(f"{scratch}/bundle")
    assert thr == 0.42 and len(names) == 64
    a = [r.p1 for r in models.positive_probability(m2.transform(test)).orderBy("vec_id").collect()]
    b = [r.p1 for r in sc.orderBy("vec_id").collect()]
    assert a == pytest.approx(b)


def test_score_readings_flags_bad_rows(spark, split):
    train, _ = split
    m = models.logistic_regression().fit(train)
    names = [f"d{i}" for i in range(64)]
    good = {n: 0.1 for n in names}
    missing = {n: 0.1 for n in names[:-1]}
    extra = dict(good, zz=1.0)
    df = spark.createDataFrame([(1, good), (2, missing), (3, extra)], "id int, r map<string,double>")
    out = {r.id: r for r in scoring.score_readings(df, "r", names, m, 0.5).collect()}
    assert out[1].error is None and out[1].failure_probability is not None
    assert "absent: d63" in out[2].error and out[2].failure_probability is None
    assert "unknown: zz" in out[3].error


def test_pad_and_cut(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0, 2.0, 3.0, 4.0],)], "v array<double>")
    got = [r.p for r in df.select(cleaning.pad_vector("v", 3).alias("p")).collect()]
    assert got == [[1.0, 2.0, 0.0], [1.0, 2.0, 3.0]]


def test_decision_record_threshold_inclusive(spark):
    df = spark.createDataFrame([(0.5,), (0.49,)], "p double")
    r = scoring.decisions(df, "p", 0.5).collect()
    assert r[0].will_fail and r[0].risk_level == "HIGH" and r[0].confidence == 0.5
    assert not r[1].will_fail and r[1].confidence == pytest.approx(0.51)


def test_unknown_scaler(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError):
        prepare.fit_scaler(df, ["x"], "zscore")


def test_scalers_zero_spread(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0), (3.0, 4.0)], "c double, x double")
    for m in prepare.METHODS:
        out = prepare.scale(df, ["c", "x"], m).collect()
        assert all(r.c == 0.0 for r in out)
    rob = prepare.scale(df, ["x"], "robust").collect()
    assert sorted(r.x for r in rob)[1] == 0.0  # median maps to 0


def test_smote_rows_lie_between_parents(spark):
    rows = [(i, [float(i % 7), float(i % 5)], 1 if i < 12 else 0) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y int")
    out = prepare.smote(df, "y", "id", "v", k=5)
    counts = {r.y: r.c for r in out.groupBy("y").agg(F.count("*").alias("c")).collect()}
    assert counts[0] == counts[1] == 48
    vec = {r.id: r.v for r in rows and df.collect()}
    for r in out.where("synthetic").collect():
        a, b = vec[r.base_id], vec[r.nb_id]
        for x, lo, hi in zip(r.v, a, b):
            assert min(lo, hi) - 1e-12 <= x <= max(lo, hi) + 1e-12


def test_smote_without_neighbours_keeps_its_columns(spark):
    df = spark.createDataFrame([(i, [float(i)], int(i == 0)) for i in range(4)], "id long, v array<double>, y int")
    out = prepare.smote(df, "y", "id", "v")
    assert out.columns == ["id", "y", "v", "synthetic", "draw", "base_id", "nb_id", "u"] and out.where("y = 1").count() == 3


def test_oversample_balances(spark):
    df = spark.createDataFrame([(i, 1 if i < 5 else 0) for i in range(20)], "id long, y int")
    out = prepare.oversample_random(df, "y", "id")
    c = {r.y: r.c for r in out.groupBy("y").agg(F.count("*").alias("c")).collect()}
    assert c[0] == c[1] == 15

"""Node tables, scores, importances and the grid search against plain versions; fits on data with a signal."""

import itertools

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tremor.operators import forest, metrics, models, prepare


@pytest.fixture(scope="module")
def tables(spark):
    r = np.random.default_rng(11)
    x = r.normal(size=(600, 6))
    y = (x[:, 0] + 0.8 * x[:, 1] * x[:, 2] + 0.5 * r.normal(size=600) > 1.0).astype(int)
    rows = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, y))], "id long, vec array<double>, y int")
    s = prepare.stratified_split(rows, "y", "id", 0.25, 42).withColumn("features", array_to_vector("vec"))
    train = models.prepare_training(s.where(~F.col("is_test")), "y").coalesce(2).persist()
    return train, s.where("is_test").withColumn("label", F.col("y").cast("double")).persist()


@pytest.fixture(scope="module")
def fits(tables):
    train, _ = tables
    return {"logistic": models.logistic_regression().fit(train), "forest": models.random_forest(30, 6).fit(train),
            "boosted": models.boosted_trees(15, 3, 0.3, pos_weight=models.positive_weight(train)).fit(train)}


def test_models_find_the_signal(tables, fits):
    _, test = tables
    got = {r.model: r for r in models.compare(fits, test).collect()}
    assert set(got) == set(fits)
    assert all(r.roc_auc > 0.8 for r in got.values()), got
    for name, model in fits.items():
        own = models.positive_probability(model.transform(test))
        assert got[name].roc_auc == pytest.approx(metrics.roc_auc(own, "y", "p1").first().roc_auc)
        hit = own.where("p1 >= 0.5 AND y = 1").count() / own.where("y = 1").count()
        assert got[name].recall == pytest.approx(hit)


def test_logistic_fit_equals_newton(tables, fits):
    train, _ = tables
    rows = train.select("vec", "label", "weight").collect()
    x, y, w = (np.array([r[c] for r in rows], float) for c in ("vec", "label", "weight"))
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    # Spark scales once more inside and penalises the scaled coefficients; its mean loss is over the weights
    scale = np.sqrt(((z - (w[:, None] * z).sum(0) / w.sum()) ** 2 * w[:, None]).sum(0) / (w.sum() - 1))
    design, beta = np.column_stack([np.ones(len(z)), z / scale]), np.zeros(7)
    penalty = np.diag([0.0] + [0.01] * 6) * w.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        beta -= np.linalg.solve(design.T @ (design * (w * p * (1 - p))[:, None]) + penalty, design.T @ (w * (p - y)) + penalty @ beta)
    found = fits["logistic"].stages[-1]
    assert np.allclose(found.coefficients.toArray(), beta[1:] / scale, atol=2e-3)
    assert found.intercept == pytest.approx(beta[0], abs=2e-3)


def test_node_scores_equal_spark(spark, tables, fits):
    _, test = tables
    model = fits["forest"]
    scaled = models.positive_probability(model.transform(test)).withColumn("own", F.col("p1")).drop("p1")
    from pyspark.ml.functions import vector_to_array
    trees = forest.Forest.of(forest.node_table(spark, model.stages[-1]))
    both = forest.score_forest(scaled.withColumn("x", vector_to_array("scaled")), "x", trees).collect()
    assert len(both) == test.count() and all(r.own == pytest.approx(r.p1, abs=1e-12) for r in both)

    boosted = fits["boosted"]
    margin = forest.Forest.of(forest.node_table(spark, boosted.stages[-1]), shares=False)
    rows = models.positive_probability(boosted.transform(test)).withColumn("x", vector_to_array("scaled")).select("x", "p1").collect()
    x = np.array([r.x for r in rows])
    sums = sum(w * v[0] for w, v in zip(boosted.stages[-1].treeWeights, margin.walk(x, [30])))
    assert np.allclose(1 / (1 + np.exp(-2 * sums)), [r.p1 for r in rows])


def test_importances_equal_spark(spark, fits):
    model = fits["forest"].stages[-1]
    names = [f"f{i}" for i in range(6)]
    got = forest.importances(forest.node_table(spark, model), names).orderBy("rank").collect()
    own = dict(zip(names, model.featureImportances.toArray()))
    assert {r.feature: pytest.approx(r.importance) for r in got} == own
    assert [r.feature for r in got] == sorted(own, key=lambda n: (-own[n], n)) and got[0].feature == "f0"
    assert forest.importances(forest.node_table(spark, model), names, top_n=2).count() == 2


def plain_probability(nodes, x, depth, split, trees):
    total = 0.0
    for t in range(trees):
        at, steps = nodes[t, 0], 0
        while at.left >= 0 and steps < depth and at.rows >= split:
            at, steps = nodes[t, at.left if x[at.feature] <= at.threshold else at.right], steps + 1
        total += at.stats[1] / sum(at.stats)
    return total / trees


GRID = {"n_estimators": [3, 7], "max_depth": [2, None], "min_samples_split": [2, 40], "min_samples_leaf": [1, 9]}


def test_search_reads_every_setting_off_the_nodes(spark, tables, monkeypatch):
    train, _ = tables
    folded = models.stratified_folds(train.drop("weight"), "y", "id", 3).select("features", "label", "fold", "id", "vec").persist()
    fitted = {}
    table = forest.node_table

    def kept(session, model):
        nodes = table(session, model)
        fitted[model.getMinInstancesPerNode(), model.getNumTrees, len(fitted)] = {(n.tree, n.node): n for n in nodes.collect()}
        return nodes

    monkeypatch.setattr(forest, "node_table", kept)
    scores = forest.search_forest(folded, 3, GRID, parallel=1)
    got = forest.recall_per_setting(scores, list(GRID)).collect()
    assert len(got) == 16 and sorted(r["rank"] for r in got) == list(range(1, 17))
    rows = folded.collect()
    for r in got:
        recalls = []
        for (leaf, _, job), nodes in fitted.items():
            if leaf == r.min_samples_leaf:
                own = [x for x in rows if x.fold == job % 3 and x.label == 1]
                hits = [plain_probability(nodes, x.vec, r.max_depth or 30, r.min_samples_split, r.n_estimators) > 0.5 for x in own]
                recalls.append(np.mean(hits))
        assert len(recalls) == r.folds == 3
        assert r.cv_recall == pytest.approx(np.mean(recalls)) and r.least == pytest.approx(min(recalls))
    best = min(got, key=lambda r: r["rank"])
    assert best.cv_recall == max(r.cv_recall for r in got)


def test_boosted_search_and_sparks_own(tables):
    train, _ = tables
    folded = models.stratified_folds(train, "y", "id", 2).persist()
    grid = {"max_depth": [2, 3], "learning_rate": [0.3], "subsample": [0.8], "colsample_bytree": [0.7]}
    got = forest.recall_per_setting(forest.search_boosted(folded, 2, grid, rounds=4), list(grid)).collect()
    assert len(got) == 2 and all(0.4 < r.cv_recall <= 1 for r in got)
    cv = models.tune(models.random_forest(5, 3), {"maxDepth": [2, 4]}, folds=2).fit(folded)
    assert len(cv.avgMetrics) == 2 and all(0 < m <= 1 for m in cv.avgMetrics)
    five = models.tune(models.random_forest(3, 2), {"maxDepth": [2]}).fit(models.stratified_folds(train, "y", "id"))
    assert len(five.avgMetrics) == 1


def test_folds_hold_the_classes(tables):
    train, _ = tables
    per = models.stratified_folds(train, "y", "id").groupBy("fold", "y").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in per if r.y == y]
        assert len(sizes) == models.FOLDS and max(sizes) - min(sizes) <= 1


def test_search_grows_large_forests_in_parts(spark, tables, monkeypatch):
    train, _ = tables
    folded = models.stratified_folds(train.drop("weight"), "y", "id", 2).select("features", "label", "fold", "vec").persist()
    grid, parts, table = {"n_estimators": [3, 7], "max_depth": [2, None], "min_samples_split": [2, 40], "min_samples_leaf": [1]}, [], forest.node_table

    def kept(session, model):
        nodes = table(session, model)
        parts.append((model.totalNumNodes, [list(g) for _, g in itertools.groupby(nodes.orderBy("tree", "node").collect(), lambda n: n.tree)]))
        return nodes

    monkeypatch.setattr(forest, "node_table", kept)
    scores = forest.search_forest(folded, 2, grid, parallel=1, nodes=150)
    first = next(i for i in range(1, len(parts) + 1) if sum(len(trees) for _, trees in parts[:i]) == 7)
    assert 1 < first and sum(len(trees) for _, trees in parts) == 14
    assert all(n < 600 for n, _ in parts)  # a whole forest here has more
    got = sorted((r.n_estimators, r.max_depth or 30, r.min_samples_split, r.y, round(r.p1, 9)) for r in scores.where("fold = 0").collect())
    nodes = {(t, n.node): n for t, own in enumerate(own for _, trees in parts[:first] for own in trees) for n in own}
    want = sorted((t, d or 30, s, int(x.label), round(plain_probability(nodes, x.vec, d or 30, s, t), 9))
                  for x in folded.where("fold = 0").collect() for t in (3, 7) for d in (2, None) for s in (2, 40))
    assert got == want


def test_importances_of_a_forest_in_parts(spark, tables):
    train, _ = tables
    build = lambda n, seed: models.random_forest(n, 6, seed=seed)
    whole, parts = (forest.forest_nodes(train, build, 12, 6, nodes=n).persist() for n in (10 ** 6, 200))
    assert len(list(forest.grown(train, build, 12, 6, nodes=200))) > 1
    assert [sorted(r.tree for r in t.select("tree").distinct().collect()) for t in (whole, parts)] == [list(range(12))] * 2
    one = forest.node_table(spark, models.random_forest(12, 6).fit(train).stages[-1])
    assert whole.exceptAll(one).isEmpty() and one.exceptAll(whole).isEmpty()  # a small forest is one fit, as before
    assert forest.importances(parts, [f"f{i}" for i in range(6)]).orderBy("rank").first().feature == "f0"


@pytest.mark.parametrize("rows, parts", [(500, 1), (8_000, 1), (20_000, 3)])
def test_fit_tables_are_spread_by_rows(spark, rows, parts):
    """Before, one task had up to 50,000 rows of a fit, and every level walked all trees again."""
    df = models.packed(spark.range(0, rows, 1, 2))
    assert df.rdd.getNumPartitions() == parts
    assert df.agg(F.count("id"), F.countDistinct("id"), F.sum("id")).first()[:] == (rows, rows, rows * (rows - 1) // 2)
    assert models.random_forest().getStages()[-1].getCacheNodeIds()


def test_tasks_grow_the_search_of_larger_tables(tables, monkeypatch):
    """Before, every level of every part of every forest was a job of Spark's, and model_tuning over 1 GB did not end in time."""
    train, _ = tables
    folded = models.stratified_folds(train.drop("weight"), "y", "id", 3).select("features", "label", "fold").persist()
    grid = {"n_estimators": [20, 60], "max_depth": [3, None], "min_samples_split": [2, 40], "min_samples_leaf": [1, 9]}
    fitted = {tuple(r[c] for c in grid): r for r in forest.recall_per_setting(forest.search_forest(folded, 3, grid), list(grid)).collect()}

    def none(*_):
        raise AssertionError("a fit of Spark's")

    monkeypatch.setattr(forest, "grown", none)
    scores = forest.search_forest(folded, 3, grid, least=1)
    rows = scores.groupBy(*grid, "fold", "y").count().collect()
    want = {(r.fold, int(r.label)): r["count"] for r in folded.groupBy("fold", "label").count().collect()}
    assert len(rows) == 16 * len(want) and all(r["count"] == want[r.fold, r.y] for r in rows)
    got = forest.recall_per_setting(scores, list(grid)).collect()
    assert {tuple(r[c] for c in grid) for r in got} == set(fitted) and all(r.folds == 3 for r in got)
    assert all(r.cv_recall == pytest.approx(fitted[tuple(r[c] for c in grid)].cv_recall, abs=0.15) for r in got)
    assert np.mean([r.cv_recall for r in got]) == pytest.approx(np.mean([r.cv_recall for r in fitted.values()]), abs=0.05)
    again = forest.search_forest(folded.repartition(5).persist(), 3, grid, least=1)  # the rows in other places
    assert again.exceptAll(scores).isEmpty() and scores.exceptAll(again).isEmpty()
    with pytest.raises(Exception, match="must not be null"):
        forest.search_forest(folded.withColumn("label", F.when(F.col("fold") > 0, F.col("label"))), 3, grid, least=1)


def plain_tree(codes, y, copies, weights, leaf, depth, at):
    """All splits of a node tried one by one; (rows, share, left, right, feature, bin)."""
    def sums(own):
        return sum(copies[i] for i in own), sum(copies[i] * y[i] for i in own)

    def part(n, n1):
        a, b = weights[0] * (n - n1), weights[1] * n1
        return a, b, a * b / (a + b)

    n, n1 = sums(at)
    a, b, whole = part(n, n1)
    out = (n, b / (a + b))
    best = None
    for f in range(codes.shape[1]) if depth and 0 < n1 < n else ():
        for cut in range(forest.groves.BINS - 1):
            own = [i for i in at if codes[i, f] <= cut]
            left, left1 = sums(own)
            if min(left, n - left) >= leaf:
                rest = part(left, left1)[2] + part(n - left, n1 - left1)[2]
                if whole - rest > 1e-12 * (a + b) and (best is None or rest < best[0] - 1e-12):
                    best = rest, f, cut
    if best:
        _, f, cut = best
        two = [plain_tree(codes, y, copies, weights, leaf, depth - 1, [i for i in at if (codes[i, f] <= cut) == side]) for side in (True, False)]
        if len(two[0]) > 2 or len(two[1]) > 2 or (two[0][1] > 0.5) != (two[1][1] > 0.5):
            return *out, *two, f, cut
    return out


@pytest.mark.parametrize("leaf, depth, chunk", [(1, 30, 2048), (4, 30, 2), (2, 3, 1)])
def test_grown_tree_equals_a_plain_one(monkeypatch, leaf, depth, chunk):
    monkeypatch.setattr(forest.groves, "CHUNK", chunk)
    r = np.random.default_rng(5)
    codes = r.integers(0, 32, (90, 2)).astype(np.uint8)  # two features: both are drawn for every node
    y = ((codes[:, 0] > 12) & (codes[:, 1] < 20) ^ (r.random(90) < 0.1)).astype(float)
    weights = (0.7, 1.9)
    tree = forest.groves.grow(codes, y, weights, leaf, depth, np.random.default_rng([42, leaf]))
    copies = np.random.default_rng([42, leaf]).poisson(1.0, 90)
    plain = plain_tree(codes, y, copies, weights, leaf, depth, [i for i in range(90) if copies[i]])

    def same(node, at):
        assert tree.rows[at] == node[0] and tree.value[at] == pytest.approx(node[1])
        if len(node) == 2:
            assert tree.left[at] == at == tree.right[at]
            return 1
        assert (tree.feature[at], tree.bin[at]) == node[4:]
        return same(node[2], tree.left[at]) + same(node[3], tree.right[at])

    assert same(plain, 0) >= 4
    for limits, split in itertools.product(([1, 2, 30], [3]), (2, 8, 25)):
        says = tree.values_from(split)
        for limit, place in zip(limits, tree.places(codes, limits)):
            for i, code in enumerate(codes):
                node, steps = plain, 0
                while len(node) > 2 and steps < limit and node[0] >= split:
                    node, steps = node[2 if code[node[4]] <= node[5] else 3], steps + 1
                assert says[place[i]] == pytest.approx(node[1])


def test_split_points_follow_sparks_rule():
    points = forest.groves.split_points
    assert points(np.array([1.0, 3.0, 1.0, 9.0]), np.ones(4)).tolist() == [2.0, 6.0]
    assert points(np.array([7.0, 7.0]), np.ones(2)).tolist() == []
    r = np.random.default_rng(2)
    values, weights = np.round(r.gamma(2.0, size=4000), 2), r.choice([0.6, 5.0], 4000)
    distinct = np.unique(values)
    w = [weights[values == v].sum() for v in distinct]
    stride, so_far, target, want = weights.sum() / 32, w[0], weights.sum() / 32, []
    for i in range(1, len(distinct)):
        before, so_far = so_far, so_far + w[i]
        if abs(before - target) < abs(so_far - target):
            want.append((distinct[i - 1] + distinct[i]) / 2)
            target += stride
    assert len(want) > 25 and points(values, weights).tolist() == pytest.approx(want)

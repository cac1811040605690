"""Rank selection, split cut-offs, draws, exact neighbours and nearest-neighbour information against plain versions."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from tremor.operators import information, neighbours, prepare
from tremor.operators.selection import quantiles, select_ranks

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def values(kind, n=3000):
    r = np.random.default_rng(7)
    return {"normal": r.normal(size=n), "tied": r.integers(-3, 4, n).astype(float), "one": np.full(n, 4.2),
            "wide": r.choice([-1.0, 1.0], n) * 10.0 ** r.uniform(-300, 300, n), "zeros": np.where(r.random(n) < 0.7, 0.0, r.normal(size=n)),
            "narrow": 1e6 + r.normal(size=n) * 1e-9, "edges": r.choice([float("inf"), -float("inf"), 0.0, -0.0, 5e-324, 1.7e308], n)}[kind]


@pytest.mark.parametrize("select", [8192, 16, 1])
def test_ranks_of_any_distribution(spark, select):
    kinds = ["normal", "tied", "one", "wide", "zeros", "narrow", "edges"]
    data = {k: values(k, 800) for k in kinds}
    df = spark.createDataFrame([(k, float(v)) for k in kinds for v in data[k]] + [("normal", None), ("tied", float("nan"))], "k string, x double")
    rows = df.where("x IS NOT NULL AND NOT isnan(x)")
    asked = lambda n: F.array(*[F.struct(F.lit(i).alias("id"), F.floor((n - 1) * p).cast("long").alias("rank")) for i, p in enumerate(PROBS)])
    found = {(r.k, r.id): r.value for r in select_ranks(rows, ["k"], "x", asked, select).collect()}
    for k in kinds:
        own = np.sort(data[k])
        for i, p in enumerate(PROBS):
            assert found[k, i] == own[int((len(own) - 1) * p)], (k, p)
    q = {r.k: r for r in quantiles(df.where("k <> 'edges'"), ["k"], "x", PROBS, select=select).collect()}
    for k in kinds[:-1]:
        assert np.allclose([q[k][f"q_{int(p * 100)}"] for p in PROBS], np.quantile(data[k], PROBS), rtol=1e-12), k
        assert q[k].n == 800


def test_quantiles_without_keys_and_of_null_keys(spark):
    df = spark.createDataFrame([(None if i % 3 == 0 else "a", float(i)) for i in range(100)], "k string, x double")
    assert quantiles(df, [], "x", [0.5]).first().q_50 == 49.5
    assert quantiles(df.where("x < 0"), ["k"], "x", [0.5]).count() == 0
    got = {r.k: r.q_50 for r in quantiles(df, ["k"], "x", [0.5], select=4).collect()}
    assert got == {None: 49.5, "a": float(np.median([i for i in range(100) if i % 3]))}


def test_ranks_of_whole_numbers(spark):
    r = np.random.default_rng(1)
    own = np.sort(np.append(r.integers(-(1 << 62), 1 << 62, 3000), [0, 1, 2, 3, 3, 3]))
    df = spark.createDataFrame([(int(v),) for v in own], "x long")
    asked = lambda n: F.array(*[F.struct(F.lit(i).alias("id"), F.lit(i * 97).cast("long").alias("rank")) for i in range(30)])
    assert {x.id: x.value for x in select_ranks(df, [], "x", asked, 8).collect()} == {i: int(own[i * 97]) for i in range(30)}


def plain_split(rows, size=0.2, seed=42):
    """Ids of the test set: md5 order inside each class, largest remainders first."""
    h = lambda i: int(hashlib.md5(f"{i}|{seed}".encode()).hexdigest()[:15], 16)
    classes = {}
    for i, y in rows:
        classes.setdefault(y, []).append(i)
    n_test = math.ceil(size * len(rows))
    share = {y: divmod(n_test * len(ids), len(rows)) for y, ids in classes.items()}
    left = n_test - sum(f for f, _ in share.values())
    extra = sorted(classes, key=lambda y: (-share[y][1], y is not None, y))[:left]
    return {i for y, ids in classes.items() for i in sorted(ids, key=lambda i: (h(i), i))[:share[y][0] + (y in extra)]}


def test_split_by_cut_off(spark):
    rows = [(i, None if i % 11 == 0 else i % 3) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, y int")
    out = prepare.stratified_split(df, "y", "id", 0.2, 42)
    assert {r.id for r in out.where("is_test").collect()} == plain_split(rows) and out.count() == 1000
    one = prepare.stratified_split(df, "y", "id", 0.2, 42, stratify=False)
    assert {r.id for r in one.where("is_test").collect()} == plain_split([(i, 0) for i, _ in rows])


def test_split_sizes_hold_when_ids_repeat(spark):
    df = spark.createDataFrame([(i // 50, i % 2) for i in range(400)], "id long, y int")
    out = prepare.stratified_split(df, "y", "id", 0.2, 42)
    assert {r.y: r.c for r in out.where("is_test").groupBy("y").agg(F.count("*").alias("c")).collect()} == {0: 40, 1: 40}
    assert out.count() == 400


def test_draws_of_many_classes(spark):
    rows = [(i, None if i < 3 else f"c{int(math.sqrt(i))}") for i in range(500)]
    out = prepare.oversample_random(spark.createDataFrame(rows, "id long, y string"), "y", "id")
    counts = {r.y: r.c for r in out.groupBy("y").agg(F.count("*").alias("c")).collect()}
    assert len(set(counts.values())) == 1 and len(counts) == len({y for _, y in rows})
    drawn = out.where("synthetic").groupBy("y", "draw").count()
    assert drawn.where("count <> 1").isEmpty()


def plain_neighbours(ids, x, k):
    out = {}
    for i, own in enumerate(ids):
        d = np.zeros(len(ids))
        for j in range(x.shape[1]):
            d += (x[:, j] - x[i, j]) ** 2
        d = np.sqrt(d)
        order = [j for j in np.lexsort((ids, d)) if j != i][:k]
        out[int(own)] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def check_neighbours(spark, ids, x, k, cell):
    df = spark.createDataFrame([(int(i), p.tolist()) for i, p in zip(ids, x)], "id long, v array<double>")
    got, compared = {}, {}
    for r in neighbours.nearest_neighbours(df, "id", "v", k, cell=cell).orderBy("id", "slot").collect():
        got.setdefault(r.id, []).append((r.nb_id, r.dist))
        compared[r.id] = r.compared
    assert got == plain_neighbours(ids, x, k)
    return sum(compared.values())


def test_neighbours_of_clustered_points(spark):
    r = np.random.default_rng(0)
    centres = r.normal(size=(40, 8)) * 20
    x = centres[r.integers(0, 40, 1500)] + r.normal(size=(1500, 8)) * 0.3
    x[:60] = x[0]  # copies: ties are broken by id
    n = check_neighbours(spark, r.permutation(1500) * 3, x, 5, 40)
    assert n < 1500 * 1500 / 4, n


def test_neighbours_of_embeddings(spark):
    import pyarrow.parquet as pq
    t = pq.read_table(f"{SF01.replace('0.01', '0.1')}/embeddings.parquet", columns=["vec_id", "embedding"]).slice(0, 2000)
    x = np.array(t["embedding"].to_pylist(), np.float64)
    assert x.shape == (2000, 64)
    assert check_neighbours(spark, t["vec_id"].to_numpy(), x, 5, 250) <= 2000 * 2000


def test_hot_cell_is_split(spark, monkeypatch):
    r = np.random.default_rng(3)
    x = np.vstack([r.normal(size=(500, 3)) * 1e-3, r.normal(size=(100, 3)) * 50])
    monkeypatch.setattr(neighbours, "QUERIES", 64)
    check_neighbours(spark, np.arange(600), x, 4, 30)


def test_few_points(spark):
    x = np.array([[0.0, 1.0], [0.0, 2.0], [5.0, 5.0]])
    check_neighbours(spark, np.arange(3), x, 5, 10)
    empty = spark.createDataFrame([], "id long, v array<double>")
    assert neighbours.nearest_neighbours(empty, "id", "v", 3).count() == 0


def plain_information(x, y, k=3):
    def psi(n):
        return -0.5772156649015329 + sum(1 / i for i in range(1, int(n)))

    x = np.array([0.0 if v is None else v for v in x])
    keep = np.array([np.sum(y == c) > 1 for c in y])
    x, y = x[keep], y[keep]
    terms = []
    for v, c in zip(x, y):
        own = np.sort(np.abs(x[y == c] - v))
        kk = min(k, len(own) - 1)
        d = own[kk]
        m = np.sum(np.abs(x - v) < d) if d > 0 else np.sum(x == v)
        terms.append(psi(kk) - psi(len(own)) - psi(m))
    return max(0.0, psi(len(x)) + float(np.mean(terms)))


@pytest.mark.parametrize("block", [1 << 16, 7])
def test_information_equals_a_plain_version(spark, block):
    r = np.random.default_rng(5)
    y = np.array([0] * 120 + [1] * 60 + [2] * 3 + [3])
    cols = {"signal": y + r.normal(size=184) * 0.5, "noise": r.normal(size=184), "steps": r.integers(0, 4, 184) / 10.0,
            "gaps": np.round(r.normal(size=184), 1), "same": np.zeros(184), "far": r.normal(size=184) * 10.0 ** r.integers(-200, 200, 184)}
    data = {n: [None if n == "gaps" and i % 9 == 0 else float(v) for i, v in enumerate(x)] for n, x in cols.items()}
    df = spark.createDataFrame([(*row, int(c)) for *row, c in zip(*data.values(), y)] + [(*[1.0] * 6, None)],
                               ", ".join(f"{n} double" for n in data) + ", y int")
    got = {x.feature: x.mutual_info for x in information.mutual_information(df, list(data), "y", block_rows=block).collect()}
    for n, x in data.items():
        assert got[n] == pytest.approx(plain_information(x, y), abs=1e-9), n
    assert got["signal"] > 0.3 and got["same"] == 0.0


def test_interval_ends_are_exact():
    r = np.random.default_rng(0)
    x = np.concatenate([r.normal(size=1000) * 10.0 ** r.integers(-8, 8, 1000), r.integers(-20, 20, 2000) / 10, [-1, 0, 1, 0.3, -0.3, 5.0, 0, 0]])
    d = np.concatenate([np.abs(r.normal(size=1000)) * 10.0 ** r.integers(-8, 8, 1000), np.abs(r.integers(0, 20, 2000) / 10 - r.integers(0, 20, 2000) / 10),
                        [1, 1, 1, 0.2, 0.3, 0, 0, 1e-310]])
    lo, hi = information.interval_ends(x, d)
    some = d > 0
    assert (lo[~some] == x[~some]).all() and (hi[~some] == x[~some]).all()
    x, d, lo, hi = x[some], d[some], lo[some], hi[some]
    assert (np.abs(hi - x) < d).all() and (np.abs(lo - x) < d).all()
    assert (np.abs(np.nextafter(hi, np.inf) - x) >= d).all() and (np.abs(np.nextafter(lo, -np.inf) - x) >= d).all()


def test_information_reads_its_rows_once_per_column(spark):
    """Counts of distinct values are made in one pass; before, every later step went back to the rows."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.range(0, 300, 1, 2).selectExpr("id * 7 % 31 + 0.5D AS a", "CAST(NULL AS double) AS b", "CAST(id % 3 AS int) AS y")
    df = df.mapInArrow(count, "a double, b double, y int")
    got = {x.feature: x.mutual_info for x in information.mutual_information(df, ["a", "b"], "y").collect()}
    assert read.value == 2 * 300 and set(got) == {"a", "b"} and got["b"] == 0.0

"""Whitening against dense linear algebra: exact integers, components, inertia counts."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import embedding_whitening as ew
from tests.conftest import SF_MED
from tests.llm.corpus import CLASHES

VECTORS = "vec_id long, embedding array<float>"


def dense(data, want=ew.COMPONENTS):
    """(rows kept, n, deviations, whitened, explained) with plain numpy and Python integers."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in data
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    distinct = sorted(set(tuple(x) for _, x in kept))
    n = len(distinct)
    sums = [sum(c) for c in zip(*distinct)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(x, sums)) for _, x in kept]
    c = np.array(distinct, float) - np.array([s / n for s in sums])
    values, vectors = np.linalg.eigh(c.T @ c / n)
    order = np.argsort(-values)[:want]
    order = [k for k in order if values[k] > 1e-9 * values.max()]
    x = np.array([x for _, x in kept], float) - np.array([s / n for s in sums])
    return (kept, n, deviation, x @ vectors[:, order] / np.sqrt(values[order]),
            values[order] / values.sum())


def test_whole_table_equals_dense_algebra(spark):
    data = spark.read.parquet(f"{SF_MED}/embeddings.parquet")
    kept, n, deviation, whitened, explained = dense(
        [(r.vec_id, r.embedding) for r in data.collect()])
    rows = ew.op11_embedding_whitening(spark, SF_MED).collect()
    assert len(rows) == len(kept) * 16 and {r.n for r in rows} == {n}
    by = {(r.vec_id, r.component): r for r in rows}
    for at, (vec_id, _) in enumerate(kept):
        assert by[vec_id, 1].deviation == deviation[at]
    got = np.array([[by[i, k + 1].whitened for k in range(16)] for i, _ in kept])
    got *= np.sign((got * whitened).sum(axis=0))
    assert np.abs(got - whitened).max() < 1e-8
    for k in range(16):
        assert by[kept[0][0], k + 1].explained == pytest.approx(explained[k], rel=1e-10)
    assert {r.identity_error for r in rows}.pop() < 1e-10


def odd_vectors():
    rng = np.random.default_rng(3)
    data = [(i, [float(c) for c in rng.standard_normal(5)]) for i in range(40)]
    return data + [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5),
                   (103, [1.0, 2.0, float("inf"), 0.0, 0.0]), (0, data[0][1]), (0, data[0][1]),
                   (None, data[1][1]), (200, data[2][1])]


def test_odd_vectors(spark):
    data = odd_vectors()
    table = spark.createDataFrame(data + [(300, []), (301, [1.0, 2.0])], VECTORS)
    for name in CLASHES + ["x", "whitened", "at"]:
        table = table.withColumn(name, F.lit("x"))
    model = ew.fit_whitening(table, 3)
    kept, n, deviation, whitened, explained = dense(data, 3)
    assert model.n == n == 40 and model.explained == pytest.approx(explained)
    rows = ew.whitened_vectors(table, model).collect()
    assert sorted((str(r.vec_id), r.deviation) for r in rows) == sorted(
        (str(i), d) for (i, _), d in zip(kept, deviation))
    got = np.array([r.whitened for r in rows])
    assert np.abs(got.sum(axis=0)) == pytest.approx(np.abs(whitened.sum(axis=0)), abs=1e-7)
    assert model.identity_error < 1e-10


@pytest.mark.parametrize("data", [[], [(1, None)], [(1, [])], [(1, [0.5, 1.0]), (2, [0.5, 1.0])]])
def test_nothing_to_whiten(spark, tmp_dir, data):
    spark.createDataFrame(data, VECTORS).write.parquet(f"{tmp_dir}/embeddings.parquet")
    assert ew.op11_embedding_whitening(spark, tmp_dir).collect() == []


def test_large_entries_stay_exact(spark):
    data = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])]
    table = spark.createDataFrame(data, VECTORS)
    model = ew.fit_whitening(table)
    x = [[2 ** 40 + 1_000_000, 1_000_000], [-2 ** 40 + 1_000_000, 1_000_064], [1_000_000, 1_000_128]]
    sums = [sum(c) for c in zip(*x)]
    assert model.sums == tuple(sums)
    want = [sum((3 * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    got = {r.vec_id: r.deviation for r in ew.whitened_vectors(table, model).collect()}
    assert got == {i + 1: (w if w < 2 ** 63 else None) for i, w in enumerate(want)}


def matrices():
    rng = np.random.default_rng(1)
    for n, decay in ((1, 1.0), (7, 0.1), (40, 0.5), (40, 3.0)):
        a = rng.standard_normal((2 * n, n)) * np.exp(-decay * np.arange(n) / 4)
        yield a.T @ a / n
    q = np.linalg.qr(rng.standard_normal((24, 24)))[0]
    yield (q * np.repeat([7.0, 3.0, 1.0, 0.5], 6)) @ q.T  # equal eigenvalues
    yield np.diag([4.0, 4.0, 0.0, 0.0, 1.0])
    yield np.ones((9, 9))


@pytest.mark.parametrize("v", list(matrices()), ids=range(7))
def test_components(spark, v):
    v = (v + v.T) / 2
    truth = np.linalg.eigvalsh(v)[::-1]
    for shift in np.linspace(0.01, 1.1, 23) * truth[0]:
        assert ew.below(v, shift) == (truth < shift).sum()
    values, vectors = ew.principal_components(spark, v, 16)
    want = truth[:16][truth[:16] > ew.ZERO * truth.sum()]
    assert values[:len(want)] == pytest.approx(want, rel=1e-4) and len(values) <= 16
    k = len(want)
    assert np.abs(v @ vectors - vectors * values).max() < 1e-12 * truth[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert k == len(values)


def test_a_missing_pair_is_not_passed_over():
    with pytest.raises(ArithmeticError):
        ew.feast(np.diag([1.0, 2.0, 3.0]), 0.5, 2.5, 3)

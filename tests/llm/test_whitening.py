import math
from fractions import Fraction

import numpy as np
import pytest

from cohortweave.llm import whitening
from cohortweave.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, key string, vector string, n int, component int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "k", "v", 1, 2) for i, v in rows], SCHEMA)


def usable(vectors, dims):
    return [v for v in vectors if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]


def check(rows, vectors, components):
    """Result rows against numpy's eigenvectors and exact sums."""
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for v in vectors], dtype=np.int64)
    n, dims = x.shape
    sums = [int(s) for s in x.sum(0)]
    y = np.array([[float(Fraction(int(a)) - Fraction(s, n)) for a, s in zip(row, sums)] for row in x])
    values, directions = np.linalg.eigh(y.T @ y / n)
    values, directions = values[::-1][:components], directions.T[::-1][:components]
    told = {}
    for r in rows:
        told.setdefault(r.component, {}).setdefault(r.vec_id, r)
    assert sorted(told) == list(range(1, len(values) + 1)) and len(rows) == n * len(values)
    deviations = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    for k, (value, direction) in enumerate(zip(values, directions)):
        found = np.array([told[k + 1][i].whitened for i in range(n)])
        wanted = y @ direction / math.sqrt(value)
        assert min(np.abs(found - wanted).max(), np.abs(found + wanted).max()) < 1e-7
        some = told[k + 1][0]
        assert some.explained == pytest.approx(value / (y * y).sum() * n, rel=1e-9) and some.n == n
        assert some.identity_error < 1e-9
        assert [int(told[k + 1][i].deviation) for i in range(n)] == deviations


@pytest.mark.parametrize("dims, n, offset", [(5, 40, 0.0), (9, 300, 1e6), (16, 16, 0.0)])
def test_as_numpy(spark, dims, n, offset):
    rng = np.random.default_rng(dims)
    vectors = (rng.normal(size=(n, dims)) * np.arange(1, dims + 1) + offset).tolist()
    rows = whitening.whiten(frame(spark, list(enumerate(vectors))).repartition(4), components=4).collect()
    check(rows, vectors, 4)


def test_unusable_vectors_and_ties(spark):
    rng = np.random.default_rng(1)
    good = rng.normal(size=(30, 3)).tolist()
    bad = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 0.0, 0.0], [1.0, 2.0], [1e300, 0.0, 0.0]]
    rows = whitening.whiten(frame(spark, [*enumerate(good), *((100 + i, v) for i, v in enumerate(bad))])).collect()
    check(rows, good, 3)
    again = whitening.whiten(frame(spark, [(None, v) for v in good] + [(1, v) for v in good])).collect()
    assert len(again) == 180 and {r.n for r in again} == {60}


def test_no_variance_and_empty(spark):
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([(1, [1.0, 2.0])] * 5, [(1, [])], [(1, None)]):
        none = whitening.whiten(frame(spark, rows))
        assert none.columns == names and none.collect() == []
    assert whitening.whiten(frame(spark, [(1, [1.0])]).limit(0)).collect() == []
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i, 0.5]) for i in range(9)])).collect()
    assert {r.component for r in line} == {1} and all(abs(r.explained - 1) < 1e-12 for r in line)
    equal = whitening.whiten(frame(spark, [(i, [float(i % 2), float(i // 2)]) for i in range(4)])).collect()
    assert {round(r.explained, 9) for r in equal} == {0.5} and len(equal) == 8


def test_large_entries_stay_exact(spark):
    vectors = [[1e12 + i * i, -3e12 * (i % 3)] for i in range(50)]
    rows = whitening.whiten(frame(spark, list(enumerate(vectors)))).collect()
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x)]
    exact = {i: sum((50 * a - s) ** 2 for a, s in zip(row, sums)) for i, row in enumerate(x)}
    assert {r.vec_id: int(r.deviation) for r in rows} == exact


def test_cholesky_and_jacobi():
    rng = np.random.default_rng(3)
    half = rng.normal(size=(40, 12)) @ np.diag(10.0 ** -np.arange(12))
    full = half.T @ half
    factor = whitening.pivoted_cholesky(full)
    assert np.abs(factor @ factor.T - full).max() < 1e-12 * full.max()
    turned = whitening.orthogonal_columns(factor)
    gram = turned.T @ turned
    scale = np.sqrt(np.outer(gram.diagonal(), gram.diagonal()))
    assert np.abs(gram / scale - np.eye(len(gram))).max() < 1e-13
    singular = np.linalg.svd(half, compute_uv=False) ** 2
    assert np.allclose(np.sort(gram.diagonal())[::-1][:5], singular[:5], rtol=1e-8)
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)


def test_the_query(spark, tmp_path):
    rng = np.random.default_rng(8)
    vectors = np.float32(rng.normal(size=(200, 12)) * 0.1).tolist()
    data = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")
    data.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op13_embedding_whitening"](spark, str(tmp_path))
    assert dict(got.dtypes)["deviation"] == "bigint"
    check(got.collect(), vectors, 8)

"""Whitening against an eigenvalue decomposition of the covariance, and its steps on hard matrices."""

import numpy as np
import pytest
from pyspark.sql import types as T

from sitewise.llm import whitening


def triangle(a):
    d = a.shape[1]
    r = np.linalg.qr(a, mode="r")
    return np.concatenate([r, np.zeros((d - len(r), d))])


def matrices():
    rnd = np.random.default_rng(0)
    u, v = np.linalg.qr(rnd.normal(size=(200, 24)))[0], np.linalg.qr(rnd.normal(size=(24, 24)))[0]
    for s in ([1] * 24, [1] * 5 + [0.1] * 19, [1, 1 - 1e-9, 1 - 2e-9, 0.5] + [0.1] * 20, [3, 2] + [0] * 22, np.linspace(1, 0.99, 24), np.logspace(0, -4, 24)):
        yield (u * np.array(s)) @ v
    yield np.repeat(np.eye(7), 3, axis=0)
    yield np.array([[1.0, 0, 0], [0, 0, 0]])
    for _ in range(60):
        yield rnd.integers(-2, 3, size=(rnd.integers(1, 30), rnd.integers(1, 12))).astype(float)


def test_singular_values_and_directions():
    for a in matrices():
        diagonal, upper, back = whitening.bidiagonal(triangle(a))
        squares = whitening.squared_singular_values(diagonal, upper)
        want = np.linalg.svd(triangle(a), compute_uv=False)
        assert np.abs(np.sqrt(squares) - want).max() <= 1e-13 * want[0] + 1e-15
        k = int((squares[:4] > (len(diagonal) * whitening.EPS) ** 2 * max(squares[0], whitening.TINY)).sum())
        if k:
            z = back(whitening.directions(diagonal, upper, squares, k))
            assert np.abs(z.T @ z - np.eye(k)).max() < 1e-12
            assert np.abs(a.T @ (a @ z) - z * squares[:k]).max() < 1e-12 * squares[0]


def test_small_values_are_accurate():
    """Entries of widely different size: every singular value to nearly all digits, as the scaled inverse has it too."""
    rnd = np.random.default_rng(1)
    diagonal, upper = rnd.uniform(1, 2, 12) * 10.0 ** -np.arange(0, 24, 2), rnd.uniform(1, 2, 11) * 10.0 ** -np.arange(1, 23, 2)
    squares = whitening.squared_singular_values(diagonal, upper)
    # The product of all values is that of the diagonal, whatever their size.
    assert abs(np.log(squares).sum() - 2 * np.log(diagonal).sum()) < 1e-12 * abs(np.log(squares).sum())
    flipped = whitening.squared_singular_values(diagonal[::-1], upper[::-1])
    assert np.abs(flipped / squares - 1).max() < 1e-13


def vectors():
    rnd = np.random.default_rng(2)
    x = (rnd.normal(size=(150, 9)) * np.linspace(1, 3, 9) @ rnd.normal(size=(9, 9))).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(x)]
    rows += [(i, x[i % 3]) for i in range(150, 200)] + [(3, x[3]), (None, x[5]), (None, None), (201, None), (202, [])]
    rows += [(203, [None] * 9), (204, [float("nan"), *x[0][1:]]), (205, [float("-inf"), *x[0][1:]]), (206, x[0][:4]), (207, [-0.0] * 9)]
    return rows


SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def test_against_the_covariance(spark):
    rows = vectors()
    clash = ["x", "d", "value", "n", "vector", "component"]
    schema = T.StructType([*SCHEMA.fields, *(T.StructField(c, T.StringType()) for c in clash)])
    df = spark.createDataFrame([(*r, *clash) for r in rows], schema).repartition(11)
    model = whitening.fit_whitening(whitening.vectors(df))
    place = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted((tuple(r) for r in whitening.whiten(df, model).collect()), key=place)
    good = [(i, v) for i, v in rows if v and len(v) == 9 and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(256 * np.array([v for _, v in good])).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    far = fit - s / n
    values, axes = np.linalg.eigh(far.T @ far / n)
    values, axes = values[::-1], axes[:, ::-1]
    assert model.n == n and model.sums == s.tolist()
    assert np.allclose(model.variances, values[:4], rtol=1e-12) and np.allclose(model.explained, values[:4] / values.sum(), rtol=1e-12)
    sign = np.sign((model.directions * axes[:, :4]).sum(axis=0))
    want = (x - s / n) @ axes[:, :4] * sign / np.sqrt(values[:4])
    deviation = ((n * x - s) ** 2).sum(axis=1)
    expected = sorted(((i, k + 1, n, deviation[at], want[at, k]) for at, (i, _) in enumerate(good) for k in range(4)), key=place)
    assert [r[:4] for r in got] == [r[:4] for r in expected]
    assert np.abs(np.array([r[4] for r in got]) - [r[4] for r in expected]).max() < 1e-10
    assert {r[6] for r in got} == {model.identity_error} and model.identity_error < 1e-12


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    model = whitening.fit_whitening(whitening.vectors(df))
    assert model is None and whitening.whiten(df, model).count() == 0


def test_few_components_and_exact_numbers(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 2.0]), (3, [4.0, 2.0])], SCHEMA)
    rows = whitening.whiten(df, whitening.fit_whitening(whitening.vectors(df))).collect()
    assert [r.component for r in rows] == [1, 1, 1] and rows[0].explained == 1
    big = whitening.Whitening(3, [2**52, 1], np.eye(2), np.ones(2), np.ones(2), 0.0)
    with pytest.raises(OverflowError):
        big.deviations(np.array([[2**52, 0]]))
    low = whitening._packed(np.array([[1, -128], [1, 128], [2**40, 0]]))
    assert [len(b) for b in low] == [3, 5, 17] and whitening._unpacked(low, 2).tolist() == [[1, -128], [1, 128], [2**40, 0]]

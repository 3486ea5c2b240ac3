"""Whitening against numpy's eigenvectors of the whole covariance."""

import math

import duckdb
import numpy as np
import pytest

from fleetlens.llm import queries as llm
from fleetlens.llm import whitening

SF = "/root/testdata/sf0.001"


def whole(vectors):
    return np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors])


def reference(vectors, components=16):
    """(n, deviations, whitened, explained) from the covariance of distinct vectors."""
    x = whole(vectors)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    _, values, basis = np.linalg.svd(fit - sums / n)  # more exact than the covariance's eigenvectors
    values = values**2 / n
    deviations = [sum((int(n) * int(c) - int(s)) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    deviations = [d if d < 1 << 63 else None for d in deviations]
    whitened = (x - sums / n) @ basis[:components].T / np.sqrt(values[:components])
    return n, deviations, whitened, values[:components] / values.sum()


def compared(rows, vectors, components=16, close=1e-9):
    n, deviations, whitened, explained = reference(vectors, components)
    mine = np.zeros_like(whitened)
    for r in rows:
        assert r.n == n and r.deviation == deviations[r.vec_id] and r.identity_error <= 1e-10
        assert math.isclose(r.explained, explained[r.component - 1], rel_tol=1e-9)
        mine[r.vec_id, r.component - 1] = r.whitened
    signs = np.sign((mine * whitened).sum(0))
    assert np.abs(mine - whitened * signs).max() < close


def test_query_equals_numpy(spark):
    vectors = [v for _, v in sorted(duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall())]
    rows = llm.QUERIES["op13_whitening"](spark, SF).collect()
    assert len(rows) == 16 * len(vectors)
    compared(rows, vectors)


SCHEMA = "vec_id long, embedding array<double>, label int, x int, id string, component string"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 1, 2, "i", "c") for i, v in zip(ids, vectors, strict=True)], SCHEMA)


@pytest.mark.parametrize("spread", [[1, 1, 1, 1], [1e4, 1, 1e-1, 300.0], [1, 0, 1, 1]])
def test_scales_copies_and_constant_columns(spark, spread):
    """Columns of very different or no spread; half of the rows are copies of one vector."""
    draw = np.random.default_rng(4)
    vectors = (draw.normal(size=(60, 4)) * spread * 3).tolist()
    vectors += [vectors[0]] * 60
    found = whitening.whiten(table(spark, vectors), components=3).collect()
    assert len(found) == 3 * len(vectors)
    compared(found, vectors, 3, 1e-7)


def test_dependent_columns_and_few_rows_give_their_rank(spark):
    draw = np.random.default_rng(5)
    base = draw.integers(-50, 50, (40, 2)) / 64
    vectors = np.hstack([base, base[:, :1] + base[:, 1:], base[:, :1]]).tolist()
    found = whitening.whiten(table(spark, vectors)).collect()
    assert {r.component for r in found} == {1, 2}
    assert max(r.identity_error for r in found) < 1e-8
    found = whitening.whiten(table(spark, draw.normal(size=(3, 8)).tolist())).collect()
    assert {r.component for r in found} == {1, 2} and len(found) == 6


def test_unusable_rows_go(spark):
    draw = np.random.default_rng(6)
    good = draw.normal(size=(20, 3)).tolist()
    bad = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 1.0, 1.0], [1e300, 0.0, 0.0], [1.0, 2.0]]
    ids = [*range(20), *[None] * 7]
    found = whitening.whiten(table(spark, good + bad, ids)).collect()
    assert {r.vec_id for r in found} == set(range(20))
    compared(found, good, 3)
    alone = whitening.whiten(table(spark, [*good, good[0]], [*range(20), None])).collect()
    assert sum(r.vec_id is None for r in alone) == 3


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_no_spread_no_row(spark, vectors):
    found = whitening.whiten(table(spark, vectors))
    assert found.collect() == []
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviation_beyond_64_bits_is_null():
    whitener = whitening.Whitener(3, np.array([0]), np.zeros((1, 0)), np.zeros(0), np.zeros(0))
    assert whitener.deviation(np.array([[5], [1 << 40]])) == [225, None]

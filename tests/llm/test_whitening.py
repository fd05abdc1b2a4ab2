"""Whitening against a dense eigendecomposition."""

import numpy as np
import pytest

from rankwell.llm import queries, whitening
from tests.conftest import SMALL

SHAPE = "vec_id long, embedding array<float>"


def brute(vectors, k=8):
    """(x, n, eigenvalues, eigenvectors) of the usable vectors, worked out densely."""
    fine = [v for v in vectors if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(1024 * np.array(fine, np.float32).astype(np.float64)).astype(np.int64) + 100_000
    centred = x - x.sum(axis=0) / len(x)
    values, turned = np.linalg.eigh(centred.T @ centred / len(x))
    return x, len(x), values[::-1][:k], turned[:, ::-1][:, :k], values.sum()


def compare(rows, ids, vectors, k=8):
    x, n, values, turned, trace = brute(vectors, k)
    held = values > 1e-12 * trace
    values, turned = values[held], turned[:, held]
    assert len(rows) == n * len(values)
    assert {r.n for r in rows} == {n}
    deviations = dict(zip(ids, ((n * x - x.sum(axis=0)) ** 2).sum(axis=1).tolist()))
    assert all(r.deviation == deviations[r.vec_id] for r in rows)
    want = (x - x.sum(axis=0) / n) @ turned / np.sqrt(values)
    for c in range(len(values)):
        mine = {r.vec_id: r for r in rows if r.component == c + 1}
        got = np.array([mine[i].whitened for i in ids])
        sign = np.sign(got @ want[:, c])
        assert np.allclose(got * sign, want[:, c], atol=1e-7)
        assert all(abs(r.explained - values[c] / trace) < 1e-10 for r in mine.values())
    assert max(r.identity_error for r in rows) < 1e-9


def test_query(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    got = queries.QUERIES["op13_whitening"](spark, SMALL).collect()
    compare(got, [r.vec_id for r in rows], [r.embedding for r in rows])


def test_unusable_repeated_and_clashing_rows(spark):
    rng = np.random.default_rng(1)
    vectors = [[float(c) for c in rng.standard_normal(5) * (5, 4, 3, 2, 1)] for _ in range(40)]
    rows = [(i, v, "a") for i, v in enumerate(vectors)]
    bad = [(90, None, "b"), (91, [1.0, None, 0.0, 0.0, 0.0], "b"), (92, [float("nan")] * 5, "b"), (93, [float("inf")] * 5, "b")]
    df = spark.createDataFrame(rows + bad + [rows[0]], f"{SHAPE}, x string")
    got = whitening.components(df).collect()
    assert len(got) == 41 * 5 and {r.vec_id for r in got} == set(range(40))
    x, n, values, _, trace = brute(vectors + [vectors[0]])
    shares = sorted({r.explained for r in got}, reverse=True)
    assert n == 41 and np.allclose(shares, values / trace)


def test_low_rank_and_equal_eigenvalues(spark):
    """Two equal eigenvalues and dimensions without a variance."""
    corners = [[a / 4, b / 4, 0.5, 0.25] for a in (-1, 1) for b in (-1, 1)]
    df = spark.createDataFrame(list(enumerate(corners)), SHAPE)
    got = whitening.components(df).collect()
    assert len(got) == 8 and {r.component for r in got} == {1, 2}
    assert all(abs(r.explained - 0.5) < 1e-12 for r in got) and got[0].identity_error < 1e-12
    one = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], SHAPE)
    assert whitening.components(one).count() == 0


def test_empty_and_uneven(spark):
    assert whitening.components(spark.createDataFrame([], SHAPE)).count() == 0
    assert whitening.components(spark.createDataFrame([(1, None)], SHAPE)).count() == 0
    with pytest.raises(ValueError):
        whitening.components(spark.createDataFrame([(1, [0.5]), (2, [0.5, 1.0])], SHAPE))


def test_stops_once_settled(spark):
    """A steep spectrum needs fewer steps than dimensions."""
    rng = np.random.default_rng(2)
    scale = 0.5 ** np.arange(60)
    vectors = [[float(c) for c in rng.standard_normal(60) * scale * 40] for _ in range(300)]
    rows = whitening.usable(spark.createDataFrame(list(enumerate(vectors)), SHAPE))
    model = whitening.fit(rows, k=2)
    _, _, values, _, _ = brute(vectors, 2)
    assert model.steps < 30 and np.allclose(model.values, values, rtol=1e-12)

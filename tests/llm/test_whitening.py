"""Rank-one updates against a plain eigendecomposition, whitened rows against plain arithmetic."""

import math

import numpy as np
import pytest

from ledgerloom.llm import whitening
from ledgerloom.llm.registered import QUERIES


@pytest.mark.parametrize("dims, rows", [(1, 5), (3, 2), (8, 40), (16, 300)])
def test_updates_give_the_plain_spectrum(dims, rows):
    rng = np.random.default_rng(dims)
    x = np.floor(64 * rng.normal(size=(rows, dims)) * np.linspace(0.05, 1, dims))
    x[: rows // 3] = x[0]
    spectrum, other = whitening.Spectrum(dims), whitening.Spectrum(dims)
    for row in x[: rows // 2]:
        spectrum.join(1, row, np.zeros((0, dims)))
    other.add_rows(x[rows // 2 :])
    spectrum.add(other)
    centred = x - x.mean(axis=0)
    scatter = centred.T @ centred
    assert spectrum.n == rows and np.allclose(spectrum.mean, x.mean(axis=0))
    top = max(1.0, np.abs(scatter).max())
    assert np.allclose(spectrum.vectors * spectrum.values @ spectrum.vectors.T, scatter, atol=1e-9 * top)
    assert np.allclose(spectrum.vectors.T @ spectrum.vectors, np.eye(dims), atol=1e-10)


def test_secular_roots_lie_between_the_poles():
    rng = np.random.default_rng(1)
    poles = np.sort(np.append(rng.normal(size=20), [3.0, 3.0 + 1e-9]))
    z2 = rng.random(22) ** 4
    origin, step = whitening.secular_roots(poles, z2)
    expected = np.linalg.eigvalsh(np.diag(poles) + np.sqrt(np.outer(z2, z2)))
    assert np.allclose(poles[origin] + step, expected, atol=1e-12)


def plain(vectors):
    good = [(key, v) for key, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v in good], dtype=np.int64)
    n, total = len(x), x.sum(axis=0)
    centred = (n * x - total) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return [k for k, _ in good], n, ((n * x - total) ** 2).sum(axis=1), centred, values[::-1], axes[:, ::-1]


def test_whitened_rows(spark, tmp_path):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(600, 40)) * np.linspace(0.1, 2, 40)
    vectors = [(at, [float(c) for c in row]) for at, row in enumerate(data)]
    vectors += [(601, None), (602, [1.0] * 39 + [None]), (603, [float("nan")] * 40), (604, [float("-inf")] * 40)]
    vectors += [(None, vectors[0][1]), (5, vectors[5][1])]
    frame = spark.createDataFrame(
        [(k, v, 1, "clash", 7) for k, v in vectors + [(700, [0.5] * 3), (701, [])]],
        "vec_id BIGINT, embedding ARRAY<FLOAT>, n INT, x STRING, component INT",
    )
    frame.repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = QUERIES["op12_whitening"](spark, str(tmp_path))
    assert found.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    ]
    keys, n, deviation, centred, values, axes = plain(vectors)
    rows = found.collect()
    assert len(rows) == n * 32 and {r.n for r in rows} == {n}
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    by = {(r.vec_id, r.component): r for r in rows}
    for component in range(32):
        plainly = centred @ axes[:, component] / math.sqrt(values[component])
        ours = np.array([by[key, component + 1].whitened for key in keys])
        assert np.allclose(ours * np.sign(ours @ plainly), plainly, atol=1e-8)
        assert abs(by[1, component + 1].explained - values[component] / values.sum()) < 1e-12
    assert all(by[key, 1].deviation == d for key, d in zip(keys, deviation.tolist()))


def test_empty_and_equal_vectors(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        frame = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>")
        assert whitening.whitened(frame).collect() == []
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0])], "vec_id BIGINT, embedding ARRAY<FLOAT>")
    assert sorted(abs(r.whitened) for r in whitening.whitened(frame).collect()) == [1.0, 1.0]

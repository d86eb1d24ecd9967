"""Jacobi-Davidson and whitening against plain linear algebra."""

import numpy as np
import pyarrow as pa
import pytest

from tablepact.llm.whitening import jacobi_davidson, minres, op12_whitening, vectors, whiten

TABLE = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """What each remaining row should have, from exact sums and a dense eigensolver."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in kept], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    centred = ((n * x - sums) / n).astype(float)
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    e, axes = e[::-1], axes[:, ::-1]
    real = e > 1e-9 * e[0]
    return [i for i, _ in kept], n, ((n * x - sums) ** 2).sum(axis=1), e[real][:32], axes[:, real][:, :32], centred


def matches(got, rows):
    ids, n, deviation, e, axes, centred = plain(rows)
    k = len(e)
    assert len(got) == len(ids) * k
    found = sorted(got, key=lambda r: (r.vec_id is None, r.vec_id or 0, r.component))
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    assert [r.vec_id for r in found] == [ids[i] for i in order for _ in range(k)]
    assert [r.component for r in found] == list(range(1, k + 1)) * len(ids)
    assert {r.n for r in found} == {n}
    assert [r.deviation for r in found[::k]] == [int(deviation[i]) for i in order]
    white = np.array([r.whitened for r in found]).reshape(len(ids), k)
    expected = (centred @ axes / np.sqrt(e))[order]
    expected = expected * np.sign((expected * white).sum(axis=0))
    assert np.allclose(white, expected, rtol=0, atol=1e-7 * np.abs(expected).max())
    share = e / (centred**2).sum() * n
    assert np.allclose([r.explained for r in found[:k]], share, rtol=1e-10)
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9


def test_table(spark, tiny):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=40).tolist()) for i in range(300)]
    rows[:6] = [(0, None), (1, [None] * 40), (2, [float("nan")] * 40), (None, rows[3][1]), (4, [float("inf")] + [0.0] * 39), (5, [0.0] * 40)]
    frame = spark.createDataFrame([(i, v, None) for i, v in rows], TABLE).repartition(5)
    asserted = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    matches(op12_whitening(spark, tiny(frame, embeddings=frame)).collect(), asserted)


def test_fewer_components_than_wanted(spark):
    for rows in (
        [(1, [0.5, 1.0, 3.0]), (2, [1.0, -1.0, 0.25]), (3, [0.0, 4.0, 1.0]), (4, [9.0, 4.0, 1.0])],
        [(1, [0.5, 1.0, 3.0]), (2, [1.0, -1.0, 0.25])],
        [(1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [5.0, -3.0])],
    ):
        frame = spark.createDataFrame([(i, v, 0) for i, v in rows], TABLE)
        matches(whiten(frame).collect(), rows)


def test_empty_and_alike(spark):
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None, 0)], [(1, [], 0)], [(1, [2.0, 3.0], 0)], [(1, [2.0, 3.0], 0), (2, [2.0, 3.0], 0)]):
        frame = whiten(spark.createDataFrame(rows, TABLE))
        assert frame.columns == names and frame.collect() == []


def test_lengths_and_sizes_that_cannot_be(spark):
    with pytest.raises(Exception, match="vectors of 1 and of 2 entries"):
        whiten(spark.createDataFrame([(1, [1.0], 0), (2, [1.0, 2.0], 0)], TABLE))
    with pytest.raises(Exception, match="too large"):
        whiten(spark.createDataFrame([(1, [1e30], 0)], TABLE))


def test_clashing_columns(spark):
    rows = [(1, [0.5, 1.0]), (2, [1.0, -1.0]), (3, [0.0, 4.0])]
    frame = spark.createDataFrame([(i, v, 7.0, "x") for i, v in rows], "vec_id long, embedding array<double>, whitened double, N string")
    matches(whiten(frame).collect(), rows)


def test_long_vectors_in_pieces(spark, monkeypatch):
    import tablepact.llm.whitening as module

    monkeypatch.setattr(module, "PIECE", 1000)
    batch = pa.RecordBatch.from_pydict({"v": [[float(i)] * 400 for i in range(10)] + [None]})
    assert [len(x) for _, x in vectors(batch, "v")] == [2] * 5


def test_eigenpairs_of_many_shapes():
    rng = np.random.default_rng(2)
    for size, n, block in ((64, 500, 16), (64, 500, 3), (200, 4000, 16), (10, 3, 16), (33, 200, 1), (1, 9, 4)):
        x = rng.normal(size=(n, size))
        a = x.T @ x / n
        values, axes = jacobi_davidson(lambda b: a @ b, size, 32, np.trace(a), block)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:32], rtol=0, atol=1e-13 * values[0])
        assert np.abs(a @ axes - axes * values).max() < 1e-13 * values[0] * max(size, 16)
        assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-12


def test_repeated_eigenvalues_are_all_found():
    a = np.diag([5.0] * 6 + [3.0] * 30 + [1.0] * 10)
    values, axes = jacobi_davidson(lambda b: a @ b, 46, 32, np.trace(a), block=4)
    assert np.allclose(values, [5.0] * 6 + [3.0] * 26)
    assert np.abs(a @ axes - axes * values).max() < 1e-12


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(20, 20))
    a = a + a.T
    right = rng.normal(size=(20, 3))
    assert np.allclose(a @ minres(lambda b: a @ b, right, 25), right, atol=1e-6)

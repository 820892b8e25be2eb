import numpy as np
import pytest
from pyspark.sql import functions as F

from contractlake.llm.whitening import eigen, fit_whitening, jacobi_columns, pivoted_cholesky, whiten, whitened_rows

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(spark, values, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 1) for i, v in enumerate(values)], schema)


def plain(values, components=32):
    """Everything by plain numpy on the rows that can be used."""
    x = np.floor(64 * np.array(values, np.float64)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    z = x - total / n
    covariance = z.T @ z / n
    e, v = np.linalg.eigh(covariance)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    return n, ((n * x - total) ** 2).sum(axis=1), e, v, z @ v / np.sqrt(e), np.trace(covariance)


@pytest.mark.parametrize("n, d", [(500, 7), (2000, 40)])
def test_equals_plain_eigenvectors(spark, n, d):
    rng = np.random.default_rng(n)
    values = np.float32(rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + rng.normal(size=d)).astype(float)
    count, deviation, e, v, w, trace = plain(values)
    rows = whitened_rows(vectors(spark, values.tolist())).select("row.vec_id", "*").collect()
    assert len(rows) == n * min(d, 32)
    assert {r.component for r in rows} == set(range(1, min(d, 32) + 1)) and {r.n for r in rows} == {count}
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    got = np.zeros_like(w)
    for r in rows:
        got[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == deviation[r.vec_id]
        assert r.explained == pytest.approx(e[r.component - 1] / trace, rel=1e-9)
    signs = np.sign((got * w).sum(axis=0))
    assert np.abs(got - w * signs).max() < 1e-6


def test_factors():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(30, 12))
    matrix = a @ a.T  # rank 12 of 30
    factor, order = pivoted_cholesky(matrix)
    assert factor.shape == (30, 12) and np.allclose(factor @ factor.T, matrix[np.ix_(order, order)])
    assert np.allclose(np.triu(factor, 1), 0)
    turned = jacobi_columns(factor)
    gram = turned.T @ turned
    assert np.abs(gram - np.diag(gram.diagonal())).max() < 1e-10 * gram.max()
    values, directions = eigen(matrix)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:12], rtol=1e-12)
    assert np.allclose(directions.T @ directions, np.eye(12), atol=1e-12)
    assert np.allclose(directions * values @ directions.T, matrix)


def test_close_and_far_eigenvalues():
    rng = np.random.default_rng(4)
    q, _ = np.linalg.qr(rng.normal(size=(20, 20)))
    want = np.array([1e8, 1e8 - 1e-3, *np.geomspace(1e6, 1, 18)])
    values, directions = eigen(q * want @ q.T)
    assert np.allclose(values, want, rtol=1e-7)
    assert np.abs(directions.T @ directions - np.eye(20)).max() < 1e-12


def test_unusable_vectors_are_left_out_and_equal_ones_count(spark):
    rng = np.random.default_rng(1)
    good = rng.normal(size=(60, 3)).tolist()
    odd = [None, [], [1.0, None, 2.0], [float("nan"), 1.0, 1.0], [float("inf"), 0.0, 0.0], [1.0, 2.0], [1e38, 0.0, 0.0]]
    frame = vectors(spark, good + good[:20] + odd)
    # Extra columns with the names the operator makes.
    for name in ("row", "vector", "deviation", "whitened", "component", "n", "_at"):
        frame = frame.withColumn(name, F.lit("x"))
    rows = whitened_rows(frame).select(F.col("row.vec_id").alias("vec_id"), "component", "whitened", "n").collect()
    assert {r.vec_id for r in rows} == set(range(80)) and {r.n for r in rows} == {80}
    by = {(r.vec_id, r.component): r.whitened for r in rows}
    assert all(by[i, c] == by[60 + i, c] for i in range(20) for c in (1, 2, 3))


def test_null_keys_and_repeated_rows_stay(spark):
    rng = np.random.default_rng(1)
    rows = [(None if i % 3 else i // 3, v, None) for i, v in enumerate(rng.normal(size=(30, 2)).tolist())]
    found = whitened_rows(spark.createDataFrame(rows * 2, SCHEMA))
    assert found.count() == 120 and found.where("row.vec_id IS NULL").count() == 80


@pytest.mark.parametrize("values", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 50, [None, [None]], [[], []]])
def test_without_any_difference_there_is_no_component(spark, values):
    found = whitened_rows(vectors(spark, values))
    assert found.count() == 0
    assert found.columns == ["row", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_fewer_directions_than_components(spark):
    rng = np.random.default_rng(9)
    flat = rng.normal(size=(100, 2)).round(1) @ np.array([[1.0, 2.0, 4.0], [8.0, -4.0, 0.0]])
    rows = whitened_rows(vectors(spark, flat.tolist())).collect()
    assert len(rows) <= 300 and rows[0].identity_error < 1e-4


def test_deviations_beyond_a_long(spark):
    values = [[1e6 * i, -3e5 * i * i] for i in range(400)]
    frame = vectors(spark, values, "vec_id long, embedding array<double>, label int")
    found = whiten(frame, fit_whitening(frame))
    assert dict(found.dtypes)["deviation"] == "decimal(38,0)"
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in values]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((400 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(x)}
    assert {r.vec_id: int(r.deviation) for r in found.select("row.vec_id", "deviation").collect()} == want

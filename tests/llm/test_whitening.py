"""Whitening against a dense eigensolver and exact integers."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import types as T

from speechtable.llm import whitening

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("x", T.StringType()), T.StructField("n", T.IntegerType())])


def given(vectors):
    return [(i, [float(np.float32(x)) for x in v], "x", 0) for i, v in enumerate(vectors)]


def checked(spark, rows, k=8):
    """Compare with a dense solver on the rows that count; the rows found."""
    kept = [(i, [int(np.floor(1024 * float(x))) + 100000 for x in v]) for i, v, *_ in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA), k).collect()
    n, d = len(kept), len(kept[0][1])
    k = min(k, d)
    x = np.array([v for _, v in kept], object)
    total = x.sum(0)
    exact = x * n - total
    centred = exact.astype(np.float64) / n
    cov = centred.T @ centred / n
    want, basis = np.linalg.eigh(cov)
    want, basis = want[::-1][:k], basis[:, ::-1][:, :k]
    assert len(found) == n * k and {r["n"] for r in found} == {n}
    by_id: dict = {}
    for r in found:
        by_id.setdefault(r["id"], []).append(r)
    deviation = {i: int(s) for (i, _), s in zip(kept, (exact * exact).sum(1))}
    assert all(r["deviation"] == deviation[r["id"]] for r in found)
    explained = np.array([r["explained"] for r in sorted(by_id[kept[0][0]], key=lambda r: r["component"])])
    assert np.allclose(explained, want / np.trace(cov), rtol=1e-9, atol=1e-12)
    white = np.array([[r["whitened"] for r in sorted(by_id[i], key=lambda r: r["component"])] for i, _ in kept], float)
    assert np.abs(white.T @ white / n - np.eye(k)).max() < 1e-9
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9
    dense = centred @ basis / np.sqrt(want)
    signs = np.sign((white * dense).sum(0))
    gaps = np.abs(np.diff(np.linalg.eigvalsh(cov)[::-1]))[: k].min() / want[0] if d > k else 1e-3
    assert np.abs(white * signs - dense).max() < 1e-10 / gaps + 1e-8
    return found


def test_equals_a_dense_solver(spark):
    rng = np.random.default_rng(1)
    checked(spark, given(rng.standard_normal((700, 24)) @ np.diag(1 / np.arange(1, 25)) + 40))


def test_flat_spectrum_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "PARTS", 3)
    monkeypatch.setattr(whitening, "BLOCK", 16)
    rng = np.random.default_rng(2)
    rows = given(rng.standard_normal((400, 40)))
    df = spark.createDataFrame(rows, SCHEMA).repartition(9)
    a = whitening.fit(whitening.rows_of(df, "vec_id", "embedding", 1024), 40, 8, 1024)
    x = np.floor(1024 * np.array([r[1] for r in rows]))
    want = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1][:8]
    assert np.allclose(a.values, want, rtol=1e-12) and a.residual < 1e-12 * want[0] and a.identity_error < 1e-10


def test_fewer_dimensions_than_components_and_a_hot_vector(spark):
    rng = np.random.default_rng(3)
    rows = given(list(rng.standard_normal((60, 3))) + [[1.0, 2.0, 3.0]] * 200)
    checked(spark, rows)


def test_rows_without_a_part(spark):
    rng = np.random.default_rng(4)
    rows = given(rng.standard_normal((50, 4)))
    rows += [(90, None, "x", 0), (91, [1.0, None, 1.0, 1.0], "x", 0), (92, [float("nan")] * 4, "x", 0), (93, [1.0, float("-inf"), 0.0, 0.0], "x", 0), (94, [], "x", 0)]
    checked(spark, rows)
    ragged = spark.createDataFrame(rows + [(95, [1.0, 2.0], "x", 0), (96, [3e38, 0.0, 0.0, 0.0], "x", 0), (None, [1.0, 0.0, 0.0, 2.0], None, None)], SCHEMA)
    got = whitening.whiten(ragged).collect()
    assert {r["id"] for r in got} == {*range(50), None} and len(got) == 51 * 4 and got[0]["n"] == 51


def test_without_variance(spark):
    same = whitening.whiten(spark.createDataFrame(given([[1.0, 2.0]] * 5), SCHEMA)).collect()
    assert len(same) == 10 and all((r["deviation"], r["whitened"], r["explained"], r["identity_error"]) == (0, None, None, None) for r in same)
    line = whitening.whiten(spark.createDataFrame(given([[float(i), 2.0 * i, 1.0] for i in range(9)]), SCHEMA)).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in line) and line[0]["identity_error"] < 1e-10
    assert abs(line[0]["explained"] - 1) < 1e-12
    assert len(whitening.whiten(spark.createDataFrame(given([[5.0]]), SCHEMA)).collect()) == 1
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, None, None)], SCHEMA)).collect() == []


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [float(i) * 1e9, 1.0], "x", 0) for i in range(4)]
    assert {r["deviation"] for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()} == {None}


@pytest.mark.parametrize("d", [1, 2, 9, 30, 64, 150])
def test_solver(d):
    rng = np.random.default_rng(d)
    for a in (rng.standard_normal((d, 2 * d)), np.eye(d), np.zeros((d, d)), np.diag(np.repeat([3.0, 1.0], [d // 2, d - d // 2]))):
        a = a @ a.T
        values, vectors, residual = whitening.leading(lambda u: a @ u, d, min(8, d))
        want = np.linalg.eigvalsh(a)[::-1][: len(values)]
        assert np.allclose(values, want, atol=1e-11 * max(want[0], 1)) and residual <= 1e-12 * max(want[0], 1)
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)

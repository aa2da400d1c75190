import numpy as np
import pytest
from pyspark.sql import types as T

from speechtable.llm import embed

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("n", T.StringType())])


def brute(rows, cosine=0.98):
    """n_links and smallest reachable id, by all pairs."""
    n = len(rows)
    unit = []
    for _, v, label, _ in rows:
        ok = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.array(v, np.float64) if ok else None
        unit.append((label, len(v), x / np.linalg.norm(x)) if ok else None)
    linked = [[j for j in range(n) if i != j and unit[i] and unit[j] and unit[i][:2] == unit[j][:2]
               and float(unit[i][2] @ unit[j][2]) >= cosine] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.append((rows[i][0], len(linked[i]), min(rows[k][0] for k in seen)))
    return sorted(out)


def family(rng, dims, size, spread):
    base = rng.standard_normal(dims)
    return [base + spread * rng.standard_normal(dims) for _ in range(size)]


def test_components_and_counts_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    vectors = []
    for size, spread in ((70, 0.05), (2, 0.1), (5, 0.12), (3, 0.01)):
        vectors += family(rng, 16, size, spread)
    vectors += list(rng.standard_normal((120, 16)))
    rows = [(int(i), [float(np.float32(x)) for x in v], int(i % 2), "x") for i, v in enumerate(vectors)]
    rows += [(1000 + i, rows[0][1], 0, None) for i in range(40)]  # a common vector
    got = embed.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["id"], r["n_links"], r["component_id"]) for r in got) == brute(rows)
    assert all(r["kept"] == (r["id"] == r["component_id"]) for r in got)


def test_family_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(embed, "BLOCK", 16)
    rows = [(i, [float(np.float32(x)) for x in v], 1, None) for i, v in enumerate(family(np.random.default_rng(1), 8, 90, 0.03))]
    got = embed.near_vectors(spark.createDataFrame(rows, SCHEMA), window=4).collect()
    assert sorted((r["id"], r["n_links"], r["component_id"]) for r in got) == brute(rows)


def test_unusable_rows_stay_alone(spark):
    v = [1.0, 2.0]
    rows = [(1, v, 1, None), (2, v, 1, None), (3, v, None, None), (4, v, None, None), (5, None, 1, None), (6, None, 1, None),
            (7, [0.0, 0.0], 1, None), (8, [0.0, 0.0], 1, None), (9, [float("nan"), 1.0], 1, None), (10, [float("nan"), 1.0], 1, None),
            (11, [1.0, None], 1, None), (12, [float("inf"), 1.0], 1, None), (13, [], 1, None), (14, [1.0, 2.0, 0.0], 1, None),
            (15, [2.0, 4.0], 1, None), (16, [2.0, 4.0], 2, None), (None, [2.0, 4.0], 3, None)]
    got = {r["id"]: (r["n_links"], r["component_id"]) for r in embed.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    assert got[1] == got[2] == got[15] == (2, 1)
    assert all(got[i] == (0, i) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 16))


@pytest.mark.parametrize("n", [0, 1])
def test_empty_and_single(spark, n):
    got = embed.near_vectors(spark.createDataFrame([(1, [1.0], 1, None)][:n], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(1, 0, 1, True)][:n]

"""Hard negatives against scoring every pair."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechtable.llm import hardneg

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("bucket", T.StringType()), T.StructField("row", T.IntegerType())])


def brute(rows, every, k=5, m=5, scale=256):
    """All pairs in exact integers."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v], lab) for i, v, lab, *_ in rows
            if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept = [r for r in kept if sum(x * x for x in r[1]) <= 1 << 62]
    out = []
    for a, (i, v, lab) in enumerate(kept):
        if i % every:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, l == lab) for b, (j, w, l) in enumerate(kept) if b != a and len(w) == len(v)]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for score, j, _ in [s for s in scored if s[2]][:k]:
            fit = [s for s in scored if not s[2] and 80 * score <= 100 * s[0] <= 100 * score][:m]
            out += [(i, j, rank + 1, n, score, s) for rank, (s, n, _) in enumerate(fit)]
    return sorted(out)


def found(spark, rows, every):
    df = spark.createDataFrame(rows, SCHEMA)
    made = hardneg.hard_negatives(df, F.col("vec_id") % every == 0)
    assert made.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in made.collect())


def vectors(seed, n, dims, labels, spread=1.0, lengths=(1.0, 1.0)):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal(dims)
    out = []
    for i in range(n):
        v = (centre + spread * rng.standard_normal(dims)) * rng.uniform(*lengths)
        hot = 0 if rng.random() < 0.4 else int(rng.integers(labels))
        out.append((i, [float(np.float32(x)) for x in v], hot, "b", 0))
    return out


@pytest.mark.parametrize("spread,lengths", [(0.4, (1, 1)), (0.1, (0.01, 3)), (2.0, (0.5, 1.5))])
def test_equals_all_pairs(spark, monkeypatch, spread, lengths):
    monkeypatch.setattr(hardneg, "GROUP_ANCHORS", 7)
    rows = vectors(int(spread * 10), 500, 12, 5, spread, lengths)
    got = found(spark, rows, 20)
    assert got == brute(rows, 20) and got


def test_many_buckets_of_one_label(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "GROUP_BYTES", 20_000)
    rows = vectors(9, 2500, 4, 2, 0.3)
    assert found(spark, rows, 250) == brute(rows, 250)


def test_ties_repeats_zero_and_unlike_rows(spark):
    one, two = [1.0, 0.5, 0.0], [0.9, 0.5, 0.1]
    rows = [(i, one, i % 3, None, None) for i in range(40)]  # a common vector: every score is a tie
    rows += [(10, one, 1, None, None), (10, one, 1, None, None), (30, two, 0, None, None)]  # repeated ids, equal and not
    rows += [(100 + i, [0.0, 0.0, 0.0], i % 2, None, None) for i in range(6)]
    rows += [(200, [-1.0, 0.0, 0.0], 0, None, None), (201, [1.0, 0.0, 0.0], 0, None, None), (210, [], 1, None, None), (211, [], 1, None, None), (212, [], 2, None, None)]
    rows += [(220, [1.0, 0.5], 1, None, None), (221, [1.0, 0.6], 1, None, None), (222, [1.0, 0.5], 0, None, None)]
    rows += [(300, None, 1, None, None), (310, one, None, None, None), (320, [1.0, None, 0.0], 1, None, None), (330, [float("nan"), 1.0, 1.0], 1, None, None),
             (340, [float("inf"), 1.0, 1.0], 1, None, None), (350, [3e38, 1.0, 1.0], 1, None, None), (None, one, 1, None, None)]
    got = found(spark, rows, 10)
    assert got == brute(rows, 10) and {r[0] for r in got} >= {0, 10, 30, 100, 210, 220}


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(3_000_000, 4_000_000, 6)
    rows = [(i, [float(np.float32(x + int(d))) for x, d in zip(base, rng.integers(-3, 4, 6))], i % 2, None, None) for i in range(60)]
    assert found(spark, rows, 10) == brute(rows, 10)


@pytest.mark.parametrize("rows", [[], [(0, [1.0], 1, None, None)], [(0, [1.0], 1, None, None), (1, [1.0], 1, None, None)], [(0, None, None, None, None)]])
def test_nothing_to_find(spark, rows):
    assert found(spark, rows, 1) == []

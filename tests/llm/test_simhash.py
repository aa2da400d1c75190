import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from speechtable.llm import simhash


def brute_print(text):
    words = []
    for word in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ") \
            .replace("\n", " ").replace("\r", " ").split(" "):
        if word:
            words.append(word)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_prints_and_groups_equal_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    ids = sorted(texts)
    prints = [brute_print(texts[i]) for i in ids]
    want = {ids[k]: (prints[k], ids[c]) for k, c in enumerate(brute_components(prints))}
    got = {r["id"]: (r["fp"] % (1 << 64), r["component"]) for r in simhash.near_groups(docs).collect()}
    assert got == want


def test_dense_families(spark):
    """Chains and families of fingerprints."""
    rng = np.random.default_rng(5)
    prints = [int(x) for x in rng.integers(0, 1 << 63, 60)]
    for base in prints[:6]:
        prints += [base ^ int(sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 4), replace=False))) for _ in range(40)]
    rng.shuffle(prints)
    docs = spark.createDataFrame([(i, np.uint64(p).astype(np.int64).item()) for i, p in enumerate(prints)], "doc_id long, fp long")
    original, simhash.fingerprints = simhash.fingerprints, lambda d, *_: d.select(F.col("doc_id").alias("id"), "fp")
    try:
        got = {r["id"]: r["component"] for r in simhash.near_groups(docs).collect()}
    finally:
        simhash.fingerprints = original
    assert [got[i] for i in range(len(prints))] == brute_components(prints)


def test_tree_search_equals_scan():
    rng = np.random.default_rng(2)
    leaves = rng.integers(0, 1 << 20, 500).astype(np.uint64)
    leaves = leaves[np.argsort(simhash.gray_ranks(leaves))]
    asks = rng.integers(0, 1 << 20, 50).astype(np.uint64)
    tree = simhash.GrayTree(leaves, np.full(500, ~np.uint64(0)))
    got = {*zip(*map(list, tree.search(asks, 4)))}
    assert got == {(i, j) for i, q in enumerate(asks) for j, v in enumerate(leaves) if int(q ^ v).bit_count() <= 4}


def test_arrangements_meet_within_two_bits():
    rng = np.random.default_rng(9)
    for _ in range(300):
        a = int(rng.integers(0, 1 << 63)) << 1
        b = a ^ sum(1 << int(k) for k in rng.choice(64, 2, replace=False))
        turned = list(zip(simhash.arrangements(np.array([a], np.uint64)), simhash.arrangements(np.array([b], np.uint64))))
        assert all(int(x[0] ^ y[0]).bit_count() == 2 for (x, _), (y, _) in turned)
        assert any(int(x[0]) >> (64 - n) == int(y[0]) >> (64 - n) for (x, n), (y, _) in turned)


def test_nulls_empty_ties_and_extra_columns(spark):
    rows = [(1, None, 5), (2, "", 5), (3, " \t\n", 5), (4, "One two", 5), (5, "one  TWO", 5), (6, "a b c d" * 5000, 5), (6, "a b c d" * 5000, 5), (None, "z y x", 5)]
    got = simhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string, fp int")).collect()
    by = {r["id"]: r["component"] for r in got}
    assert len(got) == len(rows) and by == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, None: None}
    assert {r["fp"] for r in got if r["id"] in (1, 2, 3)} == {0}


@pytest.mark.parametrize("n", [0, 1])
def test_small_tables(spark, n):
    docs = spark.createDataFrame([(7, "a b c")][:n], "doc_id long, text string")
    assert [r["component"] for r in simhash.near_groups(docs).collect()] == [7][:n]

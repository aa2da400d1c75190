import numpy as np

import corpus_pipeline
from speechtable.llm import jaccard, simhash
from tests.llm.brute import WORD


def shingles(text, words=5):
    found = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)} or {tuple(found)}


def brute_kept(texts, similarity=0.8):
    """The smallest id of every component, by all pairs."""
    ids = sorted(texts)
    sets, root = [shingles(texts[i]) for i in ids], list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if min(len(sets[i]), len(sets[j])) >= similarity * max(len(sets[i]), len(sets[j])):
                shared = len(sets[i] & sets[j])
                if shared / (len(sets[i]) + len(sets[j]) - shared) >= similarity:
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    return sorted({ids[find(k)] for k in range(len(ids))})


def planted(rng, bases, copies):
    """Texts and copies of copies with words changed, put in and left out."""
    out = []
    for _ in range(bases):
        family = [[f"w{x}" for x in rng.integers(0, 5000, rng.integers(30, 400))]]
        for _ in range(copies):
            words = list(family[rng.integers(len(family))])
            for _ in range(rng.integers(1, max(2, len(words) // 40))):
                at = int(rng.integers(len(words)))
                words[at : at + int(rng.integers(0, 2))] = [f"x{rng.integers(10**6)}"] * int(rng.integers(0, 2))
            family.append(words)
        out += [" ".join(words) for words in family]
    return {int(i): out[k] for i, k in enumerate(rng.permutation(len(out)))}


def test_planted_edits_equal_all_pairs(spark):
    texts = planted(np.random.default_rng(4), 60, 8)
    texts |= {1000: "one two three", 1001: "One  two\nthree", 1002: "one two four", 1003: "", 1004: None, 1005: " \t"}
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    got = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    want = brute_kept(texts)
    assert got == want and len(want) < len(texts) / 3


def test_tables_equal_all_pairs(spark, sf):
    for folder in (sf, "/root/testdata/sf0.01"):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        got = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, folder).collect())
        assert got == brute_kept({r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()})


def test_prints_are_simhashes_of_samples():
    rng = np.random.default_rng(6)
    for n in (1, 3, 400, 2500):
        shingles = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        drawn = jaccard.samples(shingles)
        assert drawn.shape == (jaccard.PRINTS, jaccard.SAMPLE) and np.isin(drawn, shingles).all()
        got = jaccard.sample_prints(shingles) ^ jaccard._REGIONS
        for row, value in zip(drawn.tolist(), got.tolist()):
            assert value == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in row) > len(row))


def test_near_prints_equal_all_pairs():
    rng = np.random.default_rng(12)
    prints = [int(x) for x in rng.integers(0, 1 << 63, 200)]
    for base in prints[:40]:
        prints += [base ^ int(sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 4), replace=False))) for _ in range(12)]
    ranks = np.unique(simhash.gray_ranks(np.array(prints, np.uint64)))
    codes = [int(r) ^ int(r) >> 1 for r in ranks]
    root, moved = list(range(len(codes))), True
    near = [(i, j) for i in range(len(codes)) for j in range(i)
            if codes[i] >> 64 - jaccard.FRONT == codes[j] >> 64 - jaccard.FRONT and (codes[i] ^ codes[j]).bit_count() <= jaccard.RADIUS]
    while moved:
        moved = False
        for i, j in near:
            if root[i] != root[j]:
                root[i] = root[j] = min(root[i], root[j])
                moved = True
    got = jaccard.near_prints(ranks)
    assert near and len({*zip(got.tolist(), root)}) == len({*root}) == len({*got.tolist()})
    assert len(jaccard.near_prints(ranks[:0])) == 0


def test_sets_of_near_prints_are_candidates(spark):
    """Two sets without an equal fingerprint meet where two differ in two bits."""
    prints = np.random.default_rng(3).integers(0, 1 << 63, (3, jaccard.PRINTS), dtype=np.uint64)
    prints[1, 7] = prints[0, 7] ^ np.uint64(0b101)
    rows = [(i, bytearray(simhash.gray_ranks(p).tobytes())) for i, p in enumerate(prints)]
    found = jaccard._groups(spark.createDataFrame(rows, "cls long, prints binary"), 3).collect()
    assert sorted(r["cls"] for r in found) == [0, 1] and len({r["bucket"] for r in found}) == 1


class Sets:
    def __init__(self, sets):
        self.sets = sets

    def find_all(self, keys):
        found = [self.sets[int(k)] for k in keys]
        return np.repeat(np.arange(len(keys)), [len(s) for s in found]), {"shingle": np.concatenate(found)}


def test_search_in_pieces_finds_whole_chains(monkeypatch):
    # Set k reaches 0.8 with set k + 1 only; a second chain shares nothing with the first.
    sets = {k: np.arange(k * 2, k * 2 + 20) + (1000 if k >= 40 else 0) for k in range(80)}
    for piece in (7, 1000):
        monkeypatch.setattr(jaccard, "PIECE", piece)
        links = jaccard._search(np.arange(80, dtype=np.uint64), Sets(sets), 0.8)
        assert sorted((min(a, b), max(a, b)) for a, b in links) == [(k, k + 1) for k in range(79) if k != 39]


def test_texts_of_one_id_are_rows_of_their_own(spark):
    rng = np.random.default_rng(8)
    one, two, three = (" ".join(f"w{x}" for x in rng.integers(0, 5000, 100)) for _ in range(3))
    rows = [(1, one), (1, two), (2, two + " end"), (3, one + " end"), (4, three), (4, three), (4, three + " end"), (None, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert len(got) == 4 and {(1, one), (1, two), (None, one)} <= set(got)
    assert [t for i, t in got if i == 4][0] in (three, three + " end")


def test_all_prints_within_the_radius_are_candidates(spark):
    """Wherever the differing bits are, also among the first ones."""
    rng = np.random.default_rng(9)
    bits = [(0, 1), (0, 63), (62, 63), (40, 63), (5, 40), (35, 36), (20, 50), (63, 63), (36, 36)]
    rows, want = [], set()
    for k, (i, j) in enumerate(bits):
        prints = rng.integers(0, 1 << 63, (2, jaccard.PRINTS), dtype=np.uint64)
        prints[1, k] = prints[0, k] ^ np.uint64(1 << i | 1 << j)
        rows += [(2 * k + n, bytearray(simhash.gray_ranks(p).tobytes())) for n, p in enumerate(prints)]
        want.add((2 * k, 2 * k + 1))
    far = rng.integers(0, 1 << 63, (1, jaccard.PRINTS), dtype=np.uint64).repeat(2, axis=0)
    far[1] ^= np.uint64(1 << 63 | 1 << 30 | 1)
    rows += [(100 + n, bytearray(simhash.gray_ranks(p).tobytes())) for n, p in enumerate(far)]
    found = {}
    for r in jaccard._groups(spark.createDataFrame(rows, "cls long, prints binary"), 3).collect():
        found.setdefault(r["bucket"], set()).add(r["cls"])
    assert {tuple(sorted(g)) for g in found.values()} == want


def test_orders_bring_near_prints_together():
    rng = np.random.default_rng(10)
    one = rng.integers(0, 1 << 63, 64 * 63 // 2, dtype=np.uint64)
    other = one ^ np.array([1 << i | 1 << j for i in range(64) for j in range(i)], np.uint64)
    a, b = jaccard.turned(one), jaccard.turned(other)
    assert (np.bitwise_count(a ^ b) == 2).all() and ((a ^ b) >> np.uint64(64 - jaccard.FRONT) == 0).any(axis=1).all()


def test_few_and_many_prints_make_the_same_groups(monkeypatch):
    rng = np.random.default_rng(14)
    base = int(rng.integers(0, 1 << 63))
    prints = [base ^ int(sum(1 << int(b) for b in rng.choice(30, rng.integers(0, 5), replace=False))) for _ in range(150)]
    ranks = np.unique(simhash.gray_ranks(np.array(prints, np.uint64)))
    groups = []
    for few in (1, 64, 1000):
        monkeypatch.setattr(jaccard, "FEW", few)
        root = jaccard.near_prints(ranks)
        groups.append({frozenset(np.flatnonzero(root == r).tolist()) for r in np.unique(root)})
    assert groups[0] == groups[1] == groups[2] and 1 < len(groups[0]) < len(ranks)

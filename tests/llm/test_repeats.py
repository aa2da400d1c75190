import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechtable.llm import fmindex, repeats, suffix, textbatch
from tests.llm.brute import WORD, covered, texts

EDGES = {0: "x" * 400, 1: "x" * 60 + "y" + "x" * 60, 2: None, 3: "", 4: "short", 5: "ab" * 90, 6: "c" + "ab" * 80, 7: "é" * 70, 8: "é" * 40 + "è" * 40,
         9: "w " * 120, 10: "w " * 30 + "v " + "w " * 70, 11: " \n", None: "ab" * 60}


def byte_result(df):
    return {r["id"]: (bytes(r["kept"]), [(s["start"], s["length"]) for s in r["spans"]]) for r in df.collect()}


def byte_brute(docs, length):
    data = {i: (t or "").encode() for i, t in docs.items()}
    gone = covered(data, length)
    return {i: (bytes(b for b, g in zip(data[i], gone[i]) if not g), [(m.start(), len(m[0])) for m in re.finditer(b"\1+", gone[i])]) for i in data}


def word_result(df):
    return {r["id"]: (bytes(r["kept"]).decode(), r["n_words"], r["n_removed"], [(s["first"], s["words"]) for s in r["intervals"]]) for r in df.collect()}


def word_brute(docs, length):
    data = {i: WORD.findall(t or "") for i, t in docs.items()}
    gone = covered(data, length)
    return {i: (" ".join(w for w, g in zip(data[i], gone[i]) if not g), len(data[i]), sum(gone[i]),
                [(m.start(), len(m[0])) for m in re.finditer(b"\1+", gone[i])]) for i in data}


@pytest.mark.parametrize("hot", [repeats.HOT, 3])
def test_documents_equal_brute_force(spark, sf, monkeypatch, hot):
    """Also with every anchor of three documents dealt out window by window."""
    monkeypatch.setattr(repeats, "HOT", hot)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = texts(spark, sf)
    assert byte_result(suffix.dedup(docs)) == byte_brute(want, 50)
    assert word_result(fmindex.dedup(docs)) == word_brute(want, 50)


def test_edges(spark):
    rows = [(i, t, 1, 2) for i, t in EDGES.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id int, row int").repartition(3)
    assert byte_result(suffix.dedup(docs)) == byte_brute(EDGES, 50)
    assert word_result(fmindex.dedup(docs)) == word_brute(EDGES, 50)


def test_short_lengths_and_repeated_ids(spark):
    rng = np.random.default_rng(4)
    docs = {i: "".join(rng.choice(list("ab "), int(rng.integers(0, 60)))) for i in range(40)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert byte_result(suffix.dedup(df, length=5, gram=3)) == byte_brute(docs, 5)
    assert word_result(fmindex.dedup(df, length=2, gram=1)) == word_brute(docs, 2)
    twice = spark.createDataFrame([(1, "k" * 70), (1, "k" * 70), (2, "k" * 70)], "doc_id long, text string")
    assert sorted((r["id"], len(r["kept"])) for r in suffix.dedup(twice).collect()) == [(1, 70), (1, 70), (2, 0)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix.dedup(docs).count() == fmindex.dedup(docs).count() == suffix.dedup_texts(docs).count() == 0


def test_texts_keep_whole_characters(spark):
    docs = spark.createDataFrame([(1, "é" * 60, "k"), (2, "a" + "é" * 60 + "b", "l"), (3, None, None)], "doc_id long, text string, id string")
    got = {r["doc_id"]: (r["text"], r["id"]) for r in suffix.dedup_texts(docs).collect()}
    assert got == {1: ("é" * 60, "k"), 2: ("ab", "l"), 3: (None, None)}


def suffixes(data, offsets, length):
    return [(s, k, bytes(data[a + k : b])) for s, (a, b) in enumerate(zip(offsets, offsets[1:])) for k in range(max(0, b - a - length + 1))]


def test_interval_tree_finds_all_maximal_repeats():
    rng = np.random.default_rng(8)
    for _ in range(20):
        parts = [bytes(rng.choice([97, 98, 0, 255], int(rng.integers(0, 40)), p=[0.5, 0.3, 0.1, 0.1]).astype(np.uint8)) for _ in range(6)]
        data, offsets = np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        length = 4
        all_ = suffixes(data, offsets.tolist(), length)
        want = set()
        for s, k, text in all_:
            for n in range(length, len(text) + 1):
                members = [(t, j) for t, j, other in all_ if other[:n] == text[:n]]
                longer = {other[:n + 1] for t, j, other in all_ if other[:n] == text[:n] and len(other) > n}
                ends = any(len(other) == n for _, _, other in all_ if other[:n] == text[:n])
                left = {parts[t][j - 1] if j else ("edge", t) for t, j in members}
                if len(members) > 1 and (len(longer) + ends > 1 or not longer) and (len(left) > 1 or any(j == 0 for _, j in members)):
                    want.add((n, frozenset(members)))
        got = {(n, frozenset(zip(s.tolist(), k.tolist()))) for s, k, n in suffix.groups(data, offsets, length)}
        assert got == want


def test_backward_search_counts_and_statistics():
    rng = np.random.default_rng(6)
    parts = [rng.integers(1, 6, int(rng.integers(1, 40))).astype(np.uint64) for _ in range(12)]
    words, bounds = np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    index = fmindex.FMIndex(words, bounds, 4)
    occurs = {tuple(p[i : i + n].tolist()) for p in parts for n in range(1, 5) for i in range(len(p) - n + 1)}
    asks = [rng.integers(1, 8, 50).astype(np.uint64), np.array([9, 9], np.uint64), parts[3]]
    flat, cut = np.concatenate(asks), np.concatenate(([0], np.cumsum([len(a) for a in asks])))
    matched, block = index.statistics(flat, cut)
    for a, b in zip(cut, cut[1:]):
        for i in range(a, b):
            best = max([n for n in range(1, 5) if i + n <= b and tuple(flat[i : i + n].tolist()) in occurs], default=0)
            assert matched[i] == best
            if best == 4:
                members = set(index.segment[index.low[block[i]] : index.high[block[i]]].tolist())
                assert members == {k for k, p in enumerate(parts) if any((p[j : j + 4] == flat[i : i + 4]).all() for j in range(len(p) - 3))}


def test_wavelet_rank():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 37, 1000)
    matrix = fmindex.WaveletMatrix(symbols, 6)
    asks, ends = rng.integers(0, 40, 200), rng.integers(0, 1001, 200)
    assert matrix.rank(asks, ends)[0].tolist() == [int((symbols[:e] == s).sum()) for s, e in zip(asks, ends)]


def test_word_hashes_depend_on_content_only():
    data = np.frombuffer("aa b aa\tcc  b".encode(), np.uint8)
    starts, ends, rows = textbatch.split_words(data, np.array([0, 4, 4, len(data)]))
    names = textbatch.hash_spans(data, starts, ends)
    assert rows.tolist() == [0, 2, 2, 5] and names[0] == names[2] and names[1] == names[4] and len(set(names.tolist())) == 3


def test_spans_unite_inside_a_segment():
    rng = np.random.default_rng(3)
    segment, begin, units = rng.integers(0, 5, 60), rng.integers(0, 40, 60), rng.integers(1, 6, 60)
    got = repeats.united(segment, begin, units, np.arange(60))
    cells = lambda s, b, u: {(int(x), int(k)) for x, y, n in zip(s, b, u) for k in range(y, y + n)}
    assert cells(*got[:3]) == cells(segment, begin, units)
    ends = {(int(s), int(b + u)) for s, b, u in zip(*got[:3])}
    assert all((int(s), int(b)) not in ends for s, b in zip(got[0], got[1]))


def test_packed_rows_come_back():
    import pyarrow as pa

    from speechtable.llm import store

    keys = np.array([5, 1 << 63, 7, (1 << 64) - 1, 5], np.uint64)
    batch = pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(["a", "b", "c", "d", "e"])], ["key", "v"])
    packed = list(store.pack(batch, 2))
    assert packed[0].column(0).to_pylist() == [0, 2, 3]
    back = [(k % (1 << 64), v) for b in store.unpack(packed) for k, v in zip(*(c.to_pylist() for c in b.columns))]
    assert back == [(5, "a"), (5, "e"), (7, "c"), (1 << 63, "b"), ((1 << 64) - 1, "d")]


def test_frequent_grams_make_no_candidates(spark):
    """Phrases that all documents use are no anchors where the words around them differ."""
    rng = np.random.default_rng(12)
    phrases = ["as a matter of fact ", "on the other hand we ", "in the first place it "]
    docs = {i: "".join(phrases[k % 3] + "".join(rng.choice(list("abcdefghij"), 40)) + " " for k in range(20)) for i in range(30)}
    df = spark.createDataFrame(list(docs.items()), "id long, text string")
    rule = repeats.Rule("bytes", 50, 16)
    assert len(repeats.anchor_store(df, rule)) == 0
    docs[99] = docs[7][100:400]
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert byte_result(suffix.dedup(df)) == byte_brute(docs, 50)


def test_runs_cover_every_window_once():
    """Equal windows have equal anchors, whatever block or row they stand in."""
    rng = np.random.default_rng(2)
    parts = [b"x" * 90, b"", b"ab" * 70, bytes(rng.integers(97, 100, 300).astype(np.uint8)), b"short"]
    parts += [parts[3][20:280], b"cab" + b"ab" * 40, b"-" * 5]
    data, offsets = np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    for rule in (repeats.Rule("bytes", 50, 16), repeats.Rule("bytes", 9, 8), repeats.Rule("bytes", 5, 3), repeats.Rule("bytes", 16, 16)):
        units = repeats.units_of(data, offsets, rule)
        seen = {}
        for block in (repeats.BLOCK, 64):
            with pytest.MonkeyPatch.context() as m:
                m.setattr(repeats, "BLOCK", block)
                runs = repeats.runs_of(units, rule)
            windows = [(int(r), int(s + k), int(a)) for s, n, a, r in zip(runs.start, runs.windows, runs.anchor, runs.row) for k in range(n)]
            assert sorted(w[:2] for w in windows) == [(r, s) for r, (a, b) in enumerate(zip(offsets, offsets[1:])) for s in range(a, b - rule.length + 1)]
            for _, s, a in windows:
                assert seen.setdefault(data[s : s + rule.length].tobytes(), a) == a
        assert runs.windows.max() <= repeats.MAX_RUN


def test_solver_sees_anchors_of_several_first_documents_only(spark):
    seen = []

    def solver(data, offsets, first, length):
        seen.append(len(first))
        return suffix.solver(data, offsets, first, length)

    rng = np.random.default_rng(5)
    text = "".join(rng.choice(list("abcdefghij "), 400))
    docs = spark.createDataFrame([(i, text) for i in range(6)], "id long, text string").coalesce(1)
    rule = repeats.Rule("bytes", 50, 16)
    found = repeats.solve(docs, rule, repeats.anchor_store(docs, rule), solver)
    assert len(found) > 0 and not seen
    # Whole copies are one segment each: later documents repeat it whole.
    assert all((found.shard(k)[1]["units"] == 0xFFFFFFFF).all() and (found.shard(k)[1]["doc"] == 0).all() for k in found.shards)


def test_a_row_a_shard_stays_small():
    import pyarrow as pa

    from speechtable.llm import store

    keys = np.arange(256, dtype=np.uint64) << np.uint64(56)
    batch = pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array([b"body"] * 256, pa.binary()), pa.array(np.arange(256, dtype=np.uint32))], ["key", "body", "n"])
    packed = list(store.pack(batch, 8))
    assert sum(len(v) for v in packed[0].column(1).to_pylist()) < 160 * 256
    back = store.unpack(packed)
    assert len(back) == 1 and back[0].column(1).to_pylist() == [b"body"] * 256 and back[0].column(2).to_pylist() == list(range(256))
    assert store.unpack(iter([])) == [] and not list(store.pack(batch.slice(0, 0), 8))

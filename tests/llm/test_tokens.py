import base64
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings as limits, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from speechtable.llm import bpe, packing, pretoken
from tests.llm.brute import texts

RANKS, FILE = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
EDGES = {1: None, 2: "", 3: " ", 4: "\n\n  a", 5: "it's 'll 's'm I'd've ''s 're", 6: "x" * 500, 7: "<|endoftext|>", 8: "日本語 123  \t é !　?",
         9: "a  b   c \n", 10: "=" * 97 + " " * 30, 11: "\U0001f600‍\U0001f468 é", None: "null id"}


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@limits(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aZé1 '\n\tstmdrevl!? 　日"), max_size=25), max_size=5))
def test_split_equals_pattern(rows):
    data = [r.encode() for r in rows]
    offsets = np.concatenate(([0], np.cumsum([len(d) for d in data]))).astype(np.int64)
    flat = np.frombuffer(b"".join(data), np.uint8)
    starts, before = pretoken.split(flat, offsets)
    ends = np.append(starts[1:], len(flat))
    got = [[flat[a:b].tobytes().decode() for a, b in zip(starts[x:y], ends[x:y])] for x, y in zip(before, before[1:])]
    assert got == [regex.findall(public_tokenizers.PATTERN, r) for r in rows]


def test_encode_equals_library_and_decodes(spark, sf, library):
    want = texts(spark, sf) | EDGES
    docs = spark.createDataFrame([(i, t, 1) for i, t in want.items()], "doc_id long, text string, ids int").repartition(3)
    found = bpe.encode(docs, RANKS).select("id", "ids", bpe.decode(F.col("ids"), RANKS).alias("back")).collect()
    assert len(found) == len(want)
    for r in found:
        assert r["ids"] == library.encode_ordinary(want[r["id"]] or "")
        assert bytes(r["back"]).decode() == (want[r["id"]] or "")


def test_heap_merges_equal_fold_of_library(library):
    rng = np.random.default_rng(0)
    for n in (1, 2, 97, 300):
        word = bytes(rng.choice(list(b"aabbcnt"), n).astype(np.uint8))
        assert bpe.merge_long(word, bpe.ranks(RANKS)) == library.encode_ordinary(word.decode())


@pytest.mark.parametrize("windows,size", [(64, 2048), (3, 64)])
def test_packing_covers_every_id_once(spark, sf, windows, size):
    want = texts(spark, sf) | EDGES
    tokenizer = Tokenizer.from_file(FILE)
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in want.items()}
    docs = spark.createDataFrame([(i, t, 1) for i, t in want.items()], "doc_id long, text string, part int").repartition(3)
    rows = packing.pack(docs, FILE, windows=windows, size=size).collect()
    at, used = dict.fromkeys(want, 0), {}
    for r in sorted(rows, key=lambda r: r["start"]):
        i = r["doc_id"]
        assert r["start"] == at[i] and r["doc_tokens"] == len(ids[i]) and r["length"] > 0
        at[i] += r["length"]
        assert r["ids_crc32"] == zlib.crc32(ids[i][r["start"] : at[i]].tobytes())
    assert at == {i: len(v) for i, v in ids.items()}
    for r in sorted(rows, key=lambda r: r["offset"]):
        assert r["offset"] == used.get(r["sequence_id"], 0)
        used[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(used.values()) <= size
    padding = sum(size - n for n in used.values() if n & (n - 1))
    assert padding <= 0.05 * sum(used.values())


def test_packer_places_best_fit_and_emits_fullest():
    packer = packing.Packer(10, 2, 3, 0)
    put = lambda doc, n: packer.add(doc, np.zeros(n, "<u4"))
    put("a", 6)  # room 4
    put("b", 5)  # fits no window: a new one, room 5
    put("c", 4)  # best fit: the window of a, now full
    assert [(r[0], r[5]) for r in packer.done] == [("a", 0), ("c", 0)]
    put("d", 7)  # a new window, room 3
    put("e", 6)  # fits none: the fullest (room 3) takes three of it and leaves
    assert [(r[0], r[1], r[2], r[5]) for r in packer.done[2:]] == [("d", 0, 7, 1), ("e", 0, 3, 1)]
    assert sorted(room for room, _ in packer.rooms) == [2, 5] or sorted(room for room, _ in packer.rooms) == [2]


@pytest.mark.parametrize("n", [0, 1])
def test_small_tables(spark, n):
    docs = spark.createDataFrame([(1, None)][:n], "doc_id long, text string")
    assert [tuple(r)[:3] for r in packing.pack(docs, FILE).collect()] == [(1, 0, 1)][:n]
    assert [list(r["ids"]) for r in bpe.encode(docs, RANKS).collect()] == [[]][:n]


def test_packing_takes_ids_as_the_library_gives_them(spark):
    tokenizer = Tokenizer.from_file(FILE)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|><|endoftext|>  it's\n", "<|endoftext", "|>plain text", "<|endof", "text|>", "", "word " * 900 + "<|endoftext|>"]
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), FILE).collect()
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        assert [r["start"] for r in own] == np.cumsum([0, *(r["length"] for r in own)])[:-1].tolist() and sum(r["length"] for r in own) == len(ids)
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in own)

"""Prefix token counts against the library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechtable.llm import prefixcounts, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "e", "the", "ing", " ", "  ", "\n", "\t", "▁", "é", "日本", "𝔘", "\x00", "<s>", "</s>", "<0x0A>", "0", "ab", "XX", " and", "　", "aaaa"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts(seed: int, n: int, most: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, most))) for _ in range(n)]


def stored(table) -> dict:
    """id -> all counts, from the rows of the table."""
    out: dict = {}
    for r in sorted(table.collect(), key=lambda r: (r["id"], r["start"])):
        assert r["start"] == len(out.setdefault(r["id"], []))
        out[r["id"]] += r["counts"]
    return out


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, counts string, _doc int")


def test_every_prefix_equals_the_library(spark, library):
    found = texts(1, 60, 40)
    table = prefixcounts.prefixes(docs(spark, [(i, t, "x", 1) for i, t in enumerate(found)]), PATH)
    got = stored(table)
    assert all(got[i] == [len(library.encode(t[: k + 1])) for k in range(len(t))] for i, t in enumerate(found))


@pytest.mark.parametrize("window", [5, 64])
def test_long_texts_go_on_where_a_window_ends(library, monkeypatch, window):
    monkeypatch.setattr(prefixcounts, "CHUNK_BYTES", window)
    made = prefixcounts.Counter(PATH)
    for text in [*texts(2, 60, 60), "a" * 300, " " * 90, "日" * 70]:
        data = np.frombuffer(text.encode(), np.uint8)
        got = [c for part in made.long(data) for c in part.tolist()]
        assert got == [len(library.encode(text[: k + 1])) for k in range(len(text))]


def test_rows_of_parts_and_a_text_beyond_a_chunk(spark, library):
    rng = random.Random(3)
    long = " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(300_000)) + "z" * 200_000
    table = prefixcounts.prefixes(docs(spark, [(1, long, None, None), (2, "b" * 70_000, None, None)]), PATH)
    parts = table.select("id", "start", F.size("counts").alias("n"), "last").collect()
    assert all(r["n"] <= prefixcounts.PART for r in parts) and sum(r["last"] for r in parts) == 2
    got = {r["id"]: r for r in prefixcounts.totals(table).collect()}
    assert got[1]["n_tokens"] == len(library.encode(long)) and got[1]["n_bytes"] == len(long.encode()) and got[1]["n_chars"] == len(long)
    assert got[2]["n_tokens"] == len(library.encode("b" * 70_000))
    for k in (1, 65_536, 65_537, 1_000_001):
        at = [r[0] for r in table.where("id = 1").select(prefixcounts.count_at(k)).collect() if r[0] is not None]
        assert at == [len(library.encode(long[:k]))]


def test_budgets_and_cuts_equal_trying_every_prefix(spark, library):
    rows = [(i % 50, t, "extra", i) for i, t in enumerate(texts(4, 60, 30))] + [(None, "the end", "e", 0), (None, "the end", "e", 0), (99, None, "n", 0)]
    given = docs(spark, rows)
    table = prefixcounts.prefixes(given, PATH)
    for budget in (0, 1, 7, 1000):
        def longest(t):
            return max((k for k in range(len(t) + 1) if len(library.encode(t[:k])) <= budget), default=0)

        kept = {(r["id"], r["key"]): (r["n_kept"], r["fits"]) for r in prefixcounts.within(table, budget).collect()}
        assert kept == {(i, hashlib.md5((t or "").encode()).hexdigest()): (longest(t or ""), len(library.encode(t or "")) <= budget) for i, t, _, _ in rows}
        cut = prefixcounts.truncated(given, table, budget)
        assert cut.columns == given.columns
        want = sorted((str(i), t[: longest(t)] if t is not None else None, c, d) for i, t, c, d in rows if t is not None)
        assert sorted((str(r[0]), r[1], r[2], r[3]) for r in cut.collect() if r[1] is not None) == want
        assert cut.where("doc_id = 99").first()["text"] is None


def test_empty_table_and_other_id_types(spark):
    table = prefixcounts.prefixes(docs(spark, []), PATH)
    assert table.collect() == [] and prefixcounts.within(table, 3).collect() == []
    one = spark.createDataFrame([("k", "")], "name string, body string")
    row = prefixcounts.prefixes(one, PATH, "name", "body").first()
    assert (row["id"], row["counts"], row["last"], row["n_tokens"], row["n_bytes"]) == ("k", [], True, 0, 0)


def test_models_that_cannot_be_counted_are_refused(spark, monkeypatch):
    real = sentencepiece.SentencePieceProcessor.normalize
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "normalize", lambda self, t: real(self, t).upper())
    with pytest.raises(ValueError, match="normalisation"):
        prefixcounts.Vocabulary(PATH)


def test_query_counts_whole_texts(spark, library, tmp_path):
    spark.createDataFrame([(1, "word " * 5000), (2, None), (3, ""), (4, "日本 <s> x"), (4, "again")], T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in queries.op12_token_counts(spark, str(tmp_path)).collect())
    want = [(i, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 4096)
            for i, t in ((1, "word " * 5000), (2, None), (3, ""), (4, "日本 <s> x"), (4, "again"))]
    assert got == sorted(want)

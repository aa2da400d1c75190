"""Language-model scores: an interpolated modified Kneser-Ney model of word pairs.

Counting runs in Spark over whole training texts. The model is a set of stores (sorted hash arrays in the shared folder, see ``store``) which
the workers map into memory when they score:

* words: hash of each training token and its count; a word's place in it is its number;
* pairs: (number of the word before, number of the word) in one 64-bit key, and the count;
* shapes: for each number how many different words precede it, and how many pairs it starts once, twice or more often.

A text is a sequence of words and one end; the end of the text before stands before its first word. With counts c and discounts D
estimated from the counts of counts, p(w | h) = max(c(hw) - D, 0) / c(h) + g(h) p1(w), and p1 does the same with the numbers of different
words before w, down to an even share for each known word and one for all unknown ones.

Scale: tokens are counted per chunk of text before they are shuffled, so a common word or pair is one row a chunk. Pair shards are ranges of
keys cut at equal shares of text by the words' counts (inside a word where one word fills more than a shard), so no word is a hot
key. The driver sees file names and sums. At most 2^32 - 1 distinct words fit a key; more raise an error.

A null text is empty: one end. Null and repeated ids are documents of their own; a null training mark counts as no. Without training
documents every probability is 1. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechtable.llm import store, textbatch

#: Stands for the end of a text among word hashes.
_END = np.uint64(0x5DEECE66D1234567)
#: Pairs a task gathers before it sends them on.
_HOLD = 4_000_000


@dataclass
class Model:
    words: store.Store
    pairs: store.Store
    shapes: store.Store
    pair_discounts: np.ndarray
    word_discounts: np.ndarray

    @property
    def tokens(self) -> int:
        return self.words.totals.get("n", 0)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words and ends, tokens before each row and in all)."""
    data = textbatch.LOWER[data]
    starts, ends, rows = textbatch.split_words(data, offsets)
    hashes = np.insert(textbatch.hash_spans(data, starts, ends), rows[1:], _END)
    return hashes, rows + np.arange(len(rows))


def _count(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sum of n (or how often each occurs)."""
    if n is None:
        keys = np.sort(keys)
        heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        return keys[heads], np.diff(np.append(heads, len(keys)))
    order, heads, _ = textbatch.distinct(keys)
    return keys[order][heads], np.add.reduceat(n[order].astype(np.int64), heads) if len(heads) else n.astype(np.int64)


def _sum(keys: np.ndarray, values: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    keys, n = _count(keys, values["n"])
    return keys, {"n": n}


def _numbers(words: store.Store, hashes: np.ndarray) -> np.ndarray:
    """Number of each token, -1 if unknown."""
    order, heads, run = textbatch.distinct(hashes)
    out = np.empty(len(hashes), np.int64)
    out[order] = words.index(hashes[order][heads])[run]
    return out


def _vocabulary(docs: DataFrame) -> store.Store:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in textbatch.chunks(batch.column(0)):
                keys, n = _count(_tokens(data, offsets)[0])
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])

    counted = docs.select("text").mapInArrow(run, "key long, n long")
    return store.build(counted, "key", {"n": "<i8"}, _sum, summary=lambda _, v: {"n": v["n"].sum()})


def _places(spark, words: store.Store, shares: list[float]) -> list[tuple[int, float]]:
    """(word number, share inside the word) at each share of all tokens, words in the order of their numbers."""
    sums = {r["shard"]: r["n"] for r in store.over_shards(
        spark, words, lambda number, _, v: iter([pa.RecordBatch.from_pydict({"shard": [number], "n": [int(v["n"].sum())]})]), "shard long, n long").collect()}
    total, before, offsets, at = sum(sums.values()), {}, words.offsets(), 0
    for number in sorted(sums):
        before[number], at = at, at + sums[number]

    def find(number, _, values):
        upto = before[number] + np.cumsum(values["n"])
        for k, share in enumerate(shares):
            want = share * total
            if before[number] <= want < before[number] + sums[number]:
                i = int(np.searchsorted(upto, want, "right"))
                inside = (want - (upto[i] - values["n"][i])) / values["n"][i]
                yield pa.RecordBatch.from_pydict({"k": [k], "word": [offsets[number] + i], "inside": [float(inside)]})

    rows = {r["k"]: (r["word"], r["inside"]) for r in store.over_shards(spark, words, find, "k long, word long, inside double").collect()}
    return [rows[k] for k in range(len(shares))]


def _cuts(spark, words: store.Store, parts: int) -> np.ndarray:
    """Pair keys that cut the training text into about equal shares."""
    if parts < 2 or not len(words):
        return np.zeros(0, np.uint64)
    first = _places(spark, words, [k / parts for k in range(1, parts)])
    second = _places(spark, words, [inside for _, inside in first])
    return np.unique(np.array([(a << 32) | b for (a, _), (b, _) in zip(first, second)], np.uint64))


def _pairs(docs: DataFrame, words: store.Store) -> store.Store:
    cuts = _cuts(docs.sparkSession, words, 1 << store.bits_for(docs))
    parts = len(cuts) + 1

    def send(held: list) -> pa.RecordBatch:
        keys, n = _count(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))
        # Count and shard share a column: sorted keys then take few bytes in the shuffle.
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n * parts + store.shards_of(keys, 0, cuts))], ["key", "mark"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, _, data, offsets in textbatch.chunks(batch.column(0)):
                number = _numbers(words, _tokens(data, offsets)[0])
                if not len(number):
                    continue
                held.append(_count(_keys(number)))
                size += len(held[-1][0])
                if size >= _HOLD:
                    yield send(held)
                    held, size = [], 0
        if held:
            yield send(held)

    rows = docs.select("text").mapInArrow(run, "key long, mark long")
    rows = rows.repartitionById(parts, (F.col("mark") % parts).cast("int")).select("key", F.expr(f"mark div {parts}").alias("n"))
    of = lambda _, v: {f"c{k}": (v["n"] == k).sum() for k in (1, 2, 3, 4)}
    return store.build(rows, "key", {"n": "<u4"}, _sum, placed=True, cuts=cuts, summary=of)


def _keys(number: np.ndarray) -> np.ndarray:
    """Pair keys of consecutive tokens whose numbers are known; each text ends with the end, which stands before the next one's first word."""
    end = number[-1:]
    before = np.concatenate([end, number[:-1]])
    return (before.astype(np.uint64) << np.uint64(32)) | number.astype(np.uint64)


def _shapes(spark, pairs: store.Store, words: store.Store, parts: int) -> store.Store:
    """Per word number: different words before it, pairs it starts with count 1, 2 and more."""
    size = max(1, -(-len(words) // parts))
    cuts = np.arange(size, len(words), size).astype(np.uint64)

    def run(number, keys, values):
        n = np.asarray(values["n"])
        head, tail = np.asarray(keys) >> np.uint64(32), np.asarray(keys) & np.uint64(0xFFFFFFFF)
        starts = np.flatnonzero(np.concatenate(([True], head[1:] != head[:-1])))
        zeros = np.zeros(len(starts), np.int64)
        shape = [np.add.reduceat(test.astype(np.int64), starts) for test in (n == 1, n == 2, n >= 3)]
        word, times = _count(tail)
        for ids, columns in ((head[starts], [zeros, *shape]), (word, [times, *[np.zeros(len(word), np.int64)] * 3])):
            yield pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), *map(pa.array, columns)], ["key", "before", "once", "twice", "more"])

    def add(keys, values):
        order, heads, _ = textbatch.distinct(keys)
        return keys[order][heads], {k: np.add.reduceat(v[order], heads) if len(heads) else v for k, v in values.items()}

    rows = store.over_shards(spark, pairs, run, "key long, before long, once long, twice long, more long")
    rows = rows.repartitionById(len(cuts) + 1, F.floor(F.col("key") / size).cast("int"))
    of = lambda _, v: {f"c{k}": (v["before"] == k).sum() for k in (1, 2, 3, 4)} | {"before": v["before"].sum()}
    return store.build(rows, "key", dict.fromkeys(("before", "once", "twice", "more"), "<i8"), add, placed=True, cuts=cuts, summary=of)


def discounts(c: dict[str, int]) -> np.ndarray:
    """D for counts 0, 1, 2, 3 and more, from how many items were counted 1, 2, 3 and 4 times."""
    n1, n2, n3, n4 = (c.get(f"c{k}", 0) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    one = 1 - 2 * y * n2 / n1 if n1 else 0.5
    two = 2 - 3 * y * n3 / n2 if n2 else one
    more = 3 - 4 * y * n4 / n3 if n3 else two
    return np.concatenate(([0.0], np.clip([one, two, more], 0.05, [1, 2, 3])))


def train(docs: DataFrame) -> Model:
    """Count the texts of ``docs`` (column text)."""
    words = _vocabulary(docs)
    if len(words) >= 1 << 32:
        raise ValueError(f"{len(words)} distinct words do not fit a pair key of 64 bits")
    pairs = _pairs(docs, words)
    shapes = _shapes(docs.sparkSession, pairs, words, 1 << store.bits_for(docs))
    return Model(words, pairs, shapes, discounts(pairs.totals), discounts(shapes.totals))


def _chunk_scores(model: Model, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known, log10 of the base share, log10 p) of each token of a chunk."""
    order, heads, run = textbatch.distinct(hashes)
    unique = hashes[order][heads]
    found, word = model.words.find(unique)
    number = model.words.index(unique)
    count = word["n"].astype(np.float64)
    total, kinds = model.tokens, len(model.words)
    base = np.log10((count + 0.5) / (total + 0.5 * (kinds + 1)))
    # Lower order: how many different words stand before.
    shape = {k: np.zeros(len(unique)) for k in ("before", "once", "twice", "more")}
    by = np.argsort(number, kind="stable")
    by = by[number[by] >= 0]
    _, got = model.shapes.find(number[by].astype(np.uint64))
    for k, v in got.items():
        shape[k][by] = v
    c, d = model.shapes.totals, model.word_discounts
    types = c.get("before", 0)
    left = (d[1] * c.get("c1", 0) + d[2] * c.get("c2", 0) + d[3] * (kinds - c.get("c1", 0) - c.get("c2", 0))) / types if types else 1.0
    before = shape["before"]
    lower = np.maximum(before - d[np.minimum(before, 3).astype(np.int64)], 0) / max(types, 1) + left / (kinds + 1)
    d = model.pair_discounts
    back = np.where(found, (d[1] * shape["once"] + d[2] * shape["twice"] + d[3] * shape["more"]) / np.maximum(count, 1), 1.0)
    # Back to the tokens in their places.
    which = np.empty(len(hashes), np.int64)
    which[order] = run
    ends = np.flatnonzero(unique == _END)
    previous = np.concatenate([ends, which[:-1]])
    p = back[previous] * lower[which]
    both = np.flatnonzero(found[which] & found[previous])
    key = (number[previous[both]].astype(np.uint64) << np.uint64(32)) | number[which[both]].astype(np.uint64)
    ranked = np.argsort(key, kind="stable")
    key = key[ranked]
    fresh = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
    seen, pair = model.pairs.find(key[fresh])
    n = np.where(seen, pair["n"], 0).astype(np.float64)[np.cumsum(fresh) - 1]
    p[both[ranked]] += np.maximum(n - d[np.minimum(n, 3).astype(np.int64)], 0) / count[previous[both[ranked]]]
    return found[which], base[which], np.log10(p)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) of every whole text; scores are sums of log10 probabilities."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in textbatch.chunks(batch.column(1)):
                hashes, rows = _tokens(data, offsets)
                known, base, full = _chunk_scores(model, hashes)
                heads = rows[:-1]  # every text has a token
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(rows)), pa.array(np.add.reduceat(known.astype(np.int64), heads)),
                     pa.array(np.add.reduceat(base, heads)), pa.array(np.add.reduceat(full, heads))],
                    ["id", "n_tokens", "n_known", "base_score", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, n_known long, base_score double, score double")


def perplexity(scored: DataFrame) -> Column:
    """10 to the mean negative log10 probability of a token."""
    return F.pow(F.lit(10.0), -scored["score"] / scored["n_tokens"])

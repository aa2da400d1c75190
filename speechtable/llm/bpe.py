"""Byte-level BPE in two steps: merges are folded over the distinct words in Spark, documents then look their words up.

``encode`` splits whole texts by the pattern and keeps the distinct words. Each word becomes an array of its bytes (as hex pairs); a fold of
Spark's higher-order functions merges the leftmost pair of least rank until no pair has one. The rank map is a literal: a
table of two arrays in which a token lies in one of the two slots its hash names, since a lookup in a literal map walks all its entries. The ids of words go to
a store of sorted hash arrays in the shared folder; a second pass over the texts maps it and joins the ids of a
document's words, so occurrences of words are never shuffled. ``decode`` concatenates the binary pieces of ids from a literal list.

Words longer than ``LONG_WORD`` bytes (rare: unbroken runs) are merged by a heap in the second pass, as a fold over n bytes moves n² of them.
Words are told apart by 64-bit hashes.

Scale: one shuffle of distinct words per task, bounded by vocabulary, not by text; a store shard is one task's. A null text is an empty
one, with no ids. Null and repeated ids are rows of their own; other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechtable.functions.waves import let
from speechtable.llm import pretoken, store, textbatch

LONG_WORD = 96


@cache
def ranks(path: str) -> dict[bytes, int]:
    """Rank of each token of a rank file: lines of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def _slots(path: str) -> tuple[list[str | None], list[int]]:
    """Cuckoo table of the ranks: each hex token lies in one of the two slots its hash names."""
    names = {token.hex().upper(): rank for token, rank in ranks(path).items()}
    size = 1 << max(4, (3 * len(names)).bit_length() - 1)
    slots: list[str | None] = [None] * size
    at = {name: _pair(xxhash.xxh64_intdigest(name, 42), size) for name in names}
    for name in names:
        place, moves = at[name][0], 0
        while name is not None:
            slots[place], name = name, slots[place]
            if name is not None:
                one, two = at[name]
                place = two if place == one else one
                moves += 1
                if moves > size:
                    raise ValueError("the rank file's tokens do not fit a table of two choices")
    return slots, [names[x] if x is not None else -1 for x in slots]


def _pair(value: int, size: int) -> tuple[int, int]:
    return value % size, (value >> 32) % size


def rank_table(path: str) -> tuple[Column, Column]:
    """The rank map as two literals: hex tokens in slots, and their ranks."""
    slots, values = _slots(path)
    literal = lambda x, kind: F.from_json(F.lit(json.dumps(x, separators=(",", ":"))), f"array<{kind}>")
    return literal(slots, "string"), literal(values, "int")


def fold(word: Column, table: tuple[Column, Column]) -> Column:
    """Ids of a binary word: merges folded over its bytes. The literals stand in the expression once."""
    return let(table[0], lambda slots: let(table[1], lambda values: _fold(word, slots, values)))


def _fold(word: Column, slots: Column, values: Column) -> Column:
    size = F.size(slots)

    def rank(token: Column) -> Column:
        def look(x: Column) -> Column:
            def either(h: Column) -> Column:
                one = F.pmod(h, size).cast("int")
                two = F.pmod(F.shiftrightunsigned(h, 32), size).cast("int")
                return F.when(F.get(slots, one) == x, F.get(values, one)).when(F.get(slots, two) == x, F.get(values, two))

            return let(F.xxhash64(x), either)

        return let(token, look)

    def step(state: Column, _: Column) -> Column:
        def merged(i: Column) -> Column:
            s, r, n = state["s"], state["r"], F.size(state["s"])

            def put(t: Column) -> Column:
                left = F.when(i > 1, F.array(rank(F.concat(F.get(s, i - 2), t)))).otherwise(F.array().cast("array<int>"))
                right = F.when(i < n - 1, F.array(rank(F.concat(t, F.get(s, i + 1))))).otherwise(F.array().cast("array<int>"))
                return F.struct(
                    F.concat(F.slice(s, F.lit(1), i - 1), F.array(t), F.slice(s, i + 2, n)).alias("s"),
                    F.concat(F.slice(r, F.lit(1), F.greatest(i - 2, F.lit(0))), left, right, F.slice(r, i + 2, n)).alias("r"))

            return let(F.concat(F.get(s, i - 1), F.get(s, i)), put)

        best = F.array_min(state["r"])
        return F.when(best.isNull(), state).otherwise(let(F.array_position(state["r"], best).cast("int"), merged))

    text = F.hex(word)
    length = F.octet_length(word)
    pairs = lambda s: F.transform(F.slice(s, F.lit(1), F.size(s) - 1), lambda a, i: rank(F.concat(a, F.get(s, i + 1))))
    bytes_ = F.transform(F.sequence(F.lit(0), length - 1), lambda i: F.substring(text, i * 2 + 1, F.lit(2)))
    start = let(bytes_, lambda s: F.struct(s.alias("s"), pairs(s).alias("r")))
    ended = F.aggregate(F.sequence(F.lit(1), F.greatest(length - 1, F.lit(1))), start, step, lambda x: F.transform(x["s"], rank))
    return let(rank(text), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(ended))


def merge_long(word: bytes, table: dict[bytes, int]) -> list[int]:
    """The same merges by a heap over a linked list of pieces."""
    if word in table:
        return [table[word]]
    n = len(word)
    piece: list[bytes | None] = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, piece[i] + piece[i + 1]) for i in range(n - 1) if (r := table.get(piece[i] + piece[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, joined = heapq.heappop(heap)
        j = after[i] if piece[i] is not None else n
        if j >= n or piece[i] + piece[j] != joined:
            continue
        piece[i], piece[j] = joined, None
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for a in (before[i], i):
            b = after[a] if a >= 0 else n
            if b < n and (r := table.get(piece[a] + piece[b])) is not None:
                heapq.heappush(heap, (r, a, piece[a] + piece[b]))
    return [table[p] for p in piece if p is not None]


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, rows = pretoken.split(data, offsets)
    ends = np.append(starts[1:], len(data))
    return starts, ends, rows, textbatch.hash_spans(data, starts, ends)


def dictionary(docs: DataFrame, text_col: str, path: str) -> store.Store:
    """Ids of all distinct words up to ``LONG_WORD`` bytes, by word hash."""
    bits = store.bits_for(docs)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.uint64)
        for batch in batches:
            for _, _, data, offsets in textbatch.chunks(batch.column(0)):
                starts, ends, _, hashes = _words(data, offsets)
                order, heads, _ = textbatch.distinct(hashes)
                pick = order[heads]
                pick = pick[(ends[pick] - starts[pick] <= LONG_WORD) & ~np.isin(hashes[pick], seen, kind="sort")]
                if len(seen) < 1_000_000:  # words this task has sent already; beyond, the next task drops repeats
                    seen = np.concatenate([seen, hashes[pick]])
                sizes = ends[pick] - starts[pick]
                words = textbatch.binary_array(textbatch.gather(data, starts[pick], sizes), sizes)
                yield pa.RecordBatch.from_arrays([pa.array(hashes[pick].view(np.int64)), words.cast(pa.binary())], ["key", "word"])

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if parts:
            whole = pa.Table.from_batches(parts).combine_chunks()
            order, heads, _ = textbatch.distinct(whole["key"].to_numpy().view(np.uint64))
            yield from whole.take(pa.array(np.sort(order[heads]))).to_batches(max_chunksize=10_000)

    found = docs.select(text_col).mapInArrow(collect, "key long, word binary")
    found = store.place(found, "key", bits).mapInArrow(once, "key long, word binary")
    ids = found.select("key", F.posexplode(fold(F.col("word"), rank_table(path))).alias("pos", "id"))
    return store.build(ids, "key", {"pos": "<u1", "id": "<u4"}, _in_order, bits, placed=True)


def _in_order(keys: np.ndarray, values: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    order = np.lexsort((values["pos"], keys))
    return keys[order], {name: v[order] for name, v in values.items()}


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): token ids of every whole text. ``path`` names the rank file."""
    words = dictionary(docs, text_col, path)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in textbatch.chunks(batch.column(1)):
                starts, ends, rows, hashes = _words(data, offsets)
                order, heads, number = textbatch.distinct(hashes)
                sample = order[heads]
                owner, columns = words.find_all(hashes[sample])
                ids, sizes = columns["id"], np.bincount(owner, minlength=len(sample)) if len(sample) else np.zeros(0, np.int64)
                first = np.cumsum(sizes) - sizes
                long = np.flatnonzero(ends[sample] - starts[sample] > LONG_WORD)
                if len(long):
                    table, extra = ranks(path), []
                    for k in long:
                        got = merge_long(data[starts[sample[k]] : ends[sample[k]]].tobytes(), table)
                        first[k], sizes[k] = len(ids) + sum(map(len, extra)), len(got)
                        extra.append(got)
                    ids = np.concatenate([ids, np.array([i for x in extra for i in x], np.uint32)])
                which = np.empty(len(starts), np.int64)
                which[order] = number
                count = sizes[which]
                total = np.concatenate(([0], np.cumsum(count)))[rows]
                values = pa.array(textbatch.gather(ids, first[which], count).astype(np.int32, copy=False))
                # No more than a few million ids a batch.
                for at in range(0, b - a, 2048):
                    to = min(at + 2048, b - a)
                    cut = values.slice(total[at], total[to] - total[at])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(a + at, to - at), pa.ListArray.from_arrays(pa.array((total[at : to + 1] - total[at]).astype(np.int32)), cut)], ["id", "ids"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids array<int>")


def decode(ids: Column, path: str) -> Column:
    """Bytes of a list of ids: their binary pieces one after another."""
    by_rank = {rank: token for token, rank in ranks(path).items()}
    pieces = [by_rank[i].hex().upper() if i in by_rank else None for i in range(max(by_rank) + 1)]
    table = F.from_json(F.lit(json.dumps(pieces, separators=(",", ":"))), "array<string>")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), ""))

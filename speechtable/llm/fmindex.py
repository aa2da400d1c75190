"""Substring dedup: matching statistics of documents against a compressed FM-index.

A shard's distinct segments (see ``repeats``) are words. Their Burrows-Wheeler transform is held as a wavelet matrix: one packed bit vector per bit
of a word's number, with counts every 64 bits. Backward search streams documents from right to left and keeps, for each place, the
interval of the suffix array that matches the longest stretch up to ``length`` words; an interval of the full length names all its occurrences.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechtable.llm import repeats, textbatch


class WaveletMatrix:
    """Rank of symbols in a sequence of numbers below 2^bits."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.n = bits, len(symbols)
        self.words, self.counts, self.zeros = [], [], []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            padded = np.zeros(-(-(self.n + 1) // 64) * 64, np.uint8)
            padded[: self.n] = bit
            words = np.packbits(padded, bitorder="little").view("<u8")
            self.words.append(words)
            self.counts.append(np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))[:-1].astype(np.int32))
            self.zeros.append(int(self.n - bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def _ones(self, level: int, i: np.ndarray) -> np.ndarray:
        block, rest = i >> 6, (i & 63).astype(np.uint64)
        part = self.words[level][block] & ((np.uint64(1) << rest) - np.uint64(1))
        return self.counts[level][block] + np.bitwise_count(part)

    def rank(self, symbol: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
        """How often each symbol occurs before each end."""
        places = [np.zeros(len(symbol), np.int64), *ends]
        for level in range(self.bits):
            bit = (symbol >> (self.bits - 1 - level)) & 1 == 1
            for k, i in enumerate(places):
                ones = self._ones(level, i)
                places[k] = np.where(bit, self.zeros[level] + ones, i - ones)
        return [p - places[0] for p in places[1:]]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only suffixes that still tie are sorted again. The last symbol is unique."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    fresh = np.concatenate(([True], text[order][1:] != text[order][:-1]))
    rank = np.full(n + 1, -1, np.int64)
    rank[order] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    depth = 1
    slots = _tied(fresh)
    while len(slots):
        at = order[slots]
        head, second = rank[at], rank[np.minimum(at + depth, n)]
        inner = np.lexsort((second, head))
        at, head, second = at[inner], head[inner], second[inner]
        order[slots] = at
        fresh = np.concatenate(([True], (head[1:] != head[:-1]) | (second[1:] != second[:-1])))
        rank[at] = slots[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
        slots = slots[_tied(fresh)]
        depth *= 2
    return order


def _tied(fresh: np.ndarray) -> np.ndarray:
    return np.flatnonzero(~fresh | np.concatenate((~fresh[1:], [False])))


class FMIndex:
    """Index of segments of hashed words. Suffixes are grouped into blocks that share ``length`` words."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray, length: int):
        count = len(bounds) - 1
        order, heads, run = textbatch.distinct(words)
        self.alphabet = words[order][heads]
        number = np.empty(len(words), np.int64)
        number[order] = run
        owner = np.repeat(np.arange(count), np.diff(bounds))
        # Each segment ends in a mark of its own, below all words.
        text = np.empty(len(words) + count, np.int64)
        at = np.arange(len(words)) + owner
        text[at] = number + count
        marks = bounds[1:] + np.arange(count)
        text[marks] = np.arange(count)
        self.n, self.length = len(text), length
        array = suffix_order(text)
        symbols = np.maximum(text - count + 1, 0)  # 0: any mark
        self.transform = WaveletMatrix(symbols[array - 1], max(1, int(len(self.alphabet)).bit_length()))
        self.first = np.searchsorted(text[array], np.arange(len(self.alphabet) + 1) + count - 1, "left")
        self.first[0] = 0
        # Equal hashes of the first ``length`` words: exact up to the 64-bit identity of words.
        segment = np.searchsorted(marks, array, "left")
        self.segment = segment
        prefix = textbatch.prefix_hash(textbatch.mix(text.astype(np.uint64) + np.uint64(1)))
        full = marks[segment] - array >= length
        name = np.zeros(self.n, np.uint64)
        name[full] = textbatch.span_hash(prefix, array[full], array[full] + length)
        fresh = np.concatenate(([True], (name[1:] != name[:-1]) | ~full[1:] | ~full[:-1]))
        self.block = np.cumsum(fresh) - 1
        self.low = np.flatnonzero(fresh)
        self.high = np.append(self.low[1:], self.n)

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """Symbol of each word, 0 where it is not in the index."""
        if not len(self.alphabet):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.alphabet, words), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == words, at + 1, 0)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of symbol + match from the intervals of the matches."""
        a, b = self.transform.rank(symbol, low, high)
        base = self.first[symbol]
        gone = symbol == 0
        return np.where(gone, 0, base + a), np.where(gone, 0, base + b)

    def statistics(self, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(matched words up to ``length``, block or -1) at each place of the streamed documents."""
        symbols = self.numbers(words)
        matched, found = np.zeros(len(words), np.int64), np.full(len(words), -1, np.int64)
        lanes = np.flatnonzero(np.diff(bounds) > 0)
        at = bounds[1:][lanes] - 1
        low, high, size = np.zeros(len(lanes), np.int64), np.full(len(lanes), self.n), np.zeros(len(lanes), np.int64)
        while len(lanes):
            a, b = self.extend(symbols[at], low, high)
            size = size + 1
            for k in np.flatnonzero(a >= b):
                a[k], b[k], size[k] = self._longest(symbols, int(at[k]), int(size[k]) - 1)
            # Longer than asked: widen to all suffixes that share ``length`` words.
            full = size >= self.length
            size = np.minimum(size, self.length)
            block = self.block[np.minimum(a, self.n - 1)]
            a, b = np.where(full, self.low[block], a), np.where(full, self.high[block], b)
            matched[at], found[at] = size, np.where(full, block, -1)
            stay = at > bounds[lanes]
            lanes, at, low, high, size = lanes[stay], at[stay] - 1, a[stay], b[stay], size[stay]
        return matched, found

    def _longest(self, symbols: np.ndarray, at: int, most: int) -> tuple[int, int, int]:
        """The longest match that starts at a place, of at most ``most`` words: prefixes of a match occur, so bisect its length."""
        best, least = (0, self.n, 0), 0
        while least < most:
            middle = (least + most + 1) // 2
            low, high = np.zeros(1, np.int64), np.full(1, self.n)
            for k in range(at + middle - 1, at - 1, -1):
                low, high = self.extend(symbols[k : k + 1], low, high)
                if low[0] >= high[0]:
                    break
            if low[0] < high[0]:
                best, least = (int(low[0]), int(high[0]), middle), middle
            else:
                most = middle - 1
        return best


def solver(data: np.ndarray, offsets: np.ndarray, first: np.ndarray, length: int):
    """Spans of segments whose windows occur under an id below the segment's own least id."""
    starts, ends, bounds = textbatch.split_words(data, offsets)
    words = textbatch.hash_spans(data, starts, ends)
    index = FMIndex(words, bounds, length)
    _, block = index.statistics(words, bounds)
    least = np.minimum.reduceat(np.append(first, np.iinfo(np.int64).max)[np.minimum(index.segment, len(first))], index.low)
    owner = np.repeat(np.arange(len(first)), np.diff(bounds))
    hit = np.flatnonzero((block >= 0) & (least[block] < first[owner]))
    if not len(hit):
        return (np.zeros(0, np.int64),) * 4
    # Neighbouring windows make one span, under the greatest of their ids: any id below the segment's own will do.
    fresh = np.concatenate(([True], (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])))
    heads = np.flatnonzero(fresh)
    last = hit[np.append(heads[1:], len(hit)) - 1]
    begin = hit[heads]
    return owner[begin], begin - bounds[owner[begin]], last - begin + length, np.maximum.reduceat(least[block[hit]], heads)


def dedup(docs: DataFrame, length: int = 50, gram: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept, intervals): remaining words joined by one space, and (first word, words) of the removed runs.

    A word goes if a window of ``length`` consecutive words that covers it also starts in a document with a smaller id; windows are judged on
    the input. A null text has no words; null ids count as greater than all others; repeated ids are rows of their own; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def finish(batch, data, offsets, units, gone):
        n = batch.num_rows
        stay = ~gone
        size = (units.ends - units.starts)[stay]
        # A word and the space after it, gathered from the text with one space written behind each word.
        words = np.full(int(size.sum()) + len(size), 0x20, np.uint8)
        ends = np.cumsum(size + 1)
        inside = np.ones(len(words), bool)
        inside[ends - 1] = False
        words[inside] = textbatch.gather(data, units.starts[stay], size)
        kept_before = np.concatenate(([0], np.cumsum(stay)))[units.rows]
        bytes_before = np.concatenate(([0], ends))[kept_before]
        text = words.tobytes()
        kept = [text[a : max(a, b - 1)] for a, b in zip(bytes_before[:-1].tolist(), bytes_before[1:].tolist())]
        edge = np.zeros(len(gone) + 1, bool)
        edge[units.rows] = True
        begin = np.flatnonzero(gone & (np.concatenate(([True], ~gone[:-1])) | edge[:-1]))
        end = np.flatnonzero(gone & (np.concatenate((~gone[1:], [True])) | edge[1:])) + 1
        rows = np.searchsorted(begin, units.rows)
        base = units.rows[:-1][np.repeat(np.arange(n), np.diff(rows))]
        spans = pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.StructArray.from_arrays(
            [pa.array(begin - base), pa.array(end - begin)], ["first", "words"]))
        total = np.diff(units.rows)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(total), pa.array(total - np.diff(kept_before)), spans, pa.array(kept, pa.binary())],
                                          ["id", "n_words", "n_removed", "intervals", "kept"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return repeats.marks(rows, repeats.Rule("words", length, min(gram, length)), solver, finish,
                         f"id {kind}, n_words long, n_removed long, intervals array<struct<first:long,words:long>>, kept binary")



"""Suffix-array dedup: maximal repeats from the common-prefix interval tree of an enhanced suffix array.

A shard's distinct segments (see ``repeats``) are indexed by a suffix array with longest-common-prefix values and left neighbours. A stack scan
over runs of values of at least ``length`` finds the intervals of the common-prefix tree; an interval whose members all follow the
same byte is no maximal repeat, since the longer string one byte to the left has the same members, and is passed over. Every other interval
is a repeat group with all its occurrences, not just neighbours in the array: each member is marked by the group's least document id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechtable.llm import repeats

#: Bytes in a packed comparison word: 9 bits each, so that the end of a segment sorts before byte 0.
_PACK = 7


def enhanced(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(position, segment, lcp, ends of the padded segments): suffixes of at least ``length`` bytes in order, with the
    bytes each shares with the one before it (exact where it is ``length`` or more)."""
    sizes = np.diff(offsets)
    padded = offsets[:-1] + np.arange(len(sizes)) * _PACK
    symbols = np.zeros(len(data) + (len(sizes) + 1) * _PACK, np.uint64)
    symbols[np.arange(len(data)) + np.repeat(np.arange(len(sizes)) * _PACK, sizes)] = data.astype(np.uint64) + np.uint64(1)
    packed = np.zeros(len(symbols) - _PACK + 1, np.uint64)
    for j in range(_PACK):
        packed |= symbols[j : j + len(packed)] << np.uint64(9 * (_PACK - 1 - j))
    stops = padded + sizes
    starts = np.maximum(sizes - length + 1, 0)
    segment = np.repeat(np.arange(len(sizes)), starts)
    position = padded[segment] + np.arange(len(segment)) - np.repeat(np.cumsum(starts) - starts, starts)
    order = np.argsort(packed[position], kind="stable")
    position, segment = position[order], segment[order]
    lcp = np.zeros(len(position), np.int64)
    slots, depth, head = np.arange(len(position)), 0, np.zeros(len(position), np.int64)
    while len(slots):
        if depth:
            at = position[slots] + depth
            word = np.where(at < stops[segment[slots]], packed[np.minimum(at, len(packed) - 1)], np.uint64(0))
            inner = np.lexsort((word, head))
            position[slots], segment[slots], word = position[slots][inner], segment[slots][inner], word[inner]
        else:
            word = packed[position]
        # Neighbours of one group that differ in this word part here; those that have both ended are equal.
        joined = head[1:] == head[:-1]
        differ = word[1:] != word[:-1]
        parted = np.flatnonzero(joined & differ)
        lcp[slots[parted + 1]] = depth + (_PACK * 9 - 1 - _top_bit(word[parted + 1] ^ word[parted])) // 9
        ended = np.flatnonzero(joined & ~differ & (word[1:] == 0))
        lcp[slots[ended + 1]] = stops[segment[slots[ended + 1]]] - position[slots[ended + 1]]
        tied = joined & ~differ & (word[1:] != 0)
        stay = np.concatenate((tied, [False])) | np.concatenate(([False], tied))
        head = np.cumsum(np.concatenate(([True], ~tied)))[stay]
        slots = slots[stay]
        depth += _PACK
    return position, segment, lcp, stops


def _top_bit(x: np.ndarray) -> np.ndarray:
    """Index of the highest set bit."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x | (x >> np.uint64(shift))
    return np.bitwise_count(x).astype(np.int64) - 1


def intervals(lcp: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, common bytes) of every interval of the common-prefix tree of at least ``length``; lcp[0] is below ``length``."""
    stack: list[tuple[int, int]] = []  # (first, value), values rise
    for i, value in enumerate(lcp.tolist() + [0]):
        first = i - 1
        while stack and stack[-1][1] > value:
            first, top = stack.pop()
            yield first, i - 1, top
        if value >= length and (not stack or stack[-1][1] < value):
            stack.append((first, value))


def groups(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(segments, places in them, common bytes) of the maximal repeats of a shard, each with all its occurrences."""
    position, segment, lcp, stops = enhanced(data, offsets, length)
    begin = stops - np.diff(offsets)
    place = position - begin[segment]
    left = np.full(len(position), -1, np.int64)
    inner = place > 0
    left[inner] = data[offsets[segment[inner]] + place[inner] - 1]
    # Where a segment begins, its left neighbour is unknown: such a member always counts as different.
    changes = np.concatenate(([0], np.cumsum(np.concatenate(([0], (left[1:] != left[:-1]) | (left[1:] < 0))))[: len(left)]))
    deep = lcp >= length
    edges = np.flatnonzero(np.diff(np.concatenate(([False], deep, [False])).astype(np.int8)))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        # Slots a-1 .. b-1 share at least ``length`` bytes; without any change of the left byte none of them is maximal.
        a -= 1
        if changes[b] == changes[a + 1] and left[a] >= 0:
            continue
        for first, last, common in intervals(np.concatenate(([0], lcp[a + 1 : b])), length):
            first, last = first + a, last + a
            if left[first] < 0 or changes[last + 1] != changes[first + 1]:
                yield segment[first : last + 1], place[first : last + 1], common


def solver(data: np.ndarray, offsets: np.ndarray, first: np.ndarray, length: int):
    """Spans of segments that repeat under an id below the segment's own least id."""
    out = [], [], [], []
    for member, place, common in groups(data, offsets, length):
        least = first[member].min()
        later = first[member] > least
        n = int(later.sum())
        if n:
            for values, new in zip(out, (member[later], place[later], np.full(n, common), np.full(n, least))):
                values.append(new)
    return tuple(np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for v in out)


def dedup(docs: DataFrame, length: int = 50, gram: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, kept, spans): the remaining bytes of every text, and (start, length) of the maximal removed runs.

    A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller id; strings are judged on the input. A
    null text is empty; null ids count as greater than all others; repeated ids are rows of their own; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def finish(batch, data, offsets, units, gone):
        n = batch.num_rows
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begin = np.flatnonzero(gone & (np.concatenate(([True], ~gone[:-1])) | edge[:-1]))
        end = np.flatnonzero(gone & (np.concatenate((~gone[1:], [True])) | edge[1:])) + 1
        rows = np.searchsorted(begin, offsets)
        base = offsets[:-1][np.repeat(np.arange(n), np.diff(rows))]
        spans = pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.StructArray.from_arrays(
            [pa.array(begin - base), pa.array(end - begin)], ["start", "length"]))
        bounds = (offsets - np.concatenate(([0], np.cumsum(end - begin)))[rows]).astype(np.int32)
        kept = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data[~gone]))])
        return pa.RecordBatch.from_arrays([batch.column(0), kept, spans], ["id", "kept", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return repeats.marks(rows, repeats.Rule("bytes", length, min(gram, length)), solver, finish,
                         f"id {kind}, kept binary, spans array<struct<start:long,length:long>>")


def dedup_texts(docs: DataFrame, length: int = 50, gram: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes gone from its texts, all columns kept.

    Only whole characters go: of a character that is partly repeated all bytes stay. A null text stays null.
    """

    def finish(batch, data, offsets, units, gone):
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        if len(lead):
            gone = np.repeat(np.logical_and.reduceat(gone, lead), np.diff(np.append(lead, len(data))))
        kept = np.concatenate(([0], np.cumsum(~gone)))[offsets].astype(np.int32)
        text = pa.Array.from_buffers(pa.string(), batch.num_rows, [None, pa.py_buffer(kept), pa.py_buffer(np.ascontiguousarray(data[~gone]))])
        text = pc.if_else(batch.column(1).is_valid(), text, pa.scalar(None, pa.string()))
        return pa.RecordBatch.from_arrays([batch.column(2), text], ["row", "text"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*(_named(c) for c in docs.columns if c != text_col)).alias("row"))
    kind = T.StructType([rows.schema["row"], T.StructField("text", T.StringType())])
    found = repeats.marks(rows, repeats.Rule("bytes", length, min(gram, length)), solver, finish, kind)
    return found.select(*(F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns))


def _named(column: str) -> Column:
    """The column of a name that may hold dots and backticks."""
    quoted = column.replace("`", "``")
    return F.col(f"`{quoted}`")

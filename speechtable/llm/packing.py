"""Packing of documents into training sequences: bounded-space best fit.

A task keeps at most ``windows`` open sequences. A document's whole sequences leave at once; its rest goes to the open window with the
least room it fits into, else to a new window. When none fits and all windows are open, the fullest is topped up with
the first tokens of the document (if it has at least ``min_cut`` places left) and leaves. What is still open at the end of the tasks
is merged in groups of ``merge_tasks`` tasks, cutting pieces at full sequences; the last tokens of a group are cut
into sequences whose lengths are powers of two, which need no padding.

Scale: no shuffle but that of the leftovers (at most ``windows`` sequences a task); a task's memory is its windows and one batch. Ids of
words are cached up to ``CACHE_WORDS`` distinct words a process. Sequence ids are (partition, counter), so a retried task numbers alike.

Special tokens written out in a text become their ids, as the library has it by default. A null text is an empty document; every document ends with the end id. Null and repeated ids are documents of their own; other columns
are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechtable import settings
from speechtable.llm import pretoken, textbatch

CACHE_WORDS = 1_000_000
_ROW = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class WordCache:
    """Token ids of words, by word hash, in flat arrays."""

    def __init__(self, encode, limit: int = CACHE_WORDS, marks: tuple[bytes, ...] = (), encode_text=None):
        self.encode, self.limit, self.marks, self.encode_text = encode, limit, marks, encode_text
        self._clear()

    def _clear(self) -> None:
        self.keys, self.starts, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def add(self, keys: np.ndarray, words: list[bytes]) -> None:
        lists = self.encode(words)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in lists for i in x), np.uint32, int(sizes.sum()))])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.starts, self.sizes = (np.insert(a, at, b) for a, b in ((self.keys, keys), (self.starts, starts), (self.sizes, sizes)))

    def chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, ids before each row and in all)."""
        ids, before = self._by_words(data, offsets)
        marked = self._marked(data, offsets)
        if not marked:
            return ids, before
        parts = [ids[a:b] for a, b in zip(before[:-1].tolist(), before[1:].tolist())]
        for row in marked:
            parts[row] = np.array(self.encode_text(data[offsets[row] : offsets[row + 1]].tobytes().decode()), np.uint32)
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))

    def _marked(self, data: np.ndarray, offsets: np.ndarray) -> list[int]:
        """Rows that hold the text of a special token: the library cuts a text there before it looks for words."""
        text, found = data.tobytes(), set()
        for mark in self.marks:
            at = text.find(mark)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, "right")) - 1
                if at + len(mark) <= offsets[row + 1]:
                    found.add(row)
                at = text.find(mark, at + 1)
        return sorted(found)

    def _by_words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, rows = pretoken.split(data, offsets)
        ends = np.append(starts[1:], len(data))
        hashes = textbatch.hash_spans(data, starts, ends)
        order, heads, run = textbatch.distinct(hashes)
        sample = order[heads]
        keys = hashes[sample]
        known = np.zeros(len(keys), bool)
        if len(self.keys) and len(keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = self.keys[at] == keys
        if not known.all():
            if len(self.keys) + int((~known).sum()) > self.limit:
                self._clear()
                known[:] = False
            text = data.tobytes()
            new = sample[~known]
            self.add(keys[~known], [text[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
        at = np.searchsorted(self.keys, keys)
        which = np.empty(len(starts), np.int64)
        which[order] = at[run] if len(run) else at[:0]
        sizes = self.sizes[which]
        before = np.concatenate(([0], np.cumsum(sizes)))
        return textbatch.gather(self.ids, self.starts[which], sizes), before[rows]


_CACHES: dict[str, WordCache] = {}


def library_cache(path: str) -> WordCache:
    """Word ids by the tokenizers library, one cache a process."""
    if path not in _CACHES:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        _CACHES[path] = WordCache(
            lambda words: [e.ids for e in tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)],
            marks=tuple(t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()),
            encode_text=lambda text: tokenizer.encode(text, add_special_tokens=False).ids)
    return _CACHES[path]


class Packer:
    """Open windows of one task."""

    def __init__(self, size: int, windows: int, min_cut: int, first: int):
        self.size, self.windows, self.min_cut, self.number = size, windows, min_cut, first
        self.open: dict[int, list] = {}  # window -> pieces (doc, start, ids, doc tokens)
        self.rooms: list[tuple[int, int]] = []  # (room, window), sorted
        self.opened = 0
        self.done: list[tuple] = []

    def _emit(self, pieces: list) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.done.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.number, at))
            at += len(ids)
        self.number += 1

    def _put(self, place: int, piece: tuple) -> None:
        room, window = self.rooms.pop(place)
        self.open[window].append(piece)
        room -= len(piece[2])
        if room:
            insort(self.rooms, (room, window))
        else:
            self._emit(self.open.pop(window))

    def add(self, doc, ids: np.ndarray) -> None:
        total, at = len(ids), 0
        while total - at >= self.size:
            self._emit([(doc, at, ids[at : at + self.size], total)])
            at += self.size
        if at == total:
            return
        place = bisect_left(self.rooms, (total - at, -1))
        if place == len(self.rooms) and len(self.open) >= self.windows:
            room, window = self.rooms[0]
            if room >= self.min_cut:
                self._put(0, (doc, at, ids[at : at + room], total))
                at += room
            else:
                self.rooms.pop(0)
                self._emit(self.open.pop(window))
            place = bisect_left(self.rooms, (total - at, -1))
        if place == len(self.rooms):
            self.opened += 1
            self.open[self.opened] = []
            insort(self.rooms, (self.size, self.opened))
            place = len(self.rooms) - 1
        self._put(place, (doc, at, ids[at:], total))


def pack(docs: DataFrame, path: str, end_id: int = 1, size: int = 2048, windows: int = 64, min_cut: int = 8, merge_tasks: int = 64,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset. ``path`` names the tokenizers file."""
    kind = docs.schema[id_col].dataType.simpleString()

    def arrays(rows: list, ids: list, part: int, doc_type) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * 7
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], doc_type), *(pa.array(c, pa.int64()) for c in columns[1:]), pa.array([part] * len(rows), pa.int64()), pa.array(ids, pa.binary())],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "part", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, part = library_cache(path), TaskContext.get().partitionId()
        packer, end, doc_type = Packer(size, windows, min_cut, part << 32), np.array([end_id], "<u4"), None
        for batch in batches:
            doc_type, names = batch.column(0).type, batch.column(0).to_pylist()
            for a, b, data, offsets in textbatch.chunks(batch.column(1)):
                ids, rows = cache.chunk(data, offsets)
                for k in range(a, b):
                    packer.add(names[k], np.concatenate([ids[rows[k - a] : rows[k - a + 1]], end]).astype("<u4", copy=False))
            yield arrays(packer.done, [None] * len(packer.done), part, doc_type)
            packer.done = []
        if packer.open:
            rest, ids = [], []
            for window, pieces in packer.open.items():
                at = 0
                for doc, start, piece, total in pieces:
                    rest.append((doc, start, len(piece), None, total, None, (window << 20) + at))
                    ids.append(piece.tobytes())
                    at += len(piece)
            yield arrays(rest, ids, part, doc_type)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not parts:
            return
        whole = pa.Table.from_batches(parts).sort_by([("part", "ascending"), ("offset", "ascending")])
        doc_type, groups = whole["doc_id"].type, whole["part"].to_numpy() // merge_tasks
        for group in np.unique(groups):
            packer = Packer(size, 1, 1, (1 << 62) + (int(group) << 32))
            rows = whole.filter(pa.array(groups == group))
            pieces = [(d, s, np.frombuffer(i, "<u4"), t) for d, s, i, t in zip(*(rows[c].to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")))]
            for sequence in _refill(pieces, size):
                packer._emit(sequence)
            yield arrays(packer.done, [None] * len(packer.done), 0, doc_type)

    schema = f"doc_id {kind}, {_ROW}, part long, ids binary"
    packed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
    packed = settings.materialize(packed, "packed")
    rest = packed.where("sequence_id IS NULL")
    groups = F.floor(F.col("part") / merge_tasks)
    merged = rest.repartition(groups).mapInArrow(merge, schema)
    return packed.where("sequence_id IS NOT NULL").unionByName(merged).drop("part", "ids")


def _refill(pieces: list, size: int) -> Iterator[list]:
    """Sequences of exactly ``size`` tokens, then powers of two."""
    left = sum(len(p[2]) for p in pieces)
    want, held, sequence = 0, 0, []
    for doc, start, ids, total in pieces:
        at = 0
        while at < len(ids):
            if not sequence:
                want, held = size if left >= size else 1 << (left.bit_length() - 1), 0
            take = min(want - held, len(ids) - at)
            sequence.append((doc, start + at, ids[at : at + take], total))
            at, held, left = at + take, held + take, left - take
            if held == want:
                yield sequence
                sequence = []

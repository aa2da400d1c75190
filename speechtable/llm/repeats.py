"""Passages that repeat across documents: which ``length`` units in a row also start in a document with a smaller id.

Units are bytes or words. Suffix and FM indexes of whole shards of a corpus cannot be built against each other, so the work is cut along
anchors: the place of the least hash among the k-grams of a window of ``length`` units, and the units beside it on the side where the window holds
more of them. Equal windows have equal anchors, wherever they stand; with the units beside it an anchor is about two thirds of a window long, so that frequent
k-grams alone make no candidates.

1. ``anchor_store`` counts in how many documents each anchor occurs; only anchors of two or more are kept.
2. ``segments``: neighbouring windows with one such anchor form a segment (at most ``MAX_RUN`` windows). Distinct segments travel to
   the shard of their anchor with the least and greatest document id, once per ``PORTION`` of them however often they occur.
3. A solver indexes the distinct segments of a shard and reports spans of a segment that occur in a document before its first one. Segments whose
   anchor no other first document has need none. A segment is named with its shard in front, so that its spans stay in that shard.
4. ``apply`` looks the segments of every document up in the mapped result and marks the spans.

No window is lost: equal windows lie in segments of one shard. Texts are never shuffled whole, and documents never meet under one key: a
passage of a third of all documents is one distinct segment per portion. Where its edges differ in every document the anchor is hot
(``HOT`` documents): its windows then travel one by one to a shard chosen by the anchor and both ends of the window, so that windows which
reach into their own document's text part.

Null texts are empty. A null id counts as greater than all others. Rows with one id are one document to the rule "smaller id", yet stay rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from speechtable.llm import store, textbatch

MAX_RUN = 128
HOT = 4096
#: Bytes of text at a time: arrays hold 8 bytes a unit.
CHUNK = {"bytes": 1 << 20, "words": 2 << 20}
#: Windows whose hashes are made at a time, so that they stay in the processor's cache.
BLOCK = 1 << 17
#: Anchors, and bytes of segments, that a task gathers before it deals them out: a shard's share of a chunk alone is small where shards are many.
ANCHORS, PORTION = 1 << 21, 16 << 20
_LAST = np.iinfo(np.int64).max
#: (segment bodies, offsets, least id of each) -> (segment, first unit, units, id) of spans that also occur under a smaller id.
Solver = Callable[[np.ndarray, np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Rule:
    """Units ("bytes" or "words"), window length, and the k-gram anchors are taken from."""

    units: str
    length: int
    gram: int


@dataclass
class Units:
    """Units of a chunk (bytes, or hashed words), first unit of each row, and where units lie in the bytes."""

    values: np.ndarray
    rows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def prefix(self) -> tuple[np.ndarray, np.ndarray]:
        return textbatch.prefix_hash(textbatch.byte_values(self.values) if self.values.dtype == np.uint8 else self.values)


def units_of(data: np.ndarray, offsets: np.ndarray, rule: Rule) -> Units:
    if rule.units == "bytes":
        at = np.arange(len(data) + 1)
        return Units(data, offsets, at[:-1], at[1:])
    starts, ends, rows = textbatch.split_words(data, offsets)
    return Units(textbatch.hash_spans(data, starts, ends), rows, starts, ends)


@dataclass
class Runs:
    """Windows of a chunk grouped by anchor: first unit, number of windows, anchor, row."""

    start: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    row: np.ndarray


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    n, size = len(values) - width + 1, 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:n], values[width - size : width - size + n])


def gram_hashes(values: np.ndarray, gram: int) -> np.ndarray:
    """Hash of each ``gram`` neighbours; of 8 to 16 bytes as two words that cover them."""
    n = len(values) - gram + 1
    if values.dtype != np.uint8 or not 8 <= gram <= 16:
        at = np.arange(n)
        return textbatch.span_hash(textbatch.prefix_hash(textbatch.byte_values(values) if values.dtype == np.uint8 else values), at, at + gram)
    words = np.ndarray((len(values) - 7,), "<u8", np.ascontiguousarray(values), 0, (1,))
    h = words[:n] * np.uint64(0x9E3779B97F4A7C55)
    h ^= h >> np.uint64(32)
    h += words[gram - 8 :]
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h


def runs_of(units: Units, rule: Rule) -> Runs:
    total = len(units.values) - rule.length + 1
    parts = [_block_runs(units, at, min(at + BLOCK, total), rule) for at in range(0, total, BLOCK)] if (np.diff(units.rows) >= rule.length).any() else []
    none = np.zeros(0, np.int64)
    start, windows, anchor = (np.concatenate(p) for p in zip(*parts)) if parts else (none, none, none.view(np.uint64))
    return Runs(start, windows, anchor, np.searchsorted(units.rows, start, "right") - 1)


def _block_runs(units: Units, begin: int, end: int, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, anchor) for the windows [begin, end), in order."""
    slack, n = rule.length - rule.gram, end - begin
    hashes = gram_hashes(units.values[begin : end + rule.length - 1], rule.gram)
    least = sliding_min(hashes, slack + 1)
    change = np.ones(n, bool)
    change[1:] = least[1:] != least[:-1]
    # Windows over the end of a row are none.
    bounds = units.rows[np.searchsorted(units.rows, begin, "right") : np.searchsorted(units.rows, end + rule.length - 1)] - begin
    change[bounds[bounds < n]] = True
    change[np.maximum(bounds - rule.length + 1, 0)] = True
    start = np.flatnonzero(change)
    stop = np.append(start[1:], n)
    if len(bounds):
        over = np.append(bounds, n + rule.length)
        inside = start + rule.length <= over[np.searchsorted(bounds, start, "right")]
        start, stop = start[inside], stop[inside]
    parts = -(-(stop - start) // MAX_RUN)
    first = np.repeat(start, parts) + (np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)) * MAX_RUN
    last = np.minimum(np.repeat(stop, parts), first + MAX_RUN) - 1
    # Of several least grams of a window the first one counts. One that has just come in stands at the window's end.
    gram = first + slack
    search = np.flatnonzero((first == 0) | (least[first] >= least[first - 1]))
    gram[search] = _first_least(hashes, least, first[search], slack)
    more = np.flatnonzero(last > gram)
    if len(more):
        times = last[more] - gram[more]
        single = np.repeat(gram[more] + 1 - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
        at = _first_least(hashes, least, single, slack)
        heads = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (single[1:] != single[:-1] + 1))))
        tails = np.append(heads[1:], len(at)) - 1
        last = np.minimum(last, gram)
        first, last, gram = np.concatenate([first, single[heads]]), np.concatenate([last, single[tails]]), np.concatenate([gram, at[heads]])
    # Windows that hold at least half of the other units before the gram, then those that hold more behind it.
    half = (slack + 1) // 2
    before, behind = np.flatnonzero(first <= gram - half), np.flatnonzero(last > gram - half)
    anchor = np.concatenate([_anchors(hashes, gram[before] - half, half, rule.gram), _anchors(hashes, gram[behind], slack - half + 1, rule.gram)])
    start = np.concatenate([first[before], np.maximum(first[behind], gram[behind] - half + 1)])
    stop = np.concatenate([np.minimum(last[before], gram[before] - half), last[behind]]) + 1
    order = np.argsort(start)
    return start[order] + begin, (stop - start)[order], anchor[order]


def _first_least(hashes: np.ndarray, least: np.ndarray, windows: np.ndarray, slack: int) -> np.ndarray:
    """Place of the first gram of each window that has its least hash."""
    out, grams = np.empty(len(windows), np.int64), np.lib.stride_tricks.sliding_window_view(hashes, slack + 1)
    for at in range(0, len(windows), 4096):
        some = windows[at : at + 4096]
        out[at : at + 4096] = some + (grams[some] == least[some][:, None]).argmax(axis=1)
    return out


def _anchors(hashes: np.ndarray, at: np.ndarray, wider: int, gram: int) -> np.ndarray:
    """Hash of the ``gram + wider`` units from each place, out of the grams that cover them."""
    out = hashes[at]
    for step in [*range(gram, wider, gram), wider]:
        out = textbatch.mix(out + np.uint64(0xA5A5A5A5DEADBEEF)) ^ hashes[at + step]
    # Least hashes crowd at small values; mixed again they spread over the shards.
    return textbatch.mix(out ^ np.uint64(0xA5A5A5A5DEADBEEF))


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(_LAST).to_numpy()


def anchor_store(docs: DataFrame, rule: Rule) -> store.Store:
    """Anchors of two or more documents, and of how many. ``docs`` has id and text."""

    def deal(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        key, n = (np.concatenate(p) for p in zip(*parts))
        order, heads, _ = textbatch.distinct(key, stable=False)
        n = np.add.reduceat(n[order], heads) if len(heads) else n
        yield from store.pack(pa.RecordBatch.from_arrays([pa.array(key[order][heads].view(np.int64)), pa.array(n)], ["anchor", "n"]), bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for _, _, data, offsets in textbatch.chunks(batch.column(0), CHUNK[rule.units]):
                runs = runs_of(units_of(data, offsets, rule), rule)
                order = np.argsort(runs.anchor)
                key = runs.anchor[order]
                fresh = np.ones(len(key), bool)
                fresh[1:] = key[1:] != key[:-1]
                # Where anchors are equal their rows stand in order.
                ties = np.flatnonzero(~fresh | ~np.append(fresh[1:], True))
                order[ties] = order[ties][np.lexsort((runs.row[order[ties]], key[ties]))]
                row = runs.row[order]
                pair = fresh.copy()
                pair[1:] |= row[1:] != row[:-1]
                heads = np.flatnonzero(fresh)
                parts.append((key[heads], np.add.reduceat(pair.astype(np.int32), heads) if len(heads) else np.zeros(0, np.int32)))
                held += len(heads)
                if held >= ANCHORS:
                    yield from deal(parts)
                    parts, held = [], 0
        if held:
            yield from deal(parts)

    bits = store.bits_for(docs)
    counted = docs.select("text").mapInArrow(run, store.PACKED)
    return store.build(counted, "anchor", {"n": "<u4"}, _shared, bits, packed=True)


def _shared(keys: np.ndarray, values: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    order, heads, _ = textbatch.distinct(keys, stable=False)
    total = np.add.reduceat(values["n"][order].astype(np.int64), heads) if len(heads) else np.zeros(0, np.int64)
    keep = total >= 2
    return keys[order][heads][keep], {"n": np.minimum(total[keep], 0xFFFFFFFF).astype("<u4")}


@dataclass
class Segments:
    """Candidate segments of a chunk: units [start, stop), the shard key, the identity, the row."""

    start: np.ndarray
    stop: np.ndarray
    route: np.ndarray
    name: np.ndarray
    row: np.ndarray


def segments(units: Units, rule: Rule, anchors: store.Store) -> Segments:
    runs = runs_of(units, rule)
    order = np.argsort(runs.anchor)
    found, columns = anchors.find(runs.anchor[order])
    count = np.zeros(len(order), np.int64)
    count[order] = np.where(found, columns["n"], 0)
    plain, hot = np.flatnonzero((count > 0) & (count < HOT)), np.flatnonzero(count >= HOT)
    prefix = units.prefix() if len(plain) or len(hot) else textbatch.prefix_hash(np.zeros(0, np.uint64))
    times = runs.windows[hot]
    single = np.repeat(runs.start[hot], times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    end = min(8, rule.length)
    ends = textbatch.span_hash(prefix, single, single + end) ^ textbatch.span_hash(prefix, single + rule.length - end, single + rule.length) * np.uint64(3)
    start = np.concatenate([runs.start[plain], single])
    stop = np.concatenate([runs.start[plain] + runs.windows[plain], single + 1]) + rule.length - 1
    route = np.concatenate([runs.anchor[plain], textbatch.mix(np.repeat(runs.anchor[hot], times) ^ ends)])
    row = np.concatenate([runs.row[plain], np.repeat(runs.row[hot], times)])
    return Segments(start, stop, route, _filed(textbatch.span_hash(prefix, start, stop), route, anchors.bits), row)


def _filed(name: np.ndarray, route: np.ndarray, bits: int) -> np.ndarray:
    """Names in the shard of their route."""
    rest = np.uint64(64 - bits)
    return route >> rest << rest | name >> np.uint64(bits)


def solve(docs: DataFrame, rule: Rule, anchors: store.Store, solver: Solver) -> store.Store:
    """Spans of segments under a smaller id: by segment name, the first unit, the units and that id."""
    bits = store.bits_for(docs)

    def deal(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        name, route, first, last, size, body = (np.concatenate(p) for p in zip(*parts))
        order, heads, _ = textbatch.distinct(name, stable=False)
        one = order[heads]
        body = textbatch.binary_array(body, size).take(pa.array(one)).cast(pa.binary())
        # The name follows from the body; it need not travel.
        yield from store.pack(pa.RecordBatch.from_arrays([
            pa.array(route[one].view(np.int64)), pa.array(np.minimum.reduceat(first[order], heads)), pa.array(np.maximum.reduceat(last[order], heads)), body],
            ["route", "first", "last", "body"]), bits)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            ids = _ids(batch.column(0))
            for a, _, data, offsets in textbatch.chunks(batch.column(1), CHUNK[rule.units]):
                units = units_of(data, offsets, rule)
                found = segments(units, rule, anchors)
                order, heads, _ = textbatch.distinct(found.name, stable=False)
                if not len(heads):
                    continue
                doc = ids[a + found.row[order]]
                one = order[heads]
                begin, size = units.starts[found.start[one]], units.ends[found.stop[one] - 1] - units.starts[found.start[one]]
                parts.append((found.name[one], found.route[one], np.minimum.reduceat(doc, heads), np.maximum.reduceat(doc, heads), size, textbatch.gather(data, begin, size)))
                held += len(parts[-1][-1])
                if held >= PORTION:
                    yield from deal(parts)
                    parts, held = [], 0
        if held:
            yield from deal(parts)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = store.unpack(batches)
        if not parts:
            return
        whole = pa.Table.from_batches(parts).combine_chunks()
        del parts
        name = np.concatenate([_names(data, offsets, rule) for _, _, data, offsets in textbatch.chunks(whole["body"], CHUNK[rule.units])])
        name = _filed(name, whole["route"].to_numpy().view(np.uint64), bits)
        order, heads, _ = textbatch.distinct(name, stable=False)
        first = np.minimum.reduceat(whole["first"].to_numpy()[order], heads)
        last = np.maximum.reduceat(whole["last"].to_numpy()[order], heads)
        one = order[heads]
        name, route = name[one], whole["route"].to_numpy()[one].view(np.uint64)
        data, offsets = textbatch.flat(whole["body"].combine_chunks().take(pa.array(one)))
        del whole
        by = np.argsort(route, kind="stable")
        edge = np.flatnonzero(np.concatenate(([True], route[by][1:] != route[by][:-1])))
        times = np.diff(np.append(edge, len(by)))
        # Only a segment that first occurs after another one of its anchor can hold units of an earlier document.
        mixed = np.minimum.reduceat(first[by], edge) < np.maximum.reduceat(first[by], edge)
        alone, by = by[~np.repeat(mixed, times)], by[np.repeat(mixed, times)]
        alone = alone[first[alone] != last[alone]]
        whole = np.full(len(alone), 0xFFFFFFFF, np.int64)
        found = [(name[alone], np.zeros(len(alone), np.int64), whole, first[alone])]
        # A task indexes its segments in portions of whole anchors, about 4 MB each.
        portion = np.cumsum(np.diff(offsets)[by]) // (4 << 20)
        times = times[mixed]
        group = np.repeat(portion[np.cumsum(times) - times], times)
        for number in np.unique(group):
            pick = by[group == number]
            size = np.diff(offsets)[pick]
            part = textbatch.gather(data, offsets[pick], size)
            segment, begin, units, doc = solver(part, np.concatenate(([0], np.cumsum(size))), first[pick], rule.length)
            segment, begin, units, doc = united(segment, begin, units, doc)
            # All later documents of a segment repeat it whole; where an earlier one does so for all, they need no row of their own.
            long = np.zeros(len(pick), np.int64)
            np.maximum.at(long, segment, np.where(begin == 0, units, 0))
            many = np.flatnonzero((first[pick] != last[pick]) & (long < _sizes(part, size, rule)))
            total = np.concatenate([np.full(len(many), 0xFFFFFFFF, np.int64), units])
            found.append((name[pick][np.concatenate([many, segment])], np.concatenate([np.zeros(len(many), np.int64), begin]), total,
                          np.concatenate([first[pick][many], doc])))
        name, begin, units, doc = (np.concatenate(p) for p in zip(*found))
        yield from store.pack(pa.RecordBatch.from_arrays([
            pa.array(name.view(np.int64)), pa.array(begin.astype(np.uint32)), pa.array(units.astype(np.uint32)), pa.array(doc)], ["name", "begin", "units", "doc"]), bits)

    rows = store.place_packed(docs.select("id", "text").mapInArrow(emit, store.PACKED), bits).mapInArrow(index, store.PACKED)
    return store.build(rows, "name", {"begin": "<u4", "units": "<u4", "doc": "<i8"}, bits=bits, placed=True, packed=True)


def _names(data: np.ndarray, offsets: np.ndarray, rule: Rule) -> np.ndarray:
    """Identity of each body, the same as ``segments`` gives the units in their document."""
    units = units_of(data, offsets, rule)
    return textbatch.span_hash(units.prefix(), units.rows[:-1], units.rows[1:])


def _sizes(data: np.ndarray, sizes: np.ndarray, rule: Rule) -> np.ndarray:
    """Units of each body."""
    return sizes if rule.units == "bytes" else np.diff(units_of(data, np.concatenate(([0], np.cumsum(sizes))), rule).rows)


def united(segment: np.ndarray, begin: np.ndarray, units: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping or touching spans of a segment as one, under their greatest id: all ids are below the segment's own least one, so any of them
    tells a document of the segment that an earlier one holds the units."""
    order = np.lexsort((begin, segment))
    segment, begin, stop, doc = segment[order], begin[order], (begin + units)[order], doc[order]
    if not len(segment):
        return segment, begin, stop, doc
    # Reach so far inside a segment: a running maximum over places that grow from segment to segment.
    wide = int(stop.max()) + 1
    reach = np.maximum.accumulate(segment * wide + stop)
    fresh = np.concatenate(([True], segment[1:] * wide + begin[1:] > reach[:-1]))
    heads = np.flatnonzero(fresh)
    tails = np.append(heads[1:], len(segment)) - 1
    return segment[heads], begin[heads], reach[tails] - segment[heads] * wide - begin[heads], np.maximum.reduceat(doc, heads)


def covered(units: Units, ids: np.ndarray, rule: Rule, anchors: store.Store, spans: store.Store) -> np.ndarray:
    """Which units of a chunk lie in a window that also starts under a smaller id. ``ids`` are the rows' ids."""
    found = segments(units, rule, anchors)
    order, heads, run = textbatch.distinct(found.name, stable=False)
    names = found.name[order][heads]
    owner, columns = spans.find_all(names)
    # Each occurrence of a segment meets the segment's spans.
    sizes = np.bincount(owner, minlength=len(names))
    first = np.cumsum(sizes) - sizes
    which = np.empty(len(order), np.int64)
    which[order] = run
    times = sizes[which]
    occurrence = np.repeat(np.arange(len(order)), times)
    span = textbatch.gather(np.arange(len(owner)), first[which], times)
    smaller = columns["doc"][span] < ids[found.row[occurrence]]
    occurrence, span = occurrence[smaller], span[smaller]
    if not len(span):
        return np.zeros(len(units.values), bool)
    begin = found.start[occurrence] + columns["begin"][span]
    stop = np.minimum(begin + columns["units"][span], found.stop[occurrence])
    change = np.bincount(begin, minlength=len(units.values) + 1) - np.bincount(stop, minlength=len(units.values) + 1)
    return np.cumsum(change[: len(units.values)]) > 0


def marks(docs: DataFrame, rule: Rule, solver: Solver, finish: Callable, schema: str | StructType) -> DataFrame:
    """Run all steps over ``docs`` (id, text, any others); ``finish(batch, rows, data, offsets, units, covered)`` makes a chunk's output."""
    narrow = docs.select("id", "text")
    anchors = anchor_store(narrow, rule)
    spans = solve(narrow, rule, anchors, solver)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch.column(0))
            for a, b, data, offsets in textbatch.chunks(batch.column(1), CHUNK[rule.units]):
                units = units_of(data, offsets, rule)
                yield finish(batch.slice(a, b - a), data, offsets, units, covered(units, ids[a:b], rule, anchors, spans))

    return docs.select("id", "text", *(c for c in docs.columns if c not in ("id", "text"))).mapInArrow(run, schema)

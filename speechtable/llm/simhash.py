"""SimHash near-duplicates over a Gray-order hierarchical index.

``fingerprints`` gives every document the 64-bit SimHash of its word shingles. ``near_groups`` links fingerprints that
differ in at most ``radius`` bits and returns the component of every document.

The index: distinct fingerprints are sorted by Gray rank, so that neighbours share most bits, and a tree factors shared bit patterns
into upper nodes: a child keeps only the bits its parent does not hold, a search adds the differences found on the way
down and drops a whole group as soon as they exceed ``radius``.

Scale: equal fingerprints are one row before anything is compared. Nine arrangements move chosen bits to the front; rows meet in a task by 35
front bits, and every pair within two bits meets in at least one arrangement, so no link is lost, each fingerprint travels nine
times whatever the size, and a dense family is dealt out by the bits its members differ in. A task returns a spanning forest of its links,
never all pairs. A null text counts as empty, an empty text has fingerprint zero; repeated and null ids stay rows of their own; input
columns other than the named two are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechtable import settings
from speechtable.llm import store, textbatch
from speechtable.llm.components import components


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``words`` words, repeats included; fewer words: of the whole sequence."""
    tokens = text.lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words))))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits set in more than half of the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[at : at + (1 << 16)]).astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp): the fingerprint as a long with the same 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            values = [majority(shingle_hashes(t.as_py() or b"", words)) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(values, np.uint64).view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp long")


def gray_ranks(fp: np.ndarray) -> np.ndarray:
    """Place of each code word in the Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp ^ (fp >> np.uint64(shift))
    return fp


class GrayTree:
    """Levels of (pattern, mask) over leaves in Gray order; a node's mask holds only bits its parent lacks."""

    def __init__(self, patterns: np.ndarray, masks: np.ndarray, fanout: int = 8):
        self.fanout, self.levels = fanout, []
        values, masks = patterns & masks, masks.copy()
        while True:
            n = len(values)
            if n <= fanout:
                self.levels.append((values, masks))
                break
            heads = np.arange(0, n, fanout)
            both = np.bitwise_and.reduceat(values, heads)
            shared = np.bitwise_and.reduceat(masks, heads) & ~(np.bitwise_or.reduceat(values, heads) ^ both)
            own = masks & ~np.repeat(shared, fanout)[:n]
            self.levels.append((values & own, own))
            values, masks = both & shared, shared
        self.levels.reverse()

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) of all pairs with at most ``radius`` differing known bits."""
        top = len(self.levels[0][0])
        query = np.repeat(np.arange(len(queries)), top)
        node = np.tile(np.arange(top), len(queries))
        differing = np.zeros(len(query), np.uint8)
        for depth, (values, masks) in enumerate(self.levels):
            if depth:
                query, differing = np.repeat(query, self.fanout), np.repeat(differing, self.fanout)
                node = (node[:, None] * self.fanout + np.arange(self.fanout)).ravel()
                inside = node < len(values)
                query, node, differing = query[inside], node[inside], differing[inside]
            differing = differing + np.bitwise_count((queries[query] ^ values[node]) & masks[node])
            near = differing <= radius
            query, node, differing = query[near], node[near], differing[near]
        return query, node


class Forest:
    """Union-find that remembers the links which joined two trees."""

    def __init__(self, n: int):
        self.root, self.links = np.arange(n), []

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        root = self.root
        while not np.array_equal(up := root[root], root):
            root = up
        self.root = root
        a, b = root[left], root[right]
        apart = a != b
        if not apart.any():
            return
        pairs = np.unique(np.stack([a[apart], b[apart]], 1), axis=0).tolist()
        parent: dict[int, int] = {}

        def find(x):
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        for x, y in pairs:
            rx, ry = find(x), find(y)
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
                self.links.append((x, y))
        for x in parent:
            root[x] = find(x)


def _widths(n: int) -> list[int]:
    return [n - 2 * (n // 3), n // 3, n // 3]


def _turn(x: np.ndarray, width: int, by: int) -> np.ndarray:
    """Rotate the lowest ``width`` bits to the left."""
    if not by:
        return x
    low = x & np.uint64((1 << width) - 1) if width < 64 else x
    turned = (low << np.uint64(by)) | (low >> np.uint64(width - by))
    return turned if width == 64 else (turned & np.uint64((1 << width) - 1)) | (x ^ low)


def arrangements(fp: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """(fingerprints with chosen bits in front, number of these bits), nine times.

    Of three blocks, two differing bits leave one alike; of three blocks of the other bits again one. So two fingerprints within two bits
    agree in the front bits of at least one arrangement.
    """
    blocks = _widths(64)
    for i, block in enumerate(blocks):
        rest = 64 - block
        turned = _turn(fp, 64, sum(blocks[:i]))
        inner = _widths(rest)
        for j, sub in enumerate(inner):
            yield _turn(turned, rest, sum(inner[:j])), block + sub


def _links(arranged: np.ndarray, turn: np.ndarray, rep: np.ndarray, radius: int) -> np.ndarray:
    """Spanning forest of a task's rows: every arrangement is an index of its own, and all its rows ask it."""
    forest = Forest(len(rep))
    for number in np.unique(turn):
        here = np.flatnonzero(turn == number)
        here = here[np.argsort(gray_ranks(arranged[here]), kind="stable")]
        fp = arranged[here]
        tree = GrayTree(fp, np.full(len(fp), ~np.uint64(0)))
        for at in range(0, len(fp), 256):
            query, leaf = tree.search(fp[at : at + 256], radius)
            forest.add(here[query + at], here[leaf])
    return rep[np.array(forest.links, np.int64).reshape(-1, 2)]


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """(id, fp, component): component is the smallest id reachable over links of at most ``radius`` (0 to 2) differing bits."""
    if not 0 <= radius <= 2:
        raise ValueError("radius must be 0, 1 or 2: nine arrangements find no more")
    prints = settings.materialize(fingerprints(docs, id_col, text_col, words), "fingerprints")
    kind = prints.schema["id"].dataType.simpleString()
    classes = prints.groupBy("fp").agg(F.min("id").alias("rep"))
    bits = store.bits_for(prints)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for number, (arranged, front) in enumerate(arrangements(fp)):
                group = textbatch.mix((arranged >> np.uint64(64 - front)) + (np.uint64(number + 1) << np.uint64(60)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group.view(np.int64)), pa.array(np.full(len(fp), number, np.int32)), pa.array(arranged.view(np.int64)), batch.column(1)],
                    ["group", "turn", "arranged", "rep"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if parts:
            turn, arranged, rep = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in parts]) for i in (1, 2, 3))
            pairs = _links(arranged.view(np.uint64), turn, rep, radius)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    # Null ids can only lead a class whose ids are all null; such rows stay alone.
    routed = classes.where("rep IS NOT NULL").mapInArrow(spread, f"group long, turn int, arranged long, rep {kind}")
    edges = store.place(routed, "group", bits).mapInArrow(link, f"a {kind}, b {kind}")
    found = components(edges, "a", "b")
    by_print = classes.join(found, classes["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("component"))
    return prints.join(by_print, "fp").select("id", "fp", "component")

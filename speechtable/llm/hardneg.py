"""Hard negatives by inner product, with candidates from length buckets of sorted coordinate lists.

Vectors become integers (``floor(scale * x)``) and are cut into *length buckets*: runs of one label by falling length, at most ``BUCKET`` rows. A
bucket stores, for each coordinate, its rows in the order of that coordinate of the direction. For an anchor q and a score bound t, a row of a
bucket with greatest length m can only qualify if the angle between both is at most arccos(t / (|q| m)): a bucket whose bound
exceeds 1 is skipped, and otherwise each of the anchor's *focus coordinates* (its largest) leaves a range of feasible values, which is a run of that coordinate's
list. The runs are intersected, what is left is scored exactly in integers. The bound rises as better rows are found.

Two searches: the ``positives`` best rows of the anchor's own label, then for each positive with score p the ``negatives`` best rows of other
labels with ``low * p <= of * score <= high * p``. Higher scores come first, ties by the smaller id. Nothing is approximate.

Scale: anchors are the stated query set. Anchors and buckets meet in a grid of groups of bounded bytes (rows: one copy for each group of
anchors, anchors: one copy for each group of buckets of the label or, for negatives, of all), so neither a hot label nor a common
vector makes a large task. A group keeps its best rows only; these are ranked over all groups.

Rows take no part if their id, label or vector is null, if the vector holds null or non-finite components, or if its integer length exceeds
2^31 (a score would not fit a long). Vectors of unlike dimension are never compared; an empty vector scores 0 with its like. Repeated rows and ids are rows of
their own. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from speechtable import settings

#: Rows of a length bucket at most; ``MIN_BUCKET`` at least, where lengths fall below ``NARROW`` of the greatest.
BUCKET, MIN_BUCKET, NARROW = 2048, 64, 0.9
#: Focus coordinates of an anchor.
FOCUS = 6
#: Bytes of buckets and number of anchors that one group of the grid holds; groups there are at least where buckets suffice.
GROUP_BYTES, GROUP_ANCHORS, GROUPS = 64 << 20, 8192, 12
#: Room for rounding in feasible ranges.
_SLACK = 1e-9
_LONGEST = float(1 << 31)
_BUCKETS = "bucket long, dims int, label string, n int, top double, ids binary, vectors binary, orders binary, asks binary"
_ANCHORS = "row long, id long, dims int, label string, vector binary"


def hard_negatives(vectors: DataFrame, asks: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
                   scale: int = 256, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, of: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows that satisfy ``asks``."""
    buckets = settings.materialize(length_buckets(vectors, asks, id_col, label_col, vector_col, scale), "buckets")
    anchors = settings.materialize(_anchors(buckets), "anchors")
    kind = "row long, anchor_id long, other long, score long"
    best = _searched(buckets, anchors, ["dims", "label"], _positives(positives), kind)
    order = W.partitionBy("row").orderBy(F.desc("score"), "other")
    best = best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    found = best.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "other", "score"))).alias("found"))
    asked = settings.materialize(anchors.join(found, "row"), "positives")
    kind = "row long, place int, anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    made = _searched(buckets, asked, ["dims"], _negatives(negatives, low, high, of), kind)
    order = W.partitionBy("row", "place").orderBy(F.desc("negative_score"), "negative_id")
    made = made.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return made.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def length_buckets(vectors: DataFrame, asks: Column, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """Buckets of one dimension and label, by falling length."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                          F.coalesce(asks, F.lit(False)).alias("ask"), F.col(vector_col).cast("array<double>").alias("x"))
    x = F.col("x")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(True)))

    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            ends = lists.offsets.to_numpy()
            with np.errstate(over="ignore", invalid="ignore"):
                values = np.floor(scale * lists.values.to_numpy(zero_copy_only=False))
            dims = np.diff(ends)
            lengths = np.zeros(len(dims))
            for d in np.unique(dims[dims > 0]).tolist():
                which = np.flatnonzero(dims == d)
                with np.errstate(over="ignore", invalid="ignore"):
                    lengths[which] = np.sqrt((values[ends[:-1][which][:, None] + np.arange(d)] ** 2).sum(1))
            keep = np.flatnonzero(lengths <= _LONGEST)
            if not len(keep):
                continue
            held = [values[ends[i] : ends[i + 1]].astype("<i4").tobytes() for i in keep.tolist()]
            picked = batch.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays([picked.column(0), picked.column(1), picked.column(2), pa.array(dims[keep], pa.int32()),
                                              pa.array(lengths[keep]), pa.array(held, pa.binary())], ["id", "label", "ask", "dims", "length", "vector"])

    made = rows.mapInArrow(integers, "id long, label string, ask boolean, dims int, length double, vector binary")
    order = [F.col("dims"), F.col("label"), F.desc("length"), F.col("id")]
    return made.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_cut, _BUCKETS)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 28
    key, held = None, []

    def buckets(whole: bool) -> Iterator[pa.RecordBatch]:
        """Buckets from the start of what is held; all of it, or while a full bucket is there."""
        nonlocal held, number
        ids, asks, lengths, vectors = (np.concatenate(part) for part in zip(*held))
        at = 0
        while at < len(ids) and (whole or len(ids) - at >= BUCKET):
            part = lengths[at : at + BUCKET]
            short = np.flatnonzero(part < NARROW * part[0])
            end = at + (max(int(short[0]), MIN_BUCKET) if len(short) else len(part))
            end = min(end, len(ids))
            unit = _unit(vectors[at:end], lengths[at:end])
            orders = np.argsort(unit, axis=0, kind="stable").astype("<u2").T
            yield pa.RecordBatch.from_pylist([{
                "bucket": number, "dims": key[0], "label": key[1], "n": end - at, "top": float(part[0]), "ids": ids[at:end].tobytes(),
                "vectors": vectors[at:end].tobytes(), "orders": np.ascontiguousarray(orders).tobytes(), "asks": asks[at:end].tobytes()}], _schema())
            number, at = number + 1, end
        held = [(ids[at:], asks[at:], lengths[at:], vectors[at:])] if at < len(ids) else []

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ids, asks = batch.column(0).to_numpy().astype("<i8"), batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint8)
        labels, dims, lengths = batch.column(1).to_pylist(), batch.column(3).to_numpy(), batch.column(4).to_numpy()
        texts = np.array(labels, object)
        runs = [0, *(np.flatnonzero((texts[1:] != texts[:-1]) | (dims[1:] != dims[:-1])) + 1).tolist(), n]
        for a, b in zip(runs, runs[1:]):
            now = int(dims[a]), labels[a]
            if now != key and held:
                yield from buckets(True)
            key = now
            vectors = np.frombuffer(b"".join(batch.column(5).slice(a, b - a).to_pylist()), "<i4").reshape(b - a, now[0])
            held.append((ids[a:b], asks[a:b], lengths[a:b], vectors))
            if sum(len(h[0]) for h in held) >= BUCKET:
                yield from buckets(False)
    if held:
        yield from buckets(True)


def _schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _BUCKETS.split(", ")])


def _unit(vectors: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return vectors / np.where(lengths > 0, lengths, 1.0)[:, None]


def _anchors(buckets: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                at = np.flatnonzero(np.frombuffer(r["asks"], np.uint8))
                vectors = np.frombuffer(r["vectors"], "<i4").reshape(r["n"], r["dims"])
                yield pa.RecordBatch.from_arrays([
                    pa.array(r["bucket"] * BUCKET + at, pa.int64()), pa.array(np.frombuffer(r["ids"], "<i8")[at], pa.int64()),
                    pa.array([r["dims"]] * len(at), pa.int32()), pa.array([r["label"]] * len(at), pa.string()),
                    pa.array([vectors[i].tobytes() for i in at], pa.binary())], ["row", "id", "dims", "label", "vector"])

    return buckets.mapInArrow(run, _ANCHORS)


def _searched(buckets: DataFrame, anchors: DataFrame, keys: list[str], search, kind: str) -> DataFrame:
    """All pairs of a group of buckets and a group of anchors with equal keys, each searched as one task's unit."""
    size = F.octet_length("ids") + F.octet_length("vectors") + F.octet_length("orders")
    least = F.least(F.count("*"), F.lit(GROUPS))
    has = buckets.groupBy(*keys).agg(F.greatest(F.ceil(F.sum(size) / GROUP_BYTES), least).cast("int").alias("_down"))
    ask = anchors.groupBy(*keys).agg(F.ceil(F.count("*") / GROUP_ANCHORS).cast("int").alias("_over"))
    grid = has.join(ask, keys)
    left = buckets.join(grid, keys).withColumn("_r", F.pmod(F.xxhash64("bucket"), "_down").cast("int"))
    left = left.withColumn("_c", F.explode(F.sequence(F.lit(0), F.col("_over") - 1))).drop("_down", "_over", "asks")
    right = anchors.join(grid, keys).withColumn("_c", F.pmod(F.xxhash64("row"), "_over").cast("int"))
    right = right.withColumn("_r", F.explode(F.sequence(F.lit(0), F.col("_down") - 1))).drop("_down", "_over")
    group = [*keys, "_r", "_c"]
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(search, kind)


@dataclass
class Bucket:
    """One length bucket in memory."""

    number: int
    label: str
    top: float
    ids: np.ndarray
    vectors: np.ndarray
    orders: np.ndarray
    exact: np.ndarray
    unit: np.ndarray
    _lists: dict[int, np.ndarray] = field(default_factory=dict)

    @classmethod
    def read(cls, table: pa.Table, i: int) -> Bucket:
        r = {c: table[c][i].as_py() for c in ("bucket", "label", "n", "dims", "top", "ids", "vectors", "orders")}
        vectors = np.frombuffer(r["vectors"], "<i4").reshape(r["n"], r["dims"])
        exact = vectors.astype(np.float64)
        return cls(r["bucket"], r["label"], r["top"], np.frombuffer(r["ids"], "<i8"), vectors,
                   np.frombuffer(r["orders"], "<u2").reshape(r["dims"], r["n"]), exact, _unit(vectors, np.sqrt((exact * exact).sum(1))))

    def values(self, f: int) -> np.ndarray:
        """The coordinate's list: its values in order."""
        if f not in self._lists:
            self._lists[f] = self.unit[self.orders[f], f]
        return self._lists[f]

    def candidates(self, anchor: Anchor, bound: float) -> np.ndarray | None:
        """Rows that can reach the bound; None where all can."""
        if bound <= 0 or not anchor.length * self.top:
            return None if bound <= 0 else np.zeros(0, np.int64)
        cosine = bound / (anchor.length * self.top)
        if cosine > 1 + _SLACK:
            return np.zeros(0, np.int64)
        wide = np.arccos(min(1.0, max(-1.0, cosine - _SLACK)))
        least = np.cos(np.minimum(np.pi, anchor.angles + wide)) - _SLACK
        most = np.cos(np.maximum(0.0, anchor.angles - wide)) + _SLACK
        ranges = []
        for f, a, b in zip(anchor.focus, least, most):
            ordered = self.values(f)
            ranges.append((int(np.searchsorted(ordered, a)), int(np.searchsorted(ordered, b, "right")), f, a, b))
        start, end, first, _, _ = min(ranges, key=lambda r: r[1] - r[0])
        found = self.orders[first][start:end]
        for _, _, f, a, b in sorted(ranges, key=lambda r: r[1] - r[0])[1:]:
            value = self.unit[found, f]
            found = found[(value >= a) & (value <= b)]
        return found

    def scores(self, anchor: Anchor, rows: np.ndarray | None) -> np.ndarray:
        if anchor.length * self.top < 2.0**53:
            return ((self.exact if rows is None else self.exact[rows]) @ anchor.exact).astype(np.int64)
        return (self.vectors if rows is None else self.vectors[rows]).astype(np.int64) @ anchor.vector


class Anchor:
    """One anchor: its largest coordinates first, and where they point."""

    def __init__(self, row: int, id: int, label: str, vector: bytes):
        self.row, self.id, self.label = row, id, label
        self.vector = np.frombuffer(vector, "<i4").astype(np.int64)
        self.exact = self.vector.astype(np.float64)
        self.length = float(np.sqrt((self.exact * self.exact).sum()))
        self.focus = np.argsort(-np.abs(self.exact), kind="stable")[:FOCUS].tolist()
        self.angles = np.arccos(np.clip(self.exact[self.focus] / (self.length or 1.0), -1.0, 1.0))


class Best:
    """The k best (score, id) so far within [least, most]."""

    def __init__(self, k: int, least: float = -np.inf, most: float = np.inf):
        self.k, self.least, self.most = k, least, most
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def bound(self) -> float:
        """What a row must reach to count."""
        return max(self.least, float(self.scores[-1])) if len(self.scores) == self.k else self.least

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fit = (scores >= self.bound()) & (scores <= self.most)
        if not fit.any():
            return
        scores, ids = np.concatenate([self.scores, scores[fit]]), np.concatenate([self.ids, ids[fit]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def _walk(left: pa.Table, anchors: list[tuple[Anchor, list[Best]]], same: bool) -> None:
    """Every anchor through the buckets of its own label or of the others, longest first."""
    for i in np.argsort(-left["top"].to_numpy(), kind="stable").tolist() if left.num_rows else []:
        bucket = Bucket.read(left, i)
        for anchor, best in anchors:
            if (anchor.label == bucket.label) != same or not best:
                continue
            rows = bucket.candidates(anchor, min(b.bound() for b in best))
            if rows is not None and not len(rows):
                continue
            scores, ids = bucket.scores(anchor, rows), bucket.ids if rows is None else bucket.ids[rows]
            own = anchor.row - bucket.number * BUCKET
            if 0 <= own < len(bucket.ids):
                other = (np.arange(len(bucket.ids)) if rows is None else rows) != own
                scores, ids = scores[other], ids[other]
            for b in best:
                b.add(scores, ids)


def _positives(k: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        anchors = [(Anchor(r["row"], r["id"], r["label"], r["vector"]), [Best(k)]) for r in right.to_pylist()]
        _walk(left, anchors, True)
        sizes = [len(best.ids) for _, (best,) in anchors]
        long = pa.int64()
        return pa.table({
            "row": pa.array(np.repeat(np.array([a.row for a, _ in anchors], np.int64), sizes), long),
            "anchor_id": pa.array(np.repeat(np.array([a.id for a, _ in anchors], np.int64), sizes), long),
            "other": pa.array(np.concatenate([np.zeros(0, np.int64), *(b.ids for _, (b,) in anchors)]), long),
            "score": pa.array(np.concatenate([np.zeros(0, np.int64), *(b.scores for _, (b,) in anchors)]), long)})

    return search


def _negatives(k: int, low: int, high: int, of: int):
    kinds = [("row", pa.int64()), ("place", pa.int32()), ("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("negative_id", pa.int64()),
             ("positive_score", pa.int64()), ("negative_score", pa.int64())]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        anchors, given = [], []
        for r in right.to_pylist():
            bands = [(p, -(-low * p["score"] // of), high * p["score"] // of) for p in r["found"]]
            bands = [band for band in bands if band[1] <= band[2]]
            anchors.append((Anchor(r["row"], r["id"], r["label"], r["vector"]), [Best(k, a, b) for _, a, b in bands]))
            given.append([p for p, _, _ in bands])
        _walk(left, anchors, False)
        rows = [(a.row, p["place"], a.id, p["other"], i, p["score"], s)
                for (a, best), band in zip(anchors, given) for b, p in zip(best, band) for i, s in zip(b.ids.tolist(), b.scores.tolist())]
        columns = list(zip(*rows)) if rows else [()] * len(kinds)
        return pa.table({name: pa.array(list(column), kind) for (name, kind), column in zip(kinds, columns)})

    return search

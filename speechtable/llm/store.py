"""Sorted hash arrays in the shared folder, memory-mapped by the tasks that look keys up.

A store has 2^bits shards by the top bits of an unsigned 64-bit key. A shard file is its sorted keys followed by one
array per column. Files carry a name of their own per attempt, and only the names that finished tasks return are used,
so a retried task or a lost executor leaves at most a file nobody reads. On a shared folder that is not a mounted file
system a process copies a shard to its temporary folder when it first needs it and removes it at exit.
"""

from __future__ import annotations

import atexit
import functools
import json
import math
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechtable import settings
from speechtable.sources import files

#: Rows of one task at a time: (unsorted unsigned keys, columns) in, the same out.
Reduce = Callable[[np.ndarray, dict[str, np.ndarray]], tuple[np.ndarray, dict[str, np.ndarray]]]


@dataclass
class Store:
    """Where the shards lie; small, so that it travels with the task."""

    bits: int
    columns: tuple[tuple[str, str], ...]
    shards: dict[int, tuple[str, int]]
    totals: dict[str, int] = field(default_factory=dict)
    #: First keys of the shards after the first, where the top bits do not name the shard.
    cuts: np.ndarray | None = None
    _open: dict = field(default_factory=dict, repr=False, compare=False)

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def __len__(self) -> int:
        return sum(n for _, n in self.shards.values())

    def shard(self, number: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Mapped (keys, columns) of a shard."""
        if number not in self._open:
            path, n = self.shards.get(number, ("", 0))
            local = _local(path) if n else ""
            arrays, at = [], 0
            for kind in ("<u8", *(kind for _, kind in self.columns)):
                # A plain view of the map: NumPy's own class costs some microseconds a call.
                arrays.append(np.asarray(np.memmap(local, np.dtype(kind), "r", at, (n,))) if n else np.zeros(0, kind))
                at += n * np.dtype(kind).itemsize
            self._open[number] = arrays[0], dict(zip((name for name, _ in self.columns), arrays[1:]))
        return self._open[number]

    def offsets(self) -> dict[int, int]:
        """Rows before each shard, in key order."""
        out, total = {}, 0
        for number in sorted(self.shards):
            out[number] = total
            total += self.shards[number][1]
        return out

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Place of each sorted key among all keys of the store, -1 where unknown."""
        out, offsets = np.full(len(keys), -1, np.int64), self.offsets()
        for number, a, b in self._parts(keys):
            known, _ = self.shard(number)
            if len(known):
                at = np.minimum(np.searchsorted(known, keys[a:b]), len(known) - 1)
                out[a:b] = np.where(known[at] == keys[a:b], at + offsets[number], -1)
        return out

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """(found, columns) for sorted keys; columns hold zeros where a key is unknown. Keys are unique in the store."""
        found = np.zeros(len(keys), bool)
        out = {name: np.zeros(len(keys), kind) for name, kind in self.columns}
        for number, a, b in self._parts(keys):
            known, columns = self.shard(number)
            if not len(known):
                continue
            at = np.minimum(np.searchsorted(known, keys[a:b]), len(known) - 1)
            found[a:b] = hit = known[at] == keys[a:b]
            for name, values in columns.items():
                out[name][a:b][hit] = values[at[hit]]
        return found, out

    def find_all(self, keys: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """(index into keys, columns): one entry per stored row whose key is among the sorted keys."""
        index, out = [], {name: [] for name, _ in self.columns}
        for number, a, b in self._parts(keys):
            known, columns = self.shard(number)
            low = np.searchsorted(known, keys[a:b], "left")
            sizes = np.searchsorted(known, keys[a:b], "right") - low
            rows = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
            index.append(np.repeat(np.arange(a, b), sizes))
            for name, values in columns.items():
                out[name].append(np.asarray(values[rows]))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return join(index, np.int64), {name: join(out[name], kind) for name, kind in self.columns}

    def _parts(self, keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
        if not len(keys):
            return
        owner = shards_of(keys, self.bits, self.cuts)
        cuts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        for a, b in zip(cuts, np.append(cuts[1:], len(keys))):
            yield int(owner[a]), int(a), int(b)


def shards_of(keys: np.ndarray, bits: int, cuts: np.ndarray | None = None) -> np.ndarray:
    """Shard of each unsigned key."""
    if cuts is not None:
        return np.searchsorted(cuts, keys, "right")
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def bits_for(df: DataFrame) -> int:
    """Shards follow the session's shuffle partitions."""
    return max(3, math.ceil(math.log2(max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))))


#: Rows on the way to a shard: the columns of many rows compressed together, one value per chunk and shard.
PACKED = "shard int, rows binary"
_ZSTD = pa.Codec("zstd")
#: Bytes of unpacked rows in a batch.
_BATCH = 1 << 29


def pack(batch: pa.RecordBatch, bits: int) -> Iterator[pa.RecordBatch]:
    """Deal a batch out to shards by its first column, unsigned 64-bit keys. Sorted keys travel as differences: a few bytes less each.

    The other columns are numbers, strings or binary values without nulls. Shards are many and a shard's share of a batch may be small, so it carries
    its bytes and one short head, not a stream of Arrow's with its schema.
    """
    keys = batch.column(0).to_numpy().view(np.uint64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    cuts = np.flatnonzero(np.diff(shards_of(keys, bits), prepend=-1))
    if not len(cuts):
        return
    rows, columns = batch.take(pa.array(order)), []
    for column in rows.columns[1:]:
        if pa.types.is_primitive(column.type):
            columns.append((column.to_numpy(), None))
        else:
            column = column.slice(0)
            _, ends, data = column.buffers()
            ends = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
            columns.append((np.frombuffer(data if data is not None else b"", np.uint8), ends))
    head = json.dumps([[f.name, str(f.type)] for f in rows.schema]).encode()
    parts = []
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)]):
        raw = [len(head).to_bytes(4, "little"), (b - a).to_bytes(8, "little"), head, np.diff(keys[a:b], prepend=np.uint64(0)).tobytes()]
        for values, ends in columns:
            raw += [values[a:b].tobytes()] if ends is None else [np.diff(ends[a : b + 1]).tobytes(), values[ends[a] : ends[b]].tobytes()]
        raw = b"".join(raw)
        parts.append(len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True))
    yield pa.RecordBatch.from_arrays([pa.array(shards_of(keys[cuts], bits), pa.int32()), pa.array(parts, pa.binary())], ["shard", "rows"])


def unpack(batches: Iterator[pa.RecordBatch]) -> list[pa.RecordBatch]:
    """The rows ``pack`` dealt out, keys as int64, in few batches."""
    out, held, size = [], {}, 0

    def flush() -> None:
        for head, parts in held.items():
            names, kinds = zip(*json.loads(head))
            arrays = []
            for k, kind in enumerate(kinds):
                kind = pa.int64() if not k else pa.type_for_alias(kind)
                values = np.concatenate([p[k][0] for p in parts])
                if parts[0][k][1] is None:
                    arrays.append(pa.array(values, kind))
                else:
                    ends = np.concatenate(([0], np.cumsum(np.concatenate([p[k][1] for p in parts]))))
                    arrays.append(pa.Array.from_buffers(kind, len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)]))
            out.append(pa.RecordBatch.from_arrays(arrays, list(names)))
        held.clear()

    for batch in batches:
        for blob in batch.column(1):
            blob = blob.as_buffer()
            raw = _ZSTD.decompress(blob.slice(8), decompressed_size=int.from_bytes(blob.slice(0, 8).to_pybytes(), "little"), asbytes=True)
            at, n = 12 + int.from_bytes(raw[:4], "little"), int.from_bytes(raw[4:12], "little")
            head = raw[12:at]
            columns = [(np.cumsum(np.frombuffer(raw, np.uint64, n, at), dtype=np.uint64).view(np.int64), None)]
            at += 8 * n
            for kind in _kinds(head)[1:]:
                if kind is None:
                    sizes = np.frombuffer(raw, np.int32, n, at)
                    columns.append((np.frombuffer(raw, np.uint8, int(sizes.sum()), at + 4 * n), sizes))
                    at += 4 * n + len(columns[-1][0])
                else:
                    columns.append((np.frombuffer(raw, kind, n, at), None))
                    at += kind.itemsize * n
            held.setdefault(head, []).append(columns)
            size += len(raw)
            if size >= _BATCH:
                flush()
                size = 0
    flush()
    return out


@functools.cache
def _kinds(head: bytes) -> list[np.dtype | None]:
    """NumPy's kinds of the columns, None for values of varying size."""
    kinds = [pa.type_for_alias(kind) for _, kind in json.loads(head)]
    return [np.dtype(kind.to_pandas_dtype()) if pa.types.is_primitive(kind) else None for kind in kinds]


def place_packed(df: DataFrame, bits: int) -> DataFrame:
    return df.repartitionById(1 << bits, "shard")


def place(df: DataFrame, key: str, bits: int) -> DataFrame:
    """Bring the rows of a shard into one task: one shuffle by the top bits of the key."""
    return df.repartitionById(1 << bits, F.shiftrightunsigned(key, 64 - bits).cast("int") if bits else F.lit(0))


def build(df: DataFrame, key: str, columns: dict[str, str], reduce: Reduce | None = None, bits: int | None = None, placed: bool = False, packed: bool = False,
          cuts: np.ndarray | None = None, summary: Callable[[np.ndarray, dict[str, np.ndarray]], dict[str, int]] | None = None) -> Store:
    """Write a store from rows of ``df`` (``key`` long, read as unsigned; ``columns`` name to NumPy type).

    ``reduce`` merges equal keys of a shard. Keys must be hashes, so that shards are even, or else ``cuts`` says where shards begin.
    ``placed`` rows were dealt out by shard already, ``packed`` ones come from ``pack`` with the same bits. The numbers ``summary`` finds in a shard are added up in ``totals``.
    """
    spark, bits = df.sparkSession, bits_for(df) if bits is None else bits
    folder, kinds = settings.fresh_path(spark, "store"), tuple(columns.items())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = unpack(batches) if packed else batches
        parts = [(b.column(0).to_numpy(zero_copy_only=False), [b.column(i + 1).to_numpy(zero_copy_only=False) for i in range(len(kinds))]) for b in batches]
        if not parts:
            return
        keys = np.concatenate([p[0] for p in parts]).view(np.uint64)
        values = {name: np.concatenate([p[1][i] for p in parts]).astype(kind) for i, (name, kind) in enumerate(kinds)}
        del parts
        if reduce is not None:
            keys, values = reduce(keys, values)
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], {name: values[name][order].astype(kind) for name, kind in kinds}
        # Partitions hold whole shards, mostly one each.
        owner = shards_of(keys, bits, cuts)
        for number in np.flatnonzero(np.bincount(owner)) if len(owner) else ():
            a, b = np.searchsorted(owner, [number, number + 1])
            path = put(folder, [keys[a:b], *(values[name][a:b] for name, _ in kinds)])
            note = json.dumps({k: int(v) for k, v in summary(keys[a:b], {n: v[a:b] for n, v in values.items()}).items()}) if summary else "{}"
            yield pa.RecordBatch.from_pydict({"shard": pa.array([number], pa.int32()), "path": [path], "n": pa.array([b - a], pa.int64()), "note": [note]})

    if packed:
        rows = df if placed else place_packed(df, bits)
    else:
        rows = df.select(key, *columns)
        rows = rows if placed else place(rows, key, bits)
    files = rows.mapInArrow(write, "shard int, path string, n long, note string").collect()
    totals: dict[str, int] = {}
    for r in files:
        for k, v in json.loads(r["note"]).items():
            totals[k] = totals.get(k, 0) + v
    return Store(bits, kinds, {r["shard"]: (r["path"], r["n"]) for r in files}, totals, cuts)


def over_shards(spark: SparkSession, store: Store, fn: Callable[[int, np.ndarray, dict[str, np.ndarray]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Rows ``fn`` makes of each shard (number, keys, columns), one task per shard."""
    numbers = sorted(store.shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                yield from fn(numbers[k], *store.shard(numbers[k]))

    return spark.range(0, len(numbers), 1, max(1, len(numbers))).mapInArrow(run, schema)


def put(folder: str, arrays: list[np.ndarray]) -> str:
    """Write arrays one after another to a new file below the folder."""
    system, root = files.locate(folder)
    system.create_dir(root, recursive=True)
    name = uuid.uuid4().hex
    with system.open_output_stream(f"{root}/{name}") as out:
        for values in arrays:
            out.write(np.ascontiguousarray(values).data)
    return f"{folder}/{name}"


_COPIES: list[str] = []


def _local(uri: str) -> str:
    system, path = files.locate(uri)
    if isinstance(system, fs.LocalFileSystem):
        return path
    if not _COPIES:
        _COPIES.append(tempfile.mkdtemp(prefix="store-"))
        atexit.register(shutil.rmtree, _COPIES[0], True)
    target = os.path.join(_COPIES[0], os.path.basename(path))
    if not os.path.exists(target):
        with system.open_input_stream(path) as source, open(f"{target}.part", "wb") as out:
            shutil.copyfileobj(source, out, 1 << 20)
        os.replace(f"{target}.part", target)
    return target

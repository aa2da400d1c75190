"""Tar shards as a Spark data source: ``spark.read/write.format("tarshards")``.

Reading: one range per shard; a plain tar larger than ``splitBytes`` is read in several ranges. A partition is one range, or, where there are more
ranges than ``tasks``, neighbouring ranges of some bytes together, so that small shards do not make a task each. Where an index (``tarindex``) or the writer's
manifest says where samples start, a partition opens its range right there, at a cost that does not depend on the range's place; without one its task
walks the headers before it (``read_tarshards`` and ``read_listed`` then build an index first). Writing: tasks write whole numbered shards under names of
their attempt, the manifest of the commit (``manifest``) says which of them count, so a retried or killed task leaves nothing that is read.
"""

from __future__ import annotations

import contextlib
import io
import tarfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)

from speechtable import settings
from speechtable.operators.ordering import assign_shards
from speechtable.sources import files, manifest, tarindex
from speechtable.sources.ingest import pcm_bytes, wave_header
from speechtable.sources.manifest import is_complete  # noqa: F401
from speechtable.sources.tarindex import escaped, named

SHARD_STRIDE = 1 << 32  # ordinal = shard number * stride + sample number
BATCH_BYTES = 32 << 20
#: Bytes of ranges one task reads together at most; a larger range is a task of its own.
TASK_BYTES = 128 << 20
MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")
#: Samples between two entries of a written shard.
EVERY = 1000

READ_SCHEMA = (
    "shard string, ordinal bigint, key string, members map<string, binary>, sizes map<string, bigint>, error string"
)
_BATCH = pa.schema([
    ("shard", pa.string()), ("ordinal", pa.int64()), ("key", pa.string()),
    ("members", pa.map_(pa.string(), pa.binary())), ("sizes", pa.map_(pa.string(), pa.int64())), ("error", pa.string()),
])


@dataclass
class ShardRange(InputPartition):
    """Samples that start in [start, stop); reading opens the shard at ``entry``, where sample ``sample`` starts."""

    path: str
    number: int
    start: int
    stop: int
    entry: int = 0
    sample: int = 0


@dataclass
class ShardRanges(InputPartition):
    """Ranges one task reads, in order."""

    ranges: list[ShardRange]


def grouped(ranges: list[ShardRange], sizes: list[int], tasks: int) -> list[ShardRanges]:
    """Neighbouring ranges together, of about the same bytes: as many groups as ``tasks``, more where these would hold over ``TASK_BYTES``."""
    # Opening a range costs about as much as reading some of it.
    costs = [size + (64 << 10) for size in sizes]
    share, held, out = min(TASK_BYTES, sum(costs) / tasks), 0, []
    for part, cost in zip(ranges, costs):
        if not out or held + cost / 2 > share:
            out.append(ShardRanges([]))
            held = 0
        out[-1].ranges.append(part)
        held += cost
    return out


def list_shards(path: str) -> list[fs.FileInfo]:
    """Shard files of a path: itself, or those below it that count (plain tars first, by path)."""
    system, inner = files.locate(path)
    found = system.get_file_info(inner)
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(f"Input not found: {path}")
    if found.type == fs.FileType.File:
        return [found]
    below = [f for f in system.get_file_info(fs.FileSelector(inner, recursive=True)) if f.type == fs.FileType.File]
    shards = [f for f in manifest.only_listed(below, system) if f.base_name.endswith(manifest.SHARD_SUFFIXES)]
    visible = [f for f in shards if not f.base_name.startswith((".", "_"))]
    return sorted(visible, key=lambda f: (f.base_name.endswith(".gz"), f.path.split("/")))


def listed_shards(path: str) -> list[tuple[str, int, fs.FileInfo]]:
    """(uri, bytes, file) of the shards of a path, in order."""
    root = files.locate(path)[1]
    return [(files.full(path, root, f.path), f.size, f) for f in list_shards(path)]


def _samples(
    part: ShardRange, head: int | None, first: int = 0, end: int = 1 << 62,
) -> Iterator[tuple[int, str, dict[str, bytes], dict[str, int]]]:
    """(sample number, key, members, sizes) of the samples that start in the partition's byte range.

    Payloads of samples before ``first`` are not read, and nothing from sample ``end`` on. With ``head`` only that many bytes of each payload are
    read, the rest is skipped by seeking; of a WAV member a plain header with its true length is made, wherever its samples start.
    """
    system, inner = files.locate(part.path)
    packed = part.path.endswith(".gz")
    number, key, mine, members, sizes = part.sample - 1, None, False, {}, {}
    with contextlib.ExitStack() as opened:
        if packed or head is not None:
            source = opened.enter_context(system.open_input_stream(inner, compression=None) if packed else system.open_input_file(inner))
            if part.entry:
                source.seek(part.entry)
            found = _tar_members(opened.enter_context(tarfile.open(fileobj=source, mode="r|gz" if packed else "r:")), head)
        else:
            found = _plain_members(tarindex.Window(opened.enter_context(system.open_input_file(inner)), part.stop), part.entry)
        for member, payload in found:
            name, suffix = named(member.name)
            if not suffix:
                continue
            if name != key:
                if mine:
                    yield number, key, members, sizes
                if number + 1 >= end or member.offset >= part.stop and not packed:
                    return
                number, key, members, sizes = number + 1, name, {}, {}
                mine = packed or member.offset >= part.start
            if mine and number >= first:
                members[suffix], sizes[suffix] = payload(suffix), member.size
        if mine and key is not None:
            yield number, key, members, sizes


def _tar_members(tar: tarfile.TarFile, head: int | None) -> Iterator[tuple[tarfile.TarInfo, Callable[[str], bytes]]]:
    """Files of an archive, and what reads the payload of each, or its head."""
    for member in tar:
        tar.members = []  # the index is not needed and would grow with the shard
        if not member.isfile():
            continue

        def payload(suffix: str, member=member) -> bytes:
            wanted = member.size if head is None else min(head, member.size)
            body = tar.extractfile(member)
            if head is not None and suffix.rsplit(".", 1)[-1] == "wav":
                return wave_header(body, member.size)
            found = body.read(wanted)
            if len(found) != wanted:
                raise tarfile.ReadError(f"member {member.name} is cut short")
            return found

        yield member, payload


def _plain_members(window: tarindex.Window, at: int) -> Iterator[tuple[tarindex.Member, Callable[[str], bytes]]]:
    """The same for whole payloads of a plain tar."""
    for member in tarindex.plain_members(window, at):
        if not member.file:
            continue

        def payload(suffix: str, member=member) -> bytes:
            found = window.read(member.data, member.size, member.size < tarindex.BUFFER)
            if len(found) != member.size:
                raise tarfile.ReadError("unexpected end of data")
            return found

        yield member, payload


class TarShardReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options.get("path")
        if not self.path:
            raise ValueError("tarshards needs a path")
        self.mode = options.get("mode", "PERMISSIVE").upper()
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        self.split_bytes = int(options.get("splitbytes", 1 << 30))
        self.head = int(options["headbytes"]) if "headbytes" in options else None
        self.index = options.get("index")
        self.tasks = int(options["tasks"]) if "tasks" in options else None

    def partitions(self) -> list[InputPartition]:
        ranges, sizes = [], []
        shards = listed_shards(self.path)
        big = [(uri, size) for uri, size, _ in shards if size > self.split_bytes and not uri.endswith(".gz")]
        entries = _entries(self.path, big, self.index) if big else {}
        for number, (uri, size, _) in enumerate(shards):
            if (uri, size) in entries:
                found = [ShardRange(uri, number, a, b, a, n) for a, b, n in tarindex.cut(entries[uri, size], self.split_bytes)]
            else:
                whole = uri.endswith(".gz") or size <= self.split_bytes or self.index == "none"
                step = size + 1 if whole else self.split_bytes
                found = [ShardRange(uri, number, at, at + step) for at in range(0, max(size, 1), step)]
            ranges += found
            sizes += [min(r.stop, size) - r.start for r in found]
        if self.tasks and len(ranges) > self.tasks:
            return grouped(ranges, sizes, self.tasks)
        # An empty listing still needs one (empty) partition.
        return ranges or [ShardRange("", 0, 0, 0)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for part in partition.ranges if isinstance(partition, ShardRanges) else [partition]:
            if part.path:
                yield from _rows(part, files.plain(part.path), self.mode, self.head)


def _entries(path: str, shards: list[tuple[str, int]], index: str | None) -> dict[tuple[str, int], list[tuple[int, int]]]:
    """Sample starts of plain shards (uri, bytes), by the index named or beside the corpus, and by their manifests."""
    wanted, out = set(shards), {}
    for folder in {uri.rpartition("/")[0] for uri, _ in shards}:
        for s in manifest.listed(folder) or []:
            if s.entries and (f"{folder}/{s.name}", s.bytes) in wanted:
                out[f"{folder}/{s.name}", s.bytes] = [tuple(e) for e in s.entries]
    if index != "none":
        found = tarindex.read_entries(index or f"{path.rstrip('/')}/{tarindex.FOLDER}")
        out |= {k: v for k, v in found.items() if k in wanted}
    return out


def _rows(
    partition: ShardRange, shard: str, mode: str, head: int | None, first: int = 0, end: int = 1 << 62,
) -> Iterator[pa.RecordBatch]:
    """Batches of a partition's samples numbered [first, end); a broken shard ends in a row with its error, in nothing, or in the error itself."""
    rows, held = [], 0
    try:
        for number, key, members, sizes in _samples(partition, head, first, end):
            if number < first:
                continue
            ordinal = partition.number * SHARD_STRIDE + number
            rows.append((shard, ordinal, key, list(members.items()), list(sizes.items()), None))
            held += sum(len(v) for v in members.values())
            if held >= BATCH_BYTES:
                yield _batch(rows)
                rows, held = [], 0
    except (tarfile.TarError, OSError, EOFError) as error:
        if mode == "FAILFAST":
            raise
        if mode == "PERMISSIVE":
            rows.append((shard, None, None, None, None, f"{type(error).__name__}: {error}"))
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(list(c), type=f.type) for c, f in zip(zip(*rows), _BATCH)]
    return pa.RecordBatch.from_arrays(columns, schema=_BATCH)


@dataclass
class Written(WriterCommitMessage):
    shards: list[manifest.Shard]


def _payload(value, suffix: str, rate: int | None) -> bytes:
    if isinstance(value, bytes):
        return value
    if isinstance(value, np.ndarray):
        return pcm_bytes(value, rate) if suffix == "wav" else value.astype("<f4").tobytes()
    return str(value).encode("utf-8")


#: Header of an empty member without a name.
_BLANK = tarfile.TarInfo("").tobuf(tarfile.USTAR_FORMAT)
_BLANK_SUM = int(_BLANK[148:154], 8) - sum(_BLANK[124:135])


def _header(name: str, size: int) -> bytes | None:
    """The header ``tarfile`` would write; None for names and sizes that need more than one block."""
    if not name.isascii() or not 0 < len(name) <= 100 or "\0" in name or size >= 8**11:
        return None
    plain, digits = name.encode(), b"%011o" % size
    check = b"%06o\0" % (_BLANK_SUM + sum(plain) + sum(digits))
    return b"".join((plain.ljust(100, b"\0"), _BLANK[100:124], digits, _BLANK[135:148], check, _BLANK[155:]))


@dataclass
class _Open:
    """A shard while it is written."""

    system: fs.FileSystem
    path: str
    name: str
    count: int = 0
    entries: list = field(default_factory=list)

    def __post_init__(self):
        self.out = self.system.open_output_stream(self.path, compression=None)
        self.packed = self.name.endswith(".gz")
        self.tar = tarfile.open(fileobj=self.out, mode="w|gz" if self.packed else "w|")

    def add(self, key: str, members: list[tuple[str, bytes]]) -> None:
        if not self.packed and self.count % EVERY == 0 and members:
            self.entries.append((self.tar.offset, self.count))
        stem = escaped(key)
        for suffix, payload in members:
            header = _header(f"{stem}.{suffix}", len(payload))
            if header is None:
                member = tarfile.TarInfo(f"{stem}.{suffix}")
                member.size = len(payload)
                self.tar.addfile(member, io.BytesIO(payload))
                self.tar.members = []  # would grow with the shard
            else:
                data = b"".join((header, payload, bytes(-len(payload) % tarindex.BLOCK)))
                self.tar.fileobj.write(data)
                self.tar.offset += len(data)
        self.count += bool(members)

    def close(self) -> manifest.Shard:
        self.tar.close()
        size = self.out.tell()
        self.out.close()
        return manifest.Shard(self.name, self.count, size, self.entries)


class TarShardWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.pattern = options.get("pattern", "dataset-%06d.tar")
        self.rate = int(options["rate"]) if "rate" in options else None
        self.list_only = options.get("listonly")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, inner = files.locate(self.folder)
        system.create_dir(inner, recursive=True)
        token, done, current, shard, last = uuid.uuid4().hex[:12], [], None, None, None
        try:
            for batch in iterator:
                names = [n for n in batch.schema.names if n not in ("__shard__", "__key__")]
                columns = {n: self._values(batch.column(n)) for n in names}
                for i, (number, key) in enumerate(zip(batch.column("__shard__").to_pylist(), batch.column("__key__").to_pylist())):
                    if number != current:
                        if shard is not None:
                            done.append(shard.close())
                        stem, _, suffix = (self.pattern % number).partition(".tar")
                        name = f"{stem}-{token}.tar{suffix}"
                        shard, current, last = _Open(system, f"{inner}/{name}", name), number, None
                    if key is None or key == last:
                        raise ValueError(f"shard {number} would hold key {key!r} twice in a row: a reader takes both for one sample")
                    last = key
                    shard.add(key, [(n, _payload(columns[n][i], n, self.rate)) for n in names if columns[n][i] is not None])
            if shard is not None:
                done.append(shard.close())
                shard = None
        except BaseException:
            # Nobody will list these; taking them away now only saves the space.
            if shard is not None:
                shard.close()
                done.append(manifest.Shard(shard.name, 0, 0))
            self._remove(done)
            raise
        return Written(done)

    @staticmethod
    def _values(array: pa.Array) -> list:
        if pa.types.is_list(array.type):
            return [None if v is None else np.asarray(v.values) for v in (s if s.is_valid else None for s in array)]
        return array.to_pylist()

    def commit(self, messages: list) -> None:
        found = sorted((s for message in messages if message for s in message.shards), key=lambda s: s.name)
        if self.list_only:
            system, inner = files.locate(self.list_only)
            with system.open_output_stream(inner, compression=None) as out:
                out.write(manifest.lines(found))
        else:
            manifest.commit(self.folder, found)

    def abort(self, messages: list) -> None:
        self._remove([s for message in messages if message for s in message.shards])

    def _remove(self, shards: list[manifest.Shard]) -> None:
        system, inner = files.locate(self.folder)
        for shard in shards:
            if system.get_file_info(f"{inner}/{shard.name}").type == fs.FileType.File:
                system.delete_file(f"{inner}/{shard.name}")


class TarShards(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tarshards"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: T.StructType) -> TarShardReader:
        return TarShardReader(self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> TarShardWriter:
        return TarShardWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TarShards)


def read_tarshards(
    spark: SparkSession, path: str, mode: str = "PERMISSIVE", split_bytes: int = 1 << 30, head_bytes: int | None = None,
    index: str | None = None,
) -> DataFrame:
    """(shard, ordinal, key, members, sizes, error) of all samples below a path.

    ``head_bytes`` reads only the start of each member; ``sizes`` are the full ones. Plain shards beyond ``split_bytes`` are split at the entries
    of the ``index`` named, of the one beside the corpus or of their manifest; what none of them covers is indexed now, by a job over its headers.
    Tasks follow the bytes and the session's parallelism, not the number of shards and ranges: small ones are read several by a task.
    """
    register(spark)
    reader = spark.read.format("tarshards").option("mode", mode).option("splitBytes", split_bytes).option("tasks", tarindex.spread(spark))
    if head_bytes is not None:
        reader = reader.option("headBytes", head_bytes)
    big = [(uri, size) for uri, size, _ in listed_shards(path) if size > split_bytes and not uri.endswith(".gz")]
    if big:
        known = _entries(path, big, index)
        fine = {k for k, found in known.items() if len(found) * split_bytes > k[1] / 4}
        if len(fine) < len(big):
            index = settings.fresh_path(spark, "tarindex")
            rest = spark.createDataFrame([k for k in big if k not in fine], "path string, size bigint")
            kept = spark.createDataFrame([(*k, *e) for k in fine for e in known[k]], tarindex.ENTRIES)
            tarindex.header_index(rest, EVERY, split_bytes).unionByName(kept).write.parquet(index)
    if index is not None:
        reader = reader.option("index", index)
    return reader.load(path)


def read_listed(
    catalog: DataFrame, mode: str = "PERMISSIVE", head_bytes: int | None = None, split_bytes: int = 1 << 30, index: str | None = None,
) -> DataFrame:
    """The same columns for the shards a catalogue (ordinal, path) lists: select among its rows, then read.

    The list never leaves the executors: tasks look the sizes up, plain shards beyond ``split_bytes`` are cut at the entries of an ``index`` (of
    the headers, which a job walks now, where it has none of a shard), and each range is a row of work. Sample ordinals follow the catalogue's.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    spark = catalog.sparkSession

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_size(path) for path in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], ["ordinal", "path", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                part = ShardRange(r["path"], r["ordinal"], r["start"], r["stop"], r["start"], r["sample"])
                yield from _rows(part, files.plain(r["path"]), mode, head_bytes)

    tasks = tarindex.spread(spark)
    named = catalog.select(F.col("ordinal").cast("bigint"), "path").repartition(tasks, "path")
    sized = settings.materialize(named.mapInArrow(sizes, "ordinal bigint, path string, size bigint"), "catalog")
    big = sized.filter((F.col("size") > split_bytes) & ~F.col("path").endswith(".gz"))
    ranges = sized.select("ordinal", "path", F.lit(0).cast("bigint").alias("start"), F.lit(1 << 62).alias("stop"), F.lit(0).cast("bigint").alias("sample"))
    if not big.isEmpty():
        shards = big.select("path", "size").distinct()
        entries = spark.read.parquet(index).join(shards, ["path", "size"]) if index else spark.createDataFrame([], tarindex.ENTRIES)
        rest = shards.join(entries, ["path", "size"], "left_anti")
        entries = settings.materialize(entries.unionByName(tarindex.header_index(rest, EVERY, split_bytes)), "entries")
        first = entries.groupBy("path", F.floor(F.col("byte") / split_bytes).alias("part")).agg(F.min(F.struct("byte", "sample")).alias("at"))
        order = W.partitionBy("path").orderBy("part")
        start = F.when(F.col("at.sample") == 0, 0).otherwise(F.col("at.byte")).cast("bigint")
        cuts = first.select("path", start.alias("start"), F.coalesce(F.lead("at.byte").over(order), F.lit(1 << 62)).alias("stop"), F.col("at.sample").alias("sample"))
        split = sized.select("ordinal", "path").join(cuts, "path").select("ordinal", "path", "start", "stop", "sample")
        ranges = ranges.join(cuts.select("path").distinct(), "path", "left_anti").select(*split.columns).unionByName(split)
    return ranges.repartition(tasks, "path", "start").mapInArrow(run, READ_SCHEMA)


def _size(path: str) -> int | None:
    """Bytes of a shard; None where only reading it will tell what is wrong."""
    try:
        found = files.info(path)
        return found.size if found.type == fs.FileType.File else None
    except (OSError, ValueError):
        return None


def write_tarshards(
    df: DataFrame, folder: str, max_count: int, pattern: str = "dataset-%06d.tar", key: str = "key",
    order: str = "ordinal", force: bool = False, dense: bool = False, rate: int | None = None,
) -> bool:
    """Write shards of ``max_count`` consecutive samples; False when the folder is already complete.

    Column names are member suffixes (``wav``, ``text.txt``, ``metadata.json``): binary as it is,
    float arrays as little-endian float32 (a ``wav`` array as 16-bit PCM at ``rate``), other values
    as text, nulls left out. ``dense`` says that ``order`` already counts 0..n-1, which saves
    numbering the rows; otherwise the input is scanned for its ordinals too, so give a written table. ``force`` replaces a finished
    folder: readers see its old shards until the new manifest is there, then the old ones are deleted. Two equal keys in a row are refused.
    """
    if max_count < 1:
        raise ValueError("max_count must be >= 1")
    if manifest.is_complete(folder) and not force:
        return False
    manifest.begin(folder)
    if dense:
        shard_of = df.withColumn("__shard__", F.floor(F.col(order) / max_count))
    else:
        shard_of = assign_shards(df, max_count, order, "__shard__")
    save_shards(shard_of, folder, pattern, key, order, rate)
    if force:
        manifest.vacuum(df.sparkSession, folder)
    return True


def save_shards(df: DataFrame, folder: str, pattern: str, key: str, order: str, rate: int | None, list_only: str | None = None) -> None:
    """Write rows that carry their ``__shard__``; with ``list_only`` the list of shards goes to that file instead of the folder's manifest."""
    register(df.sparkSession)
    if rate is None and "wav" in df.columns and isinstance(df.schema["wav"].dataType, T.ArrayType):
        raise ValueError("a wav array needs its rate")
    placed = df.repartition("__shard__").sortWithinPartitions("__shard__", order)
    members = [F.col(f"`{c}`") for c in df.columns if c not in (key, order, "__shard__")]
    rows = placed.select(F.col("__shard__").cast("int"), F.col(key).cast("string").alias("__key__"), *members)
    writer = rows.write.format("tarshards").option("pattern", pattern)
    if rate is not None:
        writer = writer.option("rate", rate)
    if list_only is not None:
        writer = writer.option("listOnly", list_only)
    writer.mode("append").save(folder)

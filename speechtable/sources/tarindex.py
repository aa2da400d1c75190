"""Where samples start in tar shards: built by tasks that each walk the headers of one byte range.

A range task looks for the first header at its start by checksum, in steps of 512 bytes, and follows the headers from there. Payloads that hold
tar files of their own could mislead it, so the ranges of a shard are then put in a row: where one ends the next header
is known, and a range that began elsewhere is walked again from the right place. Sample numbers follow from the
counts of the ranges before. A shard that cannot be read to its end, or whose global headers every reader needs, has no entries.
"""

from __future__ import annotations

import tarfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechtable.sources import files

#: Name of the index beside a corpus.
FOLDER = "_tarindex"
BLOCK = 512
_SCAN = 1 << 20
#: Bytes a reader of headers and small payloads asks its file for at once.
BUFFER = 8 << 10
_END = 1 << 62
ENTRIES = "path string, size bigint, byte bigint, sample bigint"
_WALKED = ("path string, size bigint, start bigint, stop bigint, first bigint, next bigint, first_key string, last_key string, "
           "starts array<bigint>, error string")


def named(member: str) -> tuple[str, str]:
    """(sample key, suffix): the base name is cut at its first dot, then what ``escaped`` wrote is restored."""
    folder, _, base = member.rpartition("/")
    stem, _, suffix = base.partition(".")
    stem = stem.replace("%2E", ".").replace("%25", "%")
    return (f"{folder}/{stem}" if folder else stem), suffix.lower()


def escaped(key: str) -> str:
    """A key whose base name has no dot, since the first dot ends the key."""
    folder, slash, base = key.rpartition("/")
    return folder + slash + base.replace("%", "%25").replace(".", "%2E")


@dataclass(slots=True)
class Member:
    """A member of a plain tar: its header is at ``offset``, its payload at ``data``."""

    name: str
    offset: int
    data: int
    size: int
    file: bool = True
    #: Whether global headers apply.
    special: bool = False


def _plain(head: bytes, at: int) -> Member | None:
    """The member of a plain header block; None where only ``tarfile`` can tell (links, long names, sparse files, bad or last blocks)."""
    if len(head) != BLOCK or head[156] not in b"0\0" or head[124] & 0x80:
        return None
    try:
        if int(head[148:156].split(b"\0", 1)[0], 8) != 256 + sum(head) - sum(head[148:156]):
            return None
        size = int(head[124:136].split(b"\0", 1)[0], 8)
    except ValueError:
        return None
    name = head[:100].split(b"\0", 1)[0]
    if head[345]:
        name = head[345:500].split(b"\0", 1)[0] + b"/" + name
    if size < 0 or name.endswith(b"/"):
        return None
    return Member(name.decode(tarfile.ENCODING, "surrogateescape"), at, at + BLOCK, size)


class Window:
    """A file read some kilobytes at a time, never ahead beyond ``stop``."""

    def __init__(self, source, stop: int):
        self.source, self.stop, self.start, self.data = source, stop, 0, b""

    def read(self, start: int, n: int, ahead: bool = True) -> bytes:
        low = start - self.start
        if low < 0 or low + n > len(self.data):
            self.source.seek(start)
            self.data, self.start, low = self.source.read(max(n, min(BUFFER, self.stop - start) if ahead else 0)), start, 0
        return self.data[low : low + n]


def plain_members(window: Window, at: int) -> Iterator[Member]:
    """Members of a plain tar from the header at ``at``, as ``tarfile`` reads them; what is not a plain header is left to it."""
    start, size = at, 0
    while True:
        # The byte before tells whether the payload that ends here is whole.
        back = int(at > start)
        head = window.read(at - back, back + BLOCK, size < BUFFER)
        if back and not head:
            raise tarfile.ReadError("unexpected end of data")
        found = _plain(head[back:], at)
        if found is None:
            break
        yield found
        size = found.size
        at = found.data + -(-size // BLOCK) * BLOCK
    window.source.seek(at)
    with tarfile.open(fileobj=window.source, mode="r:") as tar:
        for member in tar:
            tar.members = []  # the index is not needed and would grow with the shard
            yield Member(member.name, member.offset, member.offset_data, member.size, member.isfile(), bool(tar.pax_headers))


def next_header(source, start: int, stop: int) -> int | None:
    """The first place at or after ``start``, a multiple of 512, whose block is a header by its checksum; None if none is before ``stop``."""
    at = -(-start // BLOCK) * BLOCK
    while at < stop:
        source.seek(at)
        data = source.read(min(_SCAN, -(-(stop - at) // BLOCK) * BLOCK))
        blocks = np.frombuffer(data[: len(data) // BLOCK * BLOCK], np.uint8).reshape(-1, BLOCK)
        if not len(blocks):
            return None
        sums = blocks.sum(1, dtype=np.int64) - blocks[:, 148:156].sum(1, dtype=np.int64) + 256
        # A checksum field is octal digits, then a zero byte or a space; blocks of zeros end the archive.
        likely = (sums > 256) & (((blocks[:, 148:154] >= 0x30) & (blocks[:, 148:154] <= 0x37)) | (blocks[:, 148:154] == 0x20)).all(1)
        for i in np.flatnonzero(likely).tolist():
            digits = blocks[i, 148:156].tobytes().split(b"\0")[0].strip()
            if digits and int(digits, 8) == sums[i] and at + i * BLOCK < stop:
                return at + i * BLOCK
        at += len(blocks) * BLOCK
    return None


def walk(path: str, size: int, start: int, stop: int, at: int | None) -> dict:
    """The samples whose first header lies in [start, stop), from the header at ``at`` or, without one, the first that is found."""
    out = {"path": path, "size": size, "start": start, "stop": stop, "first": None, "next": None, "first_key": None, "last_key": None,
           "starts": [], "error": None}
    system, inner = files.locate(path)
    try:
        with system.open_input_file(inner) as source:
            at = next_header(source, start, stop) if at is None else at
            out["first"] = at
            if at is None or at >= stop:
                out["next"] = at
                return out
            for member in plain_members(Window(source, stop), at):
                if member.special:
                    raise tarfile.ReadError("global headers")
                if member.offset >= stop:
                    out["next"] = member.offset
                    break
                if not member.file:
                    continue
                key, suffix = named(member.name)
                if not suffix:
                    continue
                if key != out["last_key"]:
                    out["starts"].append(member.offset)
                    out["last_key"] = key
                    out["first_key"] = out["first_key"] if out["first_key"] is not None else key
            else:
                out["next"] = _END
    except (tarfile.TarError, OSError, EOFError, ValueError) as error:
        out["error"] = f"{type(error).__name__}: {error}"
    return out


def _walked(ranges: DataFrame) -> DataFrame:
    """Walk (path, size, start, stop, at)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield pa.RecordBatch.from_pylist([walk(r["path"], r["size"], r["start"], r["stop"], r["at"])], _SCHEMA)

    # A fixed number of tasks: the rows are small, the work behind them is not.
    tasks = spread(ranges.sparkSession)
    return ranges.repartition(tasks, "path", "start").mapInArrow(run, _WALKED)


_ENTRIES = pa.schema([("path", pa.string()), ("size", pa.int64()), ("byte", pa.int64()), ("sample", pa.int64())])
_SCHEMA = pa.schema([
    ("path", pa.string()), ("size", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("first", pa.int64()), ("next", pa.int64()),
    ("first_key", pa.string()), ("last_key", pa.string()), ("starts", pa.list_(pa.int64())), ("error", pa.string())])


def spread(spark: SparkSession) -> int:
    """Tasks for rows that each stand for a large read."""
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def header_index(shards: DataFrame, every: int = 1000, range_bytes: int = 256 << 20) -> DataFrame:
    """(path, size, byte, sample) of plain shards (path, size): each ``every``-th sample and the first one that starts in each range of bytes.

    One pass over the headers of each range; payloads are skipped. A range's row holds its sample starts: keep ``range_bytes`` below some GB.
    """
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(range_bytes).cast("bigint"))
    ranges = shards.filter(~F.col("path").endswith(".gz")).select("path", F.col("size").cast("bigint"), F.explode(starts).alias("start"))
    ranges = ranges.withColumn("stop", F.col("start") + range_bytes).withColumn("at", F.when(F.col("start") == 0, F.lit(0)).cast("bigint"))

    def settle(ranges: pa.Table) -> pa.Table:
        """Entries of one shard: its ranges in order, each from where the one before it ends."""
        due, count, key, out = 0, 0, None, []
        for r in ranges.sort_by("start").to_pylist():
            if due >= r["stop"]:
                continue  # all of the range belongs to a member that starts before it
            if r["first"] != due:
                r = walk(r["path"], r["size"], r["start"], r["stop"], due)
            if r["error"] is not None:
                return _ENTRIES.empty_table()
            goes_on = int(r["first_key"] is not None and r["first_key"] == key)
            for place, byte in enumerate(r["starts"][goes_on:]):
                if place == 0 or count % every == 0:
                    out.append({"path": r["path"], "size": r["size"], "byte": byte, "sample": count})
                count += 1
            due, key = r["next"], r["last_key"] or key
        return pa.Table.from_pylist(out, _ENTRIES)

    return _walked(ranges).groupBy("path").applyInArrow(settle, ENTRIES)


def write_index(spark: SparkSession, path: str, every: int = 1000, range_bytes: int = 256 << 20, folder: str | None = None) -> str:
    """Index the plain shards below a path; the index lies beside them, or in ``folder``. Shards that change later lose their entries."""
    from speechtable.sources.tarshards import listed_shards

    folder = folder or f"{path.rstrip('/')}/{FOLDER}"
    shards = spark.createDataFrame([(p, s) for p, s, _ in listed_shards(path)], "path string, size bigint")
    header_index(shards, every, range_bytes).repartition(1 + shards.count() // 10000).write.mode("overwrite").parquet(folder)
    return folder


def read_entries(folder: str) -> dict[tuple[str, int], list[tuple[int, int]]]:
    """(path, size) -> sorted (byte, sample) of a written index; nothing where there is none, or an unfinished one."""
    import pyarrow.dataset as ds

    system, inner = files.locate(folder)
    if system.get_file_info(f"{inner.rstrip('/')}/_SUCCESS").type != fs.FileType.File:
        return {}
    out: dict[tuple[str, int], list[tuple[int, int]]] = {}
    for batch in ds.dataset(inner, filesystem=system, format="parquet").to_batches():
        for path, size, byte, sample in zip(*(c.to_pylist() for c in batch.select(["path", "size", "byte", "sample"]).columns)):
            out.setdefault((path, size), []).append((byte, sample))
    return {k: sorted(v) for k, v in out.items()}


def cut(entries: list[tuple[int, int]], split_bytes: int) -> list[tuple[int, int, int]]:
    """(start, stop, first sample) of ranges of about ``split_bytes`` that begin at entries; the last one is open."""
    firsts: dict[int, tuple[int, int]] = {}
    for byte, sample in entries:
        firsts.setdefault(byte // split_bytes, (byte, sample))
    starts = sorted(firsts.values())
    if starts and starts[0][1] == 0:
        starts[0] = (0, 0)
    return [(a, b, n) for (a, n), (b, _) in zip(starts, [*starts[1:], (_END, 0)])]

"""Commit of shard folders by manifest: no file is ever renamed.

A writer's tasks put shards under names of their own attempt. A shard belongs to the folder once its manifest lists it: the ``_SUCCESS``
object, one JSON line per shard (name, samples, bytes, index entries) and a last line with their number, so that a
manifest cut short does not count. What killed or repeated attempts leave is never read. A folder being written for the first time
carries ``_WRITING``; with it and without a whole manifest nothing in it counts. A finished folder stays readable until the
next manifest takes the place of its own, in one write. Until a stream's folder is finished, the logs of its epochs list its shards. Folders without either (of other tools) hold what they hold.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechtable.sources import files

MARKER, WRITING, EPOCHS = "_SUCCESS", "_WRITING", "_epochs"
#: Epochs of a stream after which their lists are put into one.
COMPACT = 64
# What counts as a shard.
SHARD_SUFFIXES = (".tar", ".tar.gz")


@dataclass(frozen=True)
class Shard:
    """A shard as its manifest lists it; ``entries`` are (byte, sample number) of samples a reader may start at."""

    name: str
    count: int
    bytes: int
    entries: list = field(default_factory=list, hash=False)


def lines(shards: Iterable[Shard]) -> bytes:
    out = [json.dumps(asdict(s), separators=(",", ":")) for s in shards]
    return "\n".join([*out, json.dumps({"shards": len(out)})]).encode()


def parse(text: bytes) -> list[Shard] | None:
    """The shards of a manifest; None for one that is cut short or none at all."""
    found = text.decode().splitlines()
    try:
        rows = [json.loads(line) for line in found]
        if not rows or rows[-1] != {"shards": len(rows) - 1}:
            return None
        return [Shard(**row) for row in rows[:-1]]
    except (ValueError, TypeError):
        return None


def read(system: fs.FileSystem, path: str) -> bytes:
    with system.open_input_stream(path, compression=None) as source:
        return source.read()


def _object(system: fs.FileSystem, path: str) -> bytes | None:
    if system.get_file_info(path).type != fs.FileType.File:
        return None
    return read(system, path)


def epochs(system: fs.FileSystem, inner: str) -> list[str]:
    """Whole logs of the epochs a stream has added to a folder, from the last one that lists all before it."""
    folder = f"{inner.rstrip('/')}/{EPOCHS}"
    if system.get_file_info(folder).type != fs.FileType.Directory:
        return []
    found = sorted(f.path for f in system.get_file_info(fs.FileSelector(folder)) if f.path.endswith(".json"))
    found = [path for path in found if _of_epoch(system, path) is not None]
    whole = [i for i, path in enumerate(found) if path.endswith(".all.json")]
    return found[whole[-1] :] if whole else found


def _of_epoch(system: fs.FileSystem, path: str) -> list[Shard] | None:
    """What an epoch added; None for a log that is cut short. The first line is the stream's own."""
    return parse(read(system, path).partition(b"\n")[2])


def listed(folder: str) -> list[Shard] | None:
    """Shards of a folder by its manifest: none where it is being written for the first time, None where it has no manifest."""
    system, inner = files.locate(folder)
    return _listed(system, inner.rstrip("/"))


def _listed(system: fs.FileSystem, inner: str) -> list[Shard] | None:
    text = _object(system, f"{inner}/{MARKER}") or b""
    found = parse(text)
    if found is None and (text.startswith(b"{") or system.get_file_info(f"{inner}/{WRITING}").type == fs.FileType.File):
        return [s for path in epochs(system, inner) for s in _of_epoch(system, path)]
    return found


def is_complete(folder: str) -> bool:
    """Whether a finished write left its marker; a manifest must be whole."""
    system, inner = files.locate(folder)
    text = _object(system, f"{inner.rstrip('/')}/{MARKER}")
    return text is not None and (not text.startswith(b"{") or parse(text) is not None)


def begin(folder: str) -> None:
    """Before anything is written: what appears in the folder counts only by a manifest."""
    system, inner = files.locate(folder)
    system.create_dir(inner, recursive=True)
    if parse(_object(system, f"{inner}/{MARKER}") or b"") is None:
        with system.open_output_stream(f"{inner}/{WRITING}"):
            pass
        if system.get_file_info(f"{inner}/{MARKER}").type == fs.FileType.File:
            # A marker without a manifest would vouch for files that are about to change.
            system.delete_file(f"{inner}/{MARKER}")


def commit(folder: str, shards: Iterable[Shard]) -> None:
    """Make these the folder's shards."""
    system, inner = files.locate(folder)
    system.create_dir(inner, recursive=True)
    with system.open_output_stream(f"{inner}/{MARKER}", compression=None) as out:
        out.write(lines(shards))
    if system.get_file_info(f"{inner}/{WRITING}").type == fs.FileType.File:
        system.delete_file(f"{inner}/{WRITING}")


def table(spark: SparkSession, folder: str) -> DataFrame:
    """(name, count, bytes) of a folder's shards by its manifest."""
    return spark.createDataFrame([(s.name, s.count, s.bytes) for s in listed(folder) or []], "name string, count bigint, bytes bigint")


def only_listed(found: list[fs.FileInfo], system: fs.FileSystem) -> list[fs.FileInfo]:
    """Files of a recursive listing that count: all of a folder without a manifest, the listed ones of a folder with one."""
    marked = {f.path.rpartition("/")[0] for f in found if f.base_name in (MARKER, WRITING)}
    names = {folder: shards for folder in marked if (shards := _listed(system, folder)) is not None}
    kept = {folder: {s.name for s in shards} for folder, shards in names.items()}
    have = {f.path for f in found}
    for folder, wanted in kept.items():
        for name in sorted(wanted):
            if f"{folder}/{name}" not in have:
                raise FileNotFoundError(f"the manifest of {folder} lists {name}, which is gone")
    return [f for f in found if (folder := f.path.rpartition("/")[0]) not in kept or f.base_name in kept[folder]]


def keep_listed(paths: DataFrame, path: str = "path") -> DataFrame:
    """Rows whose shard counts; the tasks read each folder's manifest once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, set | None] = {}
        for batch in batches:
            keep = []
            for value in batch.column(path).to_pylist():
                folder, _, name = value.rpartition("/")
                if folder not in known:
                    shards = listed(folder)
                    known[folder] = None if shards is None else {s.name for s in shards}
                keep.append(known[folder] is None or name in known[folder])
            yield batch.filter(pa.array(keep, pa.bool_()))

    return paths.mapInArrow(run, paths.schema)


def vacuum(spark: SparkSession, folder: str) -> int:
    """Delete the shards of a folder that its manifest does not list, in tasks; the number deleted.

    For folders nobody is writing to: an attempt under way looks like one left behind.
    """
    wanted = listed(folder)
    if wanted is None:
        return 0
    system, inner = files.locate(folder)
    kept = {s.name for s in wanted}
    stale = [(files.full(folder, inner, f.path),) for f in system.get_file_info(fs.FileSelector(inner))
             if f.type == fs.FileType.File and f.base_name.endswith(SHARD_SUFFIXES) and f.base_name not in kept]
    if not stale:
        return 0

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                at, name = files.locate(path)
                if at.get_file_info(name).type == fs.FileType.File:
                    at.delete_file(name)
            yield batch

    paths = spark.createDataFrame(stale, "path string")
    return paths.repartition(max(1, len(stale) // 256)).mapInArrow(delete, "path string").agg(F.count("path")).first()[0]

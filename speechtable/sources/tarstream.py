"""Tar shards as a stream: ``spark.readStream.format("tarshardstream")``.

Shards are numbered as they are first seen; a log of arrivals in the ``seen`` folder, one file per discovery, keeps that order over restarts. An
offset is (arrival number, sample number): every shard before it is read, and so many samples of that one, so a trigger may end inside a shard.
How many samples a shard holds comes from its writer's manifest; the headers of other shards are walked when they arrive.
"""

from __future__ import annotations

import json
import tarfile
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from speechtable.sources import files, manifest, tarshards

#: Threads that count the samples of newly arrived shards.
COUNTERS = 16
_OPEN = 1 << 62


@dataclass
class SampleRange(InputPartition):
    """Samples [first, end) of a shard, read from the entry at or before the first one."""

    path: str
    number: int
    first: int
    end: int
    entry: int
    sample: int


def counted(path: str, known: dict[str, manifest.Shard]) -> dict:
    """An arrival: path, samples, entries. What breaks a shard off goes with its last sample, or stands for one."""
    if path in known:
        return {"path": path, "count": known[path].count, "entries": known[path].entries}
    count, entries = 0, []
    try:
        for number, offset in _headers(path):
            if number % tarshards.EVERY == 0 and offset is not None:
                entries.append((offset, number))
            count = number + 1
    except (tarfile.TarError, OSError, EOFError):
        count = max(count, 1)
    return {"path": path, "count": count, "entries": entries}


def _headers(path: str) -> Iterator[tuple[int, int | None]]:
    """(number, place in a plain shard) of a shard's samples, by its headers."""
    system, inner = files.locate(path)
    packed = path.endswith(".gz")
    source = system.open_input_stream(inner, compression=None) if packed else system.open_input_file(inner)
    with source, tarfile.open(fileobj=source, mode="r|gz" if packed else "r:") as tar:
        number, last = -1, None
        for member in tar:
            tar.members = []
            key, suffix = tarshards.named(member.name)
            if member.isfile() and suffix and key != last:
                number, last = number + 1, key
                yield number, None if packed else member.offset


class TarShardStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.seen = options.get("path"), options.get("seen")
        if not self.path or not self.seen:
            raise ValueError("tarshardstream needs a path and a folder for what it has seen")
        self.mode = options.get("mode", "PERMISSIVE").upper()
        if self.mode not in tarshards.MODES:
            raise ValueError(f"mode must be one of {tarshards.MODES}")
        self.most = int(options.get("maxsamplespertrigger", 0))
        self.split = int(options.get("splitsamples", 5000))
        self.head = int(options["headbytes"]) if "headbytes" in options else None
        self.arrivals = self._logged()
        self.at = self._planned()

    # --- the log ---

    def _logged(self) -> list[dict]:
        system, inner = files.locate(self.seen)
        if system.get_file_info(inner).type != fs.FileType.Directory:
            return []
        out = []
        for found in sorted(system.get_file_info(fs.FileSelector(inner)), key=lambda f: f.path):
            if found.base_name.startswith("arrivals-"):
                with system.open_input_stream(found.path, compression=None) as source:
                    out += json.loads(source.read())
        return out

    def _write(self, name: str, value) -> None:
        system, inner = files.locate(self.seen)
        system.create_dir(inner, recursive=True)
        with system.open_output_stream(f"{inner}/{name}", compression=None) as out:
            out.write(json.dumps(value).encode())

    def _planned(self) -> dict:
        system, inner = files.locate(self.seen)
        if system.get_file_info(f"{inner}/planned.json").type != fs.FileType.File:
            return self.initialOffset()
        with system.open_input_stream(f"{inner}/planned.json", compression=None) as source:
            return json.loads(source.read())

    def _discover(self) -> None:
        have = {a["path"] for a in self.arrivals}
        new = [uri for uri, _, _ in tarshards.listed_shards(self.path) if uri not in have]
        if not new:
            return
        known = {f"{folder}/{s.name}": s for folder in {p.rpartition("/")[0] for p in new} for s in manifest.listed(folder) or []}
        with ThreadPoolExecutor(COUNTERS) as pool:
            found = list(pool.map(lambda p: counted(p, known), new))
        self._write(f"arrivals-{len(self.arrivals):012d}.json", found)
        self.arrivals += found

    # --- what Spark asks for ---

    def initialOffset(self) -> dict:
        return {"shard": 0, "sample": 0}

    def latestOffset(self) -> dict:
        self._discover()
        shard, sample, left = self.at["shard"], self.at["sample"], self.most or _OPEN
        while shard < len(self.arrivals) and left:
            rest = self.arrivals[shard]["count"] - sample
            if rest > left:
                sample, left = sample + left, 0
            else:
                shard, sample, left = shard + 1, 0, left - rest
        self.at = {"shard": shard, "sample": sample}
        return self.at

    def partitions(self, start: dict, end: dict) -> list[SampleRange]:
        # Spark has logged ``end`` by now: a later run, which is not told, goes on from there.
        self.at = max(self.at, end, key=lambda o: (o["shard"], o["sample"]))
        self._write("planned.json", self.at)
        out = []
        for number in range(start["shard"], min(end["shard"] + 1, len(self.arrivals))):
            arrival = self.arrivals[number]
            first = start["sample"] if number == start["shard"] else 0
            last = end["sample"] if number == end["shard"] else arrival["count"]
            entries = [tuple(e) for e in arrival["entries"]]
            cuts = [first, *[n for _, n in entries if first < n < last and n % self.split == 0], last]
            for a, b in zip(cuts, cuts[1:]):
                if a < b:
                    entry, sample = max((e for e in entries if e[1] <= a), key=lambda e: e[1], default=(0, 0))
                    # The last range of a shard stays open: what breaks it off is found there.
                    out.append(SampleRange(arrival["path"], number, a, _OPEN if b >= arrival["count"] else b, entry if sample else 0, sample))
        return out

    def read(self, partition: SampleRange) -> Iterator[pa.RecordBatch]:
        part = tarshards.ShardRange(partition.path, partition.number, partition.entry, _OPEN, partition.entry, partition.sample)
        yield from tarshards._rows(part, files.plain(partition.path), self.mode, self.head, partition.first, partition.end)


class TarShardStream(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tarshardstream"

    def schema(self) -> str:
        return tarshards.READ_SCHEMA

    def streamReader(self, schema: T.StructType) -> TarShardStreamReader:
        return TarShardStreamReader(self.options)


def stream_tarshards(
    spark: SparkSession, path: str, seen: str, max_samples: int | None = None, mode: str = "PERMISSIVE", head_bytes: int | None = None,
) -> DataFrame:
    """The columns of ``read_tarshards`` as a stream; shards that appear later are picked up, numbered by arrival.

    ``seen`` is a folder of this stream alone. ``max_samples`` limits a trigger; ``drain`` runs triggers until all is read.
    """
    spark.dataSource.register(TarShardStream)
    reader = spark.readStream.format("tarshardstream").option("seen", seen).option("mode", mode)
    if max_samples is not None:
        if max_samples < 1:
            raise ValueError("max_samples must be >= 1")
        reader = reader.option("maxSamplesPerTrigger", max_samples)
    if head_bytes is not None:
        reader = reader.option("headBytes", head_bytes)
    return reader.load(path)


def drain(start: Callable[[], StreamingQuery]) -> int:
    """Start a query again and again, each run up to its trigger's limit, until one finds nothing; the number of runs that did."""
    runs = 0
    while True:
        query = start()
        query.awaitTermination()
        if not sum(p["numInputRows"] for p in query.recentProgress):
            return runs
        runs += 1

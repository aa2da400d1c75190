"""Shard catalogues from files, folders, manifests and remote URIs."""

from __future__ import annotations

import os.path
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from speechtable.operators.ordering import dense_ordinal
from speechtable.sources import files, manifest
from speechtable.sources.manifest import SHARD_SUFFIXES

# What counts as a remote entry.
REMOTE_PREFIXES = ("s3://", "s3a://", "pipe:")
MANIFEST_SUFFIX = ".txt"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(line, entry) of a manifest: trimmed, blank and # lines left out, relative paths resolved against their own file.

    ``line`` orders the entries of a file: the first byte of the block a line was read from, and its place among the rows of the task.
    """
    text = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    # File names come percent-encoded; a plus is a plus.
    file = F.regexp_replace(F.url_decode(F.replace("file_path", F.lit("+"), F.lit("%2B"))), "^file:/+", "/")
    place = F.array(F.col("file_block_start"), F.monotonically_increasing_id())
    lines = text.select(place.alias("line"), F.col("value").alias("raw"), F.regexp_replace(file, "/[^/]*$", "").alias("folder"))
    entry = F.regexp_replace("raw", r"^\s+|\s+$", "")
    kept = lines.select("line", "folder", entry.alias("entry")).filter((F.length("entry") > 0) & ~F.col("entry").startswith("#"))
    absolute = F.col("entry").startswith("/") | F.col("entry").contains("://") | F.col("entry").startswith("pipe:")
    resolved = F.when(absolute, F.col("entry")).otherwise(F.concat_ws("/", "folder", "entry"))
    return kept.select("line", resolved.alias("entry"))


def _ends_like_shard(path: Column) -> Column:
    return path.endswith(".tar") | path.endswith(".tar.gz")


def _is_remote(path: Column) -> Column:
    remote = F.lit(False)
    for prefix in REMOTE_PREFIXES:
        remote = remote | path.startswith(prefix)
    return remote


def _rank(rank: Sequence[int]) -> Column:
    return F.array(*[F.lit(r).cast("bigint") for r in rank])


def _folder(spark: SparkSession, path: str, rank: tuple[int, ...]) -> DataFrame:
    """Shards below a folder, plain tars before compressed ones, by path; contents are not read."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{tar,tar.gz}").load(path).select("path")
    )
    listed = manifest.keep_listed(listed.select(F.regexp_replace("path", "^file:/+", "/").alias("path")))
    later = F.col("path").endswith(".tar.gz").cast("bigint")
    return listed.select(F.concat(_rank(rank), F.array(later)).alias("rank"), "path")


def _require_files(df: DataFrame) -> DataFrame:
    """Fail on listed local shards that do not exist; checked by the tasks, not the driver."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                if not path.startswith(REMOTE_PREFIXES) and files.info(path).type != fs.FileType.File:
                    raise FileNotFoundError(f"Input not found: {path}")
            yield batch

    return df.mapInArrow(check, df.schema)


def _expand(
    spark: SparkSession, entry: str, rank: tuple[int, ...], above: tuple[str, ...]
) -> Iterator[DataFrame | tuple[list[int], str]]:
    """Tables of shards below folders and manifests, and (rank, path) of entries that are shards."""
    if entry.startswith(REMOTE_PREFIXES):
        yield list(rank), entry
        return
    found = files.info(os.path.expanduser(entry))
    path = os.path.normpath(os.path.expanduser(entry)) if "://" not in entry else entry
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(f"Input not found: {entry}")
    if found.type == fs.FileType.Directory:
        yield _folder(spark, path, rank)
    elif path.endswith(SHARD_SUFFIXES):
        yield list(rank), os.path.abspath(path) if "://" not in path else path
    elif path.endswith(MANIFEST_SUFFIX):
        if path in above:
            raise ValueError(f"manifest {entry} lists itself through {' > '.join(above[above.index(path):])}")
        lines = read_manifest(spark, path)
        direct = _is_remote(F.col("entry")) | _ends_like_shard(F.col("entry"))
        placed = F.concat(_rank(rank), F.col("line"))
        yield _require_files(lines.filter(direct).select(placed.alias("rank"), F.col("entry").alias("path")))
        # What is left are folders and nested manifests: entries to expand, not shards.
        for row in lines.filter(~direct).toLocalIterator():
            yield from _expand(spark, row["entry"], (*rank, *row["line"]), (*above, path))
    else:
        raise ValueError(f"Unsupported file type: {entry}")


def shard_catalog(spark: SparkSession, inputs: str | Sequence[str]) -> DataFrame:
    """(ordinal, path) of all shards in input order, first occurrence kept."""
    inputs = [inputs] if isinstance(inputs, str) else list(inputs)
    if not inputs:
        raise ValueError("no inputs given")
    tables, named = [], []
    for at, entry in enumerate(inputs):
        for part in _expand(spark, entry, (at,), ()):
            (tables if isinstance(part, DataFrame) else named).append(part)
    if named:
        tables.append(spark.createDataFrame(named, "rank array<bigint>, path string"))
    listed = reduce(DataFrame.unionByName, tables)
    firsts = listed.groupBy("path").agg(F.min("rank").alias("rank"))
    # Folder by folder: paths compare by their parts.
    return dense_ordinal(firsts, ["rank", F.split("path", "/")]).select("ordinal", "path")

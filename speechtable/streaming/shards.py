"""Streams into tar shards of exactly ``max_count`` samples.

An epoch numbers its rows after those left over before it, writes the shards that are full, and keeps the rest (less than one shard) for the next epoch. Its
log ``_epochs/<n>.json`` is written last and lists what it added: until then nothing of it counts, and an epoch that is replayed after it changes
nothing. Every ``COMPACT`` epochs their lists are put into one. ``finish`` writes the last, shorter shard and the folder's manifest.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from speechtable import settings
from speechtable.operators.ordering import numbered
from speechtable.plans import cleansing
from speechtable.sources import files, manifest, tarshards
from speechtable.sources.manifest import COMPACT, EPOCHS

_TAIL = "_tail"
_ID, _NUMBER = "__id__", "__number__"


class ShardAppender:
    """Appends epochs to a shard folder; its state is the folder's epoch log alone."""

    def __init__(self, folder: str, max_count: int, pattern: str = "dataset-%06d.tar", key: str = "key", order: str = "ordinal", rate: int | None = None):
        if max_count < 1:
            raise ValueError("max_count must be >= 1")
        self.folder, self.max_count, self.pattern, self.key, self.order, self.rate = folder.rstrip("/"), max_count, pattern, key, order, rate
        self.system, self.inner = files.locate(self.folder)

    def _state(self) -> dict | None:
        """The last epoch: its number, shards so far, and where its left-over rows lie."""
        epochs = manifest.epochs(self.system, self.inner)
        return json.loads(manifest.read(self.system, epochs[-1]).splitlines()[0]) if epochs else None

    def append(self, rows: DataFrame, epoch: int) -> bool:
        """Add the rows of an epoch, in ``order``; False if the log already has it. A finished folder takes no more."""
        if manifest.is_complete(self.folder):
            raise ValueError(f"{self.folder} is finished")
        manifest.begin(self.folder)
        state = self._state() or {"epoch": -1, "shards": 0, "tail": None, "rows": 0}
        if epoch <= state["epoch"]:
            return False
        spark = rows.sparkSession
        staged = settings.fresh_path(spark, "epoch")
        rows.withColumn(_ID, F.monotonically_increasing_id()).write.parquet(staged)
        rows = spark.read.parquet(staged)
        placed = numbered(rows, (), self.order, ties=[_ID], index=_NUMBER).withColumn(_NUMBER, F.col(_NUMBER) + state["rows"]).drop(_ID)
        total = state["rows"] + rows.count()
        if state["tail"]:
            placed = spark.read.schema(placed.schema).parquet(state["tail"]).unionByName(placed)
        full = total // self.max_count * self.max_count
        added = self._save(placed.filter(F.col(_NUMBER) < full), state["shards"]) if full else []
        tail = None
        if total > full:
            tail = f"{self.folder}/{_TAIL}/{epoch:012d}-{staged[-12:]}"
            placed.filter(F.col(_NUMBER) >= full).withColumn(_NUMBER, F.col(_NUMBER) - full).write.parquet(tail)
        shards = state["shards"] + full // self.max_count
        self._log(epoch, {"epoch": epoch, "shards": shards, "tail": tail, "rows": total - full}, added)
        for path in (staged, state["tail"]):
            if path:
                _drop(path)
        return True

    def finish(self, spark) -> bool:
        """Write what is left over as the last shard and make the folder complete; False if it is already."""
        if manifest.is_complete(self.folder):
            return False
        state = self._state() or {"shards": 0, "tail": None}
        added = self._save(spark.read.parquet(state["tail"]), state["shards"]) if state["tail"] else []
        manifest.commit(self.folder, [*(manifest.listed(self.folder) or []), *added])
        for name in (EPOCHS, _TAIL):
            _drop(f"{self.folder}/{name}")
        manifest.vacuum(spark, self.folder)
        return True

    def _save(self, rows: DataFrame, before: int) -> list[manifest.Shard]:
        """Write rows by their number into shards after ``before`` others; what was written."""
        listing = f"{settings.fresh_path(rows.sparkSession, 'listing')}.json"
        numbered_rows = rows.withColumn("__shard__", F.lit(before) + F.floor(F.col(_NUMBER) / self.max_count)).drop(self.order)
        tarshards.save_shards(numbered_rows, self.folder, self.pattern, self.key, _NUMBER, self.rate, listing)
        system, inner = files.locate(listing)
        found = manifest.parse(manifest.read(system, inner))
        system.delete_file(inner)
        return found

    def _log(self, epoch: int, state: dict, added: list[manifest.Shard]) -> None:
        earlier = manifest.epochs(self.system, self.inner)
        folder = f"{self.inner}/{EPOCHS}"
        self.system.create_dir(folder, recursive=True)
        shards = added
        name = f"{epoch:012d}.json"
        if len(earlier) >= COMPACT:
            shards, name = [*(manifest.listed(self.folder) or []), *added], f"{epoch:012d}.all.json"
        with self.system.open_output_stream(f"{folder}/{name}", compression=None) as out:
            out.write(json.dumps(state).encode() + b"\n" + manifest.lines(shards))
        if name.endswith(".all.json"):
            for path in earlier:
                self.system.delete_file(path)


def _drop(path: str) -> None:
    system, inner = files.locate(path)
    if system.get_file_info(inner).type == fs.FileType.Directory:
        system.delete_dir(inner)


def write_shards_stream(
    sdf: DataFrame, folder: str, max_count: int, checkpoint: str, pattern: str = "dataset-%06d.tar", key: str = "key", order: str = "ordinal",
    rate: int | None = None, prepare: Callable[[DataFrame, int], DataFrame] | None = None,
) -> StreamingQuery:
    """Append a stream to shards until the available input is used up; call ``ShardAppender(...).finish`` when no more will come.

    Columns are members as in ``write_tarshards``; rows of an epoch are written in ``order``, epochs one after another. ``prepare`` turns a micro-batch
    and its epoch into the rows to write.
    """
    sink = ShardAppender(folder, max_count, pattern, key, order, rate)

    def run(batch: DataFrame, epoch: int) -> None:
        sink.append(prepare(batch, epoch) if prepare else batch, epoch)

    return sdf.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def cleanse_stream_to_shards(
    sdf: DataFrame, folder: str, model_factory: Callable[..., Callable], target_rate: int, checkpoint: str, rejected: str, per_shard: int = 5000,
    pattern: str = "dataset-%06d.tar.gz", **options,
) -> StreamingQuery:
    """``cleanse_to_shards`` over a stream: good rows go to shards, the others (key, ordinal, reason) to Parquet in ``rejected``, by epoch."""

    done: list[str] = []

    def prepare(batch: DataFrame, epoch: int) -> DataFrame:
        while done:
            _drop(done.pop())  # the model's output of the epoch before
        made = settings.fresh_path(batch.sparkSession, "restored")
        done.append(made)
        cleansing.restored_rows(batch, model_factory, target_rate, **options).write.parquet(made)
        good, bad = cleansing.split_rows(batch.sparkSession.read.parquet(made))
        bad.write.mode("overwrite").parquet(f"{rejected.rstrip('/')}/epoch={epoch}")
        return good.select("key", "ordinal", "wav", F.col("transcript").alias("text.txt"), F.col("metadata").alias("metadata.json"))

    return write_shards_stream(sdf, folder, per_shard, checkpoint, pattern, rate=target_rate, prepare=prepare)

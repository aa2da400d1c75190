"""Tar shards as a stream, in and out."""

import io
import os
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechtable.plans import cleansing
from speechtable.sources import corpus, manifest, tarshards, tarstream
from speechtable.streaming import shards
from speechtable.streaming.restore import write_stream
from tests.test_shards import odd_members, write


def rows(spark, first, n):
    return spark.range(first, first + n).select(F.concat(F.lit("k"), F.lpad("id", 4, "0")).alias("key"), F.col("id").alias("ordinal"), F.concat(F.lit("t"), "id").alias("a.txt"))


def read(spark, folder):
    back = tarshards.read_tarshards(spark, folder).orderBy("ordinal").collect()
    return [(r.ordinal // tarshards.SHARD_STRIDE, r.key, bytes(r.members["a.txt"]).decode()) for r in back]


def arrived(spark, path):
    return sorted((r.ordinal, r.key, sorted((k, bytes(v)) for k, v in (r.members or {}).items()), r.error is not None) for r in spark.read.parquet(path).collect())


@pytest.mark.parametrize("most", [None, 1000, 17, 7])
def test_stream_equals_batch_and_restarts_inside_shards(spark, tmp_path, fresh, most):
    write(tmp_path / "a.tar", odd_members(20))
    write(tmp_path / "b.tar", odd_members(9))
    out, marks, seen = fresh("out"), fresh("marks"), fresh("seen")
    # Every run is a new reader: with a limit it starts where the last one stopped, inside a shard.
    runs = tarstream.drain(lambda: write_stream(tarstream.stream_tarshards(spark, str(tmp_path), seen, most), out, marks))
    batch = sorted((r.ordinal, r.key, sorted((k, bytes(v)) for k, v in r.members.items()), False) for r in tarshards.read_tarshards(spark, str(tmp_path)).collect())
    assert arrived(spark, out) == batch and runs == -(-len(batch) // (most or len(batch)))
    # Shards that come later take the next numbers, also where their names sort first.
    write(tmp_path / "0.tar", odd_members(5))
    tarstream.drain(lambda: write_stream(tarstream.stream_tarshards(spark, str(tmp_path), seen, most), out, marks))
    new = [r for r in arrived(spark, out) if r not in batch]
    assert len(new) == 7 and {n // tarshards.SHARD_STRIDE for n, *_ in new} == {2}


def test_manifest_counts_and_entries_serve_the_stream(spark, fresh, monkeypatch):
    monkeypatch.setattr(tarshards, "EVERY", 10)
    folder = fresh("shards")
    tarshards.write_tarshards(rows(spark, 0, 95), folder, 40)
    walked = []
    monkeypatch.setattr(tarstream, "_headers", lambda path: walked.append(path) or iter(()))
    reader = tarstream.TarShardStreamReader({"path": folder, "seen": fresh("seen"), "maxsamplespertrigger": "30", "splitsamples": "20"})
    end = reader.latestOffset()
    parts = reader.partitions(reader.initialOffset(), end)
    assert not walked and end == {"shard": 0, "sample": 30} and [(p.first, p.end) for p in parts][0] == (0, 20 if len(parts) > 1 else 30)
    found = [r for p in parts for b in reader.read(p) for r in b.column("key").to_pylist()]
    assert found == [f"k{i:04d}" for i in range(30)]
    later = reader.latestOffset()
    assert later == {"shard": 1, "sample": 20}
    found = [r for p in reader.partitions(end, later) for b in reader.read(p) for r in b.column("key").to_pylist()]
    assert found == [f"k{i:04d}" for i in range(30, 60)]


@pytest.mark.parametrize("suffix", ["tar", "tar.gz"])
def test_broken_shards_in_a_stream(spark, tmp_path, fresh, suffix):
    with tarfile.open(tmp_path / f"a.{suffix}", "w:gz" if suffix.endswith("gz") else "w") as tar:
        for i in range(30):
            info = tarfile.TarInfo(f"u{i}.wav")
            info.size = 5000
            tar.addfile(info, io.BytesIO(os.urandom(5000)))
    with open(tmp_path / f"a.{suffix}", "r+b") as out:
        out.truncate(60_000)
    (tmp_path / "b.tar").write_bytes(b"junk" * 400)
    out, marks, seen = fresh("out"), fresh("marks"), fresh("seen")
    tarstream.drain(lambda: write_stream(tarstream.stream_tarshards(spark, str(tmp_path), seen, 4), out, marks))
    batch = tarshards.read_tarshards(spark, str(tmp_path)).collect()
    got = spark.read.parquet(out).collect()
    assert sorted(r.key for r in got if r.error is None) == sorted(r.key for r in batch if r.error is None)
    assert sorted(os.path.basename(r.shard) for r in got if r.error) == sorted(os.path.basename(r.shard) for r in batch if r.error)


def test_stream_options_are_checked(spark, tmp_path):
    with pytest.raises(ValueError):
        tarstream.stream_tarshards(spark, str(tmp_path), "x", 0)
    with pytest.raises(ValueError):
        tarstream.TarShardStreamReader({"path": "x"})


def test_nothing_arrived_yet(spark, tmp_path, fresh):
    assert tarstream.drain(lambda: write_stream(tarstream.stream_tarshards(spark, str(tmp_path), fresh("seen")), fresh("out"), fresh("marks"))) == 0


# --- out ------------------------------------------------------------------------------------------


def test_epochs_make_the_shards_of_one_write(spark, fresh):
    folder = fresh("shards")
    sink = shards.ShardAppender(folder, 7)
    at = 0
    for epoch, n in enumerate((5, 0, 30, 1, 6, 7)):
        assert sink.append(rows(spark, at, n).repartition(3), epoch)
        at += n
        # Only whole shards are seen before the end, and a replayed epoch changes nothing.
        assert [r[1] for r in read(spark, folder)] == [f"k{i:04d}" for i in range(at // 7 * 7)]
        before = sorted(os.listdir(folder))
        assert not sink.append(rows(spark, at, 9), epoch) and sorted(os.listdir(folder)) == before
        assert not manifest.is_complete(folder)
    assert sink.finish(spark) and not sink.finish(spark)
    whole = fresh("whole")
    tarshards.write_tarshards(rows(spark, 0, at), whole, 7)
    assert read(spark, folder) == read(spark, whole) and [s.count for s in manifest.listed(folder)] == [7] * 7
    assert not [n for n in os.listdir(folder) if n.startswith("_") and n != "_SUCCESS"]
    with pytest.raises(ValueError, match="finished"):
        sink.append(rows(spark, 0, 1), 99)


def test_an_epoch_that_broke_off_is_written_anew(spark, fresh, monkeypatch):
    folder = fresh("shards")
    sink = shards.ShardAppender(folder, 4)
    sink.append(rows(spark, 0, 6), 0)
    monkeypatch.setattr(sink, "_log", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        sink.append(rows(spark, 6, 6), 1)
    monkeypatch.undo()
    assert [r[1] for r in read(spark, folder)] == [f"k{i:04d}" for i in range(4)]
    again = shards.ShardAppender(folder, 4)
    assert again.append(rows(spark, 6, 6), 1)
    again.finish(spark)
    assert [(n, k) for n, k, _ in read(spark, folder)] == [(i // 4, f"k{i:04d}") for i in range(12)]
    assert len([n for n in os.listdir(folder) if n.endswith(".tar")]) == 3


def test_lists_of_many_epochs_are_put_into_one(spark, fresh, monkeypatch):
    monkeypatch.setattr(shards, "COMPACT", 3)
    folder = fresh("shards")
    sink = shards.ShardAppender(folder, 2)
    for epoch in range(8):
        sink.append(rows(spark, epoch * 2, 2), epoch)
    assert len(os.listdir(f"{folder}/_epochs")) <= 4 and len(read(spark, folder)) == 16
    # A log that is cut short does not count.
    last = sorted(os.listdir(f"{folder}/_epochs"))[-1]
    with open(f"{folder}/_epochs/{last}", "r+b") as out:
        out.truncate(os.path.getsize(f"{folder}/_epochs/{last}") - 4)
    assert len(read(spark, folder)) == 14 and shards.ShardAppender(folder, 2).append(rows(spark, 14, 2), 7) and len(read(spark, folder)) == 16


def half(limit=1.0):
    def run(batch):
        if np.abs(batch).max() > limit:
            raise ValueError("too loud")
        return batch / 2

    return run


def test_cleansed_stream_equals_cleansed_batch(spark, fresh):
    def speech(first, n):
        return spark.range(first, first + n).select(
            F.concat(F.lit("u"), F.lpad("id", 3, "0")).alias("key"), F.col("id").alias("ordinal"), F.lit(16000).alias("sample_rate"),
            F.when(F.col("id") % 9 == 4, F.array_repeat(F.lit(9.0), 50)).otherwise(F.array_repeat((F.col("id") / 1000).cast("double"), 40)).alias("samples"), F.concat(F.lit("s"), "id").alias("text"))

    source, folder, marks, bad = fresh("in"), fresh("shards"), fresh("marks"), fresh("bad")
    options = dict(chunk_seconds=0.1, text_col="text", on_error="quarantine")
    for first, n in ((0, 11), (11, 2), (13, 20)):
        speech(first, n).coalesce(1).write.mode("append").parquet(source)
        shards.cleanse_stream_to_shards(corpus.stream_corpus(spark, source, 1), folder, half, 16000, marks, bad, 6, **options).awaitTermination()
    shards.ShardAppender(folder, 6, "dataset-%06d.tar.gz", rate=16000).finish(spark)
    whole = fresh("whole")
    cleansing.cleanse_to_shards(speech(0, 33), whole, half, 16000, 6, **options)

    def content(path):
        return [(r.ordinal, r.key, sorted((k, bytes(v)) for k, v in r.members.items())) for r in tarshards.read_tarshards(spark, path).orderBy("ordinal").collect()]

    assert content(folder) == content(whole) and len(content(whole)) == 29
    assert sorted(r.key for r in spark.read.parquet(bad).collect()) == ["u004", "u013", "u022", "u031"]

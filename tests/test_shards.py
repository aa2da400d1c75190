"""Split index of tar shards, and commits by manifest."""

import io
import os
import re
import tarfile

import numpy as np
import pytest
from pyarrow import fs
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from speechtable.plans import pairs
from speechtable.sources import catalog, manifest, tarindex, tarshards

LONG = "folder/" * 20 + "x" * 120


def inner_tar(n):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as tar:
        for i in range(n):
            info = tarfile.TarInfo(f"inside{i}.wav")
            info.size = 900
            tar.addfile(info, io.BytesIO(b"i" * 900))
    return out.getvalue()


def write(path, members, kind=tarfile.GNU_FORMAT):
    """A tar of (name, payload); a payload of None is a folder."""
    with tarfile.open(path, "w", format=kind) as tar:
        for name, payload in members:
            info = tarfile.TarInfo(name)
            if payload is None:
                info.type = tarfile.DIRTYPE
                tar.addfile(info)
            else:
                info.size = len(payload)
                tar.addfile(info, io.BytesIO(payload))
    return str(path)


def odd_members(n=60):
    """Long names, folders, members without suffix, tars as payloads, large and empty payloads, one key over many members."""
    out = [("d", None)]
    for i in range(n):
        key = f"{LONG}{i:03d}" if i % 7 == 0 else f"u{i:03d}"
        out += [(f"{key}.wav", inner_tar(i % 5) if i % 4 == 0 else bytes([i]) * (i * 137 % 5000)), (f"{key}.txt", b"t" * (i % 3))]
        if i % 5 == 0:
            out += [("stray", b"s" * 700), (f"{key}.json", b"{}")]
    return out + [("many." + str(i), b"m" * 600) for i in range(40)] + [("last.wav", b"\0" * 30000)]


def seen(df):
    return sorted((r.ordinal, r.key, sorted((k, bytes(v)) for k, v in r.members.items())) for r in df.collect())


@pytest.mark.parametrize("kind", [tarfile.GNU_FORMAT, tarfile.PAX_FORMAT])
@pytest.mark.parametrize("size", [512, 1024, 3000, 40_000])
def test_ranges_give_the_same_samples(spark, tmp_path, kind, size):
    write(tmp_path / "a.tar", odd_members(), kind)
    write(tmp_path / "b.tar", odd_members(9), kind)
    whole = seen(tarshards.read_tarshards(spark, str(tmp_path)))
    assert len(whole) == 60 + 1 + 1 + 9 + 2
    split = tarshards.read_tarshards(spark, str(tmp_path), split_bytes=size)
    assert split.rdd.getNumPartitions() > 2 and seen(split) == whole
    listed = catalog.shard_catalog(spark, str(tmp_path))
    assert seen(tarshards.read_listed(listed, split_bytes=size)) == whole == seen(tarshards.read_listed(listed))


def test_written_index_is_used_and_forgotten_when_a_shard_changes(spark, tmp_path):
    path = write(tmp_path / "a.tar", odd_members())
    folder = tarindex.write_index(spark, str(tmp_path), every=4, range_bytes=9000)
    entries = tarindex.read_entries(folder)
    (key, found), = entries.items()
    assert key == (path, os.path.getsize(path)) and {n for _, n in found} >= set(range(0, 62, 4))
    whole = seen(tarshards.read_tarshards(spark, str(tmp_path)))
    reader = spark.read.format("tarshards").option("splitBytes", 9000)
    cut = reader.load(str(tmp_path))
    assert seen(cut) == whole and cut.rdd.getNumPartitions() == len(tarindex.cut(found, 9000))
    listed = catalog.shard_catalog(spark, str(tmp_path))
    assert seen(tarshards.read_listed(listed, split_bytes=9000, index=folder)) == whole
    write(path, odd_members(31))
    assert len(seen(reader.load(str(tmp_path)))) == 33 == len(seen(tarshards.read_tarshards(spark, str(tmp_path), split_bytes=9000)))


class Counting:
    """A file system that counts what is read."""

    def __init__(self):
        self.system, self.bytes = fs.LocalFileSystem(), 0

    def open_input_file(self, path):
        source, outer = self.system.open_input_file(path), self

        class File(io.RawIOBase):
            def read(self, n=-1):
                data = source.read() if n is None or n < 0 else source.read(n)
                outer.bytes += len(data)
                return data

            def seek(self, at, whence=0):
                return source.seek(at, whence)

            def tell(self):
                return source.tell()

            def readable(self):
                return True

            def seekable(self):
                return True

            def close(self):
                source.close()

        return File()


def test_bytes_read_do_not_depend_on_the_place(spark, tmp_path, monkeypatch):
    path = write(tmp_path / "a.tar", [(f"u{i:05d}.wav", bytes(400)) for i in range(3000)])
    folder = tarindex.write_index(spark, str(tmp_path), every=50, range_bytes=1 << 20)
    (_, found), = tarindex.read_entries(folder).items()
    read = []
    for a, b, n in tarindex.cut(found, 100_000):
        system = Counting()
        monkeypatch.setattr(tarshards.files, "locate", lambda p, s=system: (s, p))
        rows = list(tarshards._samples(tarshards.ShardRange(path, 0, a, b, a, n), None))
        assert [r[0] for r in rows] == list(range(n, n + len(rows)))
        read.append(system.bytes / len(rows))
    assert len(read) > 20 and max(read) < 1.2 * min(read)


def test_training_batches_read_shards_once(spark, tmp_path):
    cols = ", ".join(f"`{name}` {kind}" for name, kind in pairs.RECORD.items())
    rows = [(i, f"k{i}", str(i), 24, 8, 6, *([0.5 * i, 1.0],) * 6) for i in range(10)]
    tarshards.write_tarshards(spark.createDataFrame(rows, f"ordinal long, key string, {cols}"), f"{tmp_path}/train", 4)
    found = pairs.training_batches(spark, str(tmp_path), "train", 4)
    # Every plan that numbers them reads the table made of them, not the shards.
    assert found.inputFiles() and all("typed" in path for path in found.inputFiles())
    got = found.collect()
    assert sorted((r["batch_id"], r["slot"]) for r in got) == [(i // 4, i % 4) for i in range(10)]
    assert {r["key"]: r["noisy_mel"] for r in got} == {str(i): [0.5 * i, 1.0] for i in range(10)}


def test_plain_members_equal_tarfile(tmp_path):
    """Names of all kinds, links, folders, broken ends: the same members, or the same error."""
    long = "deep/" * 30 + "x" * 120 + ".wav"
    for form in (tarfile.USTAR_FORMAT, tarfile.GNU_FORMAT, tarfile.PAX_FORMAT):
        path = tmp_path / f"{form}.tar"
        with tarfile.open(path, "w", format=form) as tar:
            for i, name in enumerate(["a.wav", "a.txt", "d/é.wav", "e" * 90 + "/" + "f" * 80 + ".wav", *([long] if form != tarfile.USTAR_FORMAT else []), "z.wav"]):
                info = tarfile.TarInfo(name)
                info.size = (0, 1, 511, 512, 513, 200_000)[i]
                tar.addfile(info, io.BytesIO(bytes([65 + i]) * info.size))
                if i == 1:
                    for kind in (tarfile.DIRTYPE, tarfile.SYMTYPE):
                        other = tarfile.TarInfo("other")
                        other.type, other.linkname = kind, "a.wav"
                        tar.addfile(other)
        whole = path.read_bytes()
        for size in (len(whole), len(whole) - 200_000, 1024, 1030, 1536, 2048, 700, 100, 0):
            path.write_bytes(whole[:size])
            results = []
            for plain in (True, False):
                got = []
                try:
                    with open(path, "rb") as source:
                        if plain:
                            for m in tarindex.plain_members(tarindex.Window(source, 3000), 0):
                                got.append((m.name, m.offset, m.data, m.size, m.file))
                        else:
                            with tarfile.open(fileobj=source, mode="r:") as tar:
                                for m in tar:
                                    got.append((m.name, m.offset, m.offset_data, m.size, m.isfile()))
                except tarfile.TarError as error:
                    got.append(type(error))
                results.append(got)
            assert results[0] == results[1]


def test_headers_equal_those_of_tarfile():
    for name, size in (("a.wav", 0), ("b" * 100, 8**11 - 1), ("d/e.txt", 513)):
        info = tarfile.TarInfo(name)
        info.size = size
        assert tarshards._header(name, size) == info.tobuf(tarfile.PAX_FORMAT)
    assert tarshards._header("é", 1) is tarshards._header("c" * 101, 1) is tarshards._header("d", 8**11) is None


def test_plain_ranges_are_read_some_kilobytes_at_a_time(tmp_path, monkeypatch):
    path = write(tmp_path / "a.tar", [(f"u{i:05d}.wav", bytes(400)) for i in range(1000)])
    system, reads = Counting(), []
    monkeypatch.setattr(tarshards.files, "locate", lambda p: (system, p))
    opened = system.open_input_file

    def counted(path):
        source = opened(path)
        whole = source.read
        source.read = lambda n=-1: (reads.append(n), whole(n))[1]
        return source

    system.open_input_file = counted
    assert len(list(tarshards._samples(tarshards.ShardRange(path, 0, 0, 1 << 62), None))) == 1000
    assert len(tarindex.walk(path, 0, 0, 1 << 62, 0)["starts"]) == 1000
    assert len(reads) < 400


def test_headers_found_by_checksum_and_set_right_after_a_false_one(tmp_path):
    path = write(tmp_path / "a.tar", [("a.wav", inner_tar(6)), ("b.wav", b"1")])
    with open(path, "rb") as source:
        assert tarindex.next_header(source, 0, 1 << 30) == 0
        # Inside the first payload a header of the tar it holds is found.
        assert tarindex.next_header(source, 1, 1 << 30) == 512
        assert tarindex.next_header(source, 1, 400) is None
    assert tarindex.walk(path, 0, 512, 1024, None)["starts"] == [512] and tarindex.walk(path, 0, 0, 512, 0)["next"] > 6000


def test_shards_that_cannot_be_indexed_are_read_as_before(spark, tmp_path):
    write(tmp_path / "good.tar", odd_members(9))
    (tmp_path / "junk.tar").write_bytes(b"not a tar at all" * 900)
    cut = write(tmp_path / "short.tar", odd_members(9))
    with open(cut, "r+b") as out:
        out.truncate(9000)
    with tarfile.open(tmp_path / "global.tar", "w", format=tarfile.PAX_FORMAT, pax_headers={"comment": "all"}) as tar:
        for i in range(30):
            info = tarfile.TarInfo(f"g{i}.wav")
            info.size = 600
            tar.addfile(info, io.BytesIO(b"g" * 600))
    plain = tarshards.read_tarshards(spark, str(tmp_path))
    for df in (tarshards.read_tarshards(spark, str(tmp_path), split_bytes=2000),
               tarshards.read_listed(catalog.shard_catalog(spark, str(tmp_path)), split_bytes=2000)):
        got, want = ({(os.path.basename(r.shard), r.key) for r in d.collect() if not r.error} for d in (df, plain))
        assert got == want and {os.path.basename(r.shard) for r in df.filter("error IS NOT NULL").collect()} == {"junk.tar", "short.tar"}
        assert df.filter("error IS NULL").count() == plain.filter("error IS NULL").count()


# --- commits --------------------------------------------------------------------------------------


def rows(spark, n, text="x"):
    return spark.range(n).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("ordinal"), F.lit(text).alias("a.txt"))


def texts(spark, folder):
    return sorted((r.key, bytes(r.members["a.txt"]).decode()) for r in tarshards.read_tarshards(spark, folder).collect())


def test_manifest_lists_names_counts_bytes_and_entries(spark, fresh, monkeypatch):
    folder = fresh("shards")
    tarshards.write_tarshards(rows(spark, 2500), folder, 1200)
    found = manifest.listed(folder)
    assert [s.count for s in found] == [1200, 1200, 100] and [re.sub("-[0-9a-f]{12}", "", s.name) for s in found] == [f"dataset-{i:06d}.tar" for i in range(3)]
    assert all(os.path.getsize(f"{folder}/{s.name}") == s.bytes for s in found)
    assert [[n for _, n in s.entries] for s in found] == [[0, 1000], [0, 1000], [0]]
    # The entries are places where samples start.
    want = texts(spark, folder)
    split = spark.read.format("tarshards").option("splitBytes", found[0].entries[1][0]).load(folder)
    assert split.rdd.getNumPartitions() == 5 and split.count() == len(want) == 2500
    assert sorted(r.ordinal % tarshards.SHARD_STRIDE for r in split.collect()) == sorted([*range(1200), *range(1200), *range(100)])


def test_commit_moves_nothing(spark, fresh, monkeypatch):
    folder = fresh("shards")
    os.makedirs(folder)
    calls = []

    class Watched:
        def __getattr__(self, name):
            calls.append(name)
            return getattr(fs.LocalFileSystem(), name)

    monkeypatch.setattr(manifest.files, "locate", lambda p: (Watched(), p))
    manifest.commit(folder, [manifest.Shard(f"d-{i}.tar", 1, 1) for i in range(50)])
    assert "move" not in calls and calls.count("open_output_stream") == 1 and len(calls) < 6
    assert len(manifest.listed(folder)) == 50


def test_strays_of_killed_and_repeated_attempts_are_not_read(spark, fresh):
    folder = fresh("shards")
    tarshards.write_tarshards(rows(spark, 20), folder, 5)
    stray = tarfile.open(f"{folder}/dataset-000001-abcdefabcdef.tar", "w")
    stray.addfile(tarfile.TarInfo("ghost.txt"))
    stray.close()
    assert texts(spark, folder) == sorted((f"k{i}", "x") for i in range(20))
    assert catalog.shard_catalog(spark, folder).count() == 4 == tarshards.read_listed(catalog.shard_catalog(spark, folder)).select("shard").distinct().count()
    assert manifest.vacuum(spark, folder) == 1 and not os.path.exists(f"{folder}/dataset-000001-abcdefabcdef.tar")
    os.remove(f"{folder}/{manifest.listed(folder)[0].name}")
    with pytest.raises(Exception, match="gone"):
        tarshards.list_shards(folder)


def test_first_write_that_breaks_off_shows_nothing(spark, fresh):
    folder = fresh("shards")
    manifest.begin(folder)
    tarfile.open(f"{folder}/dataset-000000-abcdefabcdef.tar", "w").close()
    assert tarshards.list_shards(folder) == [] and not manifest.is_complete(folder)
    with open(f"{folder}/_SUCCESS", "wb") as out:
        out.write(manifest.lines([manifest.Shard("dataset-000000-abcdefabcdef.tar", 0, 0)])[:-3])
    assert tarshards.list_shards(folder) == [] and not manifest.is_complete(folder)
    assert tarshards.write_tarshards(rows(spark, 4), folder, 5) and len(texts(spark, folder)) == 4
    assert not os.path.exists(f"{folder}/_WRITING")


def test_forced_rewrite_switches_at_once_or_not_at_all(spark, fresh):
    folder = fresh("shards")
    tarshards.write_tarshards(rows(spark, 20), folder, 5)
    bad = rows(spark, 12, "new").withColumn("a.txt", F.when(F.col("ordinal") == 9, F.raise_error(F.lit("boom")).cast("string")).otherwise(F.col("`a.txt`")))
    with pytest.raises(PySparkException):
        tarshards.write_tarshards(bad, folder, 3, force=True)
    assert texts(spark, folder) == sorted((f"k{i}", "x") for i in range(20))
    assert tarshards.write_tarshards(rows(spark, 7, "new"), folder, 3, force=True)
    assert texts(spark, folder) == sorted((f"k{i}", "new") for i in range(7)) and len(os.listdir(folder)) == 4


def test_folders_of_other_tools(spark, tmp_path, fresh):
    write(tmp_path / "a.tar", [("u.a.txt", b"x")])
    for marker in (b"", b"done at noon"):
        (tmp_path / "_SUCCESS").write_bytes(marker)
        assert texts(spark, str(tmp_path)) == [("u", "x")] and manifest.is_complete(str(tmp_path)) and manifest.listed(str(tmp_path)) is None
    assert not tarshards.write_tarshards(rows(spark, 3), str(tmp_path), 5)
    assert tarshards.write_tarshards(rows(spark, 3), str(tmp_path), 5, force=True)
    assert texts(spark, str(tmp_path)) == [(f"k{i}", "x") for i in range(3)] and not (tmp_path / "a.tar").exists()


def test_empty_table_makes_an_empty_finished_folder(spark, fresh):
    folder = fresh("shards")
    assert tarshards.write_tarshards(rows(spark, 0), folder, 5)
    assert manifest.listed(folder) == [] and manifest.is_complete(folder) and tarshards.read_tarshards(spark, folder).count() == 0
    assert np.iterable(manifest.parse(manifest.lines([])))

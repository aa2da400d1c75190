import io
import os
import re
import tarfile
import wave as riff

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from speechtable.operators import audit, records, restore, selection
from speechtable.plans import audits, cleansing
from speechtable.sources import catalog, corpus, files, ingest, tarshards


def write_tar(path, members):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with tarfile.open(path, "w:gz" if path.endswith(".gz") else "w") as tar:
        for name, payload in members:
            info = tarfile.TarInfo(name)
            info.size = len(payload)
            tar.addfile(info, io.BytesIO(payload))
    return path


def pcm(samples, rate=8000, width=2, channels=1):
    out = io.BytesIO()
    with riff.open(out, "wb") as sink:
        sink.setnchannels(channels)
        sink.setsampwidth(width)
        sink.setframerate(rate)
        sink.writeframes(samples)
    return out.getvalue()


# --- catalogue ------------------------------------------------------------------------------------


def test_catalog_order_manifests_and_duplicates(spark, tmp_path):
    root = str(tmp_path)
    for name in ("d/b.tar", "d/sub/a.tar", "d/a.tar.gz", "x.tar", "m/n.tar"):
        write_tar(f"{root}/{name}", [])
    (tmp_path / "m/inner.txt").write_text("n.tar\n")
    (tmp_path / "top.txt").write_text(f"# shards\n\n  s3://far/one.tar \n{root}/x.tar\nm/inner.txt\nd\ns3://far/one.tar\n")
    got = catalog.shard_catalog(spark, [f"{root}/x.tar", f"{root}/d", f"{root}/top.txt", "pipe:cat y.tar"]).orderBy("ordinal").collect()
    assert [r.ordinal for r in got] == list(range(7))
    assert [r.path for r in got] == [
        f"{root}/x.tar", f"{root}/d/b.tar", f"{root}/d/sub/a.tar", f"{root}/d/a.tar.gz", "s3://far/one.tar", f"{root}/m/n.tar",
        "pipe:cat y.tar",
    ]


def test_catalog_errors(spark, tmp_path):
    (tmp_path / "notes.md").write_text("x")
    (tmp_path / "list.txt").write_text("gone.tar\n")
    (tmp_path / "loop.txt").write_text("loop.txt\n")
    with pytest.raises(ValueError, match="Unsupported"):
        catalog.shard_catalog(spark, [str(tmp_path / "notes.md")])
    with pytest.raises(FileNotFoundError):
        catalog.shard_catalog(spark, [str(tmp_path / "nothing")])
    with pytest.raises(Exception, match="gone.tar"):
        catalog.shard_catalog(spark, [str(tmp_path / "list.txt")]).collect()
    with pytest.raises(ValueError, match="lists itself"):
        catalog.shard_catalog(spark, [str(tmp_path / "loop.txt")])


def test_object_uris(spark):
    df = spark.createDataFrame([("s3://b/k.tar",), ("pipe:aws --endpoint-url https://e s3 cp s3://b/k.tar -",), ("/x.tar",)], "uri string")
    assert [r.uri for r in records.to_object_uri(df, "uri").collect()] == ["s3a://b/k.tar", "s3a://b/k.tar", "/x.tar"]


# --- tar shards -----------------------------------------------------------------------------------


def test_grouping_of_members(spark, tmp_path):
    write_tar(f"{tmp_path}/a.tar", [
        ("d/u1.wav", b"1"), ("d/u1.text.txt", b"hi"), ("d/u2.WAV", b"2"), ("d/u1.wav", b"3"), ("noext", b"x"),
    ])
    rows = tarshards.read_tarshards(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [(r.ordinal, r.key, {k: bytes(v) for k, v in r.members.items()}) for r in rows] == [
        (0, "d/u1", {"wav": b"1", "text.txt": b"hi"}), (1, "d/u2", {"wav": b"2"}), (2, "d/u1", {"wav": b"3"})
    ]


def test_split_shards_give_every_sample_once(spark, tmp_path):
    members = [(f"u{i:04d}.{s}", bytes(i % 700)) for i in range(150) for s in ("wav", "txt")]
    write_tar(f"{tmp_path}/a.tar", members)
    whole = tarshards.read_tarshards(spark, str(tmp_path))
    for size in (512, 1000, 20000):
        split = tarshards.read_tarshards(spark, str(tmp_path), split_bytes=size)
        assert split.rdd.getNumPartitions() > whole.rdd.getNumPartitions()
        assert sorted((r.ordinal, r.key, len(r.members)) for r in split.collect()) == [(i, f"u{i:04d}", 2) for i in range(150)]


def test_broken_shards_by_mode(spark, tmp_path):
    write_tar(f"{tmp_path}/good.tar", [("a.wav", b"1")])
    write_tar(f"{tmp_path}/zip.tar.gz", [("b.wav", b"2" * 5000)])
    whole = (tmp_path / "zip.tar.gz").read_bytes()
    (tmp_path / "zip.tar.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "junk.tar").write_bytes(b"not a tar at all" * 100)
    kept = tarshards.read_tarshards(spark, str(tmp_path)).collect()
    assert {r.key for r in kept if r.error is None} == {"a"}
    assert sorted(os.path.basename(r.shard) for r in kept if r.error) == ["junk.tar", "zip.tar.gz"]
    assert tarshards.read_tarshards(spark, str(tmp_path), "DROPMALFORMED").count() == 1
    with pytest.raises(PySparkException):
        tarshards.read_tarshards(spark, str(tmp_path), "FAILFAST").collect()
    with pytest.raises(PySparkException):
        tarshards.read_tarshards(spark, str(tmp_path), "SOMEHOW").collect()


@pytest.mark.parametrize("suffix", ["tar", "tar.gz"])
def test_heads_and_sizes(spark, tmp_path, suffix):
    write_tar(f"{tmp_path}/a.{suffix}", [("u.mp3", b"abcdef"), ("u.txt", b"x"), ("v.wav", b"no wave")])
    rows = tarshards.read_tarshards(spark, str(tmp_path), head_bytes=2).orderBy("ordinal").collect()
    assert [({k: bytes(v) for k, v in r.members.items()}, r.sizes) for r in rows] == [
        ({"mp3": b"ab", "txt": b"x"}, {"mp3": 6, "txt": 1}), ({"wav": b""}, {"wav": 7})
    ]


def test_shard_uris():
    full = files.full
    assert full("/a/b/", "/a/b", "/a/b/c.tar") == "/a/b/c.tar"
    assert full("hdfs://h:9000/a", "/a", "/a/c.tar") == "hdfs://h:9000/a/c.tar"
    assert full("s3a://bucket/a", "bucket/a", "bucket/a/c.tar") == "s3a://bucket/a/c.tar"
    assert files.locate("file:///a/b")[1] == files.locate("file:/a/b")[1] == "/a/b"
    assert full("file:///a/b", "/a/b", "/a/b/c.tar") == "file:///a/b/c.tar" and files.plain("file:///a/b") == "/a/b"


def test_file_uris_read_like_paths(spark, tmp_path):
    write_tar(f"{tmp_path}/d/a.tar", [("u.wav", b"1")])
    for path in (f"file://{tmp_path}", f"{tmp_path}/d/a.tar", f"file://{tmp_path}/d/a.tar"):
        assert [(r.shard, r.key) for r in tarshards.read_tarshards(spark, path).collect()] == [(f"{tmp_path}/d/a.tar", "u")]


def test_empty_folder(spark, tmp_path):
    assert tarshards.read_tarshards(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("pattern", ["part-%03d.tar", "part-%03d.tar.gz"])
def test_write_rolls_skips_and_repeats(spark, fresh, pattern):
    folder = fresh("shards")
    df = spark.range(25).select(
        F.concat(F.lit("k"), "id").alias("key"), (F.col("id") * 10).alias("ordinal"),
        F.when(F.col("id") % 2 == 0, F.array(F.col("id").cast("float"))).alias("x.pth"), F.col("id").cast("int").alias("n.index"),
    )
    assert tarshards.write_tarshards(df.repartition(6), folder, 10, pattern)
    suffix = pattern[len("part-%03d"):]
    names = [re.sub(r"-[0-9a-f]{12}\.", ".", name) for name in sorted(os.listdir(folder))]
    assert names == ["_SUCCESS", *[f"part-{i:03d}{suffix}" for i in range(3)]]
    back = ingest.typed_members(tarshards.read_tarshards(spark, folder), {"x.pth": "array<float>", "n.index": "int"})
    rows = back.orderBy("ordinal").select("key", F.col("`x.pth`").alias("x"), F.col("`n.index`").alias("n")).collect()
    assert [r.key for r in rows] == [f"k{i}" for i in range(25)] and [r.n for r in rows] == list(range(25))
    assert [r.x for r in rows] == [[float(i)] if i % 2 == 0 else None for i in range(25)]
    assert not tarshards.write_tarshards(df, folder, 10, pattern)
    assert tarshards.write_tarshards(df, folder, 10, pattern, force=True)
    assert tarshards.read_tarshards(spark, folder).count() == 25
    with pytest.raises(ValueError):
        tarshards.write_tarshards(df, folder, 0)


def test_failed_write_leaves_no_shards(spark, fresh):
    folder = fresh("shards")
    bad = spark.range(10).select(F.col("id").alias("key"), F.col("id").alias("ordinal"),
                                 F.when(F.col("id") == 7, F.raise_error(F.lit("boom")).cast("string")).otherwise(F.lit("x")).alias("a.txt"))
    with pytest.raises(PySparkException):
        tarshards.write_tarshards(bad, folder, 3)
    assert not os.path.exists(f"{folder}/_SUCCESS")
    assert not os.path.isdir(folder) or tarshards.list_shards(folder) == []


# --- ingest ---------------------------------------------------------------------------------------


def test_pcm_widths_and_channels():
    ramp = np.array([-1.0, -0.5, 0.0, 0.5], dtype=np.float64)
    eight = ((ramp * 128) + 128).astype(np.uint8).tobytes()
    sixteen = (ramp * 2**15).astype("<i2").tobytes()
    thirty_two = (ramp * 2**31).astype("<i4").tobytes()
    twenty_four = b"".join(int(v * 2**23).to_bytes(3, "little", signed=True) for v in ramp)
    for raw, width in ((eight, 1), (sixteen, 2), (twenty_four, 3), (thirty_two, 4)):
        channels, rate = ingest.pcm_channels(pcm(raw, 8000, width))
        assert rate == 8000 and np.allclose(channels, [ramp])
        stereo, _ = ingest.pcm_channels(pcm(raw, 8000, width, channels=2))
        assert np.allclose(stereo, [ramp[::2], ramp[1::2]])


def test_decode_and_readable(spark):
    good = pcm(np.array([0, 16384], dtype="<i2").tobytes())
    df = spark.createDataFrame([("a.wav", good), ("b.WAV", good[:20]), ("c.flac", b"fLaC..."), ("d.txt", b"hi"), ("e.wav", None)],
                               "name string, payload binary")
    got = {r.name: r for r in ingest.decode_waves(df, "payload", "name").collect()}
    assert got["a.wav"].channels == [[0.0, 0.5]] and got["a.wav"].status is None
    assert {n: got[n].status is not None for n in got} == {"a.wav": False, "b.WAV": True, "c.flac": True, "d.txt": True, "e.wav": True}
    assert "no codec" in got["c.flac"].status and "not audio" in got["d.txt"].status
    assert {r.name for r in ingest.filter_readable(df, "payload", "name").collect()} == {"a.wav", "b.WAV", "c.flac"}


# --- audit ----------------------------------------------------------------------------------------


def test_audit_names_failed_shards_and_leaves_them_out(spark, tmp_path):
    second = np.zeros(8000, dtype="<f4").tobytes()
    write_tar(f"{tmp_path}/a.tar", [("u.x.pth", second), ("u.sr.index", b"8000"), ("v.text", b"no audio")])
    write_tar(f"{tmp_path}/b.tar", [("u.x.pth", second), ("u.sr.index", b"8000"), ("w.x.pth", second)])
    (tmp_path / "c.tar").write_bytes(b"junk" * 400)
    hours, failures = audits.audit_shards(spark, str(tmp_path), audio="x.pth")
    assert {(os.path.basename(r.shard) if r.shard else None): r.hours for r in hours.collect()} == {
        "a.tar": pytest.approx(1 / 3600, rel=1e-12), None: pytest.approx(1 / 3600, rel=1e-12)
    }
    assert {(os.path.basename(r.shard), r.reason) for r in failures.collect()} == {
        ("b.tar", "no sample rate"), ("c.tar", "unreadable shard")
    }
    known, _ = audits.audit_shards(spark, str(tmp_path), audio="x.pth", default_rate=8000)
    assert known.filter("is_total = 1").first().hours == pytest.approx(3 / 3600, rel=1e-12)


def test_audit_of_wav_members(spark, tmp_path):
    write_tar(f"{tmp_path}/a.tar", [("u.wav", pcm(np.zeros(4000, dtype="<i2").tobytes())), ("v.wav", pcm(np.zeros(4000, dtype="<i2").tobytes()))])
    hours, failures = audits.audit_shards(spark, str(tmp_path), audio="wav")
    assert hours.filter("is_total = 1").first().hours == pytest.approx(1 / 3600, rel=1e-12) and failures.count() == 0
    write_tar(f"{tmp_path}/b.tar", [("u.wav", b"RIFF"), ("w.txt", b"no audio")])
    hours, failures = audits.audit_shards(spark, str(tmp_path), audio="wav")
    assert hours.filter("is_total = 1").first().hours == pytest.approx(1 / 3600, rel=1e-12)
    assert [os.path.basename(r.shard) for r in failures.collect()] == ["b.tar"]


# --- columnar -------------------------------------------------------------------------------------


def test_export_rolls_files_and_skips_empty(spark, fresh):
    path = fresh("export")
    assert not corpus.export_corpus(spark.range(0), path) and not os.path.exists(path)
    assert corpus.export_corpus(spark.range(100).coalesce(1), path, max_rows=30)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 4
    numbered = corpus.read_corpus(spark, path, order=["id"])
    assert [(r.id, r.ordinal) for r in numbered.orderBy("id").collect()] == [(i, i) for i in range(100)]


def test_markers(spark, fresh):
    path = fresh("marks")
    assert corpus.completed_units(spark, path).count() == 0
    units = spark.createDataFrame([("en", "train"), ("ja", "train")], "unit string, split string")
    corpus.mark_completed(units.filter("unit = 'en'"), path)
    done = corpus.completed_units(spark, path)
    assert [r.unit for r in selection.skip_completed(units, done, ["unit", "split"]).collect()] == ["ja"]
    assert selection.skip_completed(units, done, ["unit", "split"], force=True).count() == 2


# --- restoration ----------------------------------------------------------------------------------


def double(limit=None):
    def run(batch):
        if limit is not None and np.abs(batch).max() > limit:
            raise ValueError("too loud")
        return np.repeat(batch, 2, axis=1) * 2  # twice the rate

    return run


def speech(spark, data):
    return spark.createDataFrame(data, "key string, ordinal bigint, samples array<float>, sample_rate int")


def test_restore_lengths_order_and_truncation(spark):
    df = speech(spark, [("a", 0, [0.5] * 10, 16000), ("b", 1, [0.25] * 1700, 16000), ("c", 2, [], 16000)])
    got = {r.key: r for r in restore.restore(df, double, 32000, batch_size=2, chunk_seconds=0.1).collect()}
    assert got["a"].restored == [1.0] * 20 and not got["a"].truncated and got["a"].restored_rate == 32000
    # The tail beyond the chunk is zeros, since the expected length counts the whole input.
    assert got["b"].truncated and got["b"].restored == [0.5] * 3200 + [0.0] * 200
    assert len(got["c"].restored) == 3200  # nothing expected: the model output stays as it is


def test_restore_policies(spark):
    df = speech(spark, [("a", 0, [0.5], 16000), ("b", 1, [9.0], 16000), ("c", 2, None, 16000), ("d", 3, [0.1], None)])
    kept = {r.key: r for r in restore.restore(df, double, 16000, 4, 0.1, "quarantine", config={"limit": 1.0}).collect()}
    assert kept["a"].status is None and "too loud" in kept["b"].status and "no audio" in kept["c"].status and "no sample rate" in kept["d"].status
    lost = {r.key: r for r in restore.restore(df.coalesce(1), double, 16000, 4, 0.1, "quarantine", config={"limit": 1.0}, retry=False).collect()}
    assert "too loud" in lost["a"].status and "too loud" in lost["b"].status
    with pytest.raises(PySparkException):
        restore.restore(df.filter("key = 'b'"), double, 16000, config={"limit": 1.0}).collect()
    with pytest.raises(ValueError):
        restore.restore(df, double, 16000, on_error="shrug")


def test_restore_on_features(spark):
    def factory():
        def run(batch):
            assert batch.shape[1:] == (4, 160)  # 0.1 s: 8 frames stacked by two
            return np.ones((len(batch), 5))

        return run

    df = speech(spark, [("a", 0, [0.1] * 1600, 16000)])
    assert restore.restore(df, factory, 16000, chunk_seconds=0.1, features=True).first().restored[:6] == [1.0] * 5 + [0.0]


def test_model_is_built_once_per_configuration():
    built = []

    def factory(size):
        built.append(size)
        return lambda batch: batch

    a = restore.cached_model(factory, {"size": 1})
    assert restore.cached_model(factory, {"size": 1}) is a
    restore.cached_model(factory, {"size": 2})
    restore.cached_model(factory, {"size": 1})
    assert built == [1, 2, 1]


def test_cleansing_to_shards(spark, fresh):
    rows = speech(spark, [("a", 0, [0.25] * 80, 8000), ("b", 5, [0.25] * 80, 8000), ("c", 9, [9.0] * 80, 8000)])
    folder = fresh("cleansed")
    options = dict(chunk_seconds=0.1, config={"limit": 5.0})
    counters = cleansing.cleanse_to_shards(rows, folder, double, 32000, 1, **options)
    assert {(r.outcome, r.n_rows) for r in counters.collect()} == {("processed", 2), ("skipped", 1)}
    back = tarshards.read_tarshards(spark, folder).orderBy("ordinal").collect()
    assert [r.key for r in back] == ["a", "b"] and len(tarshards.list_shards(folder)) == 2
    assert cleansing.cleanse_to_shards(rows, folder, double, 32000, 1, **options) is None


def test_cleansing_flow(spark, fresh):
    rows = speech(spark, [("a", 0, [0.25] * 80, 8000), ("b", 1, [0.25] * 80, 8000), ("c", 2, [9.0] * 80, 8000)])
    rows = rows.withColumn("text", F.when(F.col("key") == "a", F.lit("é")).otherwise(F.lit("")))
    done = spark.createDataFrame([("b",)], "key string")
    good, bad = cleansing.cleanse(rows, double, 32000, completed=done, text_col="text", chunk_seconds=0.1, config={"limit": 5.0})
    only = good.collect()
    assert [(r.key, len(r.wav), r.transcript) for r in only] == [("a", 320, "é")] and '"text":"é"' in only[0].metadata
    assert [(r.key, "too loud" in r.reason) for r in bad.collect()] == [("c", True)]
    counted, watch = audit.observed(restore.restore(rows, double, 32000, 4, 0.1, "quarantine", model_rate=16000, config={"limit": 5.0}))
    counted.write.format("noop").mode("overwrite").save()
    assert watch.get == {"attempted": 3, "processed": 2, "skipped": 1}


# --- records --------------------------------------------------------------------------------------


def test_record_rules(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(0, "k0", 1.5), (1, None, None)], "ordinal bigint, id string, x double")
    assert [r.key for r in records.with_key(df, "id", "train").orderBy("ordinal").collect()] == ["k0", "train-000000001"]
    assert records.require_columns(df, "x", "id") == "id"
    with pytest.warns(UserWarning):
        assert records.require_columns(df, "x", "nope") is None
    with pytest.raises(ValueError):
        records.require_columns(df, "audio")
    assert records.audio_column(df.withColumnRenamed("x", "my_audio_1")).columns == ["ordinal", "id", "audio"]
    declared = T.StructType([T.StructField("x", T.FloatType()), T.StructField("id", T.StringType())])
    assert records.conform(df, declared).schema == declared
    wrong = T.StructType([T.StructField("missing", T.StringType(), False)])
    with pytest.warns(UserWarning):
        assert records.conform(df, wrong).columns == df.columns
    assert [r.j for r in records.metadata_json(df, ["id", "x"], "j").orderBy("ordinal").collect()] == ['{"id":"k0","x":1.5}', "{}"]


def test_error_policy(spark):
    df = spark.createDataFrame([(1, 5), (2, None)], "key int, rate int")
    good, bad = records.split_quarantine(df, {"no rate": F.col("rate").isNull(), "never": F.lit(True) & (F.col("key") == 2)})
    assert [r.key for r in good.collect()] == [1] and [(r.key, r.reason) for r in bad.collect()] == [(2, "no rate")]
    strict, none = records.split_quarantine(df, {"no rate": F.col("rate").isNull()}, "fail")
    with pytest.raises(PySparkException, match="no rate"):
        strict.collect()
    assert none.count() == 0
    fine, _ = records.split_quarantine(df.filter("key = 1"), {"no rate": F.col("rate").isNull()}, "fail")
    assert fine.columns == ["key", "rate"] and fine.count() == 1


def test_record_encoding(spark):
    df = spark.range(1).select(
        F.array(F.lit(1.0)).alias("wav"), F.lit("t").alias("names"), F.lit(3).alias("sr"), F.create_map(F.lit("a"), F.lit(1)).alias("extra")
    )
    coded = records.encode_record(df)
    assert coded.columns == ["__key__", "wav.pth", "names.txt", "sr.index", "extra.pickle"]
    row = coded.first()
    assert row["extra.pickle"] == '{"a":1}' and len(row["__key__"]) == 64 and row["__key__"] == records.encode_record(df).first()["__key__"]

"""Registered queries: sources, sinks and streams, over shards written from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from speechtable import settings
from speechtable.operators import audit, ordering, records
from speechtable.plans import audits, cleansing, pairs
from speechtable.plans import fixtures as fx
from speechtable.plans.degrade_queries import _BANDS, AUDIBLE, _chain_ctes, _prepared_ctes, _rates_ctes, half_gain
from speechtable.plans.registry import digest, query, samples_long, sql_digest, sql_long
from speechtable.plans.wave_queries import merged_sql
from speechtable.sources import catalog, corpus, files, ingest, manifest, tarindex, tarshards, tarstream
from speechtable.streaming import shards
from speechtable.streaming.merge import merge_to_length_stream
from speechtable.streaming.restore import restore_stream, write_stream

PER_SHARD = 250
#: A shard's number in its file name; the writing attempt's name follows it.
_NUMBER = r"-(\d+)-[0-9a-f]{12}\.tar$"


def _written(spark, sf, pattern="dataset-%06d.tar", per_shard=PER_SHARD):
    """Waves as tar shards: float samples, rate, a text and metadata."""
    folder = settings.fresh_path(spark, "shards")
    rows = fx.wave(spark, sf).withColumn("name", F.concat(F.lit("spk"), "speaker"))
    rows = records.metadata_json(rows, ["key", "speaker"]).select(
        F.col("key"), F.col("samples").cast("array<float>").alias("input_wav.pth"),
        F.col("sample_rate").alias("sr.index"), F.col("name").alias("text.txt"), F.col("metadata").alias("metadata.json"),
    )
    placed = rows.withColumn("ordinal", F.col("key"))
    tarshards.write_tarshards(placed, folder, per_shard, pattern)
    return folder


_FIELDS = {"sr.index": "int", "text.txt": "string", "input_wav.pth": "array<float>"}


@query("WITH m AS (SELECT CAST(key AS VARCHAR) AS key, samples AS y FROM wave) " + sql_long("m"), ["wave"])
def tar_round_trip(spark, sf):
    rows = tarshards.read_tarshards(spark, _written(spark, sf))
    typed = ingest.typed_members(rows, _FIELDS)
    return samples_long(typed.withColumn("y", F.col("`input_wav.pth`").cast("array<double>")), ["key"], "y")


@query(
    """SELECT CAST(key AS VARCHAR) AS key, (row_number() OVER (ORDER BY key) - 1) // 250 AS shard_number,
        (row_number() OVER (ORDER BY key) - 1) % 250 AS sample_number, 16 AS rate, 'spk' || speaker AS text,
        CAST(speaker AS VARCHAR) AS speaker, round(list_sum(samples), 4) AS total FROM wave""",
    ["wave"],
)
def compressed_tar_members(spark, sf):
    rows = tarshards.read_tarshards(spark, _written(spark, sf, "part-%04d.tar.gz"))
    typed = ingest.typed_members(rows, {"sr.index": "int", "text.txt": "string", "metadata.json": "string", "input_wav.pth": "array<float>"})
    return typed.select(
        "key",
        F.floor(F.col("ordinal") / tarshards.SHARD_STRIDE).cast("bigint").alias("shard_number"),
        F.pmod(F.col("ordinal"), F.lit(tarshards.SHARD_STRIDE)).cast("bigint").alias("sample_number"),
        F.col("`sr.index`").alias("rate"), F.col("`text.txt`").alias("text"),
        F.get_json_object(F.col("`metadata.json`"), "$.speaker").alias("speaker"),
        F.round(F.aggregate(F.col("`input_wav.pth`").cast("array<double>"), F.lit(0.0), lambda s, v: s + v), 4).alias("total"),
    )


@query("WITH m AS (SELECT CAST(key AS VARCHAR) AS key, samples AS y FROM wave) " + sql_digest("m"), ["wave"])
def split_tar_ranges(spark, sf):
    """Each shard read by several tasks: every sample comes once, with its audio."""
    rows = tarshards.read_tarshards(spark, _written(spark, sf), split_bytes=64 << 10)
    typed = ingest.typed_members(rows, {"input_wav.pth": "array<float>"})
    return digest(typed.withColumn("y", F.col("`input_wav.pth`").cast("array<double>")), ["key"], "y")


@query(
    "WITH m AS (SELECT CAST(key AS VARCHAR) AS key, samples AS y, (row_number() OVER (ORDER BY key) - 1) % 250 AS place FROM wave) "
    + sql_digest("m", "key, place"), ["wave"])
def indexed_tar_ranges(spark, sf):
    """A header index beside the corpus; the shards of a catalogue are cut at its entries, and samples keep their numbers."""
    folder = _written(spark, sf)
    index = tarindex.write_index(spark, folder, every=20, range_bytes=32 << 10)
    rows = tarshards.read_listed(catalog.shard_catalog(spark, folder), split_bytes=48 << 10, index=index)
    rows = rows.withColumn("place", F.pmod("ordinal", F.lit(tarshards.SHARD_STRIDE)))
    typed = ingest.typed_members(rows, {"input_wav.pth": "array<float>"})
    return digest(typed.withColumn("y", F.col("`input_wav.pth`").cast("array<double>")), ["key", "place"], "y")


@query(
    """SELECT shard_number, count(*) AS n, count(*) AS n_read FROM (
        SELECT CAST((row_number() OVER (ORDER BY key) - 1) // 100 AS INT) AS shard_number FROM wave) GROUP BY shard_number""",
    ["wave"],
)
def committed_shards(spark, sf):
    """A forced rewrite with other shard sizes beside what a killed attempt left: the manifest's counts, and what is read."""
    folder = _written(spark, sf)
    left = manifest.Shard("dataset-000000-0123456789ab.tar", 1, 1)
    system, inner = files.locate(folder)
    system.copy_file(f"{inner}/{manifest.listed(folder)[0].name}", f"{inner}/{left.name}")
    rows = fx.wave(spark, sf).select("key", F.col("key").alias("ordinal"), F.col("samples").cast("array<float>").alias("input_wav.pth"))
    tarshards.write_tarshards(rows, folder, 100, force=True)
    listed = manifest.table(spark, folder).select(F.regexp_extract("name", _NUMBER, 1).cast("int").alias("shard_number"), F.col("count").alias("n"))
    read = tarshards.read_tarshards(spark, folder).groupBy(F.regexp_extract("shard", _NUMBER, 1).cast("int").alias("shard_number"))
    return listed.join(read.agg(F.count(F.lit(1)).alias("n_read")), "shard_number", "full")


@query(
    """SELECT 'dataset-' || lpad(CAST(i AS VARCHAR), 6, '0') || '.tar' AS name, i AS ordinal
        FROM (SELECT unnest(range(CAST(ceil(count(*) / 250.0) AS BIGINT))) AS i FROM wave)""",
    ["wave"],
)
def shard_catalog(spark, sf):
    listed = catalog.shard_catalog(spark, [_written(spark, sf)])
    # Between number and suffix stands the writing attempt's name.
    return listed.select(F.regexp_replace(F.regexp_extract("path", "([^/]+)$", 1), r"-[0-9a-f]{12}\.", ".").alias("name"), "ordinal")


@query(
    """SELECT ordinal, CASE WHEN ordinal % 2 = 0 THEN 's3://corpus/' || key ELSE '/corpus/' || key END || '.tar' AS entry
        FROM utt WHERE ordinal % 10 <> 9""",
    ["utt"],
)
def manifest_entries(spark, sf):
    """A manifest of all utterances; every tenth line is a comment."""
    path = settings.fresh_path(spark, "manifest")
    tar = F.when(F.col("ordinal") % 2 == 0, F.concat(F.lit("s3://corpus/"), "key", F.lit(".tar"))).otherwise(
        F.concat(F.lit("/corpus/"), "key", F.lit(".tar"))
    )
    line = F.when(F.col("ordinal") % 10 == 9, F.concat(F.lit("# "), tar)).otherwise(F.concat(F.lit("  "), tar, F.lit(" ")))
    utt = fx.utt(spark, sf)
    # One manifest file per 10,000 utterances, each read as a manifest of its own.
    lines = utt.select(F.floor(F.col("ordinal") / 10000).alias("part"), "ordinal", line.alias("value"))
    lines.repartition("part").sortWithinPartitions("part", "ordinal").select("part", "value").write.partitionBy("part").text(path)
    entries = catalog.read_manifest(spark, path).select("entry")
    key = F.regexp_extract("entry", r"([0-9]+)\.tar$", 1)
    return entries.select(key.cast("bigint").alias("ordinal"), "entry")


def _wav_members(spark, sf):
    """Waves as members: PCM WAV, every tenth cut to ten bytes, every seventh named .flac, every eleventh .txt."""
    coded = ingest.encode_waves(fx.wave(spark, sf)).withColumn(
        "name",
        F.concat("key", F.when(F.col("key") % 11 == 0, F.lit(".txt")).when(F.col("key") % 7 == 0, F.lit(".flac")).otherwise(F.lit(".WAV"))),
    )
    return coded.withColumn("wav", F.when(F.col("key") % 10 == 0, F.substring("wav", 1, 10)).otherwise(F.col("wav")))


@query(
    """WITH m AS (SELECT key, list_transform(samples, lambda v: least(round_even(v * 32768, 0), 32767) / 32768) AS y FROM wave
        WHERE key % 11 <> 0 AND key % 7 <> 0 AND key % 10 <> 0) """ + sql_long("m"),
    ["wave"],
)
def decoded_waves(spark, sf):
    decoded = ingest.decode_waves(_wav_members(spark, sf).select("key", "name", "wav"), "wav", "name")
    good = decoded.filter(F.col("status").isNull())
    return samples_long(good.select("key", F.get("channels", F.lit(0)).cast("array<double>").alias("y")), ["key"], "y")


@query(
    """SELECT CASE WHEN key % 11 = 0 THEN 'ValueError: not audio' WHEN key % 7 = 0 THEN 'ValueError: no codec for flac'
        ELSE 'ValueError: broken wav' END AS status, count(*) AS n FROM wave
        WHERE key % 11 = 0 OR key % 7 = 0 OR key % 10 = 0 GROUP BY ALL""",
    ["wave"],
)
def undecodable_members(spark, sf):
    decoded = ingest.decode_waves(_wav_members(spark, sf).select("key", "name", "wav"), "wav", "name")
    return decoded.filter(F.col("status").isNotNull()).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT key, CAST(len(samples) AS BIGINT) AS n_samples, sample_rate FROM wave
        WHERE key % 11 <> 0 AND key % 7 <> 0 AND key % 10 <> 0""",
    ["wave"],
)
def probed_members(spark, sf):
    """Lengths and rates from the first bytes of each WAV member."""
    probed = ingest.probe_waves(_wav_members(spark, sf).select("key", "name", "wav"), "wav", "name")
    return probed.filter(F.col("status").isNull()).select("key", "n_samples", "sample_rate")


@query(
    """SELECT ordinal, (row_number() OVER (ORDER BY ordinal) - 1) // 7 AS shard_id FROM
        (SELECT doc_id * 3 AS ordinal FROM labels)""",
)
def numbered_shards(spark, sf):
    """Shard numbers over ordinals with gaps."""
    rows = fx.flag(spark, sf).select((F.col("ordinal") * 3).alias("ordinal"))
    return ordering.assign_shards(rows, 7)


@query("SELECT key FROM wave WHERE key % 11 <> 0 AND key % 7 <> 0 AND key % 10 <> 0", ["wave"])
def readable_members(spark, sf):
    return ingest.filter_readable(_wav_members(spark, sf), "wav", "name").select("key")


@query("SELECT key, language, n_samples FROM utt WHERE shard = 'src3'", ["utt"])
def corpus_split(spark, sf):
    """One split of a partitioned corpus, pruned to its folder and columns."""
    root = settings.fresh_path(spark, "corpus")
    corpus.write_split(fx.utt(spark, sf).withColumnRenamed("shard", "split"), root, "first")
    return corpus.read_corpus(spark, root, "src3", ["key", "language", "n_samples", "split"]).drop("split")


@query(
    """SELECT shard AS split, CASE WHEN shard = 'src1' THEN 'second' ELSE 'first' END AS run, count(*) AS n,
        CAST(sum(ordinal) AS BIGINT) AS ordinals FROM utt GROUP BY ALL
        UNION ALL SELECT shard, 'first', count(*), CAST(sum(ordinal) AS BIGINT) FROM utt WHERE shard = 'src1' GROUP BY ALL""",
    ["utt"],
)
def split_run_layout(spark, sf):
    """Two runs, the first repeated: a repetition replaces its own folders only."""
    root = settings.fresh_path(spark, "runs")
    utt = fx.utt(spark, sf).withColumnRenamed("shard", "split")
    for run in ("first", "first"):
        corpus.write_split(utt, root, run)
    corpus.write_split(utt.filter("split = 'src1'"), root, "second")
    return corpus.read_corpus(spark, root).groupBy("split", "run").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ordinal").alias("ordinals")
    )


@query("SELECT ordinal, key, row_number() OVER (ORDER BY shard, ordinal) - 1 AS position FROM utt", ["utt"])
def exported_corpus(spark, sf):
    """Parquet export in small files, read back with a dense ordinal."""
    path = settings.fresh_path(spark, "export")
    corpus.export_corpus(fx.utt(spark, sf), path, max_rows=64)
    back = corpus.read_corpus(spark, path).withColumnRenamed("ordinal", "source_ordinal")
    placed = ordering.dense_ordinal(back, ["shard", "source_ordinal"], "position", unique=True)
    return placed.select(F.col("source_ordinal").alias("ordinal"), "key", "position")


@query(
    "SELECT shard, language FROM utt WHERE (shard, language) NOT IN (SELECT shard, language FROM utt WHERE n_samples > 25000) GROUP BY ALL",
    ["utt"],
)
def unmarked_units(spark, sf):
    """Completion markers appended in two writes, then what is left to do."""
    path = settings.fresh_path(spark, "markers")
    units = fx.utt(spark, sf)
    done = units.filter("n_samples > 25000").select(F.col("shard").alias("unit"), F.col("language").alias("split")).distinct()
    corpus.mark_completed(done.filter("split = 'en'"), path)
    corpus.mark_completed(done.filter("split <> 'en'"), path)
    marked = corpus.completed_units(spark, path).select(F.col("unit").alias("shard"), F.col("split").alias("language"))
    return units.select("shard", "language").distinct().join(marked, ["shard", "language"], "left_anti")


@query(
    """SELECT CAST(i AS INT) AS shard_number, round(sum(64 / 16.0) / 3600, 9) AS hours, count(*) AS n_utterances
        FROM (SELECT (row_number() OVER (ORDER BY key) - 1) // 250 AS i FROM wave) GROUP BY i""",
    ["wave"],
)
def shard_file_hours(spark, sf):
    """Audit of shard files: true lengths, from the member sizes alone."""
    rows = tarshards.read_tarshards(spark, _written(spark, sf), head_bytes=16)
    sizes = rows.select(
        "shard", F.floor(F.col("sizes")["input_wav.pth"] / 4).alias("n_samples"),
        F.col("members")["sr.index"].cast("string").cast("int").alias("sample_rate"),
    )
    hours = audit.shard_hours(sizes)
    return hours.select(F.regexp_extract("shard", _NUMBER, 1).cast("int").alias("shard_number"), F.round("hours", 9).alias("hours"), "n_utterances")


@query("SELECT shard, count(*) AS n, CAST(sum(n_samples) AS BIGINT) AS n_samples FROM utt GROUP BY shard", ["utt"])
def streamed_corpus(spark, sf):
    source = settings.fresh_path(spark, "stream-in")
    fx.utt(spark, sf).repartition("key").write.parquet(source)
    out, marks = settings.fresh_path(spark, "stream-out"), settings.fresh_path(spark, "stream-marks")
    write_stream(corpus.stream_corpus(spark, source, 2), out, marks).awaitTermination()
    return spark.read.parquet(out).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum("n_samples").alias("n_samples"))


LANE, SLICES = 258, 3  # keys per lane, and the arrivals a lane is spread over


@query(
    merged_sql(f"(SELECT *, speaker || ':' || (key // {LANE}) AS lane FROM clips)", "lane"), ["clips"]
)
def merged_stream(spark, sf):
    """The greedy merge over micro-batches, the open group carried as state.

    A speaker is split in lanes of keys, and each lane arrives in three slices, one after another.
    """
    source = settings.fresh_path(spark, "stream-in")
    lane = F.concat_ws(":", "speaker", F.floor(F.col("key") / LANE))
    rows = fx.clips(spark, sf).withColumn("lane", lane)
    arrival = F.floor(F.pmod("key", F.lit(LANE)) * SLICES / LANE)
    for at in range(SLICES):
        rows.filter(arrival == at).repartition("lane").write.mode("append").parquet(source)
    out, marks = settings.fresh_path(spark, "stream-out"), settings.fresh_path(spark, "stream-marks")
    merged = merge_to_length_stream(corpus.stream_corpus(spark, source, 5), 10.0, "lane", order="key")
    write_stream(merged, out, marks).awaitTermination()
    found = spark.read.parquet(out).withColumn("key", F.col("key").cast("bigint"))
    return samples_long(found, ["lane", "key", "n_members"], "samples")


@query("WITH m AS (SELECT key, list_transform(samples, lambda v: v / 2) AS y FROM wave) " + sql_long("m"), ["wave"])
def restored_stream(spark, sf):
    source = settings.fresh_path(spark, "stream-in")
    fx.wave(spark, sf).repartition("key").write.parquet(source)
    out, marks = settings.fresh_path(spark, "stream-out"), settings.fresh_path(spark, "stream-marks")
    rows = corpus.stream_corpus(spark, source, 2)
    restore_stream(rows, half_gain, out, marks, 16, chunk_seconds=0.1, config={"scale": 0.5}).awaitTermination()
    return samples_long(spark.read.parquet(out).withColumn("y", F.col("restored").cast("array<double>")), ["key"], "y")


@query(
    """WITH m AS (SELECT CAST(key AS VARCHAR) AS key, 'spk' || speaker AS text, CAST(speaker AS VARCHAR) AS speaker,
        list_transform(samples, lambda v: round_even(v / 2 * 32768, 0) / 32768) AS y FROM wave) """
    + sql_long("m", "key, text, speaker"),
    ["wave"],
)
def cleansed_shards(spark, sf):
    """Restore (half as loud), write compressed WAV shards with text and metadata, read them back."""
    folder = settings.fresh_path(spark, "cleansed")
    rows = fx.wave(spark, sf).withColumns({"ordinal": F.col("key"), "name": F.concat(F.lit("spk"), "speaker")})
    cleansing.cleanse_to_shards(
        rows, folder, half_gain, 16, PER_SHARD, config={"scale": 0.5}, chunk_seconds=4.0, model_rate=16, text_col="name"
    )
    back = tarshards.read_tarshards(spark, folder)
    named = back.select(
        "key", F.col("members")["text.txt"].cast("string").alias("text"),
        F.get_json_object(F.col("members")["metadata.json"].cast("string"), "$.speaker").alias("speaker"),
        F.col("members")["wav"].alias("wav"), F.lit("restored.wav").alias("name"),
    )
    decoded = ingest.decode_waves(named, "wav", "name")
    return samples_long(
        decoded.withColumn("y", F.get("channels", F.lit(0)).cast("array<double>")), ["key", "text", "speaker"], "y"
    )


@query(
    "WITH m AS (SELECT CAST(key AS VARCHAR) AS key, samples AS y, (row_number() OVER (ORDER BY key) - 1) % 250 AS place FROM wave) "
    + sql_digest("m", "key, place"), ["wave"])
def streamed_tar_shards(spark, sf):
    """Shards as a stream whose triggers end inside shards; every run starts a new query where the last one stopped."""
    folder, seen = _written(spark, sf), settings.fresh_path(spark, "seen")
    out, marks = settings.fresh_path(spark, "stream-out"), settings.fresh_path(spark, "stream-marks")
    most = 1 + fx.wave(spark, sf).count() * 2 // 5
    tarstream.drain(lambda: write_stream(tarstream.stream_tarshards(spark, folder, seen, most), out, marks))
    rows = spark.read.parquet(out).withColumn("place", F.pmod("ordinal", F.lit(tarshards.SHARD_STRIDE)))
    typed = ingest.typed_members(rows, {"input_wav.pth": "array<float>"})
    return digest(typed.withColumn("y", F.col("`input_wav.pth`").cast("array<double>")), ["key", "place"], "y")


@query(
    """WITH m AS (SELECT CAST(key AS VARCHAR) AS key, 'spk' || speaker AS text, CAST(speaker AS VARCHAR) AS speaker,
        list_transform(samples, lambda v: round_even(v / 2 * 32768, 0) / 32768) AS y FROM wave) """
    + sql_long("m", "key, text, speaker"),
    ["wave"],
)
def streamed_cleansed_shards(spark, sf):
    """The restoring stream into shards of equal size, rows that do not fill one carried over to the next epoch."""
    source = settings.fresh_path(spark, "stream-in")
    rows = fx.wave(spark, sf).withColumns({"ordinal": F.col("key"), "name": F.concat(F.lit("spk"), "speaker")})
    rows.repartitionByRange(5, "ordinal").write.parquet(source)
    folder, rejected = settings.fresh_path(spark, "cleansed"), settings.fresh_path(spark, "rejected")
    shards.cleanse_stream_to_shards(
        corpus.stream_corpus(spark, source, 2), folder, half_gain, 16, settings.fresh_path(spark, "stream-marks"), rejected, 70,
        config={"scale": 0.5}, chunk_seconds=4.0, model_rate=16, text_col="name").awaitTermination()
    shards.ShardAppender(folder, 70, "dataset-%06d.tar.gz", rate=16).finish(spark)
    back = tarshards.read_tarshards(spark, folder)
    named = back.select(
        "key", F.col("members")["text.txt"].cast("string").alias("text"),
        F.get_json_object(F.col("members")["metadata.json"].cast("string"), "$.speaker").alias("speaker"),
        F.col("members")["wav"].alias("wav"), F.lit("restored.wav").alias("name"),
    )
    decoded = ingest.decode_waves(named, "wav", "name")
    return samples_long(decoded.withColumn("y", F.get("channels", F.lit(0)).cast("array<double>")), ["key", "text", "speaker"], "y")


@query(
    """WITH s AS (SELECT CAST((row_number() OVER (ORDER BY key) - 1) // 250 AS INT) AS shard_number FROM wave)
        SELECT shard_number, round(sum(64 / 16.0) / 3600, 9) AS hours, CAST(grouping(shard_number) AS INT) AS is_total
        FROM s GROUP BY ROLLUP(shard_number)""",
    ["wave"],
)
def audited_shards(spark, sf):
    hours, _ = audits.audit_shards(spark, _written(spark, sf))
    return hours.select(F.regexp_extract("shard", _NUMBER, 1).cast("int").alias("shard_number"), F.round("hours", 9).alias("hours"), "is_total")


@query(
    f"""WITH /*recursive*/ base AS ({fx.SQL_VIEWS['wave']}), {_prepared_ctes(1, 160)}, {_chain_ctes(_BANDS)}, {_rates_ctes()},
        placed AS (SELECT speaker, b.key || '-0' AS key, b.key AS ordinal,
            (row_number() OVER (PARTITION BY speaker ORDER BY b.key) - 1) // 3 AS g
            FROM base b WHERE b.key || '-0' IN (SELECT key FROM rated)),
        merged AS (SELECT speaker, min_by(key, ordinal) AS key, kind, flatten(list(y ORDER BY ordinal)) AS y
            FROM rated JOIN placed USING (key) GROUP BY speaker, g, kind HAVING count(*) = 3),
        cut AS (SELECT speaker, key, kind, CASE WHEN kind LIKE '%16k' THEN y[1:80] ELSE y[1:240] END AS y,
            CAST(1 + (80 + 80 - 16) // 8 AS INT) AS n_frames FROM merged) """
    + sql_digest("cut", "speaker, key, kind, n_frames"),
    ["noise_pool", "rir_pool"],
)
def paired_shards(spark, sf):
    """Low cut, crops, degradation, two rates, merging to ten seconds per speaker, mel features."""
    rows = fx.wave(spark, sf).withColumn("ordinal", F.col("key"))
    made = pairs.training_pairs(
        rows, fx.noise_pool(spark, sf), fx.rir_pool(spark, sf), target=24, seconds=10.0, cutoff=2.0, low=8,
        band_rates=_BANDS, merge_by=["speaker"], stages=AUDIBLE,
    )
    # The short low-rate waveforms count as 16 kHz for the mel front end.
    mels = pairs.with_mel(made.withColumn("sample_rate_16k", F.lit(16000)), n_mels=6, frame_ms=1.0, hop_ms=0.5)
    kinds = [F.struct(F.lit(c).alias("kind"), F.col(c).alias("y")) for c in pairs.WAVES]
    flat = mels.select("speaker", "key", F.size("clean_mel").alias("n_frames"), F.inline(F.array(*kinds)))
    return digest(flat, ["speaker", "key", "kind", "n_frames"], "y")

"""Registered queries: rows the ordinary fixtures do not have (long, cut, null, alike, sparse, failing)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechtable import settings
from speechtable.operators import degrade, merge, records, restore, selection
from speechtable.plans import cleansing, pairs
from speechtable.plans import fixtures as fx
from speechtable.plans.degrade_queries import _BANDS, AUDIBLE, _chain_ctes, _prepared_ctes, _rates_ctes, half_gain
from speechtable.plans.registry import digest, query, samples_long, sql_digest, sql_draw, sql_long
from speechtable.plans.wave_queries import merged_sql
from speechtable.sources import catalog, corpus, files, ingest, tarshards
from speechtable.streaming.merge import merge_to_length_stream
from speechtable.streaming.restore import write_stream

_HALF = "list_transform({x}, lambda v: v / 2)"


@query(
    f"""WITH m AS (SELECT policy, key, policy = 'cut' AND len(samples) > 40 AS truncated,
            CASE WHEN policy = 'cut' AND len(samples) > 40
                THEN list_concat({_HALF.format(x='samples[1:40]')}, list_transform(range(len(samples) - 40), lambda i: 0.0::DOUBLE))
                ELSE {_HALF.format(x='samples')} END AS y
        FROM clips, (SELECT unnest(['cut', 'quarantine', 'split']) AS policy)
        WHERE policy <> 'quarantine' OR len(samples) <= 40) """ + sql_long("m", "policy, key, truncated"),
    ["clips"],
)
def cleansed_long_rows(spark, sf):
    """Clips of 20 to 64 samples and a model that takes 40: cut and flagged, quarantined, or restored in chunks."""
    rows = fx.clips(spark, sf).withColumn("ordinal", F.col("key"))
    parts = []
    for policy in restore.LONG_ROWS:
        good, _ = cleansing.cleanse(rows, half_gain, 16, config={"scale": 0.5}, chunk_seconds=2.5, model_rate=16, long_rows=policy)
        parts.append(good.withColumn("policy", F.lit(policy)))
    every = reduce(DataFrame.unionByName, parts)
    noted = F.coalesce(F.get_json_object("metadata", "$.truncated") == "true", F.lit(False))
    waves = every.select("policy", "key", noted.alias("truncated"), F.col("wav").cast("array<double>").alias("y"))
    return samples_long(waves, ["policy", "key", "truncated"], "y")


@query("WITH m AS (SELECT samples AS y, (SELECT count(*) FROM wave) AS n_keys FROM wave) " + sql_digest("m", "n_keys"), ["wave"])
def records_alike(spark, sf):
    """Records that differ in their audio only, written and read back: each keeps a key of its own."""
    rows = fx.wave(spark, sf).select("key", F.col("samples").cast("array<float>").alias("samples"), "sample_rate")
    coded = records.encode_record(rows.select("samples", "sample_rate")).withColumnRenamed("__key__", "key")
    folder = settings.fresh_path(spark, "alike")
    placed = coded.withColumn("ordinal", F.abs(F.xxhash64("key")))
    tarshards.write_tarshards(placed, folder, 100)
    typed = ingest.typed_members(tarshards.read_tarshards(spark, folder), {"samples.pth": "array<float>"})
    keys = typed.agg(F.countDistinct("key").alias("n")).scalar()
    return digest(typed.select(keys.alias("n_keys"), F.col("`samples.pth`").cast("array<double>").alias("y")), ["n_keys"], "y")


@query(
    "WITH m AS (SELECT 'spk' || speaker || '.take%2E.' || key AS key, samples AS y FROM wave) " + sql_digest("m"), ["wave"]
)
def dotted_keys(spark, sf):
    """Keys with dots and percent signs keep apart in a shard."""
    folder = settings.fresh_path(spark, "dotted")
    key = F.concat(F.lit("spk"), "speaker", F.lit(".take%2E."), "key")
    rows = fx.wave(spark, sf).select(
        key.alias("key"), F.col("key").alias("ordinal"), F.col("samples").cast("array<float>").alias("input_wav.pth"))
    tarshards.write_tarshards(rows, folder, 100)
    typed = ingest.typed_members(tarshards.read_tarshards(spark, folder), {"input_wav.pth": "array<float>"})
    return digest(typed.withColumn("y", F.col("`input_wav.pth`").cast("array<double>")), ["key"], "y")


def _floats(df, folder, per_shard, force=False):
    rows = df.select("key", F.col("key").alias("ordinal"), F.col("samples").cast("array<float>").alias("input_wav.pth"))
    tarshards.write_tarshards(rows, folder, per_shard, force=force)


def _digests(rows, keys):
    typed = ingest.typed_members(rows, {"input_wav.pth": "array<float>"})
    return digest(typed.withColumn("y", F.col("`input_wav.pth`").cast("array<double>")), keys, "y")


@query("WITH m AS (SELECT CAST(key AS VARCHAR) AS key, samples AS y FROM wave WHERE key % 3 = 0) " + sql_digest("m"), ["wave"])
def rewritten_shards(spark, sf):
    """A forced rewrite with fewer rows leaves none of the first run's."""
    folder = settings.fresh_path(spark, "rewritten")
    _floats(fx.wave(spark, sf), folder, 50)
    _floats(fx.wave(spark, sf).filter("key % 3 = 0"), folder, 50, force=True)
    return _digests(tarshards.read_tarshards(spark, folder), ["key"])


@query(
    """WITH s AS (SELECT key, samples, key % 2 AS folder, (row_number() OVER (PARTITION BY key % 2 ORDER BY key) - 1) // 40 AS shard FROM wave),
        o AS (SELECT folder, shard, row_number() OVER (ORDER BY folder, shard) - 1 AS ordinal, count(*) OVER () AS total
            FROM (SELECT DISTINCT folder, shard FROM s)),
        m AS (SELECT CAST(ordinal // CAST(ceil(total / 3.0) AS BIGINT) AS INT) AS block, CAST(key AS VARCHAR) AS key, samples AS y
            FROM s JOIN o USING (folder, shard)) """ + sql_digest("m", "block, key"),
    ["wave"],
)
def listed_blocks(spark, sf):
    """A manifest and a folder catalogued; each of three workers reads its block of shards."""
    listed, folder, path = (settings.fresh_path(spark, n) for n in ("listed", "folder", "manifest"))
    _floats(fx.wave(spark, sf).filter("key % 2 = 0"), listed, 40)
    _floats(fx.wave(spark, sf).filter("key % 2 = 1"), folder, 40)
    system, inner = files.locate(f"{path}.txt")
    with system.open_output_stream(inner) as out:
        out.write("\n".join(["# shards", *(f"  {s.path} " for s in tarshards.list_shards(listed))]).encode())
    every = catalog.shard_catalog(spark, [f"{path}.txt", folder])
    blocks = [tarshards.read_listed(selection.select_block(every, 3, i)).withColumn("block", F.lit(i)) for i in range(3)]
    return _digests(reduce(DataFrame.unionByName, blocks), ["block", "key"])


@query(
    """SELECT CAST(key AS VARCHAR) AS key, CASE WHEN key % 4 <> 3 THEN CAST(len(samples) AS BIGINT) END AS n_samples,
        key % 4 = 3 AS probe_failed, key % 4 = 3 AS decode_failed FROM wave""",
    ["wave"],
)
def wave_lengths(spark, sf):
    """WAV members: plain, with 6,000 bytes before the samples, of open-ended size, and cut short."""
    wav = F.col("wav")
    part = lambda at, n=1 << 30: F.substring(wav, at, n)
    chunk = F.concat(F.unhex(F.lit(b"LIST".hex() + "70170000")), F.unhex(F.repeat(F.lit("00"), 6000)))
    made = F.when(F.col("key") % 4 == 1, F.concat(part(1, 36), chunk, part(37))).when(
        F.col("key") % 4 == 2, F.concat(part(1, 40), F.unhex(F.lit("FFFFFFFF")), part(45))).when(
        F.col("key") % 4 == 3, F.substring(wav, F.lit(1), F.octet_length(wav) - 20)).otherwise(wav)
    coded = ingest.encode_waves(fx.wave(spark, sf)).select("key", F.col("key").alias("ordinal"), made.alias("wav"))
    folder = settings.fresh_path(spark, "lengths")
    tarshards.write_tarshards(coded, folder, 100)
    heads = tarshards.read_tarshards(spark, folder, head_bytes=16).select("key", F.col("members")["wav"].alias("wav"), F.lit("x.wav").alias("name"))
    whole = tarshards.read_tarshards(spark, folder).select("key", F.col("members")["wav"].alias("wav"), F.lit("x.wav").alias("name"))
    probed = ingest.probe_waves(heads, "wav", "name", headers=True).select("key", "n_samples", F.col("status").isNotNull().alias("probe_failed"))
    decoded = ingest.decode_waves(whole, "wav", "name").select("key", F.col("status").isNotNull().alias("decode_failed"))
    return probed.join(decoded, "key")


@query(
    f"""WITH m AS (SELECT key, CASE WHEN floor({sql_draw('key', 'codec.pick')} * 2) = 0
            THEN list_transform(samples, lambda v: round_even(v * 128, 0) / 128) ELSE samples END AS y FROM wave) """ + sql_long("m"),
    ["wave"],
)
def codec_choices(spark, sf):
    """One of two codecs a row; where the second fails the waveform stays as it was."""

    def coarse(x, rate):
        return (x * 128).round() / 128

    def failing(x, rate):
        raise RuntimeError("no such codec")

    stage = degrade.Stage("codec", p=1.0, fn=(coarse, failing))
    wave = fx.wave(spark, sf)
    made = degrade.degrade(wave, fx.noise_pool(spark, sf), fx.rir_pool(spark, sf), (stage,), on_error="keep")
    return samples_long(made.withColumn("y", F.col("noisy")), ["key"], "y")


@query(
    merged_sql("(SELECT * REPLACE (CASE WHEN speaker = 3 THEN -1 ELSE speaker END AS speaker) FROM clips)", "speaker"), ["clips"]
)
def merged_null_groups(spark, sf):
    """Rows without a speaker are merged among themselves."""
    clips = fx.clips(spark, sf).withColumn("speaker", F.when(F.col("speaker") != 3, F.col("speaker")))
    merged = merge.merge_to_length(clips, 10.0, ["samples"], ["speaker"], "key")
    return samples_long(merged.withColumn("speaker", F.coalesce("speaker", F.lit(-1))), ["speaker", "key", "n_members"], "samples")


@query(
    """WITH r AS (SELECT ordinal * 7 AS ordinal, row_number() OVER (ORDER BY ordinal) - 1 AS i, count(*) OVER () AS n FROM utt)
        SELECT ordinal, i // CAST(ceil(n / 4.0) AS BIGINT) AS block, i // greatest(n // 6, 1) AS chunk_id FROM r""",
    ["utt"],
)
def sparse_blocks(spark, sf):
    """Blocks and chunks of rows whose ordinals have gaps."""
    rows = fx.utt(spark, sf).select((F.col("ordinal") * 7).alias("ordinal"))
    blocks = [selection.select_block(rows, 4, i).withColumn("block", F.lit(i).cast("bigint")) for i in range(4)]
    return reduce(DataFrame.unionByName, blocks).join(selection.slice_chunks(rows, 6), "ordinal")


@query("SELECT ordinal, 'train-' || lpad(CAST(ordinal AS VARCHAR), 9, '0') AS key FROM utt", ["utt"])
def checked_columns(spark, sf):
    """A key column that is not there: a warning, and keys from the ordinal."""
    rows = fx.utt(spark, sf).drop("key")
    found = records.require_columns(rows, "n_samples", "utterance_id")
    return records.with_key(rows, found, "train").select("ordinal", "key")


@query("SELECT ordinal, key FROM utt WHERE sample_rate IS NULL", ["utt"])
def blocks_or_none(spark, sf):
    """No result block gives an empty table of the schema, which unites with others."""
    schema = T.StructType([T.StructField("ordinal", T.LongType()), T.StructField("key", T.StringType())])
    some = records.concat_blocks([fx.utt(spark, sf).filter("sample_rate IS NULL")], schema)
    return records.concat_blocks([], schema).unionByName(some)


@query(
    """WITH m AS (SELECT scale, key, list_transform(samples, lambda v: v * scale) AS y
        FROM wave, (SELECT unnest([0.5::DOUBLE, 0.25::DOUBLE]) AS scale)) """ + sql_digest("m", "scale, key"),
    ["wave"],
)
def cached_models(spark, sf):
    """One model a worker, built anew where its configuration differs."""
    runs = [restore.restore(fx.wave(spark, sf), half_gain, 16, chunk_seconds=4.0, model_rate=16, config={"scale": s}).withColumn("scale", F.lit(s))
            for s in (0.5, 0.25)]
    made = reduce(DataFrame.unionByName, runs)
    return digest(made.withColumn("y", F.col("restored").cast("array<double>")), ["scale", "key"], "y")


@query(
    f"""WITH /*recursive*/ base AS ({fx.SQL_VIEWS['wave']}), {_prepared_ctes(1, 32)}, {_chain_ctes(_BANDS, seconds=2)}, {_rates_ctes()},
        placed AS (SELECT key, split, (row_number() OVER (PARTITION BY split ORDER BY {sql_draw('key', 'shuffle')}, key) - 1) // 4 AS batch_id,
                CAST((row_number() OVER (PARTITION BY split ORDER BY {sql_draw('key', 'shuffle')}, key) - 1) % 4 AS INT) AS slot
            FROM (SELECT DISTINCT key, CASE WHEN {sql_draw('key', 'split')} < 0.75 THEN 'train' ELSE 'valid' END AS split FROM rated)),
        m AS (SELECT split, batch_id, slot, key, kind, 6 AS n_mels, CAST(1 + (len(y) + 80 - 16) // 8 AS INT) AS n_frames,
            list_transform(y, lambda v: CAST(v AS FLOAT)::DOUBLE) AS y FROM rated JOIN placed USING (key)  -- records hold 32-bit floats
           
            WHERE kind LIKE '%16k') """ + sql_digest("m", "split, batch_id, slot, key, kind, n_mels, n_frames"),
    ["noise_pool", "rir_pool"],
)
def preprocessed_batches(spark, sf):
    """Crops, degradation, mel features, records in shards per split, read back, shuffled and batched."""
    rows = fx.wave(spark, sf).withColumn("ordinal", F.col("key"))
    made = pairs.training_pairs(
        rows, fx.noise_pool(spark, sf), fx.rir_pool(spark, sf), target=24, n_crops=1, seconds=2.0, cutoff=2.0, low=8, stages=AUDIBLE,
        band_rates=_BANDS)
    folder = settings.fresh_path(spark, "preprocessed")
    # The short low-rate waveforms count as 16 kHz for the mel front end.
    made = made.withColumn("sample_rate_16k", F.lit(16000))
    splits = {"train": 0.75, "valid": 0.25}
    pairs.preprocess_to_shards(made, folder, 50, splits, n_mels=6, frame_ms=1.0, hop_ms=0.5)
    back = [pairs.training_batches(spark, folder, s, 4).withColumn("split", F.lit(s)) for s in splits]
    frames = lambda c: (F.size(c) / F.col("n_mels")).cast("int")
    kinds = [F.struct(F.lit(f"{s}_16k").alias("kind"), F.col(f"{s}_16k").cast("array<double>").alias("y"), frames(f"{s}_mel").alias("n_frames"))
             for s in ("clean", "noisy")]
    flat = reduce(DataFrame.unionByName, back).select("split", "batch_id", "slot", "key", "n_mels", F.inline(F.array(*kinds)))
    return digest(flat, ["split", "batch_id", "slot", "key", "kind", "n_mels", "n_frames"], "y")


def _merged_kinds(df):
    kinds = [F.struct(F.lit(n).alias("kind"), F.col(n).alias("y")) for n in ("samples", "loud")]
    return samples_long(df.select("lane", F.col("key").cast("bigint").alias("key"), "n_members", F.inline(F.array(*kinds))),
                        ["lane", "key", "n_members", "kind"], "y")


@query(
    merged_sql("(SELECT *, speaker || ':' || (key // 40) AS lane FROM clips)", "lane").replace(
        "SELECT lane, key, n_members, pos, round(value, 6) + 0.0 AS value FROM (",
        "SELECT lane, key, n_members, kind, pos, round(value * gain, 6) + 0.0 AS value FROM (SELECT unnest(['samples', 'loud']) AS kind, unnest([1.0, 2.0]) AS gain), (",
    ),
    ["clips"],
)
def merged_stream_pairs(spark, sf):
    """Two waveforms merged over micro-batches, each lane arriving in three slices."""
    source = settings.fresh_path(spark, "stream-in")
    rows = fx.clips(spark, sf).withColumns({
        "lane": F.concat_ws(":", "speaker", F.floor(F.col("key") / 40)), "loud": F.transform("samples", lambda v: v * 2)})
    arrival = F.floor(F.pmod("key", F.lit(40)) * 3 / 40)
    for at in range(3):
        rows.filter(arrival == at).repartition("lane").write.mode("append").parquet(source)
    out, marks = settings.fresh_path(spark, "stream-out"), settings.fresh_path(spark, "stream-marks")
    merged = merge_to_length_stream(corpus.stream_corpus(spark, source, 5), 10.0, "lane", ["samples", "loud"], order="key")
    write_stream(merged, out, marks).awaitTermination()
    return _merged_kinds(spark.read.parquet(out))

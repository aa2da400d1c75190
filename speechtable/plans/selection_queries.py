"""Registered queries: audits, selection, ordering, batching, records."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechtable import settings
from speechtable.functions import draws
from speechtable.operators import audit, ordering, records, selection
from speechtable.plans import fixtures as fx
from speechtable.plans.registry import digest, query, sql_digest, sql_draw
from speechtable.sources import catalog, ingest, tarshards


def _rated(spark, sf):
    return records.resolve_rate(fx.utt(spark, sf), ["sample_rate"], 500)


def _nine_digits(hours):
    """Sums in any order agree at nine digits; at six exact halves occur (n / 3.6 million)."""
    return hours.withColumn("hours", F.round("hours", 9))


@query(
    """SELECT shard, round(sum(n_samples / CAST(coalesce(sample_rate, 500) AS DOUBLE)) / 3600, 9) AS hours,
        count(n_samples) AS n_utterances FROM utt GROUP BY shard""",
    ["utt"],
)
def shard_hours(spark, sf):
    return _nine_digits(audit.shard_hours(_rated(spark, sf)))


@query(
    """SELECT shard, round(sum(n_samples / CAST(coalesce(sample_rate, 500) AS DOUBLE)) / 3600, 9) AS hours,
        CAST(grouping(shard) AS INT) AS is_total FROM utt GROUP BY ROLLUP(shard)""",
    ["utt"],
)
def corpus_hours(spark, sf):
    return _nine_digits(audit.corpus_hours(_rated(spark, sf)))


def _checked(spark, sf):
    """Utterances split by their status flags and rate."""
    joined = fx.utt(spark, sf).join(fx.flag(spark, sf), "ordinal", "left")
    return records.split_quarantine(
        joined, {"unreadable": F.col("unreadable") == 1, "no sample rate": F.col("sample_rate").isNull()}
    )


_CHECKED = """WITH marked AS (SELECT utt.*, CASE WHEN unreadable = 1 THEN 'unreadable'
        WHEN sample_rate IS NULL THEN 'no sample rate' END AS reason FROM utt LEFT JOIN flag USING (ordinal))"""


@query(_CHECKED + " SELECT key, shard, reason FROM marked WHERE reason IS NOT NULL", ["utt", "flag"])
def error_quarantine(spark, sf):
    return _checked(spark, sf)[1].select("key", "shard", "reason")


@query(
    _CHECKED
    + """ SELECT CASE WHEN reason IS NULL THEN 'processed' ELSE 'skipped' END AS outcome,
        coalesce(reason, '') AS reason, count(*) AS n_rows FROM marked GROUP BY ALL""",
    ["utt", "flag"],
)
def run_counters(spark, sf):
    return audit.run_metrics(*_checked(spark, sf))




# Shards of 200 ordinals each, so that their number grows with the table and their size does not.
_SMALL_SHARDS = "WITH small AS (SELECT * REPLACE (shard || '-' || (ordinal // 200) AS shard) FROM utt)"


def _long_failures(spark, sf):
    small = F.concat_ws("-", "shard", F.floor(F.col("ordinal") / 200))
    rows = fx.utt(spark, sf).withColumn("shard", small)
    _, bad = records.split_quarantine(rows, {"too long": F.col("n_samples") > 15000})
    return audit.shard_failures(rows, bad)


@query(
    _SMALL_SHARDS
    + " SELECT shard, count(*) AS n_failed, 'too long' AS reason FROM small WHERE n_samples > 15000 GROUP BY shard",
    ["utt"],
)
def shard_failure_report(spark, sf):
    return _long_failures(spark, sf)[1]


@query(
    _SMALL_SHARDS
    + """ SELECT shard, round(sum(n_samples / CAST(coalesce(sample_rate, 500) AS DOUBLE)) / 3600, 9) AS hours,
        count(n_samples) AS n_utterances
        FROM small WHERE shard NOT IN (SELECT shard FROM small WHERE n_samples > 15000) GROUP BY shard""",
    ["utt"],
)
def hours_without_failed_shards(spark, sf):
    good, _ = _long_failures(spark, sf)
    return _nine_digits(audit.shard_hours(records.resolve_rate(good, ["sample_rate"], 500)))


@query(
    """SELECT ordinal, key FROM utt WHERE ordinal >= 2 * (SELECT ceil(count(*) / 7.0) FROM utt)
        AND ordinal < 3 * (SELECT ceil(count(*) / 7.0) FROM utt)""",
    ["utt"],
)
def block_selection(spark, sf):
    return selection.select_block(fx.utt(spark, sf), 7, 2).select("ordinal", "key")


@query("SELECT ordinal, key FROM utt WHERE ordinal % 5 = 3", ["utt"])
def strided_selection(spark, sf):
    return selection.select_stride(fx.utt(spark, sf), 5, 3).select("ordinal", "key")


@query("SELECT ordinal, key FROM utt ORDER BY ordinal LIMIT 25", ["utt"])
def head_rows(spark, sf):
    return selection.head_rows(fx.utt(spark, sf), 25).select("ordinal", "key")


@query(
    """SELECT ordinal, ordinal // greatest((SELECT count(*) FROM utt) // 6, 1) AS chunk_id FROM utt""",
    ["utt"],
)
def chunk_slices(spark, sf):
    return selection.slice_chunks(fx.utt(spark, sf), 6).select("ordinal", "chunk_id")


@query("SELECT shard, ordinal // 4096 AS piece, 1 AS n_tasks, count(*) AS n FROM utt GROUP BY ALL", ["utt"])
def shards_by_worker(spark, sf):
    """Each piece of a shard lies in one task."""
    dealt = selection.by_shard(fx.utt(spark, sf), 8).withColumn("task", F.spark_partition_id())
    piece = F.floor(F.col("ordinal") / 4096).alias("piece")
    return dealt.groupBy("shard", piece).agg(F.countDistinct("task").cast("int").alias("n_tasks"), F.count(F.lit(1)).alias("n"))


@query("SELECT key, CAST(unnest(range(3)) AS INT) AS epoch FROM utt", ["utt"])
def repeated_rows(spark, sf):
    return selection.repeat_rows(fx.utt(spark, sf), 3).select("key", "epoch")


@query(
    f"""SELECT key, row_number() OVER (ORDER BY {sql_draw('key', 'shuffle')}, key) - 1 AS position FROM utt""",
    ["utt"],
)
def shuffled_positions(spark, sf):
    return selection.shuffle_positions(fx.utt(spark, sf)).select("key", "position")


@query("SELECT CAST(key AS VARCHAR) AS key, CAST(1 AS BIGINT) AS n_seen, round(list_sum(samples), 4) + 0.0 AS total FROM wave", ["wave"])
def buffered_shuffle(spark, sf):
    """Shards in drawn order, their samples through a buffer: every sample leaves once, with its audio."""
    folder = settings.fresh_path(spark, "shards")
    rows = fx.wave(spark, sf).select("key", F.col("key").alias("ordinal"), F.col("samples").cast("array<float>").alias("samples.pth"))
    tarshards.write_tarshards(rows, folder, 90)
    listed = selection.drawn_shards(catalog.shard_catalog(spark, folder))
    mixed = selection.shuffle_buffered(tarshards.read_listed(listed), 40)
    typed = ingest.typed_members(mixed, {"samples.pth": "array<float>"})
    total = F.aggregate(F.col("`samples.pth`").cast("array<double>"), F.lit(0.0), lambda s, v: s + v)
    return typed.groupBy("key").agg(F.count(F.lit(1)).alias("n_seen"), F.round(F.sum(total), 4).alias("total"))


@query(
    f"""SELECT key, round({sql_draw('key', 'crop')}, 9) AS u,
        CAST(floor({sql_draw('key', 'pool', '3')} * 1000) AS BIGINT) AS i,
        [8000, 16000, 22050, 24000, 44100, 48000][CAST(floor({sql_draw('key', 'rate')} * 6) AS INT) + 1] AS rate,
        {sql_draw('key', 'noise.gate')} < 0.5 AS gated FROM utt""",
    ["utt"],
)
def hashed_draws(spark, sf):
    key = F.col("key")
    return fx.utt(spark, sf).select(
        "key",
        F.round(draws.draw(key, "crop"), 9).alias("u"),
        draws.below(key, "pool", 1000, 3).alias("i"),
        draws.choice(key, "rate", [8000, 16000, 22050, 24000, 44100, 48000]).alias("rate"),
        draws.gate(key, "noise", 0.5).alias("gated"),
    )


_SPLITS = ("train", "validation", "test", "other", "invalidated")


@query(
    """WITH done AS (SELECT DISTINCT language, 'train' AS split FROM utt JOIN flag USING (ordinal) WHERE unreadable = 1
            AND n_samples > 5000)
        SELECT language, split, language IN ('en', 'es') AS heavy
        FROM (SELECT DISTINCT language, unnest(['train', 'validation', 'test', 'other', 'invalidated']) AS split FROM utt)
        WHERE (language, split) NOT IN (SELECT language, split FROM done)""",
    ["utt", "flag"],
)
def pending_units(spark, sf):
    utt = fx.utt(spark, sf)
    done = utt.join(fx.flag(spark, sf), "ordinal").filter("unreadable = 1 AND n_samples > 5000")
    done = done.select("language", F.lit("train").alias("split")).distinct()
    return selection.pending_units(utt, _SPLITS, done, heavy=["en", "es"])


@query("SELECT ordinal, key FROM utt WHERE ordinal NOT IN (SELECT ordinal FROM flag WHERE completed = 1)", ["utt", "flag"])
def resume_pending(spark, sf):
    done = fx.flag(spark, sf).filter("completed = 1")
    return selection.skip_completed(fx.utt(spark, sf), done, ["ordinal"]).select("ordinal", "key")


@query(
    """SELECT unit, ordinal, (rn - 1) // 3 AS batch_id, CAST((rn - 1) % 3 AS INT) AS slot
        FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY ordinal) AS rn FROM turns)""",
    ["turns"],
)
def mini_batches(spark, sf):
    return ordering.assign_batches(fx.turns(spark, sf), 3, ["unit"]).select("unit", "ordinal", "batch_id", "slot")


@query(
    """SELECT unit, ordinal, (rn - 1) // 3 AS batch_id, CAST((rn - 1) % 3 AS INT) AS slot
        FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY ordinal) AS rn,
                     count(*) OVER (PARTITION BY unit) AS n FROM turns) WHERE (rn - 1) // 3 < n // 3""",
    ["turns"],
)
def full_mini_batches(spark, sf):
    batched = ordering.assign_batches(fx.turns(spark, sf), 3, ["unit"], drop_last=True)
    return batched.select("unit", "ordinal", "batch_id", "slot")


@query(
    """SELECT shard, ordinal, CAST((cum - n_samples) // 20000 AS BIGINT) AS file_id
        FROM (SELECT *, sum(n_samples) OVER (PARTITION BY shard ORDER BY ordinal) AS cum FROM utt)""",
    ["utt"],
)
def size_capped_files(spark, sf):
    return ordering.assign_by_bytes(fx.utt(spark, sf), "n_samples", 20000, ["shard"]).select("shard", "ordinal", "file_id")


@query(
    """SELECT 'read' AS corpus, key, language, NULL::VARCHAR AS role FROM utt
        UNION ALL SELECT 'spoken', unit || '-' || ordinal, NULL, role FROM turns""",
    ["utt", "turns"],
)
def united_corpora(spark, sf):
    read = fx.utt(spark, sf).select("key", "language")
    spoken = fx.turns(spark, sf).select(F.concat_ws("-", "unit", "ordinal").alias("key"), "role")
    return selection.union_corpora({"read": read, "spoken": spoken}).select("corpus", "key", "language", "role")


@query(
    """SELECT shard, language, ordinal, key, n_samples FROM utt
        QUALIFY row_number() OVER (PARTITION BY shard, language ORDER BY ordinal) = 1""",
    ["utt"],
)
def first_occurrences(spark, sf):
    firsts = selection.distinct_first(fx.utt(spark, sf), ["shard", "language"])
    return firsts.select("shard", "language", "ordinal", "key", "n_samples")


@query(
    """SELECT ordinal, CASE WHEN ordinal % 3 = 0 THEN 'train-' || lpad(CAST(ordinal AS VARCHAR), 9, '0') ELSE key END AS key
        FROM utt""",
    ["utt"],
)
def derived_keys(spark, sf):
    gaps = fx.utt(spark, sf).withColumn("key", F.when(F.col("ordinal") % 3 != 0, F.col("key")))
    return records.with_key(gaps, "key", "train").select("ordinal", "key")


@query("WITH m AS (SELECT key, samples AS y FROM signal) " + sql_digest("m"), ["signal"])
def audio_column(spark, sf):
    raw = fx.signal(spark, sf).withColumnRenamed("samples", "source_audio")
    return digest(records.audio_column(raw), ["key"], "audio")


@query("SELECT key, ordinal, shard, language, sample_rate FROM utt", ["utt"])
def metadata_columns(spark, sf):
    meta = records.metadata_struct(fx.utt(spark, sf), audio_col="n_samples")
    return meta.select("meta.*")


@query(
    """SELECT key, shard AS json_shard, CAST(sample_rate AS VARCHAR) AS json_rate,
        CAST(CASE WHEN sample_rate IS NULL THEN 2 ELSE 3 END AS BIGINT) AS n_fields FROM utt""",
    ["utt"],
)
def metadata_json(spark, sf):
    coded = records.metadata_json(fx.utt(spark, sf), ["key", "shard", "sample_rate"])
    return coded.select(
        "key",
        F.get_json_object("metadata", "$.shard").alias("json_shard"),
        F.get_json_object("metadata", "$.sample_rate").alias("json_rate"),
        F.size(F.json_object_keys("metadata")).cast("bigint").alias("n_fields"),
    )


@query("SELECT unit, ordinal, CASE WHEN role = 'user' THEN text END AS transcript FROM turns", ["turns"])
def transcripts(spark, sf):
    said = fx.turns(spark, sf).withColumn("text", F.when(F.col("role") == "user", F.col("text")).otherwise(""))
    return records.transcript(said, "text").select("unit", "ordinal", "transcript")


@query(
    """SELECT key, CASE WHEN sample_rate IS NULL AND ordinal % 2 = 0 THEN 500 ELSE sample_rate END AS sample_rate
        FROM utt""",
    ["utt"],
)
def resolved_rates(spark, sf):
    utt = fx.utt(spark, sf).withColumn("declared", F.when(F.col("ordinal") % 2 == 0, F.lit(500)))
    return records.resolve_rate(utt, ["sample_rate", "declared"]).select("key", "sample_rate")


@query("SELECT key, round(list_sum(samples), 6) AS clean_sum, round(list_sum(samples), 6) AS noisy_sum FROM wave", ["wave"])
def branched_columns(spark, sf):
    both = records.branch(fx.wave(spark, sf), "samples")
    total = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda s, v: s + v), 6)
    return both.select("key", total("clean").alias("clean_sum"), total("noisy").alias("noisy_sum"))


_EXPORT = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("n_samples", T.DoubleType()), T.StructField("language", T.StringType())]
)


@query("SELECT key, CAST(n_samples AS DOUBLE) AS n_samples, language FROM utt", ["utt"])
def conformed_schema(spark, sf):
    return records.conform(fx.utt(spark, sf).select("language", "n_samples", "key"), _EXPORT)


@query("SELECT key, CAST(n_samples AS DOUBLE) AS n_samples, language FROM utt", ["utt"])
def concatenated_blocks(spark, sf):
    utt = fx.utt(spark, sf)
    blocks = [selection.select_block(utt, 3, i) for i in range(3)]
    return records.concat_blocks(blocks, _EXPORT)


@query("SELECT ordinal, 's3a://corpus/' || shard || '/' || key || '.tar' AS uri FROM utt", ["utt"])
def object_uris(spark, sf):
    plain = F.concat(F.lit("s3://corpus/"), F.col("shard"), F.lit("/"), F.col("key"), F.lit(".tar"))
    piped = F.concat(F.lit("pipe:aws s3 cp "), plain, F.lit(" -"))
    listed = fx.utt(spark, sf).select("ordinal", F.when(F.col("ordinal") % 2 == 0, plain).otherwise(piped).alias("uri"))
    return records.to_object_uri(listed, "uri")


@query(
    """SELECT key AS "key.index", CAST(speaker AS BIGINT) AS "speaker.index", 'spk' || speaker AS "name.txt",
        round(list_sum(samples), 6) AS wave_sum FROM wave""",
    ["wave"],
)
def encoded_records(spark, sf):
    rows = fx.wave(spark, sf).select("key", "speaker", F.concat(F.lit("spk"), "speaker").alias("name"), "samples")
    coded = records.encode_record(rows)
    total = F.aggregate(F.col("`samples.pth`"), F.lit(0.0), lambda s, v: s + v)
    return coded.select(
        F.col("`key.index`"), F.col("`speaker.index`").cast("bigint").alias("speaker.index"), F.col("`name.txt`"),
        F.round(total, 6).alias("wave_sum"),
    )

"""Speech-shaped views over the given tables (short arrays stand in for audio)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechtable.operators.ordering import running

SEGMENT = 48  # samples per `signal` row; the last row of a user is shorter
NOISE_SPEAKER, RIR_SPEAKER = 9, 8


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("key"),
        F.col("embedding").cast("array<double>").alias("samples"),
        F.lit(16).alias("sample_rate"),
        F.col("label").alias("speaker"),
    )


def signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waveforms of uneven length: each user's values in event order, cut into short segments."""
    events = _table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    placed = running(events, ["user_id"], "event_id")
    return (
        placed.groupBy("user_id", F.floor(F.col("row_index") / SEGMENT).alias("segment"))
        .agg(F.array_sort(F.collect_list(F.struct("event_id", "value"))).alias("values"))
        .select(
            F.concat_ws("-", "user_id", "segment").alias("key"),
            "user_id",
            F.col("segment").cast("bigint").alias("segment"),
            F.col("values.value").alias("samples"),
            F.lit(16).alias("sample_rate"),
        )
    )


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waves cut in two after 20 to 63 samples."""
    length = (20 + F.col("key") % 44).cast("int")
    rest = F.slice("samples", length + 1, F.greatest(F.size("samples") - length, F.lit(0)))
    both = wave(spark, sf_dir).select("key", F.posexplode(F.array(F.slice("samples", F.lit(1), length), rest)).alias("part", "samples"), "sample_rate", "speaker")
    return both.select((2 * F.col("key") + F.col("part")).alias("key"), "samples", "sample_rate", "speaker")


def utt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ordinal"),
        F.col("doc_id").cast("string").alias("key"),
        F.col("source").alias("shard"),
        F.col("lang").alias("language"),
        F.col("n_chars").alias("n_samples"),
        F.when(F.col("doc_id") % 7 != 0, F.lit(1000)).alias("sample_rate"),
    )


def flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("ordinal"), F.col("quality").alias("completed"), F.col("toxic").alias("unreadable")
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("unit"), F.col("turn").alias("ordinal"), "role", "text"
    )


def noise_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = wave(spark, sf_dir).filter(F.col("speaker") == NOISE_SPEAKER)
    return running(rows, order="key", index="pool_idx").select("pool_idx", "samples", "sample_rate")


def rir_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of two channels: every other sample, and those between them."""
    rows = wave(spark, sf_dir).filter(F.col("speaker") == RIR_SPEAKER)
    channels = F.array(F.filter("samples", lambda v, i: i % 2 == 0), F.filter("samples", lambda v, i: i % 2 == 1))
    return running(rows, order="key", index="pool_idx").select("pool_idx", channels.alias("channels"), "sample_rate")


# The same views for DuckDB.
SQL_VIEWS = {
    "wave": "SELECT vec_id AS key, embedding::DOUBLE[] AS samples, 16 AS sample_rate, label AS speaker FROM embeddings",
    "clips": """SELECT 2 * vec_id + part AS key, CASE WHEN part = 0 THEN embedding[1 : 20 + vec_id % 44]
            ELSE embedding[21 + vec_id % 44 : len(embedding)] END::DOUBLE[] AS samples, 16 AS sample_rate, label AS speaker
        FROM (SELECT *, unnest(range(2)) AS part FROM embeddings)""",
    "signal": f"""SELECT user_id || '-' || segment AS key, user_id, segment, list(value ORDER BY event_id) AS samples,
        16 AS sample_rate FROM (SELECT user_id, event_id, value,
                     (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // {SEGMENT} AS segment FROM events)
        GROUP BY user_id, segment""",
    "utt": """SELECT doc_id AS ordinal, CAST(doc_id AS VARCHAR) AS key, source AS shard, lang AS language,
        n_chars AS n_samples, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE 1000 END AS sample_rate FROM documents""",
    "flag": "SELECT doc_id AS ordinal, quality AS completed, toxic AS unreadable FROM labels",
    "turns": "SELECT conv_id AS unit, turn AS ordinal, role, text FROM conversations",
    "noise_pool": f"""SELECT row_number() OVER (ORDER BY vec_id) - 1 AS pool_idx, embedding::DOUBLE[] AS samples,
        16 AS sample_rate FROM embeddings WHERE label = {NOISE_SPEAKER}""",
    "rir_pool": f"""SELECT row_number() OVER (ORDER BY vec_id) - 1 AS pool_idx,
        [list_filter(embedding, lambda v, i: i % 2 = 1)::DOUBLE[], list_filter(embedding, lambda v, i: i % 2 = 0)::DOUBLE[]] AS channels,
        16 AS sample_rate FROM embeddings WHERE label = {RIR_SPEAKER}""",
}

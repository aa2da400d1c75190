"""Durations and failures of shard folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechtable import settings
from speechtable.operators import audit, records
from speechtable.sources import ingest
from speechtable.sources.tarshards import read_tarshards


RATE_BYTES = 64  # the longest text of a rate; WAV headers are found wherever they lie


def shard_lengths(
    spark: SparkSession, path: str, audio: str = "input_wav.pth", rate: str = "sr.index", default_rate: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """((shard, n_samples, sample_rate), (shard, reason)): lengths of float payloads or WAV members.

    Samples without audio count nothing; a broken shard, a cut file or a sample without a rate is a failure. Of each
    member only headers are read, and the shards are walked once: the lengths go to a table.
    """
    rows = read_tarshards(spark, path, head_bytes=RATE_BYTES)
    payload = F.col("members")[audio]
    if audio.rsplit(".", 1)[-1] == "pth":
        sized = rows.select(
            "shard", "error", F.floor(F.col("sizes")[audio] / 4).alias("n_samples"),
            F.col("members")[rate].cast("string").cast("int").alias("own_rate"),
        )
    else:
        named = rows.select("shard", "error", payload.alias("payload"), F.lit(audio).alias("name"))
        sized = ingest.probe_waves(named, "payload", "name", headers=True).select(
            "shard", F.coalesce("error", "status").alias("error"), "n_samples", F.col("sample_rate").alias("own_rate")
        )
    rated = records.resolve_rate(settings.materialize(sized, "lengths"), ["own_rate"], default_rate)
    checks = {"unreadable shard": F.col("error").isNotNull(),
              "no sample rate": F.col("n_samples").isNotNull() & F.col("sample_rate").isNull()}
    good, bad = records.split_quarantine(rated, checks)
    return good.select("shard", "n_samples", "sample_rate"), bad.select("shard", "reason")


def audit_shards(spark: SparkSession, path: str, **options) -> tuple[DataFrame, DataFrame]:
    """(hours per shard and in total, failures per shard); failed shards are left out of the total."""
    lengths, bad = shard_lengths(spark, path, **options)
    whole, failures = audit.shard_failures(lengths, bad)
    return audit.corpus_hours(whole), failures

"""Durations, counters and failures per shard; only lengths and rates are read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _hours():
    return F.sum(F.col("n_samples") / F.col("sample_rate").cast("double")) / 3600


def shard_hours(df: DataFrame) -> DataFrame:
    """Hours and rows per shard from (shard, n_samples, sample_rate); rows without audio add nothing."""
    return df.groupBy("shard").agg(
        F.coalesce(_hours(), F.lit(0.0)).alias("hours"), F.count("n_samples").alias("n_utterances")
    )


def corpus_hours(df: DataFrame) -> DataFrame:
    """Hours per shard plus the corpus total in one pass (``is_total`` = 1)."""
    return df.rollup("shard").agg(
        F.coalesce(_hours(), F.lit(0.0)).alias("hours"), F.grouping("shard").cast("int").alias("is_total")
    )


def run_metrics(good: DataFrame, bad: DataFrame) -> DataFrame:
    """One row per outcome: processed rows, and skipped rows by reason."""
    done = good.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("processed").alias("outcome"), F.lit("").alias("reason"), "n_rows"
    )
    skipped = bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("skipped").alias("outcome"), "reason", "n_rows"
    )
    return done.unionByName(skipped)


def observed(df: DataFrame, name: str = "run", bad: str = "status"):
    """(df, Observation) counting attempted, processed and skipped rows while the write job runs."""
    from pyspark.sql import Observation

    watch = Observation(name)
    skipped = F.count(F.col(bad)) if bad in df.columns else F.lit(0).cast("bigint")
    counted = df.observe(
        watch,
        F.count(F.lit(1)).alias("attempted"),
        (F.count(F.lit(1)) - skipped).alias("processed"),
        skipped.alias("skipped"),
    )
    return counted, watch


def shard_failures(df: DataFrame, bad: DataFrame, shard: str = "shard") -> tuple[DataFrame, DataFrame]:
    """(rows of shards without failure, failure count and first reason per bad shard)."""
    failures = bad.groupBy(shard).agg(F.count(F.lit(1)).alias("n_failed"), F.min("reason").alias("reason"))
    return df.join(failures.select(shard), shard, "left_anti"), failures

"""Corpus cleansing: read, leave out finished work, restore, write shards with metadata."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechtable import settings
from speechtable.operators import audit, records
from speechtable.operators.restore import restore
from speechtable.operators.selection import skip_completed
from speechtable.sources.tarshards import is_complete, write_tarshards

MODEL_RATE = 16000


def restored_rows(
    df: DataFrame, model_factory: Callable[..., Callable], target_rate: int, completed: DataFrame | None = None,
    unit_keys: tuple[str, ...] = ("key",), text_col: str | None = None, on_error: str = "quarantine",
    model_rate: int = MODEL_RATE, **options,
) -> DataFrame:
    """(key, ordinal, transcript, metadata, wav, status): one Arrow stage from source to output."""
    todo = skip_completed(df, completed, unit_keys) if completed is not None else df
    described = [c for c in todo.columns if c not in ("samples", "ordinal")]
    noted = records.metadata_json(todo, described)
    noted = records.transcript(noted, text_col) if text_col else noted.withColumn("transcript", F.lit(None).cast("string"))
    narrow = noted.select("key", "ordinal", "samples", "sample_rate", "transcript", "metadata")
    restored = restore(
        narrow, model_factory, target_rate, on_error=on_error, to="wav", model_rate=model_rate,
        drop=("samples", "sample_rate"), **options,
    )
    status = F.col("status") if on_error == "quarantine" else F.lit(None).cast("string")
    # A cut row says so wherever it goes.
    body = F.regexp_replace("metadata", r"\}$", "")
    flagged = F.concat(body, F.when(body == "{", "").otherwise(","), F.lit('"truncated":true}'))
    metadata = F.when(F.col("truncated"), flagged).otherwise(F.col("metadata"))
    return restored.select("key", "ordinal", "transcript", metadata.alias("metadata"), "truncated", "wav", status.alias("status"))


def split_rows(restored: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = restored.filter(F.col("status").isNull()).drop("status")
    return good, restored.filter(F.col("status").isNotNull()).select("key", "ordinal", F.col("status").alias("reason"))


def cleanse(df: DataFrame, model_factory: Callable[..., Callable], target_rate: int, **options) -> tuple[DataFrame, DataFrame]:
    """(good, bad) from (key, ordinal, samples, sample_rate, any metadata).

    ``good`` holds key, ordinal, wav, transcript, metadata JSON and whether the row was cut (also in the
    metadata, where it was); ``bad`` holds key, ordinal and reason. Options: ``completed`` and ``unit_keys`` leave out finished work, ``text_col``,
    ``model_rate``, ``cutoff`` and those of ``restore``. Both are lazy over the same stage; use
    ``cleanse_to_shards`` to run the model once for both.
    """
    return split_rows(restored_rows(df, model_factory, target_rate, **options))


def cleanse_to_shards(
    df: DataFrame, folder: str, model_factory: Callable[..., Callable], target_rate: int, per_shard: int = 5000,
    pattern: str = "dataset-%06d.tar.gz", force: bool = False, **options,
) -> DataFrame | None:
    """Write the cleansed corpus; None when the folder already carries its completion marker.

    Returns the counters of the run (processed, truncated if any were, and skipped by reason). The model runs once: its
    output is written to the shared folder, from which shards are numbered and written.
    """
    if is_complete(folder) and not force:
        return None
    restored = settings.materialize(restored_rows(df, model_factory, target_rate, **options), "restored")
    good, bad = split_rows(restored)
    rows = good.select(
        "key", "ordinal", "wav", F.col("transcript").alias("text.txt"), F.col("metadata").alias("metadata.json")
    )
    write_tarshards(rows, folder, per_shard, pattern, force=True, rate=target_rate)
    cut = good.filter("truncated").agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 0")
    cut = cut.select(F.lit("truncated").alias("outcome"), F.lit("").alias("reason"), "n_rows")
    return audit.run_metrics(good.select("key"), bad).unionByName(cut)

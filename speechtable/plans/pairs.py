"""Paired training data: crops, degraded copies, two rates, optional merging, mel features, splits."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechtable import settings
from speechtable.functions import draws, kernels
from speechtable.functions.stages import with_stage
from speechtable.operators import degrade, features, pairing, records, segment
from speechtable.operators.merge import merge_to_length
from speechtable.operators.ordering import assign_batches
from speechtable.operators.selection import shuffle_positions
from speechtable.sources import ingest
from speechtable.sources.tarshards import read_tarshards, write_tarshards

WAVES = ("clean", "noisy", "clean_16k", "noisy_16k")


def training_pairs(
    df: DataFrame, noise: DataFrame, rirs: DataFrame, target: int, n_crops: int = 30, seconds: float = 20.0,
    cutoff: float = 50.0, low: int = 16000, stages: Sequence[degrade.Stage] = degrade.STAGES,
    band_rates: Sequence[int] = pairing.BAND_RATES, merge_by: Sequence[str] | None = None, seed: int = draws.DEFAULT_SEED,
) -> DataFrame:
    """Rows of clean and noisy waveforms at both rates from (key, ordinal, samples, sample_rate, ...).

    Two Arrow stages touch the audio: preparing crops, and the whole degradation with resampling and
    normalising. With ``merge_by`` consecutive crops are joined to ``seconds`` inside those groups;
    the pairs are then written once, since merging scans their lengths before their audio.
    """
    crops = segment.prepare_crops(df, n_crops, seconds, cutoff, seed)
    ordered = crops.withColumn("ordinal", F.col("ordinal") * n_crops + F.col("crop")).withColumn(
        "key", F.concat_ws("-", "key", "crop")
    )
    pairs = degrade.degrade(ordered, noise, rirs, stages, seed, band_rates=band_rates, target=target, low=low)
    if merge_by is None:
        return pairs
    rates = {c: "sample_rate_16k" if c.endswith("_16k") else "sample_rate" for c in WAVES}
    written = settings.materialize(pairs.withColumn("n_clean", F.size("clean")), "pairs")
    merged = merge_to_length(written, seconds, WAVES, merge_by, rates=rates, n_samples="n_clean")
    return records.drop_nan(merged, ["clean", "noisy"], ["clean_16k", "noisy_16k"])


def with_mel(
    pairs: DataFrame, pad: int = 40, n_mels: int = features.N_MELS, frame_ms: float = features.FRAME_MS,
    hop_ms: float = features.HOP_MS,
) -> DataFrame:
    """Add log-mel matrices of both edge-padded low-rate waveforms, in one stage."""

    def run(rate, *sides):
        return tuple(None if x is None else kernels.log_mel(np.pad(x, pad), rate, n_mels, frame_ms, hop_ms) for x in sides)

    ddl = "clean_mel array<array<double>>, noisy_mel array<array<double>>"
    return with_stage(pairs, run, ddl, ["sample_rate_16k", "clean_16k", "noisy_16k"])


_MELS = ("clean_mel", "noisy_mel")
# Suffix and type of each member of a training record.
RECORD = {
    "key.txt": "string", "sample_rate.index": "int", "sample_rate_16k.index": "int", "n_mels.index": "int",
    **{f"{c}.pth": "array<float>" for c in (*WAVES, *_MELS)},
}


def preprocess_to_shards(
    pairs: DataFrame, folder: str, per_shard: int, splits: dict[str, float], seed: int = draws.DEFAULT_SEED, force: bool = False, **mel,
) -> None:
    """Mel features, typed records and numbered tar shards, in one folder per split.

    ``splits`` gives each split its share of the keys, by a hashed draw. Records are written once to the shared folder; every split is a
    filter of that table. Matrices are stored row after row beside their width.
    """
    made = with_mel(pairs, **mel)
    flat = made.select(
        "key", "ordinal", "sample_rate", "sample_rate_16k", F.size(F.get("clean_mel", F.lit(0))).alias("n_mels"),
        *[F.col(c).cast("array<float>").alias(c) for c in WAVES], *[F.flatten(c).cast("array<float>").alias(c) for c in _MELS],
    )
    drawn, upto, named = draws.draw(F.col("key"), "split", 0, seed), 0.0, F.lit(None).cast("string")
    for name, share in reversed(list(splits.items())):
        named = F.when(drawn < 1 - upto, F.lit(name)).otherwise(named)
        upto += share
    coded = records.encode_record(flat.withColumn("split", named), identity=("ordinal", "split"))
    table = settings.materialize(coded.withColumnRenamed("__key__", "key"), "records")
    for name in splits:
        write_tarshards(table.filter(F.col("split") == name).drop("split"), f"{folder}/{name}", per_shard, force=force)


def training_batches(spark: SparkSession, folder: str, split: str, size: int, seed: int = draws.DEFAULT_SEED) -> DataFrame:
    """Typed pairs of a split in shuffled batches: ``batch_id`` and ``slot`` per row.

    Numbering scans keys beside whole rows, and a shard is read whole for any of its columns: rows are read from the shards once, into a table.
    """
    typed = ingest.typed_members(read_tarshards(spark, f"{folder}/{split}"), RECORD)
    rows = typed.select(*[F.col(f"`{name}`").alias(name.rsplit(".", 1)[0]) for name in RECORD])
    return assign_batches(shuffle_positions(settings.materialize(rows, "typed"), "key", seed), size, order="position")

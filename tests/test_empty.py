"""Empty tables pass through every operator with their schema."""

import pytest
from pyspark.sql import functions as F

from speechtable.operators import audit, degrade, distance, features, merge, ordering, pairing, records, restore, segment, selection

SPEECH = "key string, shard string, ordinal bigint, samples array<float>, sample_rate int"
identity = lambda: (lambda batch: batch)


def pool(spark, kind="array<double>", name="samples"):
    value = "array(1.0D, 0.5D)" if name == "samples" else "array(array(1.0D, 0.5D))"
    return spark.range(1).selectExpr("id AS pool_idx", f"{value} AS {name}", "16 AS sample_rate")


OPERATORS = {
    "resample": lambda s, df: segment.resample(df, 8000),
    "low_cut": lambda s, df: segment.low_cut(df),
    "normalize": lambda s, df: segment.normalize(df),
    "crop": lambda s, df: segment.random_crop(df, 30, 20.0),
    "prepare": lambda s, df: segment.prepare_crops(df, 30, 20.0),
    "chunk": lambda s, df: segment.fit_chunk(df, 1.0),
    "collate": lambda s, df: segment.collate(ordering.assign_batches(df, 4, ["shard"]), ["shard", "batch_id"]),
    "merge": lambda s, df: merge.merge_to_length(df, 20.0, ["samples"], ["shard"]),
    "noise": lambda s, df: pairing.pair_noise(df, pool(s)),
    "rir": lambda s, df: pairing.pair_rir(df, pool(s, name="channels")),
    "degrade": lambda s, df: degrade.degrade(df, pool(s), pool(s, name="channels"), target=24, low=8),
    "mel": lambda s, df: features.long_features(features.log_mel(df)),
    "restore": lambda s, df: restore.restore(df, identity, 16000),
    "quarantine": lambda s, df: restore.restore(df, identity, 16000, on_error="quarantine"),
    "distance": lambda s, df: distance.spectral_distance(records.branch(df, "samples")),
    "batches": lambda s, df: ordering.assign_by_bytes(df.withColumn("n", F.size("samples")), "n", 9, ["shard"]),
    "blocks": lambda s, df: selection.select_block(df, 3, 1),
    "chunks": lambda s, df: selection.slice_chunks(df, 3),
    "distinct": lambda s, df: selection.distinct_first(df, ["key"]),
    "hours": lambda s, df: audit.shard_hours(df.withColumn("n_samples", F.size("samples"))),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty(spark, name):
    out = OPERATORS[name](spark, spark.createDataFrame([], SPEECH))
    assert out.columns and out.collect() == []


def test_empty_pool_pairs_nothing(spark):
    df = spark.createDataFrame([("k", "s", 0, [1.0, 2.0], 16)], SPEECH)
    assert pairing.pair_noise(df, pool(spark).limit(0)).first().noise is None


def test_one_sample_rows(spark):
    df = spark.createDataFrame([("k", "s", 0, [0.5], 16)], SPEECH)
    assert segment.low_cut(df, 2.0).first().samples[0] == pytest.approx(0.5 * 0.573, abs=0.05)
    assert len(segment.resample(df, 48).first().samples) == 3
    assert segment.normalize(df).first().samples == pytest.approx([0.9000001])
    assert features.log_mel(df.withColumn("sample_rate", F.lit(16000))).first().features == []
    out = degrade.degrade(df, pool(spark), pool(spark, name="channels"), [degrade.Stage(s.name, 1.0) for s in degrade.STAGES[:4]], band_rates=(8,))
    # There and back over half the rate rounds the length up, as it does in the reference.
    assert len(out.first().clean) == 1 and len(out.first().noisy) == 2

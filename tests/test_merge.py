import random

import pytest
from pyspark.sql import functions as F

from speechtable.operators.merge import merge_groups, merge_to_length
from speechtable.sources.corpus import stream_corpus
from speechtable.streaming.merge import merge_to_length_stream
from speechtable.streaming.restore import write_stream


def greedy(data, seconds):
    """{(shard, ordinal): first ordinal of its group} by one pass per shard, in exact fractions."""
    from fractions import Fraction

    out, state = {}, {}
    for shard, o, n, rate in sorted(data):
        first, total = state.get(shard, (o, Fraction(0)))
        out[shard, o] = first
        total += Fraction(n, rate)
        state[shard] = (first, total)
        if total >= Fraction(seconds):
            del state[shard]
    return out


def labels(df):
    rows = df.groupBy("shard", "group_start").agg(F.collect_list("ordinal").alias("o")).collect()
    return {(r.shard, o): min(r.o) for r in rows for o in r.o}


@pytest.mark.parametrize("width", [1, 4, 32, 1 << 16])
@pytest.mark.parametrize("low,high", [(1, 60), (0, 9), (95, 300), (25, 25)])
def test_groups_equal_a_greedy_pass(spark, width, low, high):
    rng = random.Random(width * 1000 + low)
    data = [(rng.choice(["hot", "hot", "a"]), o, rng.randint(low, high), 10) for o in rng.sample(range(900), 300)]
    df = spark.createDataFrame(data, "shard string, ordinal bigint, n_samples bigint, sample_rate int")
    assert labels(merge_groups(df, 10.0, ["shard"], width=width)) == greedy(data, 10)


def test_mixed_rates_stay_exact(spark):
    rng = random.Random(3)
    rates = [8000, 16000, 22050, 44100, 48000]
    data = [("s", o, rng.randint(1, 5) * r // 10, r) for o in range(200) for r in [rng.choice(rates)]]
    df = spark.createDataFrame(data, "shard string, ordinal bigint, n_samples bigint, sample_rate int")
    assert labels(merge_groups(df, 1.0, ["shard"], width=16)) == greedy(data, 1)


def test_no_group_columns_and_integer_ones(spark):
    df = spark.createDataFrame([(i % 2, i, 3, 1) for i in range(12)], "shard int, ordinal int, n_samples int, sample_rate int")
    whole = merge_groups(df, 6.0, [])
    assert whole.columns == ["ordinal", "group_start"] and whole.select("group_start").distinct().count() == 6
    assert labels(merge_groups(df, 6.0, ["shard"])) == greedy([tuple(r) for r in df.collect()], 6)


def test_merged_audio(spark):
    data = [("s", i, f"k{i}", [float(i)] * n, 2) for i, n in enumerate([3, 0, 2, 4, 9, 1, 1])]
    df = spark.createDataFrame(data, "shard string, ordinal bigint, key string, samples array<double>, sample_rate int")
    got = sorted(merge_to_length(df, 2.0, ["samples"], ["shard"]).collect(), key=lambda r: r.group_start)
    # 3 + 0 + 2 reaches 4, then 4, then 9; the last two rows stay short and go.
    assert [(r.key, r.samples) for r in got] == [
        ("k0", [0.0, 0.0, 0.0, 2.0]), ("k3", [3.0] * 4), ("k4", [4.0] * 4)
    ]


def test_exact_multiple_leaves_no_tail(spark):
    data = [("s", i, f"k{i}", [1.0, 1.0], 2) for i in range(4)]
    df = spark.createDataFrame(data, "shard string, ordinal bigint, key string, samples array<double>, sample_rate int")
    assert merge_to_length(df, 2.0, ["samples"], ["shard"]).count() == 2


def test_stream_agrees_with_batch(spark, fresh):
    rng = random.Random(5)
    data = [(rng.choice(["hot", "hot", "a"]), i, f"k{i}", [float(i)] * rng.randint(0, 9), 4) for i in range(120)]
    df = spark.createDataFrame(data, "shard string, ordinal bigint, key string, samples array<double>, sample_rate int")
    source, out = fresh("in"), fresh("out")
    for at in range(4):
        df.filter(F.floor(F.col("ordinal") / 30) == at).repartition("shard").write.mode("append").parquet(source)
    merged = merge_to_length_stream(stream_corpus(spark, source, 2), 5.0, "shard")
    write_stream(merged, out, fresh("marks")).awaitTermination()
    streamed = sorted(tuple(r) for r in spark.read.parquet(out).select("shard", "key", "samples").collect())
    batch = sorted(tuple(r) for r in merge_to_length(df, 5.0, ["samples"], ["shard"]).select("shard", "key", "samples").collect())
    assert streamed == batch and batch

"""Settings, policies and refusals beyond what the queries show."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from speechtable import settings
from speechtable.functions import kernels
from speechtable.operators import degrade, merge, ordering, pairing, restore, selection
from speechtable.plans import fixtures as fx
from speechtable.sources import corpus, tarshards
from speechtable.streaming.merge import merge_to_length_stream
from speechtable.streaming.restore import write_stream


def test_warehouse_on_one_machine_is_refused():
    assert settings._fallback("local[4]", "file:/tmp/w")
    assert settings._fallback("yarn", "hdfs://name/w/") == "hdfs://name/w/speechtable-intermediate"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        settings._fallback("yarn", "file:/tmp/w")


def test_clean_up_deletes_own_folders(spark, monkeypatch):
    monkeypatch.setattr(settings, "_MADE", [])
    table = settings.materialize(spark.range(3), "gone")
    path = table.inputFiles()[0]
    assert settings.clean_up(spark) == 1
    with pytest.raises(PySparkException):
        spark.read.parquet(path).count()


@pytest.mark.parametrize("n", [1, 1000, 9600])
def test_model_rate_keeps_all_samples(spark, n):
    rows = spark.createDataFrame([(1, [0.25] * n, 24000)], "key long, samples array<double>, sample_rate int")
    got = restore.restore(rows, lambda: lambda batch: batch, 24000, chunk_seconds=0.4, model_rate=24000).first()
    assert len(got["restored"]) == n and all(v == 0.25 for v in got["restored"]) and got["truncated"] is False


def test_split_equals_whole_and_failing_pieces_fail_the_row(spark):
    rows = spark.createDataFrame([(1, [float(i) for i in range(1000)], 100)], "key long, samples array<double>, sample_rate int")

    def limited():
        def model(batch):
            if (batch > 900).any():
                raise ValueError("loud")
            return batch
        return model

    whole = restore.restore(rows, lambda: lambda b: b, 100, chunk_seconds=3.0, model_rate=100, long_rows="split").first()
    assert whole["restored"] == [float(i) for i in range(1000)]
    bad = restore.restore(rows, limited, 100, chunk_seconds=3.0, model_rate=100, long_rows="split", on_error="quarantine").first()
    assert bad["restored"] is None and "loud" in bad["status"]
    with pytest.raises(ValueError):
        restore.restore(rows, limited, 100, long_rows="quarantine")


def test_low_cut_without_tap_limit_and_beyond_nyquist():
    with pytest.raises(ValueError, match="rate above"):
        kernels.low_cut(np.ones(10), 16, 8.0)
    # The response to an impulse goes on obeying the recursion, far beyond any block.
    h = kernels.low_cut(np.eye(1, 1 << 18)[0], 48000, 0.05)
    k = np.arange(1 << 17, (1 << 17) + 50)
    ratio = np.linalg.lstsq(np.stack([h[k - 1], h[k - 2]], 1), h[k], rcond=None)[0]
    early = np.arange(100, 150)
    assert np.allclose(h[early], ratio[0] * h[early - 1] + ratio[1] * h[early - 2], rtol=1e-6) and h[0] > 0.9


def test_unknown_options_and_snr_range(spark, sf):
    wave, noise, rirs = fx.wave(spark, sf), fx.noise_pool(spark, sf), fx.rir_pool(spark, sf)
    with pytest.raises(ValueError, match="no option"):
        degrade.degrade(wave, noise, rirs, (degrade.Stage("noise", options={"snr": 3}),))
    quiet = degrade.degrade(wave, noise, rirs, (degrade.Stage("noise", 1.0, options={"snr_db": (60, 61)}),))
    loud = degrade.degrade(wave, noise, rirs, (degrade.Stage("noise", 1.0, options={"snr_db": (0, 1)}),))
    gap = lambda df: df.select(F.aggregate(F.zip_with("samples", "noisy", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, v: s + v).alias("d")).agg(F.avg("d")).first()[0]
    assert 100 * gap(quiet) < gap(loud)
    failing = degrade.Stage("codec", 1.0, fn=lambda x, rate: 1 / 0)
    with pytest.raises(PySparkException):
        degrade.degrade(wave, noise, rirs, (failing,)).select("noisy").collect()


def test_equal_neighbours_are_refused(spark, fresh):
    rows = spark.createDataFrame([("k", 0, "a"), ("k", 1, "b")], "key string, ordinal long, txt string")
    with pytest.raises(PySparkException):
        tarshards.write_tarshards(rows, fresh("twice"), 10)


def test_no_wide_column_is_numbered(spark):
    """Whole rows are dealt out by their own key, never sorted into windows."""
    rows = spark.range(50).select(F.col("id").alias("ordinal"), F.col("id").cast("string").alias("key"), F.array(F.lit(0.0)).alias("samples"),
                                  F.lit("s").alias("shard"), F.lit(1).alias("size"))
    for df in (ordering.assign_batches(rows, 7, ["shard"]), ordering.assign_by_bytes(rows, "size", 9), selection.shuffle_positions(rows)):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" in text
        for part in text.split("Window")[1:]:
            assert "samples" not in part.split("\n")[0]
        assert df.count() == 50


def test_null_groups_are_batched(spark):
    rows = spark.createDataFrame([(None, i) for i in range(5)] + [("a", i) for i in range(3)], "shard string, ordinal long")
    got = {(r.shard, r.ordinal): (r.batch_id, r.slot) for r in ordering.assign_batches(rows, 2, ["shard"]).collect()}
    assert got == {(s, i): (i // 2, i % 2) for s, n in ((None, 5), ("a", 3)) for i in range(n)}


def test_stream_head_and_merge_like_batch(spark, fresh):
    source, out, marks = fresh("in"), fresh("out"), fresh("marks")
    rows = [("a", k, str(k), [float(k)] * (3 + k % 4), [0.5 * k] * (6 + 2 * (k % 4)), 8 if k % 2 else 16, 32) for k in range(30)] + [("b", 1, "e", [], [], 8, 32)]
    df = spark.createDataFrame(rows, "lane string, ordinal long, key string, x array<double>, y array<double>, rate int, high int")
    for at in range(3):
        df.filter((F.col("ordinal") / 10).cast("int") == at).coalesce(1).write.mode("append").parquet(source)
    names = {"x": "rate", "y": "high"}
    stream = merge_to_length_stream(corpus.stream_corpus(spark, source, 1), 1.0, "lane", ["x", "y"], rates=names)
    write_stream(stream, out, marks).awaitTermination()
    columns = ["lane", "key", "x", "y", "rate", "high", "n_members"]
    batch = merge.merge_to_length(df, 1.0, ["x", "y"], ["lane"], rates=names)
    assert sorted(map(tuple, spark.read.parquet(out).select(columns).collect())) == sorted(map(tuple, batch.select(columns).collect()))
    head, marks = fresh("head"), fresh("head-marks")
    write_stream(selection.head_rows(corpus.stream_corpus(spark, source, 1), 4), head, marks).awaitTermination()
    assert spark.read.parquet(head).count() == 4


def test_silent_speech_and_noise_alike_in_both_engines(spark):
    rows = [(1, [0.0, 0.0], [0.5, 0.5], 3.0), (2, [0.1, -0.2], [0.5, 0.25], 3.0), (3, [0.1, 0.2], [0.0, 0.0], 3.0), (4, [0.1, 0.2], None, 3.0)]
    df = spark.createDataFrame(rows, "key long, noisy array<double>, noise array<double>, snr_db double")
    got = [{r.key: r.noisy for r in pairing.mix_snr(df, engine=e).collect()} for e in ("native", "arrow")]
    assert all(np.allclose(got[0][k], got[1][k], equal_nan=True) for k in (1, 2, 3, 4))
    assert got[0][1] == [0.0, 0.0] and np.isnan(got[0][3]).all() and got[0][4] == [0.1, 0.2]

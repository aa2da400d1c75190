import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechtable.functions import draws, kernels, waves
from speechtable.operators import degrade, distance, features, pairing, records, segment
from speechtable.plans import fixtures as fx


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()])


def arr(values):
    return F.array(*[F.lit(float(v)) for v in values]) if len(values) else F.array().cast("array<double>")


def value(spark, column):
    return one(spark, v=column).first()["v"]


# --- native expressions -------------------------------------------------------------------------


def test_silence_turns_null_and_is_dropped(spark):
    df = one(spark, clean=waves.normalized(arr([0, 0])), noisy=arr([1, 2]))
    assert df.first()["clean"] == [None, None]
    assert records.drop_nan(df, ["clean", "noisy"], ["clean_16k"]).count() == 0
    assert records.drop_nan(one(spark, clean=arr([1]), noisy=arr([float("nan")])), ["clean", "noisy"]).count() == 0
    assert records.drop_nan(one(spark, clean=arr([1]), noisy=F.lit(None).cast("array<double>")), ["clean", "noisy"]).count() == 0


def test_normalize_keeps_the_offset(spark):
    got = value(spark, waves.normalized(arr([2, -4])))
    assert got == pytest.approx([(0.5 + 1e-7) * 0.9, (-1 + 1e-7) * 0.9])
    assert got == pytest.approx(kernels.peak_normalize(np.array([2.0, -4.0])))


def test_response_start_of_the_documented_example(spark):
    assert value(spark, waves.response_start(arr([0, 0, 1, 0.5, 0.1]))) == 2
    assert value(spark, waves.response_start(arr([0, 0]))) == 0
    h = arr([0, 0.2, -1, 0.5, 0.1])
    assert value(spark, waves.early_response(h, F.lit(20), 0.1)) == [0.0, 0.2, -1.0, 0.0, 0.0]
    assert kernels.early_part(np.array([0, 0.2, -1, 0.5, 0.1]), 20, 0.1).tolist() == [0.0, 0.2, -1.0, 0.0, 0.0]


def test_padding_cutting_tiling(spark):
    x = arr([1, 2, 3])
    assert value(spark, waves.fit(x, 5)) == [1, 2, 3, 0, 0]
    assert value(spark, waves.fit(x, 2)) == [1, 2]
    assert value(spark, waves.fit(arr([]), 2)) == [0, 0]
    assert value(spark, waves.pad_to(x, 2)) == [1, 2, 3]
    assert value(spark, waves.tiled(x, 7)) == [1, 2, 3, 1, 2, 3, 1]
    assert value(spark, waves.tiled(x, 2)) == [1, 2]
    assert value(spark, waves.tiled(arr([]), 2)) is None
    assert value(spark, waves.edge_pad(x, 2)) == [0, 0, 1, 2, 3, 0, 0]


def test_finite(spark):
    x = arr([1, float("nan"), float("inf"), float("-inf")])
    assert value(spark, waves.finite(x)) == [1.0, 0.0, 3.4028234663852886e38, -3.4028234663852886e38]


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=37)
    for q in (0.0, 0.03, 0.5, 0.97, 1.0):
        assert value(spark, waves.quantile_sorted(F.sort_array(arr(x)), F.lit(q))) == pytest.approx(np.quantile(x, q))
    assert value(spark, waves.quantile_clipped(arr([5]), F.lit(0.1), F.lit(0.9))) == [5.0]


def test_expected_length_rounds_half_to_even(spark):
    sizes = [(1, 2, 1), (3, 2, 1), (5, 2, 1)]
    got = [value(spark, segment.expected_length(F.lit(n), F.lit(r), t)) for n, r, t in sizes]
    assert got == [round(n / r * t) for n, r, t in sizes] == [0, 2, 2]


def test_chunk_has_a_floor():
    assert segment.chunk_samples(0.01) == 1600 and segment.chunk_samples(2.5) == 40000


def test_crops(spark):
    df = one(spark, key=F.lit("k"), samples=F.transform(F.sequence(F.lit(1), F.lit(100)), lambda i: i.cast("double")),
             sample_rate=F.lit(10))
    # 10 s / 2 = 5, capped at n_crops = 2.
    crops = segment.random_crop(df, n_crops=2, seconds=3.0).collect()
    assert [r.crop for r in crops] == [0, 1] and all(len(r.samples) == 30 for r in crops)
    assert all(r.samples[0] == r.crop_start + 1 and 0 <= r.crop_start <= 70 for r in crops)
    whole = segment.random_crop(df, n_crops=30, seconds=20.0).collect()
    assert len(whole) == 1 and whole[0].samples[-1] == 100.0 and whole[0].crop_start == 0
    again = [segment.random_crop(df.repartition(p), 2, 3.0).select("crop_start").collect() for p in (1, 3, 17)]
    assert again[0] == again[1] == again[2]


def test_prepared_crops_equal_the_separate_steps(spark, sf):
    rows = fx.wave(spark, sf)
    fused = segment.prepare_crops(rows, 2, 2.0, cutoff=2.0)
    steps = segment.normalize(segment.random_crop(segment.low_cut(rows, 2.0), 2, 2.0))
    a = {(r.key, r.crop): r.samples for r in fused.collect()}
    b = {(r.key, r.crop): r.samples for r in steps.collect()}
    assert a.keys() == b.keys()
    assert all(np.allclose(a[k], b[k], atol=1e-9) for k in a)


def test_draws_are_uniform_and_fixed(spark):
    df = spark.range(20000).select(draws.draw(F.col("id"), "s").alias("u"), draws.below(F.col("id"), "s", 7, 2).alias("i"))
    stats = df.agg(F.min("u"), F.max("u"), F.avg("u"), F.min("i"), F.max("i"), F.countDistinct("i")).first()
    assert 0 <= stats[0] < 0.001 and 0.999 < stats[1] < 1 and abs(stats[2] - 0.5) < 0.01 and tuple(stats[3:]) == (0, 6, 7)
    assert value(spark, draws.draw(F.lit(None).cast("string"), "s")) is not None


def test_packet_loss_spans(spark):
    # Under 3.34 s nothing is lost; 10 s lose three spans.
    short = value(spark, pairing.loss_spans(F.lit("k"), F.lit(33), F.lit(10), 20.0, 200.0, 3.0, 1))
    assert short == []
    long = value(spark, pairing.loss_spans(F.lit("k"), F.lit(160000), F.lit(16000), 20.0, 200.0, 3.0, 1))
    assert len(long) == 3 and all(0 <= s.s < s.e <= 160000 and 319 <= s.e - s.s <= 3201 for s in long)


def test_mono(spark):
    df = one(spark, channels=F.array(arr([1, 3]), arr([3, 5])))
    assert segment.to_mono(df).first()["samples"] == [2.0, 4.0]
    assert segment.to_mono(df, "first").first()["samples"] == [1.0, 3.0]
    with pytest.raises(ValueError):
        segment.to_mono(df, "last")


# --- kernels on analytic signals ----------------------------------------------------------------


def test_resample_keeps_a_tone_and_its_length():
    for source, target in ((48000, 16000), (44100, 48000), (8000, 22050)):
        n = source // 10
        t = np.arange(n) / source
        y = kernels.resample(np.sin(2 * np.pi * 440 * t), source, target)
        assert len(y) == math.ceil(n * target / source)
        expected = np.sin(2 * np.pi * 440 * np.arange(len(y)) / target)
        assert np.max(np.abs(y - expected)[200:-200]) < 0.01
    x = np.ones(5)
    assert kernels.resample(x, 8000, 8000) is x and len(kernels.resample(np.array([]), 8000, 16000)) == 0


def test_band_limit_removes_what_the_low_rate_cannot_hold():
    t = np.arange(48000) / 48000
    tone = lambda hz: kernels.resample(kernels.resample(np.sin(2 * np.pi * hz * t), 48000, 8000), 8000, 48000)
    assert np.std(tone(1000)) > 0.69 and np.std(tone(10000)) < 0.01


def test_low_cut_equals_the_recursion():
    rng = np.random.default_rng(1)
    x, rate, cutoff = rng.normal(size=3000) / 9, 1600, 50.0
    w = 2 * math.pi * cutoff / rate
    alpha, c = math.sin(w) / 2 / 0.707, math.cos(w)
    y = np.zeros(len(x))
    for n in range(len(x)):
        past = lambda v, k: v[n - k] if n >= k else 0.0
        y[n] = ((1 + c) / 2 * x[n] - (1 + c) * past(x, 1) + (1 + c) / 2 * past(x, 2) + 2 * c * past(y, 1) - (1 - alpha) * past(y, 2)) / (1 + alpha)
    assert np.allclose(kernels.low_cut(x, rate, cutoff), np.clip(y, -1, 1), atol=1e-12)
    assert abs(kernels.low_cut(np.full(48000, 0.5), 48000, 50.0)[-1]) < 1e-9


def test_convolution():
    rng = np.random.default_rng(2)
    x, h = rng.normal(size=300), rng.normal(size=40)
    assert np.allclose(kernels.convolve(x, h), np.convolve(x, h)[:300])
    assert np.allclose(kernels.convolve(x[:10], h), np.convolve(x[:10], h)[:10])
    impulse = np.zeros(50)
    impulse[3] = 1
    assert np.allclose(kernels.convolve(impulse, h)[3:43], h)
    assert np.allclose(kernels.convolve(np.array([2.0]), np.array([3.0, 1.0])), [6.0])


def test_best_lag():
    rng = np.random.default_rng(3)
    ref = rng.normal(size=400)
    for lag in (0, 17, 100):
        placed = kernels.best_lag_fit(ref, ref[lag : lag + 300])
        assert np.array_equal(placed[lag : lag + 300], ref[lag : lag + 300]) and not placed[:lag].any() and not placed[lag + 300 :].any()
    assert np.array_equal(kernels.best_lag_fit(ref, np.arange(500.0)), np.arange(400.0))
    # Equal errors everywhere: the first lag wins.
    assert kernels.best_lag_fit(np.ones(6), np.ones(4)).tolist() == [1, 1, 1, 1, 0, 0]
    brute = [float(np.mean((ref[i : i + 399] - ref[:399] * 0.3) ** 2)) for i in range(2)]
    assert kernels.best_lag_fit(ref, ref[:399] * 0.3)[0] == (ref[0] * 0.3 if np.argmin(brute) == 0 else 0.0)


def test_snr_is_reached():
    rng = np.random.default_rng(4)
    x, noise = rng.normal(size=1000), rng.normal(size=130)
    added = kernels.mix_at_snr(x, noise, 7.0) - x
    assert 10 * np.log10(np.dot(x, x) / np.dot(added, added)) == pytest.approx(7.0)


def test_log_mel_shape_and_peak():
    t = np.arange(16000) / 16000
    m = kernels.log_mel(np.sin(2 * np.pi * 1000 * t), 16000, 80, 25.0, 10.0)
    assert m.shape == (98, 80)
    edges = np.linspace(1127 * np.log(1 + 20 / 700), 1127 * np.log(1 + 8000 / 700), 82)
    assert abs(int(np.argmax(m.mean(axis=0))) - int(np.argmin(np.abs(edges[1:-1] - 1127 * np.log(1 + 1000 / 700))))) <= 1
    assert kernels.log_mel(np.full(400, 3.0), 16000, 80, 25.0, 10.0) == pytest.approx(np.log(1.1920928955078125e-07))
    assert kernels.log_mel(np.zeros(399), 16000, 80, 25.0, 10.0).shape == (0, 80)


def test_spectral_distance(spark):
    x = np.random.default_rng(5).normal(size=3000).tolist()
    df = spark.createDataFrame([("same", x, x, 16000), ("half", x, [v / 2 for v in x], 16000), ("short", x[:9], x[:9], 16000)],
                               "key string, clean array<double>, noisy array<double>, sample_rate int")
    got = {r.key: r for r in distance.spectral_distance(df, on_error="quarantine").collect()}
    assert got["same"].mel_distance == 0 and got["same"].stft_distance == 0
    assert 0 < got["half"].mel_distance < 7 * math.log10(2) + 1e-9 and got["half"].stft_distance > 2 * 2 * math.log10(2) - 1e-6
    assert got["short"].mel_distance is None and "more than 1024" in got["short"].status


# --- twins ----------------------------------------------------------------------------------------


def test_convolution_equals_the_relational_form(spark, sf):
    paired = pairing.pair_rir(fx.wave(spark, sf), fx.rir_pool(spark, sf))
    fft = pairing.convolve(paired, "samples", "rir", "wet").select("key", F.posexplode("wet").alias("i", "v"))
    x = paired.select("key", F.posexplode("samples").alias("i", "x"))
    h = paired.select("key", F.posexplode("rir").alias("j", "h"))
    long = x.join(h, "key").groupBy("key", (F.col("i") + F.col("j")).alias("i")).agg(F.sum(F.col("x") * F.col("h")).alias("w"))
    both = fft.join(long, ["key", "i"])
    assert both.count() == fft.count() and both.filter(F.abs(F.col("v") - F.col("w")) > 1e-9).count() == 0


def test_clip_equals_exact_percentiles(spark, sf):
    rows = fx.wave(spark, sf).withColumn("noisy", F.col("samples"))
    got = pairing.quantile_clip(rows, F.lit(0.05), F.lit(0.93)).select("key", F.posexplode("noisy").alias("i", "v"))
    long = rows.select("key", F.posexplode("samples").alias("i", "x"))
    bounds = long.groupBy("key").agg(F.percentile("x", F.lit(0.05)).alias("lo"), F.percentile("x", F.lit(0.93)).alias("hi"))
    both = long.join(bounds, "key").join(got, ["key", "i"])
    assert both.filter(F.abs(F.least(F.greatest("x", "lo"), "hi") - F.col("v")) > 1e-9).count() == 0


def test_chain_equals_the_single_operators(spark, sf):
    """The fused stage with every stage forced on equals the operators one after another."""
    stages = [degrade.Stage(s.name, 1.0) for s in degrade.STAGES if s.name != "codec"]
    rows, noise, rirs = fx.wave(spark, sf), fx.noise_pool(spark, sf), fx.rir_pool(spark, sf)
    fused = degrade.degrade(rows, noise, rirs, stages, band_rates=(8, 12, 24))
    step = pairing.early_rir(pairing.pair_rir(rows, rirs))
    step = pairing.convolve(pairing.convolve(step, "samples", "rir", "noisy"), "samples", "early", "clean")
    step = pairing.level_match(step, "samples", "noisy", "clean").drop("rir", "early", "rir_rate")
    step = pairing.tile_to(pairing.pair_noise(step, noise), "noise", F.size("noisy"))
    step = pairing.band_limit(pairing.mix_snr(pairing.draw_snr(step)), (8, 12, 24))
    step = pairing.packet_loss(pairing.quantile_clip(step))
    a = {r.key: (r.clean, r.noisy) for r in fused.select("key", "clean", "noisy").collect()}
    b = {r.key: (r.clean, r.noisy) for r in step.select("key", "clean", "noisy").collect()}
    assert a.keys() == b.keys() and len(a) == rows.count()
    for k in a:
        assert np.allclose(a[k][0], b[k][0], atol=1e-9) and np.allclose(a[k][1], b[k][1], atol=1e-9)


def test_chain_is_the_same_under_any_partitioning(spark, sf):
    noise, rirs = fx.noise_pool(spark, sf), fx.rir_pool(spark, sf)
    total = lambda p: degrade.degrade(fx.wave(spark, sf).repartition(p), noise, rirs, band_rates=(8, 24)).select(
        F.sum(F.hash("key", "clean", "noisy").cast("bigint"))).first()[0]
    assert total(1) == total(3) == total(17)


def test_both_engines_agree(spark, sf):
    rows = fx.wave(spark, sf).withColumn("noisy", F.col("samples"))
    paired = pairing.draw_snr(pairing.pair_noise(rows, fx.noise_pool(spark, sf), p=0.5))
    operators = {
        "clip": (lambda e: pairing.quantile_clip(rows, engine=e)),
        "loss": (lambda e: pairing.packet_loss(rows, per_10s=20.0, engine=e)),
        "norm": (lambda e: segment.normalize(rows, "noisy", engine=e)),
        "snr": (lambda e: pairing.mix_snr(paired if e == "arrow" else pairing.tile_to(paired, "noise", F.size("noisy")), engine=e)),
    }
    for name, run in operators.items():
        native, arrow = ({r.key: r.noisy for r in run(e).select("key", "noisy").collect()} for e in ("native", "arrow"))
        assert native.keys() == arrow.keys() and all(np.allclose(native[k], arrow[k], atol=1e-9) for k in native), name
    with pytest.raises(ValueError):
        segment.normalize(rows, engine="magic")


def test_silence_leaves_the_chain(spark, sf):
    noise, rirs = fx.noise_pool(spark, sf), fx.rir_pool(spark, sf)
    rows = spark.createDataFrame([("quiet", [0.0] * 64, 16), ("loud", [0.5, -0.5] * 32, 16)], "key string, samples array<double>, sample_rate int")
    crops = segment.prepare_crops(rows, 2, 2.0, cutoff=2.0)
    codec = degrade.with_codec(lambda x, rate: x[:-3])
    forced = [degrade.Stage(s.name, 1.0, s.fn) for s in codec if s.name != "reverb"]
    kept = degrade.degrade(crops, noise, rirs, forced, band_rates=(8,), target=24, low=8).collect()
    assert [r.key for r in kept] == ["loud", "loud"]
    assert degrade.degrade(crops, noise, rirs, forced, band_rates=(8,)).count() == 4
    assert kernels.best_lag_fit(np.full(4, np.nan), np.ones(3)).tolist() == [1, 1, 1, 0]


def test_user_stages(spark, sf):
    noise, rirs = fx.noise_pool(spark, sf), fx.rir_pool(spark, sf)
    gain = lambda x, rate, by: x * by
    louder = degrade.degrade(fx.wave(spark, sf), noise, rirs, [degrade.Stage("gain", 1.0, gain, {"by": 2.0})])
    row = louder.first()
    assert np.allclose(row.noisy, np.array(row.samples) * 2) and row.clean == row.samples
    with pytest.raises(ValueError):
        degrade.degrade(fx.wave(spark, sf), noise, rirs, [degrade.Stage("echo")])


def test_large_pools_are_salted_and_shuffled(spark, sf, monkeypatch):
    rows, noise = fx.wave(spark, sf), fx.noise_pool(spark, sf)
    small = {r.key: r.noise for r in pairing.pair_noise(rows, noise, p=0.5).collect()}
    monkeypatch.setattr(pairing, "BROADCAST_BYTES", 0)
    salted = pairing.pair_noise(rows, noise, p=0.5)
    assert {r.key: r.noise for r in salted.collect()} == small
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()


# --- features -------------------------------------------------------------------------------------


def test_normalised_matrix_equals_the_long_form(spark, sf):
    mels = features.log_mel(fx.wave(spark, sf).withColumn("sample_rate", F.lit(16000)), n_mels=6, frame_ms=1.0, hop_ms=0.5)
    long = features.normalize_mel(features.long_features(mels)).select("key", "frame", "mel", "value")
    matrix = features.long_features(features.normalize_mel_matrix(mels)).withColumnRenamed("value", "other")
    both = long.join(matrix, ["key", "frame", "mel"])
    assert both.count() == long.count() and both.filter(F.abs(F.col("value") - F.col("other")) > 1e-9).count() == 0


def test_padding_and_stacking(spark):
    df = spark.createDataFrame([("a", 0, [[1.0, 2.0]] * 3), ("b", 0, [[3.0, 4.0]]), ("c", 1, [])],
                               "key string, batch_id int, features array<array<double>>")
    padded = features.pad_features(df, ["batch_id"], value=1.0, dims=2)
    rows = {r.key: r for r in padded.collect()}
    assert [len(rows[k].features) for k in "abc"] == [4, 4, 0]
    assert rows["a"].attention_mask == [1, 1, 1, 0] and rows["b"].features[1] == [1.0, 1.0]
    stacked = {r.key: r for r in features.stack_frames(padded).collect()}
    assert stacked["a"].features == [[1.0, 2.0, 1.0, 2.0], [1.0, 2.0, 1.0, 1.0]] and stacked["a"].attention_mask == [1, 0]
    assert stacked["c"].features == [] and stacked["c"].attention_mask == []
    fixed = features.pad_features(df, ["batch_id"], max_length=5, dims=2).collect()
    assert all(len(r.features) == 6 for r in fixed)


def test_pools_of_many_short_clips_are_not_small(spark):
    pool = spark.range(500_000).select(F.col("id").alias("pool_idx"), F.array(F.lit(0.5)).alias("samples"), F.lit(16).alias("sample_rate"))
    rows, size = pairing.pool_size(pool, "samples")
    assert rows == 500_000 and size > pairing.BROADCAST_BYTES

"""The degradation chain: draws and pool joins as columns, all signal work in one Arrow stage."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechtable.functions import draws, kernels, waves
from speechtable.functions.stages import sample_type, with_stage
from speechtable.operators import pairing


@dataclass(frozen=True)
class Stage:
    """One augmentation: its name, probability, and for user stages ``fn(samples, rate, **options)``.

    Options of built-in stages are listed in ``OPTIONS``. A codec may have several functions, of which each row draws one.
    """

    name: str
    p: float = 0.5
    fn: Callable | Sequence[Callable] | None = None
    options: dict = field(default_factory=dict)


# The reference order; a codec is a user function and is left out unless given.
STAGES = (Stage("reverb"), Stage("noise"), Stage("band"), Stage("clip"), Stage("codec"), Stage("loss"))


# Options of the built-in stages and what they are without any.
OPTIONS = {
    "reverb": {"early_seconds": waves.EARLY_SECONDS},
    "noise": {"snr_db": pairing.SNR_DB},
    "band": {"rates": None},
    "clip": {"low": pairing.CLIP_LOW, "high": pairing.CLIP_HIGH},
    "loss": {"low_ms": pairing.LOSS_MS[0], "high_ms": pairing.LOSS_MS[1], "per_10s": pairing.LOSSES_PER_10_SECONDS},
}


def _options(stages: Sequence[Stage], name: str) -> dict:
    given = next((s.options for s in stages if s.name == name), {})
    return {**OPTIONS[name], **given}


def _check(stages: Sequence[Stage]) -> None:
    missing = [s.name for s in stages if s.fn is None and s.name not in {d.name for d in STAGES}]
    if missing:
        raise ValueError(f"stages without a function: {missing}")
    for s in stages:
        if s.name in OPTIONS and (unknown := set(s.options) - set(OPTIONS[s.name])):
            raise ValueError(f"stage {s.name} has no option {sorted(unknown)}")


def with_codec(fn: Callable | Sequence[Callable], stages: Sequence[Stage] = STAGES) -> tuple[Stage, ...]:
    """The stages with ``fn(samples, rate)``, or one of several, as codec; its output is aligned to the input."""
    return tuple(replace(s, fn=fn) if s.name == "codec" else s for s in stages)


def plan_draws(df: DataFrame, noise: DataFrame, rirs: DataFrame, stages: Sequence[Stage], key: str, rate: str, col: str,
               seed: int, band_rates: Sequence[int]) -> DataFrame:
    """Add what the stage needs per row: pool clips, drawn parameters, and a flag per stage."""
    k = F.col(key)
    out = df
    flags = []
    for s in stages:
        on = draws.gate(k, s.name, s.p, seed)
        if s.name == "reverb":
            out = pairing.pair_rir(out, rirs, seed, key, p=s.p)
            on = F.col("rir").isNotNull()
        elif s.name == "noise":
            out = pairing.pair_noise(out, noise, seed, key, p=s.p)
            on = F.col("noise").isNotNull()
        flags.append(on.alias(s.name))
    loss, clip = _options(stages, "loss"), _options(stages, "clip")
    spans = pairing.loss_spans(k, F.size(col), F.col(rate), loss["low_ms"], loss["high_ms"], loss["per_10s"], seed)
    codec = next((s.fn for s in stages if s.name == "codec"), None)
    codecs = len(codec) if isinstance(codec, Sequence) else 1
    return out.withColumn(
        "_draws",
        F.struct(
            F.array(*flags).alias("on"),
            draws.uniform(k, "snr", *_options(stages, "noise")["snr_db"], seed=seed).alias("snr_db"),
            draws.choice(k, "band", list(_options(stages, "band")["rates"] or band_rates), seed=seed).alias("band_rate"),
            draws.uniform(k, "clip.low", *clip["low"], seed=seed).alias("clip_low"),
            draws.uniform(k, "clip.high", *clip["high"], seed=seed).alias("clip_high"),
            draws.below(k, "codec.pick", codecs, 0, seed).alias("codec"),
            spans.alias("spans"),
        ),
    )


def _degrade_row(stages: Sequence[Stage], on_error: str) -> Callable:
    early = _options(stages, "reverb")["early_seconds"]

    def user(s, noisy, rate, drawn):
        fn = s.fn[drawn["codec"]] if isinstance(s.fn, Sequence) else s.fn
        try:
            return kernels.best_lag_fit(noisy, np.asarray(fn(noisy, rate, **s.options), dtype=np.float64))
        except Exception:
            if on_error == "fail":
                raise
            return noisy  # the sample stays as it was

    def run(x, rate, rir, rir_rate, noise, noise_rate, drawn):
        clean = noisy = np.asarray(x, dtype=np.float64)
        if np.isnan(noisy).any():
            return clean, noisy  # silence before normalising; the NaN filter takes it out
        for s, on in zip(stages, drawn["on"]):
            if not on or len(noisy) == 0:
                continue
            if s.name == "reverb":
                clean, noisy = kernels.reverberate(clean, kernels.resample(rir, rir_rate, rate), rate, early)
            elif s.name == "noise":
                noisy = kernels.mix_at_snr(noisy, kernels.resample(noise, noise_rate, rate), drawn["snr_db"])
            elif s.name == "band":
                band = drawn["band_rate"]
                noisy = kernels.resample(kernels.resample(noisy, rate, band), band, rate)
            elif s.name == "clip":
                noisy = kernels.clip_quantiles(noisy, drawn["clip_low"], drawn["clip_high"])
            elif s.name == "loss":
                noisy = kernels.drop_spans(noisy, drawn["spans"])
            elif s.fn is not None:
                noisy = user(s, noisy, rate, drawn)
        return clean, noisy

    return run


def degrade(
    df: DataFrame, noise: DataFrame, rirs: DataFrame, stages: Sequence[Stage] = STAGES, seed: int = draws.DEFAULT_SEED,
    col: str = "samples", rate: str = "sample_rate", key: str = "key", band_rates: Sequence[int] = pairing.BAND_RATES,
    target: int | None = None, low: int = 16000, on_error: str = "fail",
) -> DataFrame:
    """Add ``clean`` and ``noisy``; with ``target`` also both at two rates, each peak-normalised.

    Reverb changes ``clean`` too: the target becomes the direct-path signal. With ``target`` the
    rows whose waveforms hold NaN (before or after normalising) are dropped, and the four columns
    clean, noisy, clean_16k, noisy_16k carry rates ``target`` and ``low``. With on_error="keep" a row on which a
    user function (a codec) fails goes on as it was before it; with "fail" the job ends.
    """
    if on_error not in ("fail", "keep"):
        raise ValueError("on_error must be 'fail' or 'keep'")
    _check(stages)
    chain = _degrade_row(tuple(stages), on_error)
    ready = plan_draws(df, noise, rirs, stages, key, rate, col, seed, band_rates)
    if "rir" not in ready.columns:
        ready = ready.withColumns({"rir": F.lit(None).cast("array<double>"), "rir_rate": F.lit(None).cast("int")})
    if "noise" not in ready.columns:
        ready = ready.withColumns({"noise": F.lit(None).cast("array<double>"), "noise_rate": F.lit(None).cast("int")})
    inputs = [col, rate, "rir", "rir_rate", "noise", "noise_rate", "_draws"]
    kind = sample_type(df, col)
    helpers = ("rir", "rir_rate", "noise", "noise_rate", "_draws")
    if target is None:
        return with_stage(ready, chain, f"clean array<{kind}>, noisy array<{kind}>", inputs, drop=helpers)

    def paired(x, r, *rest):
        if np.isnan(x).any():
            return (None,) * 4
        full = [kernels.resample(v, r, target) for v in chain(x, r, *rest)]
        every = [*full, *(kernels.resample(v, target, low) for v in full)]
        if any(np.isnan(v).any() for v in every):
            return (None,) * 4
        every = [kernels.peak_normalize(v) for v in every]
        return tuple(every) if not any(np.isnan(v).any() for v in every) else (None,) * 4

    names = ("clean", "noisy", "clean_16k", "noisy_16k")
    staged = with_stage(ready, paired, ", ".join(f"{n} array<{kind}>" for n in names), inputs, drop=(col, *helpers))
    kept = staged.filter(F.col("clean").isNotNull())
    return kept.withColumn(rate, F.lit(target)).withColumn(f"{rate}_16k", F.lit(low))

"""Distances between paired waveforms and features."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechtable.functions import kernels, waves
from speechtable.functions.stages import with_stage

# Fixed values of the reference training losses.
MEL_SCALES = ((5, 32), (10, 64), (20, 128), (40, 256), (80, 512), (160, 1024), (320, 2048))
STFT_WINDOWS = (2048, 512)
CLAMP = 1e-5


def pair_distance(df: DataFrame, a: str, b: str, metric: str = "l1", to: str = "distance") -> DataFrame:
    """Mean absolute (l1) or squared (mse) difference of two equally long arrays."""
    if metric not in ("l1", "mse"):
        raise ValueError("metric must be 'l1' or 'mse'")
    fn = waves.mean_abs_difference if metric == "l1" else waves.mean_squared_difference
    return df.withColumn(to, fn(F.col(a), F.col(b)))


def _spectra_gap(a: np.ndarray, b: np.ndarray, power: float, log_weight: float, mag_weight: float) -> float:
    logs = lambda m: power * np.log10(np.maximum(m, CLAMP))
    return float(log_weight * np.mean(np.abs(logs(a) - logs(b))) + mag_weight * np.mean(np.abs(a - b)))


def spectral_distance(
    df: DataFrame, a: str = "clean", b: str = "noisy", rate: str = "sample_rate",
    mel_scales: Sequence[tuple[int, int]] = MEL_SCALES, windows: Sequence[int] = STFT_WINDOWS, on_error: str = "fail",
) -> DataFrame:
    """Add ``mel_distance`` and ``stft_distance``, each summed over its scales, in one stage.

    Mel: |log10| difference of mel magnitudes. STFT: |log10 of power| plus |magnitude| difference.
    Reflect padding needs more samples than half the largest window; shorter rows are errors.
    """
    sizes = sorted({w for _, w in mel_scales} | set(windows))

    def run(x, y, r):
        if x is None or y is None:
            return None, None
        if len(x) != len(y) or len(x) <= max(sizes) // 2:
            raise ValueError(f"need two equally long waveforms of more than {max(sizes) // 2} samples")
        spectra = {w: (kernels.magnitudes(x, w), kernels.magnitudes(y, w)) for w in sizes}
        mel = 0.0
        for n, w in mel_scales:
            bank = kernels.area_mel_bank(int(r), w, n)
            mel += _spectra_gap(spectra[w][0] @ bank, spectra[w][1] @ bank, 1.0, 1.0, 0.0)
        return mel, sum(_spectra_gap(*spectra[w], 2.0, 1.0, 1.0) for w in windows)

    return with_stage(df, run, "mel_distance double, stft_distance double", [a, b, rate], on_error)

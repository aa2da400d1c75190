"""Log-mel tables, their normalisation, padding and stacking."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from speechtable.functions import kernels
from speechtable.functions.stages import with_stage

# Fixed values of the reference feature extractor.
N_MELS, FRAME_MS, HOP_MS, VARIANCE_FLOOR, STRIDE = 80, 25.0, 10.0, 1e-5, 2


def log_mel(
    df: DataFrame, col: str = "samples", rate: str = "sample_rate", n_mels: int = N_MELS, frame_ms: float = FRAME_MS,
    hop_ms: float = HOP_MS, to: str = "features", on_error: str = "fail",
) -> DataFrame:
    """(frames, n_mels) log mel matrix per row; a waveform shorter than a frame has no frames."""
    return with_stage(
        df, lambda x, r: (None if x is None else kernels.log_mel(x, r, n_mels, frame_ms, hop_ms),),
        f"`{to}` array<array<double>>", [col, rate], on_error,
    )


def long_features(df: DataFrame, keys: Sequence[str] = ("key",), col: str = "features") -> DataFrame:
    """(keys..., frame, mel, value) from a feature matrix column."""
    frames = df.select(*keys, F.posexplode(col).alias("frame", "_row"))
    return frames.select(*keys, "frame", F.posexplode("_row").alias("mel", "value"))


def normalize_mel(df: DataFrame, keys: Sequence[str] = ("key",), floor: float = VARIANCE_FLOOR) -> DataFrame:
    """Long form: subtract the mean and divide by sqrt(unbiased variance + floor) per (key, mel).

    A window group is one utterance's frames in one band.
    """
    band = W.partitionBy(*keys, "mel")
    centred = F.col("value") - F.avg("value").over(band)
    return df.withColumn("value", centred / F.sqrt(F.var_samp("value").over(band) + F.lit(floor)))


def normalize_mel_matrix(df: DataFrame, col: str = "features", floor: float = VARIANCE_FLOOR) -> DataFrame:
    """The same on the matrix column, without a shuffle."""

    def run(matrix):
        if matrix is None:
            return (None,)
        m = np.asarray(matrix, dtype=float)
        with np.errstate(invalid="ignore", divide="ignore"):
            spread = m.var(axis=0, ddof=1) if len(m) > 1 else np.full(m.shape[1:], np.nan)
            return ((m - m.mean(axis=0)) / np.sqrt(spread + floor) if len(m) else m,)

    return with_stage(df, run, f"`{col}` array<array<double>>", [col])


def pad_features(
    df: DataFrame, batch_cols: Sequence[str], col: str = "features", multiple: int | None = STRIDE,
    value: float = 0.0, max_length: int | None = None, dims: int | None = None,
) -> DataFrame:
    """Pad each matrix to the batch's longest (or ``max_length``), rounded up; add ``attention_mask``.

    The window group is one batch, whose size the batching step fixed.
    """
    longest = F.lit(max_length) if max_length is not None else F.max(F.size(col)).over(W.partitionBy(*batch_cols))
    if multiple is not None:
        longest = (F.ceil(longest / F.lit(multiple)) * multiple).cast("int")
    width = F.lit(dims) if dims is not None else F.size(F.get(F.col(col), F.lit(0)))
    ready = df.withColumn("_target", longest.cast("int"))
    missing = F.greatest(F.col("_target") - F.size(col), F.lit(0))
    filler = F.array_repeat(F.array_repeat(F.lit(float(value)), F.coalesce(width, F.lit(0))), missing)
    ones = F.array_repeat(F.lit(1), F.least(F.size(col), F.col("_target")))
    return (
        ready.withColumn("attention_mask", F.concat(ones, F.array_repeat(F.lit(0), missing)))
        .withColumn(col, F.slice(F.concat(F.col(col), filler), F.lit(1), F.col("_target")))
        .drop("_target")
    )


def stack_frames(df: DataFrame, stride: int = STRIDE, col: str = "features", mask: str | None = "attention_mask") -> DataFrame:
    """Join each ``stride`` frames to one; the mask keeps every stride-th value from the second."""
    if stride < 2:
        raise ValueError("stride must be >= 2")
    x = F.col(col)
    groups = F.floor(F.size(x) / stride).cast("int")

    def joined(i: Column) -> Column:
        return F.flatten(F.slice(x, (i * stride + 1).cast("int"), F.lit(stride)))

    def every(m: Column, i: Column) -> Column:
        return F.get(m, i * stride + 1)

    steps = F.when(groups > 0, F.sequence(F.lit(0), groups - 1)).otherwise(F.array().cast("array<int>"))
    out = df.withColumn("_steps", steps)
    if mask is not None:
        # The mask is first cut to whole groups; from 1 on, each stride-th value remains.
        out = out.withColumn(mask, F.transform("_steps", lambda i: every(F.col(mask), i)))
    return out.withColumn(col, F.transform("_steps", joined)).drop("_steps")

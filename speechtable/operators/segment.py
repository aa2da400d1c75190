"""Cutting, padding, filtering, resampling and batching of waveform columns."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechtable.functions import draws, kernels, waves
from speechtable.functions.stages import is_arrow, sample_type, with_stage

MODEL_RATE = 16000


def to_mono(df: DataFrame, how: str = "mean", col: str = "channels", to: str = "samples") -> DataFrame:
    """Collapse (channels, time) to one channel: the mean, or the first."""
    if how not in ("mean", "first"):
        raise ValueError("how must be 'mean' or 'first'")
    mono = waves.mono_mean(F.col(col)) if how == "mean" else waves.mono_first(F.col(col))
    return df.withColumn(to, mono)


def resample(
    df: DataFrame, target: int | Column, col: str = "samples", rate: str = "sample_rate", to: str | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """Waveform at the target rate; ``rate`` is re-tagged when the waveform is replaced."""
    target = target if isinstance(target, Column) else F.lit(target)
    out = to or col
    staged = with_stage(
        df, lambda x, source, wanted: (None if x is None else kernels.resample(x, source, wanted),),
        f"`{out}` array<{sample_type(df, col)}>", [col, rate, target], on_error,
    )
    return staged.withColumn(rate, target.cast("int")) if out == col else staged


def fan_out_rates(
    df: DataFrame, target: int, low: int = MODEL_RATE, cols: Sequence[str] = ("clean", "noisy"),
    rate: str = "sample_rate", low_suffix: str = "_16k",
) -> DataFrame:
    """Each waveform at the target rate and a copy at the low rate, taken from the former; one stage."""
    kind = sample_type(df, cols[0])

    def run(source, *xs):
        full = [None if x is None else kernels.resample(x, source, target) for x in xs]
        return (*full, *(None if x is None else kernels.resample(x, target, low) for x in full))

    names = [*cols, *[f"{c}{low_suffix}" for c in cols]]
    ddl = ", ".join(f"`{n}` array<{kind}>" for n in names)
    staged = with_stage(df, run, ddl, [rate, *cols])
    return staged.withColumn(rate, F.lit(target)).withColumn(f"{rate}{low_suffix}", F.lit(low))


def low_cut(df: DataFrame, cutoff: float = 50.0, col: str = "samples", rate: str = "sample_rate") -> DataFrame:
    """Second-order high-pass, output clamped to [-1, 1]."""
    return with_stage(
        df, lambda x, r: (None if x is None else kernels.low_cut(x, r, cutoff),),
        f"`{col}` array<{sample_type(df, col)}>", [col, rate],
    )


def normalize(df: DataFrame, col: str = "samples", to: str | None = None, engine: str = "arrow") -> DataFrame:
    """Peak normalisation; silent rows get null (in Arrow NaN) samples, which ``drop_nan`` removes."""
    if is_arrow(engine):
        kernel = lambda x: (None if x is None else kernels.peak_normalize(x),)
        return with_stage(df, kernel, f"`{to or col}` array<{sample_type(df, col)}>", [col])
    return df.withColumn(to or col, waves.normalized(F.col(col)))


def crop_count(n_samples: Column, rate: Column, n_crops: int) -> Column:
    """int(max(min(duration / n, n), 1))."""
    per_crop = n_samples / rate / F.lit(n_crops)
    return F.floor(F.greatest(F.least(per_crop, F.lit(float(n_crops))), F.lit(1.0))).cast("int")


def crop_starts(key: Column, n_samples: Column, rate: Column, n_crops: int, seconds: float, seed: int) -> Column:
    """ARRAY of start samples, uniform in [0, max(0, n - int(rate * seconds))]."""
    room = F.greatest(n_samples - F.floor(rate * F.lit(float(seconds))), F.lit(0)) + 1
    return waves.let(
        room,
        lambda r: F.transform(
            F.sequence(F.lit(0), crop_count(n_samples, rate, n_crops) - 1),
            lambda i: draws.below(key, "crop", r, i, seed),
        ),
    )


def random_crop(
    df: DataFrame, n_crops: int, seconds: float, seed: int = draws.DEFAULT_SEED, col: str = "samples",
    rate: str = "sample_rate", key: str = "key",
) -> DataFrame:
    """One row per crop (``crop``, ``crop_start``); waveforms shorter than a crop stay whole.

    The crops are cut before the explode, so the full waveform is not copied once per crop.
    """
    x, r = F.col(col), F.col(rate)
    length = F.bround(r * F.lit(float(seconds))).cast("int")
    crops = F.transform(
        crop_starts(F.col(key), F.size(x), r, n_crops, seconds, seed),
        lambda s: F.struct(s.alias("start"), waves.cut(x, s, length).alias("samples")),
    )
    kept = [c for c in df.columns if c != col]
    return df.select(*kept, F.posexplode(crops).alias("crop", "_crop")).select(
        *kept, "crop", F.col("_crop.start").alias("crop_start"), F.col("_crop.samples").alias(col)
    )


def chunk_samples(chunk_seconds: float, rate: int = MODEL_RATE) -> int:
    """Model input length at the model's rate: at least a tenth of a second."""
    return max(int(chunk_seconds * rate), rate // 10, 1)


def fit_chunk(df: DataFrame, chunk_seconds: float, col: str = "samples") -> DataFrame:
    """Zero-pad or truncate to the model chunk."""
    return df.withColumn(col, waves.fit(F.col(col), chunk_samples(chunk_seconds)))


def expected_length(n_samples: Column, rate: Column, target_rate: int) -> Column:
    """round(duration * target), halves to even."""
    return F.bround(n_samples / rate.cast("double") * F.lit(float(target_rate))).cast("int")


def fit_expected(
    df: DataFrame, target_rate: int, col: str = "restored", source: str = "samples", rate: str = "sample_rate"
) -> DataFrame:
    """Pad or cut a restored waveform to the source's duration; empty sources leave it as it is."""
    n = expected_length(F.size(source), F.col(rate), target_rate)
    return df.withColumn(col, F.when(n > 0, waves.fit(F.col(col), n)).otherwise(F.col(col)))


def edge_pad(df: DataFrame, k: int = 40, col: str = "samples") -> DataFrame:
    return df.withColumn(col, waves.edge_pad(F.col(col), k))


def pad_to(df: DataFrame, n: int, col: str = "samples") -> DataFrame:
    """Zero-pad to n samples; ``n_samples`` keeps the true length."""
    return df.withColumn("n_samples", F.size(col)).withColumn(col, waves.pad_to(F.col(col), n))


def _ordered(df: DataFrame, batch_cols: Sequence[str], slot: str, fields: Sequence[str]) -> DataFrame:
    """One row per batch with its members in slot order; a batch holds at most its fixed size."""
    members = F.array_sort(F.collect_list(F.struct(slot, *fields)))
    return df.groupBy(*batch_cols).agg(members.alias("_members"))


def collate(
    df: DataFrame, batch_cols: Sequence[str], slot: str = "slot", col: str = "samples", key: str = "key"
) -> DataFrame:
    """One row per batch: keys, true lengths and waveforms padded to the longest member."""
    batches = _ordered(df, batch_cols, slot, [key, col]).withColumn("longest", F.array_max(F.transform(f"_members.{col}", F.size)))
    return batches.select(
        *batch_cols,
        F.col(f"_members.{key}").alias("keys"),
        F.transform(f"_members.{col}", F.size).alias("lens"),
        waves.let(F.col("longest"), lambda n: F.transform(f"_members.{col}", lambda x: waves.pad_to(x, n))).alias("padded"),
    )


def assemble_pairs(
    df: DataFrame, batch_cols: Sequence[str], slot: str = "slot", key: str = "key",
    cols: Sequence[str] = ("clean", "noisy"), rate: str = "sample_rate", features: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(batches, ragged): stacked pairs with the first member's rate.

    Members of one batch must agree in length per column; batches that do not go to ``ragged``.
    """
    batches = _ordered(df, batch_cols, slot, [key, rate, *cols, *features])
    sizes = lambda c: F.transform(f"_members.{c}", F.size)
    even = F.lit(True)
    for c in cols:
        even = even & (F.array_min(sizes(c)) == F.array_max(sizes(c)))
    rows = batches.withColumn("_even", even).select(
        *batch_cols,
        F.col(f"_members.{key}").alias("names"),
        F.get(f"_members.{rate}", F.lit(0)).alias("sr"),
        sizes(cols[0]).alias("lens"),
        *[F.col(f"_members.{c}").alias(c) for c in (*cols, *features)],
        "_even",
    )
    ragged = rows.filter(~F.col("_even")).withColumn("reason", F.lit("ragged batch"))
    return rows.filter("_even").drop("_even"), ragged.drop("_even")


def prepare_crops(
    df: DataFrame, n_crops: int, seconds: float, cutoff: float = 50.0, seed: int = draws.DEFAULT_SEED,
    col: str = "samples", rate: str = "sample_rate", key: str = "key",
) -> DataFrame:
    """Low cut, random crops and peak normalisation in one Arrow stage.

    The same rows as ``low_cut`` → ``random_crop`` → ``normalize``, with each waveform crossing to
    Python once. Draws stay native, so the starts are those of ``random_crop``.
    """
    starts = crop_starts(F.col(key), F.size(col), F.col(rate), n_crops, seconds, seed)
    length = F.bround(F.col(rate) * F.lit(float(seconds))).cast("int")

    def run(x, r, begin, n):
        filtered = kernels.low_cut(x, r, cutoff)
        return ([kernels.peak_normalize(filtered[s : s + n]) for s in np.asarray(begin, dtype=int)],)

    drawn = df.withColumn("_starts", starts)
    kind = sample_type(df, col)
    staged = with_stage(drawn, run, f"_crops array<array<{kind}>>", [col, rate, "_starts", length], drop=[col])
    kept = [c for c in df.columns if c != col]
    return staged.select(*kept, F.posexplode(F.arrays_zip("_starts", "_crops")).alias("crop", "_crop")).select(
        *kept, "crop", F.col("_crop._starts").alias("crop_start"), F.col("_crop._crops").alias(col)
    )

"""Pairing speech with noise and impulse-response pools, and the native degradations."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechtable.functions import draws, kernels, waves
from speechtable.functions.stages import is_arrow, sample_type, with_stage
from speechtable.operators.ordering import numbered
from speechtable.operators.segment import random_crop

BROADCAST_BYTES = 64 << 20  # a pool below this size is sent to every executor
ROW_BYTES = 160  # of a broadcast row beside its samples: key, row header, hash table slot, array headers
SPREAD = 4096  # distinct join keys a shuffled pool should offer

# Fixed values of the reference degradations.
SNR_DB = (-5.0, 20.0)
CLIP_LOW, CLIP_HIGH = (0.0, 0.1), (0.9, 1.0)
LOSS_MS = (20.0, 200.0)
LOSSES_PER_10_SECONDS = 3.0
BAND_RATES = (8000, 16000, 22050, 24000, 44100, 48000)


def random_apply(
    df: DataFrame, p: float, fn: Callable[[DataFrame], DataFrame], stage: str, cols: Sequence[str], key: str = "key",
    seed: int = draws.DEFAULT_SEED,
) -> DataFrame:
    """Apply ``fn`` with probability p per row: gated rows take the new columns, others keep theirs.

    ``fn`` keeps the row count. Use the gate inside ``fn`` instead where the work itself is costly.
    """
    before = df.withColumns({f"_old_{c}": F.col(c) for c in cols}).withColumn(
        "_gate", draws.gate(F.col(key), stage, p, seed)
    )
    after = fn(before)
    chosen = {c: F.when(F.col("_gate"), F.col(c)).otherwise(F.col(f"_old_{c}")) for c in cols}
    return after.withColumns(chosen).drop("_gate", *[f"_old_{c}" for c in cols])


def prepare_pool(
    df: DataFrame, seconds: float, n_crops: int = 30, seed: int = draws.DEFAULT_SEED, col: str = "samples",
    ordinal: str = "ordinal", key: str = "key",
) -> DataFrame:
    """(pool_idx, samples, sample_rate): crops of noise recordings, numbered in source order.

    Pairing reads a pool twice (its size, then its clips): write it first when it is costly to make.
    """
    crops = random_crop(df, n_crops, seconds, seed, col, key=key)
    placed = crops.withColumn("_at", F.col(ordinal) * n_crops + F.col("crop"))
    return numbered(placed, (), "_at", index="pool_idx").select("pool_idx", F.col(col).alias("samples"), "sample_rate")


def pool_size(pool: DataFrame, col: str) -> tuple[int, int]:
    """(rows, bytes in memory) of a pool, from one aggregate over its lengths; a row costs more than its samples."""
    nested = pool.schema[col].dataType.elementType.simpleString().startswith("array")
    samples = F.aggregate(col, F.lit(0), lambda n, ch: n + F.size(ch)) if nested else F.size(col)
    rows, total = pool.agg(F.count(F.lit(1)), F.sum(samples.cast("bigint"))).first()
    return rows, 8 * (total or 0) + ROW_BYTES * rows


def _join_pool(df: DataFrame, pool: DataFrame, picked: Column, n: int, n_bytes: int, key: Column, seed: int) -> DataFrame:
    """Left join on the picked pool index (null = no pick).

    A pool of proven small size is broadcast. A larger one is shuffled; few distinct clips would
    then make few huge keys, so clips are copied over salts, and rows without a pick are spread
    over negative indexes instead of sharing one null key.
    """
    if n_bytes <= BROADCAST_BYTES:
        keyed = df.withColumn("_pick", picked)
        return keyed.join(F.broadcast(pool), F.col("_pick") == F.col("pool_idx"), "left").drop("_pick", "pool_idx")
    salts = max(1, SPREAD // max(n, 1))
    none = -1 - F.pmod(F.xxhash64(key), F.lit(1 << 40))
    salted = df.withColumn("_pick", F.coalesce(picked, none)).withColumn(
        "_salt", F.when(picked.isNull(), F.lit(0)).otherwise(draws.below(key, "salt", salts, 0, seed)).cast("int")
    )
    copies = pool.withColumn("_pool_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    same = (F.col("_pick") == F.col("pool_idx")) & (F.col("_salt") == F.col("_pool_salt"))
    return salted.join(copies, same, "left").drop("_pick", "_salt", "_pool_salt", "pool_idx")


def pair_noise(
    df: DataFrame, pool: DataFrame, seed: int = draws.DEFAULT_SEED, key: str = "key", p: float | None = None
) -> DataFrame:
    """Add ``noise`` and ``noise_rate`` from the pool row each speech row draws (null when not gated)."""
    n, n_bytes = pool_size(pool, "samples")
    pick = draws.below(F.col(key), "noise", n, 0, seed)
    if p is not None:
        pick = F.when(draws.gate(F.col(key), "noise", p, seed), pick)
    clips = pool.select("pool_idx", F.col("samples").alias("noise"), F.col("sample_rate").alias("noise_rate"))
    return _join_pool(df, clips, pick, n, n_bytes, F.col(key), seed)


def match_rate(df: DataFrame, col: str, own_rate: str, rate: str = "sample_rate") -> DataFrame:
    """Resample ``col`` from its own rate to the row's rate; equal rates pass through."""
    kind = sample_type(df, col)
    return with_stage(
        df, lambda x, a, b: (None if x is None else kernels.resample(x, a, b),), f"`{col}` array<{kind}>",
        [col, own_rate, rate],
    ).withColumn(own_rate, F.when(F.col(col).isNotNull(), F.col(rate)))


def tile_to(df: DataFrame, col: str, n: Column) -> DataFrame:
    return df.withColumn(col, waves.tiled(F.col(col), n))


def draw_snr(df: DataFrame, key: str = "key", seed: int = draws.DEFAULT_SEED, name: str = "snr_db") -> DataFrame:
    return df.withColumn(name, draws.uniform(F.col(key), "snr", *SNR_DB, seed=seed))


def mix_snr(df: DataFrame, snr_col: str = "snr_db", x: str = "noisy", noise: str = "noise", engine: str = "arrow") -> DataFrame:
    """x plus the noise (of the same length) scaled to the signal-to-noise ratio; no noise, no change.

    The Arrow form tiles the noise itself.
    """
    if is_arrow(engine):
        kernel = lambda a, b, snr: (a if a is None or b is None else kernels.mix_at_snr(a, b, snr),)
        return with_stage(df, kernel, f"`{x}` array<{sample_type(df, x)}>", [x, noise, snr_col])
    gain = waves.snr_gain(F.col(x), F.col(noise), F.col(snr_col))
    mixed = waves.mixed(F.col(x), F.col(noise), gain)
    return df.withColumn(x, F.when(F.col(noise).isNotNull(), mixed).otherwise(F.col(x).cast("array<double>")))


def pair_rir(
    df: DataFrame, pool: DataFrame, seed: int = draws.DEFAULT_SEED, key: str = "key", p: float | None = None,
    peak_normalize: bool = False,
) -> DataFrame:
    """Add ``rir`` and ``rir_rate``: one drawn channel of the response each row draws."""
    n, n_bytes = pool_size(pool, "channels")
    pick = draws.below(F.col(key), "rir", n, 0, seed)
    if p is not None:
        pick = F.when(draws.gate(F.col(key), "rir", p, seed), pick)
    clips = pool.select("pool_idx", F.col("channels").alias("_channels"), F.col("sample_rate").alias("rir_rate"))
    joined = _join_pool(df, clips, pick, n, n_bytes, F.col(key), seed)
    channel = draws.below(F.col(key), "rir.channel", F.size("_channels"), 0, seed).cast("int")
    h = F.get("_channels", channel)
    if peak_normalize:
        h = waves.let(h, lambda v: waves.scaled(v, F.try_divide(F.lit(1.0), waves.peak(v).cast("double"))))
    return joined.withColumn("rir", h).drop("_channels")


def convolve(df: DataFrame, x: str, h: str, to: str) -> DataFrame:
    """Convolution of x with h cut to the length of x (FFT inside one Arrow stage)."""
    return with_stage(
        df, lambda a, b: (a if b is None else kernels.convolve(a, b),), f"`{to}` array<{sample_type(df, x)}>",
        [x, h],
    )


def early_rir(df: DataFrame, col: str = "rir", rate: str = "sample_rate", sec: float = 0.05, ratio: float = 0.1, to: str = "early") -> DataFrame:
    """The part of a response up to its start plus int(sec * rate) samples, zero after."""
    return df.withColumn(to, waves.early_response(F.col(col), F.col(rate), sec, ratio))


def level_match(df: DataFrame, x: str, wet: str, dry: str) -> DataFrame:
    """Scale wet and dry by one factor so that the larger of their peaks equals that of x."""
    top = F.greatest(waves.peak(F.col(wet)), waves.peak(F.col(dry))).cast("double")
    factor = F.try_divide(waves.peak(F.col(x)).cast("double"), top)
    scaled = df.withColumn("_factor", factor)
    return scaled.withColumns({c: waves.scaled(F.col(c), F.col("_factor")) for c in (wet, dry)}).drop("_factor")


def band_limit(
    df: DataFrame, rates: Sequence[int] = BAND_RATES, seed: int = draws.DEFAULT_SEED, col: str = "noisy",
    rate: str = "sample_rate", key: str = "key",
) -> DataFrame:
    """Resample to a drawn rate and back, both in one stage."""
    drawn = df.withColumn("band_rate", draws.choice(F.col(key), "band", list(rates), seed=seed))

    def there_and_back(x, r, band):
        return (None if x is None else kernels.resample(kernels.resample(x, r, band), band, r),)

    return with_stage(
        drawn, there_and_back, f"`{col}` array<{sample_type(df, col)}>", [col, rate, "band_rate"]
    )


def quantile_clip(df: DataFrame, low: Column | None = None, high: Column | None = None, col: str = "noisy", key: str = "key",
                  seed: int = draws.DEFAULT_SEED, engine: str = "arrow") -> DataFrame:
    """Clamp at the low and high quantiles, drawn per row unless given."""
    low = low if low is not None else draws.uniform(F.col(key), "clip.low", *CLIP_LOW, seed=seed)
    high = high if high is not None else draws.uniform(F.col(key), "clip.high", *CLIP_HIGH, seed=seed)
    if is_arrow(engine):
        kernel = lambda x, a, b: (None if x is None else kernels.clip_quantiles(x, a, b),)
        return with_stage(df, kernel, f"`{col}` array<{sample_type(df, col)}>", [col, low, high])
    return df.withColumn(col, waves.quantile_clipped(F.col(col), low, high))


def align_best_lag(df: DataFrame, ref: str, x: str) -> DataFrame:
    """A coded signal at its original's length: cut, or placed at the lag of least squared error."""
    return with_stage(
        df, lambda a, b: (kernels.best_lag_fit(a, b),), f"`{x}` array<{sample_type(df, x)}>", [ref, x]
    )


def loss_spans(
    key: Column, n_samples: Column, rate: Column, low_ms: float, high_ms: float, per_10s: float, seed: int
) -> Column:
    """ARRAY<STRUCT<s, e>> of drawn half-open spans; empty when the signal is short."""
    duration = n_samples / rate.cast("double")
    count = F.floor(duration * F.lit(per_10s) / F.lit(10.0)).cast("int")

    def span(i: Column, d: Column) -> Column:
        length = draws.uniform(key, "loss.length", low_ms, high_ms, i, seed) / F.lit(1000.0)
        begin = lambda n: draws.draw(key, "loss.start", i, seed) * (d - n)
        ends = lambda n, b: F.struct((b * rate).cast("int").alias("s"), ((b + n) * rate).cast("int").alias("e"))
        return waves.let(length, lambda n: waves.let(begin(n), lambda b: ends(n, b)))

    spans = waves.let(duration, lambda d: F.transform(F.sequence(F.lit(0), count - 1), lambda i: span(i, d)))
    return F.when(count > 0, spans).otherwise(F.array().cast("array<struct<s:int,e:int>>"))


def packet_loss(
    df: DataFrame, seed: int = draws.DEFAULT_SEED, col: str = "noisy", rate: str = "sample_rate", key: str = "key",
    low_ms: float = LOSS_MS[0], high_ms: float = LOSS_MS[1], per_10s: float = LOSSES_PER_10_SECONDS,
    engine: str = "arrow",
) -> DataFrame:
    """Zero int(duration * 3 / 10) drawn spans of 20 to 200 ms."""
    spans = loss_spans(F.col(key), F.size(col), F.col(rate), low_ms, high_ms, per_10s, seed)
    if is_arrow(engine):
        kernel = lambda x, p: (None if x is None else kernels.drop_spans(x, p),)
        return with_stage(df, kernel, f"`{col}` array<{sample_type(df, col)}>", [col, spans])
    return df.withColumn(col, waves.dropped(F.col(col), spans))

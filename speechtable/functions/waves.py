"""Native waveform expressions over ARRAY<FLOAT|DOUBLE> columns.

Higher-order functions evaluate their lambda body once per sample, so a scalar such as the
peak must be bound outside the lambda (``let``); written inline it would cost O(n^2).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference data preparation.
NORM_OFFSET = 1e-7
NORM_SCALE = 0.9
RIR_START_RATIO = 0.1
EARLY_SECONDS = 0.05


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def zeros(n) -> Column:
    """``n`` zero samples; none when n <= 0."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.array_repeat(F.lit(0.0), F.greatest(n, F.lit(0)).cast("int"))


def cut(x: Column, start, n) -> Column:
    """Samples [start, start + n), zero-based."""
    start = start if isinstance(start, Column) else F.lit(start)
    n = n if isinstance(n, Column) else F.lit(n)
    return F.slice(x, (start + 1).cast("int"), F.greatest(n, F.lit(0)).cast("int"))


def pad_to(x: Column, n) -> Column:
    """Zero-pad on the right to at least n samples."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.concat(x, zeros(n - F.size(x)))


def fit(x: Column, n) -> Column:
    """Zero-pad or cut to exactly n samples."""
    return cut(pad_to(x, n), 0, n)


def edge_pad(x: Column, k: int) -> Column:
    return F.concat(zeros(k), x, zeros(k))


def peak(x: Column) -> Column:
    return F.array_max(F.transform(x, F.abs))


def energy(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v)


def normalized(x: Column) -> Column:
    """(v / peak + 1e-7) * 0.9; silence divides by zero and yields null samples."""
    return let(
        peak(x).cast("double"),
        lambda p: F.transform(x, lambda v: (F.try_divide(v.cast("double"), p) + F.lit(NORM_OFFSET)) * F.lit(NORM_SCALE)),
    )


def has_nan(x: Column) -> Column:
    """True when a sample is NaN or null (a null sample is what division by zero leaves)."""
    return F.coalesce(F.exists(x, lambda v: v.isNull() | F.isnan(v)), F.lit(True))


def finite(x: Column) -> Column:
    """NaN and null to 0, infinities to the largest finite float of their sign."""
    largest = F.lit(3.4028234663852886e38)
    return F.transform(
        x,
        lambda v: F.when(v.isNull() | F.isnan(v), F.lit(0.0))
        .when(v == F.lit(float("inf")), largest)
        .when(v == F.lit(float("-inf")), -largest)
        .otherwise(v.cast("double")),
    )


def mono_mean(channels: Column) -> Column:
    """Mean over channels of ARRAY<ARRAY<...>> (channels, time)."""
    return let(
        F.size(channels).cast("double"),
        lambda c: F.transform(
            F.get(channels, F.lit(0)),
            lambda _, i: F.aggregate(channels, F.lit(0.0), lambda acc, ch: acc + F.get(ch, i).cast("double")) / c,
        ),
    )


def mono_first(channels: Column) -> Column:
    return F.get(channels, F.lit(0))


def tiled(x: Column, n) -> Column:
    """Repeat x and cut to n samples; null when x is empty."""
    n = n if isinstance(n, Column) else F.lit(n)
    times = F.ceil(F.try_divide(n, F.size(x))).cast("int")
    return F.when(F.size(x) > 0, cut(F.flatten(F.array_repeat(x, times)), 0, n))


def snr_gain(speech: Column, noise: Column, snr_db: Column) -> Column:
    """Factor for the noise so that speech / noise reaches snr_db: 0 for silent speech, NaN for silent noise."""

    def gain(e: Column) -> Column:
        ratio = F.pow(F.lit(10.0), (F.lit(10.0) * F.log10(e["s"] / e["n"]) - snr_db) / F.lit(20.0))
        return F.when(e["n"] == 0, F.lit(float("nan"))).when(e["s"] == 0, F.lit(0.0)).otherwise(ratio)

    return let(F.struct(energy(speech).alias("s"), energy(noise).alias("n")), gain)


def mixed(speech: Column, noise: Column, gain: Column) -> Column:
    return let(gain, lambda g: F.zip_with(speech, noise, lambda s, n: s.cast("double") + g * n.cast("double")))


def quantile_sorted(ordered: Column, q: Column) -> Column:
    """Linear interpolation at q * (n - 1) in an ascending array."""
    at = q * (F.size(ordered) - 1)
    low = F.floor(at).cast("int")
    left = F.get(ordered, low).cast("double")
    right = F.coalesce(F.get(ordered, low + 1).cast("double"), left)
    return left + (right - left) * (at - low)


def clamped(x: Column, low: Column, high: Column) -> Column:
    return let(
        F.struct(low.alias("low"), high.alias("high")),
        lambda b: F.transform(x, lambda v: F.least(F.greatest(v.cast("double"), b["low"]), b["high"])),
    )


def quantile_clipped(x: Column, q_low: Column, q_high: Column) -> Column:
    bounds = let(
        F.sort_array(x),
        lambda s: F.struct(quantile_sorted(s, q_low).alias("low"), quantile_sorted(s, q_high).alias("high")),
    )
    return let(bounds, lambda b: F.transform(x, lambda v: F.least(F.greatest(v.cast("double"), b["low"]), b["high"])))


def response_start(h: Column, ratio: float = RIR_START_RATIO) -> Column:
    """First index whose magnitude exceeds ratio * peak; 0 for silence, null for an empty array.

    The peak itself exceeds the threshold, so the first hit never lies after it.
    """
    threshold = peak(h).cast("double") * F.lit(ratio)
    hit = let(threshold, lambda t: F.array_position(F.transform(h, lambda v: F.abs(v) > t), F.lit(True)))
    return F.when(hit > 0, (hit - 1).cast("int")).when(F.size(h) > 0, F.lit(0))


def early_response(h: Column, sample_rate: Column, seconds: float = EARLY_SECONDS, ratio: float = RIR_START_RATIO) -> Column:
    """h with everything after start + int(seconds * rate) set to zero."""
    stop = response_start(h, ratio) + F.floor(F.lit(seconds) * sample_rate).cast("int")
    return let(stop, lambda s: F.transform(h, lambda v, i: F.when(i < s, v.cast("double")).otherwise(F.lit(0.0))))


def scaled(x: Column, factor: Column) -> Column:
    return let(factor, lambda f: F.transform(x, lambda v: v.cast("double") * f))


def dropped(x: Column, spans: Column) -> Column:
    """Zero the samples inside ARRAY<STRUCT<s, e>> half-open spans."""
    return let(
        spans,
        lambda p: F.transform(
            x,
            lambda v, i: F.when(F.exists(p, lambda w: (i >= w["s"]) & (i < w["e"])), F.lit(0.0)).otherwise(v.cast("double")),
        ),
    )


def mean_abs_difference(a: Column, b: Column) -> Column:
    total = F.aggregate(F.zip_with(a, b, lambda u, v: F.abs(u.cast("double") - v)), F.lit(0.0), lambda s, d: s + d)
    return F.try_divide(total, F.size(a))


def mean_squared_difference(a: Column, b: Column) -> Column:
    diff = F.zip_with(a, b, lambda u, v: u.cast("double") - v)
    return F.try_divide(F.aggregate(diff, F.lit(0.0), lambda s, d: s + d * d), F.size(a))

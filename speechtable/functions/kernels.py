"""NumPy kernels for one waveform, used inside Arrow stages.

Resampling, the biquad and the mel front end follow public formulas (Hann-windowed sinc,
RBJ audio cookbook, Kaldi filter bank). Filters that depend only on rates are cached per worker.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

# Fixed values of the reference resampler, high-pass and mel front end.
SINC_ZERO_CROSSINGS = 6
SINC_ROLLOFF = 0.99
HIGHPASS_Q = 0.707
PREEMPHASIS = 0.97
POVEY_POWER = 0.85
MEL_LOW_HZ = 20.0
MEL_FLOOR = 1.1920928955078125e-07

#: Least transform of a convolution in blocks; samples of a block of the high-pass, and of blocks filtered together.
CONVOLVE_BLOCK, SCAN_BLOCK, SCAN_STRETCH = 1 << 15, 128, 1 << 17


#: Taps of a pair of rates that a worker keeps; larger tables are made anew for each waveform, block by block.
CACHED_TAPS = 1 << 20


def _tap_blocks(up: int, down: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first output phase, first input, taps[phase, input]) of runs of phases whose inputs overlap.

    Only inputs within reach count: about 13 for each phase (more by ``down / up`` where the rate falls). A run spans about twice
    that, so all runs together are linear in the larger factor.
    """
    cutoff = min(up, down) * SINC_ROLLOFF
    half = SINC_ZERO_CROSSINGS * down / cutoff
    phases = max(1, int(2 * half * up / down))
    for first in range(0, up, phases):
        own = np.arange(first, min(first + phases, up))
        start, end = math.floor(own[0] * down / up - half), math.ceil(own[-1] * down / up + half)
        t = (np.arange(start, end + 1)[None, :] / down - own[:, None] / up) * cutoff
        t = np.clip(t, -SINC_ZERO_CROSSINGS, SINC_ZERO_CROSSINGS)
        hann = np.cos(np.pi * t / (2 * SINC_ZERO_CROSSINGS)) ** 2
        yield first, start, np.sinc(t) * hann * (cutoff / down)


@lru_cache(maxsize=16)
def _kept_blocks(up: int, down: int) -> list[tuple[int, int, np.ndarray]]:
    return list(_tap_blocks(up, down))


def resample(x: np.ndarray, source: int, target: int) -> np.ndarray:
    """Windowed-sinc resampling; ceil(n * target / source) samples come out."""
    source, target = int(source), int(target)
    if source == target or len(x) == 0:
        return x
    g = math.gcd(source, target)
    down, up = source // g, target // g
    n_out = -(-len(x) * up // down)
    rounds = -(-n_out // up)
    reach = math.ceil(SINC_ZERO_CROSSINGS * down / (min(up, down) * SINC_ROLLOFF)) + 1
    padded = np.pad(np.asarray(x, dtype=np.float64), (reach, reach + 2 * down))
    out = np.empty((rounds, up))
    small = 30 * max(up, down) <= CACHED_TAPS
    for first, start, taps in _kept_blocks(up, down) if small else _tap_blocks(up, down):
        if rounds == 1 and first >= n_out:
            break
        span = padded[start + reach :]
        if down < taps.shape[1] < rounds:
            # Windows that overlap this much are no matrix to the library: add up shifted inputs.
            for phase, row in enumerate(taps, first):
                out[:, phase] = row[0] * span[: rounds * down : down]
                for k in range(1, len(row)):
                    out[:, phase] += row[k] * span[k : k + rounds * down : down]
        else:
            out[:, first : first + len(taps)] = sliding_window_view(span, taps.shape[1])[::down][:rounds] @ taps.T
    return out.reshape(-1)[:n_out]


def convolve(x: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Full convolution cut to the length of x; a long x is taken in blocks sized by the response, whose tails are added up."""
    n = len(x)
    if n == 0 or len(h) == 0:
        return np.zeros(n)
    h = h[:n]  # later taps only reach samples that are cut off
    whole = 1 << (n + len(h) - 2).bit_length() if n + len(h) > 2 else 1
    size = min(whole, max(CONVOLVE_BLOCK, 1 << (4 * len(h) - 1).bit_length()))
    if size == 1:
        return x * h[0]
    spectrum = np.fft.rfft(h, size)
    if size == whole:
        return np.fft.irfft(np.fft.rfft(x, size) * spectrum, size)[:n]
    out, step = np.zeros(n), size - len(h) + 1
    for at in range(0, n, step):
        part = np.fft.irfft(np.fft.rfft(x[at : at + step], size) * spectrum, size)[: n - at]
        out[at : at + len(part)] += part
    return out


@lru_cache(maxsize=64)
def _highpass(rate: int, cutoff: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block of the second-order high-pass: outputs by inputs and by the state before, state after it by the same two.

    The state is what the transposed form keeps, as its sum and its second part: the sum is small where the cut-off is low, so no digits
    cancel. All four come from running the recursion on unit vectors.
    """
    w = 2 * math.pi * cutoff / rate
    alpha, cos = math.sin(w) / (2 * HIGHPASS_Q), math.cos(w)
    a0 = 1 + alpha
    b, a2, slow = (1 + cos) / 2 / a0, (1 - alpha) / a0, 4 * math.sin(w / 2) ** 2 / a0
    total, second = np.eye(SCAN_BLOCK + 2)[SCAN_BLOCK :]
    outputs = np.empty((SCAN_BLOCK, SCAN_BLOCK + 2))
    for k, x in enumerate(np.eye(SCAN_BLOCK, SCAN_BLOCK + 2)):
        outputs[k] = y = b * x + total - second
        total, second = (1 - slow) * total + slow * (second - b * x), b * x - a2 * y
    after = np.stack([total, second])
    return tuple(np.ascontiguousarray(m.T) for m in (outputs[:, :SCAN_BLOCK], outputs[:, SCAN_BLOCK:], after[:, :SCAN_BLOCK], after[:, SCAN_BLOCK:]))


def low_cut(x: np.ndarray, rate: int, cutoff: float) -> np.ndarray:
    """Second-order high-pass, clamped to [-1, 1]; cutoffs are below half the rate.

    Blocks are filtered as if nothing came before them, all of a stretch in one product; the state is then carried from block to block, as
    a sample-by-sample loop would, in memory of one stretch beside the result.
    """
    if not 0 < cutoff < rate / 2:
        raise ValueError(f"a low cut of {cutoff:g} Hz needs a rate above {2 * cutoff:g} Hz, not {rate}")
    inputs, states, moved, kept = _highpass(int(rate), float(cutoff))
    x = np.asarray(x, dtype=np.float64)
    out = np.empty(len(x))
    total = second = 0.0
    (a, c), (d, e) = kept.T.tolist()
    for at in range(0, len(x), SCAN_STRETCH):
        part = x[at : at + SCAN_STRETCH]
        rows = -(-len(part) // SCAN_BLOCK)
        blocks = np.pad(part, (0, rows * SCAN_BLOCK - len(part))).reshape(rows, SCAN_BLOCK)
        before = []
        for own_total, own_second in (blocks @ moved).tolist():
            before.append((total, second))
            total, second = own_total + a * total + c * second, own_second + d * total + e * second
        out[at : at + SCAN_STRETCH] = (blocks @ inputs + np.array(before) @ states).reshape(-1)[: len(part)]
    return np.clip(out, -1.0, 1.0)


def peak_normalize(x: np.ndarray) -> np.ndarray:
    """(x / peak + 1e-7) * 0.9; silence gives NaN."""
    with np.errstate(invalid="ignore", divide="ignore"):
        return (np.asarray(x, dtype=np.float64) / np.max(np.abs(x), initial=0.0) + 1e-7) * 0.9


def clip_quantiles(x: np.ndarray, low: float, high: float) -> np.ndarray:
    return np.clip(x, *np.quantile(x, [low, high])) if len(x) else x


def drop_spans(x: np.ndarray, spans: list) -> np.ndarray:
    """x with half-open spans {s, e} set to zero."""
    out = np.array(x)
    for span in spans:
        out[span["s"] : span["e"]] = 0.0
    return out


def mix_at_snr(x: np.ndarray, noise: np.ndarray, snr_db: float) -> np.ndarray:
    """Tile the noise over x and add it at the signal-to-noise ratio."""
    tiled = np.resize(noise, len(x)).astype(np.float64)
    with np.errstate(invalid="ignore", divide="ignore"):
        gain = 10.0 ** ((10.0 * np.log10(np.dot(x, x) / np.dot(tiled, tiled)) - snr_db) / 20.0)
    return x + gain * tiled


def early_part(h: np.ndarray, rate: int, seconds: float = 0.05, ratio: float = 0.1) -> np.ndarray:
    """h up to its start plus int(seconds * rate) samples, zero after."""
    level = np.abs(h)
    start = int(np.argmax(level > ratio * level.max())) if len(h) else 0
    return np.where(np.arange(len(h)) < start + int(seconds * rate), h, 0.0)


def reverberate(x: np.ndarray, h: np.ndarray, rate: int, early: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """(direct-path, reverberant) copies, scaled together so the larger peak equals that of x."""
    dry, wet = convolve(x, early_part(h, rate, early)), convolve(x, h)
    top = max(np.max(np.abs(dry), initial=0.0), np.max(np.abs(wet), initial=0.0))
    with np.errstate(invalid="ignore", divide="ignore"):
        factor = np.max(np.abs(x), initial=0.0) / np.float64(top)
    return dry * factor, wet * factor


def best_lag_fit(reference: np.ndarray, x: np.ndarray) -> np.ndarray:
    """x at the reference's length: cut when longer, placed at the lag of least error when shorter."""
    n, m = len(reference), len(x)
    if m >= n:
        return x[:n]
    out = np.zeros(n)
    if m == 0:
        return out
    ref = np.asarray(reference, dtype=np.float64)
    size = 1 << (n + m).bit_length()
    cross = np.fft.irfft(np.fft.rfft(ref, size) * np.conj(np.fft.rfft(x, size)), size)[: n - m + 1]
    squares = np.concatenate([[0.0], np.cumsum(ref * ref)])
    error = squares[m:] - squares[:-m] - 2 * cross
    # The transform rounds, so lags close to the least error are compared exactly.
    near = np.flatnonzero(error <= error.min() + 1e-9 * max(1.0, squares[-1]))
    exact = [float(np.mean((ref[i : i + m] - x) ** 2)) for i in near]
    lag = int(near[int(np.argmin(exact))]) if exact else 0  # NaN has no least error
    out[lag : lag + m] = x
    return out


@lru_cache(maxsize=16)
def _mel_bank(rate: int, fft_size: int, n_mels: int) -> np.ndarray:
    """Triangular filters on the 1127 ln(1 + f / 700) scale, (bins, n_mels), Nyquist bin zero."""
    mel = lambda hz: 1127.0 * np.log(1.0 + hz / 700.0)
    edges = np.linspace(mel(MEL_LOW_HZ), mel(rate / 2), n_mels + 2)
    bins = mel(np.arange(fft_size // 2) * rate / fft_size)[:, None]
    rising = (bins - edges[:-2]) / (edges[1:-1] - edges[:-2])
    falling = (edges[2:] - bins) / (edges[2:] - edges[1:-1])
    bank = np.maximum(0.0, np.minimum(rising, falling))
    return np.vstack([bank, np.zeros((1, n_mels))])


def frames_of(x: np.ndarray, size: int, hop: int) -> np.ndarray:
    """Whole frames only: 1 + (n - size) // hop rows, none when x is shorter than a frame."""
    return sliding_window_view(x, size)[::hop] if len(x) >= size else np.empty((0, size))


@lru_cache(maxsize=16)
def _povey(size: int) -> np.ndarray:
    return (0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / (size - 1))) ** POVEY_POWER


def log_mel(x: np.ndarray, rate: int, n_mels: int, frame_ms: float, hop_ms: float) -> np.ndarray:
    """(frames, n_mels) log mel energies of DC-free, pre-emphasised, Povey-windowed frames."""
    size, hop = int(rate * 0.001 * frame_ms), int(rate * 0.001 * hop_ms)
    frames = frames_of(np.asarray(x, dtype=np.float64), size, hop)
    frames = frames - frames.mean(axis=1, keepdims=True)
    earlier = np.hstack([frames[:, :1], frames[:, :-1]])
    fft_size = 1 << (size - 1).bit_length()
    power = np.abs(np.fft.rfft((frames - PREEMPHASIS * earlier) * _povey(size), fft_size)) ** 2
    return np.log(np.maximum(power @ _mel_bank(int(rate), fft_size, n_mels), MEL_FLOOR))


def magnitudes(x: np.ndarray, size: int) -> np.ndarray:
    """(frames, bins) magnitudes of centred, reflect-padded Hann frames with hop size // 4."""
    padded = np.pad(np.asarray(x, dtype=np.float64), size // 2, mode="reflect")
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)
    return np.abs(np.fft.rfft(frames_of(padded, size, size // 4) * window, axis=1))


@lru_cache(maxsize=32)
def area_mel_bank(rate: int, size: int, n_mels: int) -> np.ndarray:
    """Area-normalised triangles on the linear-then-log mel scale (3 mel per 200 Hz below 1 kHz)."""
    log_step = math.log(6.4) / 27.0
    to_mel = lambda hz: hz * 3 / 200 if hz < 1000 else 15 + math.log(hz / 1000) / log_step
    mels = np.linspace(0.0, to_mel(rate / 2), n_mels + 2)
    hz = np.where(mels < 15, mels * 200 / 3, 1000 * np.exp(log_step * (mels - 15)))
    bins = (np.arange(size // 2 + 1) * rate / size)[:, None]
    rising = (bins - hz[:-2]) / (hz[1:-1] - hz[:-2])
    falling = (hz[2:] - bins) / (hz[2:] - hz[1:-1])
    return np.maximum(0.0, np.minimum(rising, falling)) * 2.0 / (hz[2:] - hz[:-2])

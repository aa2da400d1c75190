"""Resampling, high-pass and convolution of long waveforms against plain definitions."""

import math
import tracemalloc

import numpy as np
import pytest

from speechtable.functions import kernels


def dense_resample(x, source, target):
    """Every output sample as a sum over all inputs within reach."""
    g = math.gcd(source, target)
    down, up = source // g, target // g
    cutoff = min(up, down) * kernels.SINC_ROLLOFF
    out = np.zeros(-(-len(x) * up // down))
    for k in range(len(out)):
        t = np.clip((np.arange(len(x)) / down - k / up) * cutoff, -6, 6)
        out[k] = np.dot(x, np.sinc(t) * np.cos(np.pi * t / 12) ** 2 * (cutoff / down))
    return out


def loop_highpass(x, rate, cutoff, kind=float):
    w = kind(2 * np.longdouble("3.14159265358979323846264338327950288") * cutoff / rate)
    alpha, cos = np.sin(w) / (2 * kind(kernels.HIGHPASS_Q)), np.cos(w)
    a0, a1, a2 = 1 + alpha, -2 * cos, 1 - alpha
    b0, b1 = (1 + cos) / 2, -(1 + cos)
    y, x1, x2, y1, y2 = [], *[kind(0)] * 4
    for v in map(kind, x):
        now = (b0 * v + b1 * x1 + b0 * x2 - a1 * y1 - a2 * y2) / a0
        y.append(now)
        x1, x2, y1, y2 = v, x1, now, y1
    return np.clip(y, -1, 1)


@pytest.mark.parametrize("source,target", [(16, 24), (24, 16), (44100, 48000), (48000, 44100), (8000, 48000), (48000, 8000), (22050, 16000), (101, 97), (97, 101), (3, 1000), (1000, 3)])
@pytest.mark.parametrize("n", [1, 2, 7, 640])
def test_resampling_equals_the_sum(source, target, n):
    x = np.random.default_rng(n).standard_normal(n)
    if n * target // source > 20_000:
        return
    got = kernels.resample(x, source, target)
    assert len(got) == -(-n * target // source) and np.abs(got - dense_resample(x, source, target)).max() < 1e-12 * max(1, np.abs(got).max())


def test_prime_rates_in_bounded_memory(monkeypatch):
    x = np.random.default_rng(1).standard_normal(3000)
    tracemalloc.start()
    got = kernels.resample(x, 44101, 48000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6 and np.abs(got[:400] - dense_resample(x, 44101, 48000)[:400]).max() < 1e-12
    monkeypatch.setattr(kernels, "CACHED_TAPS", 0)
    assert np.array_equal(kernels.resample(x, 44101, 48000), got)


@pytest.mark.parametrize("cutoff", [0.001, 0.5, 50.0, 2000.0, 7900.0])
@pytest.mark.parametrize("n", [0, 1, 2, 127, 128, 129, 5000])
def test_high_pass_equals_the_loop(monkeypatch, cutoff, n):
    monkeypatch.setattr(kernels, "SCAN_STRETCH", 1024)
    x = np.random.default_rng(n).uniform(-1, 1, n) + 0.3
    got = kernels.low_cut(x, 16000, cutoff)
    assert len(got) == n and np.abs(got - loop_highpass(x, 16000, cutoff, np.longdouble)).max(initial=0) < 1e-11
    # A loop of doubles rounds its coefficients, which very low cut-offs notice.
    assert np.abs(got - loop_highpass(x, 16000, cutoff)).max(initial=0) < 1e-9


def test_an_hour_of_audio_is_cut_in_bounded_memory():
    rate, n = 16000, 16000 * 3600
    x = np.ones(n)
    tracemalloc.start()
    y = kernels.low_cut(x, rate, 20.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < x.nbytes * 2 + 20e6 and abs(y[0] - 0.99446) < 1e-3 and np.abs(y[-rate:]).max() < 1e-9
    assert np.abs(y[:3000] - loop_highpass(x[:3000], rate, 20.0)).max() < 1e-10


@pytest.mark.parametrize("n,m", [(1, 1), (5, 9), (100, 3), (70_000, 1), (70_000, 777), (200_000, 9000), (1000, 1000)])
def test_convolution_in_blocks_equals_the_sum(monkeypatch, n, m):
    monkeypatch.setattr(kernels, "CONVOLVE_BLOCK", 4096)
    rng = np.random.default_rng(n + m)
    x, h = rng.standard_normal(n), rng.standard_normal(m)
    got = kernels.convolve(x, h)
    assert len(got) == n
    for k in {0, n - 1, n // 2, *rng.integers(0, n, 40).tolist()}:
        low = max(0, k - m + 1)
        assert abs(got[k] - np.dot(x[low : k + 1], h[k - np.arange(low, k + 1)])) < 1e-9


def test_convolution_memory_follows_the_response():
    x, h = np.ones(20_000_000), np.ones(4000)
    tracemalloc.start()
    y = kernels.convolve(x, h)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < x.nbytes + 20e6 and abs(y[-1] - 4000) < 1e-6

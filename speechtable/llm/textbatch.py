"""Arrow text batches as flat byte arrays: the NumPy helpers the Arrow stages of this folder share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer document is a chunk of its own.
CHUNK_BYTES = 2 << 20
#: White space between words: space, tab, newline, vertical tab, form feed, carriage return.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection that spreads every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; the longest table up to a chunk's length stays in memory."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        made = _powers(n, base)
        if n > 2 * CHUNK_BYTES:
            return made
        _POWERS[base] = made
    return _POWERS[base][:n]


def _powers(n: int, base: int) -> np.ndarray:
    out = np.ones(max(n, 1), np.uint64)
    filled, step = 1, base
    while filled < n:
        take = min(filled, n - filled)
        out[filled : filled + take] = out[:take] * _U(step)
        filled, step = filled + take, step * step % (1 << 64)
    return out[:n]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    elif not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), ends


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of consecutive rows with about ``limit`` bytes together."""
    data, offsets = flat(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each row and in all) of the words of every row."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    white = WHITE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([True], white[:-1])) | edge[:n]
    after = np.concatenate((white[1:], [True])) | edge[1:]
    starts = np.flatnonzero(~white & before)
    ends = np.flatnonzero(~white & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span; spans do not overlap and are in order."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    inside = np.zeros(len(data) + 1, np.int64)
    inside[starts] += 1
    inside[ends] -= 1
    inside = np.cumsum(inside[:-1]).astype(bool)
    rel = np.flatnonzero(inside) - np.repeat(starts, sizes)
    value = _BYTE[data[inside]] * powers(int(sizes.max()))[rel]
    return mix(np.add.reduceat(value, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64))


def prefix_hash(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running polynomial sums of hashed values, and the inverse powers ``span_hash`` needs."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values)), out=total[1:])
    return total, powers(len(values) + 1, _INVERSE)


def span_hash(prefix: tuple[np.ndarray, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end], equal for equal content wherever it stands; spans may overlap."""
    total, inverse = prefix
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


def gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The spans data[start:start+size], one after another."""
    total = int(sizes.sum())
    if not total:
        return data[:0]
    ends = np.cumsum(sizes)
    return data[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)]


def binary_array(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A large_binary array over concatenated values."""
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def distinct(keys: np.ndarray, stable: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order that sorts the keys, starts of the runs of equal keys in that order, number of the run of each key in order)."""
    order = np.argsort(keys, kind="stable" if stable else None)
    ranked = keys[order]
    first = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(keys) else np.zeros(0, bool)
    return order, np.flatnonzero(first), np.cumsum(first) - 1

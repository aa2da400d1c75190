"""Batch restoration with a user model, and the user-function surface."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechtable.functions import kernels
from speechtable.functions.stages import STATUS, _column, _list_array, with_batches
from speechtable.operators.segment import MODEL_RATE, chunk_samples

_MODELS: dict[str, Callable] = {}
LONG_ROWS = ("cut", "quarantine", "split")


def cached_model(factory: Callable[..., Callable], config: dict) -> Callable:
    """One model per Python worker, rebuilt when its configuration changes."""
    name = f"{getattr(factory, '__module__', '')}.{getattr(factory, '__qualname__', '')}|{json.dumps(config, sort_keys=True)}"
    if name not in _MODELS:
        _MODELS.clear()
        _MODELS[name] = factory(**config)
    return _MODELS[name]


def model_features(batch: np.ndarray, rate: int = 16000, stride: int = 2) -> np.ndarray:
    """(rows, frames / stride, mels * stride) normalised mel features of equally long chunks."""
    rows = []
    for x in batch:
        m = kernels.log_mel(x, rate, 80, 25.0, 10.0)
        m = (m - m.mean(axis=0)) / np.sqrt(m.var(axis=0, ddof=1) + 1e-5)
        if len(m) % stride:  # chunks share a length, so this is the batch's round-up
            m = np.vstack([m, np.ones((stride - len(m) % stride, m.shape[1]))])
        rows.append(m.reshape(len(m) // stride, -1))
    return np.stack(rows).astype(np.float32)


def restore(
    df: DataFrame, model_factory: Callable[..., Callable], target_rate: int, batch_size: int = 16,
    chunk_seconds: float = 30.0, on_error: str = "fail", col: str = "samples", rate: str = "sample_rate",
    to: str = "restored", config: dict | None = None, features: bool = False, retry: bool = True,
    model_rate: int | None = None, cutoff: float | None = None, drop: Sequence[str] = (), long_rows: str = "cut",
) -> DataFrame:
    """Run ``model_factory(**config)`` over batches and fit each result to its source's duration.

    The model maps float32 (rows, chunk) — or the mel features of it — to one waveform per row.
    The chunk is ``chunk_seconds`` at ``model_rate`` (16 kHz where none is given). A longer row is, by
    ``long_rows``, cut to it and flagged ``truncated`` ("cut": its tail becomes zeros), given a status and no result
    ("quarantine"), or restored chunk by chunk and joined again ("split"). Under "quarantine" a failing batch
    is retried row by row (unless ``retry`` is off) and only failing rows get a status. With
    ``model_rate`` the waveform is resampled to it first, after an optional low cut, in the same
    stage; without, it must already have the model's rate.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError("on_error must be 'fail' or 'quarantine'")
    if batch_size < 1:
        raise ValueError("batch size must be >= 1")
    if long_rows not in LONG_ROWS:
        raise ValueError(f"long_rows must be one of {LONG_ROWS}")
    if long_rows == "quarantine" and on_error != "quarantine":
        raise ValueError("over-long rows can only be quarantined where failing rows are")
    settings, keep_going = dict(config or {}), on_error == "quarantine"
    chunk = chunk_samples(chunk_seconds, model_rate or MODEL_RATE)

    def padded(rows: list) -> np.ndarray:
        out = np.zeros((len(rows), chunk), dtype=np.float32)
        for line, x in zip(out, rows):
            part = x[:chunk]
            line[: len(part)] = part
        return out

    def infer(model: Callable, rows: list) -> list:
        batch = padded(rows)
        results = list(model(model_features(batch) if features else batch))
        if len(results) != len(rows):
            raise ValueError(f"model gave {len(results)} outputs for {len(rows)} rows")
        return [np.asarray(r, dtype=np.float32).reshape(-1) for r in results]

    def guarded(model: Callable, rows: list) -> list:
        try:
            return [(r, None) for r in infer(model, rows)]
        except Exception as error:
            if not keep_going:
                raise
            message = f"{type(error).__name__}: {error}"
            if not retry or len(rows) == 1:
                return [(None, message)] * len(rows)
            return [pair for x in rows for pair in guarded(model, [x])]

    def fitted(wave, n):
        if wave is None or n <= 0 or len(wave) == n:
            return wave
        return np.pad(wave, (0, n - len(wave))) if len(wave) < n else wave[:n]

    def prepared(x, source_rate):
        if x is None or source_rate is None:
            raise ValueError("no audio" if x is None else "no sample rate")
        if cutoff is not None:
            x = kernels.low_cut(x, source_rate, cutoff)
        return x if model_rate is None else kernels.resample(x, source_rate, model_rate)

    def run(batches: Iterator) -> Iterator:
        model = cached_model(model_factory, settings)
        for xs, rates in batches:
            n = len(xs)
            rows, waves, notes, cut = [None] * n, [None] * n, [None] * n, [False] * n
            for i, (x, r) in enumerate(zip(_column(xs), rates.to_pylist())):
                try:
                    row = prepared(x, r)
                    if len(row) > chunk and long_rows == "quarantine":
                        raise ValueError(f"{len(row)} samples do not fit a chunk of {chunk}")
                    rows[i], cut[i] = row, len(row) > chunk and long_rows == "cut"
                except Exception as error:
                    if not keep_going:
                        raise
                    notes[i] = f"{type(error).__name__}: {error}"
            # One piece a row, or its consecutive chunks.
            step = lambda row: chunk if long_rows == "split" else max(len(row), 1)
            pieces = [(i, at, row[at : at + step(row)]) for i, row in enumerate(rows) if row is not None
                      for at in range(0, max(len(row), 1), step(row))]
            made = [[] for _ in rows]
            for at in range(0, len(pieces), batch_size):
                picked = pieces[at : at + batch_size]
                for (i, begin, piece), (wave, note) in zip(picked, guarded(model, [p for _, _, p in picked])):
                    rate_in = model_rate or rates[i].as_py()
                    # Python rounds halves to even, as the expected length asks; a piece ends where the next begins.
                    place = lambda t: round(t / rate_in * target_rate)
                    made[i].append(fitted(wave, place(begin + len(piece)) - place(begin)))
                    notes[i] = notes[i] or note
            for i, parts in enumerate(made):
                if parts and notes[i] is None:
                    waves[i] = parts[0] if len(parts) == 1 else np.concatenate(parts)
            out = [_list_array(waves, pa.float32()), pa.array(cut, pa.bool_())]
            yield [*out, pa.array(notes, type=pa.string())] if keep_going else out

    ddl = f"`{to}` array<float>, truncated boolean" + (f", {STATUS} string" if keep_going else "")
    restored = with_batches(df, run, ddl, [col, rate], drop)
    return restored.withColumn(f"{to}_rate", F.lit(target_rate))


def apply(df: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A user step over the whole table, planned together with the rest."""
    return df.transform(fn)


def apply_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """A user generator over Arrow batches: any number of rows in, any number out."""
    return df.mapInArrow(fn, schema)

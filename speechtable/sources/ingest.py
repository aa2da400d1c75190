"""From shard members to waveform columns."""

from __future__ import annotations

import io
import struct
import wave as riff

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechtable.functions.stages import with_stage

# Suffixes that hold audio, and the first bytes of their containers.
AUDIO_SUFFIXES = ("flac", "mp3", "sox", "wav", "m4a", "ogg", "wma")
PCM_SUFFIX = "wav"


def suffix_of(name: Column) -> Column:
    """Text after the last dot, lower case."""
    return F.lower(F.regexp_extract(name, r"([^.]*)$", 1))


def is_audio(name: Column) -> Column:
    return suffix_of(name).isin(*AUDIO_SUFFIXES)


# Fixed value: what a writer that does not know the length leaves in a size field, or more.
OPEN_ENDED = 0xFFFFFFF0


def wave_shape(source, size: int) -> tuple[int, int, int, int, int]:
    """(samples, rate, channels, bytes per value, first byte of the samples) of a PCM WAV of ``size`` bytes, from its chunk headers.

    ``source`` can read and seek forward; chunk bodies are passed over wherever the samples start. The length is
    what the file holds: an open-ended size counts to its end, a file shorter than it says raises.
    """
    at = 12
    head = source.read(at)
    if len(head) < at or head[:4] != b"RIFF" or head[8:] != b"WAVE":
        raise EOFError("no RIFF header")
    form = None
    while True:
        chunk = source.read(8)
        if len(chunk) < 8:
            raise EOFError("no samples")
        name, length = chunk[:4], int.from_bytes(chunk[4:], "little")
        at += 8
        if name == b"data":
            break
        if name == b"fmt ":
            form = source.read(length)
        step = length + (length & 1) - (length if name == b"fmt " else 0)
        source.seek(step, 1)
        at += length + (length & 1)
    if form is None or len(form) < 16:
        raise EOFError("no format before the samples")
    channels, rate, width = int.from_bytes(form[2:4], "little"), int.from_bytes(form[4:8], "little"), -(-int.from_bytes(form[14:16], "little") // 8)
    # Plain PCM, or the extensible form whose subformat is PCM.
    kind = form[24:26] if form[:2] == b"\xfe\xff" else form[:2]
    if kind != b"\x01\x00" or not channels or not width:
        raise EOFError("not PCM")
    held = size - at
    if held < length < OPEN_ENDED:
        raise EOFError(f"{length} bytes of samples announced, {held} found")
    return min(held, length) // (channels * width), rate, channels, width, at


def pcm_channels(payload: bytes) -> tuple[np.ndarray, int]:
    """(channels, time) floats in [-1, 1] and the rate of a PCM WAV file."""
    frames, rate, n, width, at = wave_shape(io.BytesIO(payload), len(payload))
    raw = payload[at : at + frames * n * width]
    if width == 1:
        flat = (np.frombuffer(raw, dtype=np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        thirds = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 3).astype(np.int32)
        words = (thirds[:, 0] << 8) | (thirds[:, 1] << 16) | (thirds[:, 2] << 24)
        flat = (words / 2.0**31).astype(np.float32)
    else:
        flat = (np.frombuffer(raw, dtype=f"<i{width}") / 2.0 ** (8 * width - 1)).astype(np.float32)
    return flat.reshape(-1, n).T, rate


def pcm_bytes(samples: np.ndarray, rate: int) -> bytes:
    """Mono 16-bit PCM WAV file."""
    out = io.BytesIO()
    with riff.open(out, "wb") as sink:
        sink.setnchannels(1)
        sink.setsampwidth(2)
        sink.setframerate(int(rate))
        sink.writeframes(np.clip(np.rint(np.asarray(samples) * 32768), -32768, 32767).astype("<i2").tobytes())
    return out.getvalue()


def encode_waves(df: DataFrame, col: str = "samples", rate: str = "sample_rate", to: str = "wav") -> DataFrame:
    """16-bit PCM WAV bytes of a waveform column."""
    return with_stage(df, lambda x, r: (None if x is None else pcm_bytes(x, r),), f"`{to}` binary", [col, rate])


def decode_waves(df: DataFrame, bytes_col: str, name_col: str, drop_bytes: bool = True) -> DataFrame:
    """Add ``channels`` (channels, time), ``sample_rate`` and ``status``.

    Rows that are not audio, have no codec here, or do not decode keep null audio and say why.
    """

    def run(payload, name):
        suffix = name.rsplit(".", 1)[-1].lower()
        if suffix not in AUDIO_SUFFIXES:
            raise ValueError("not audio")
        if suffix != PCM_SUFFIX:
            raise ValueError(f"no codec for {suffix}")
        try:
            channels, rate = pcm_channels(payload)
        except EOFError as error:
            raise ValueError("broken wav") from error
        return channels, rate

    ddl = "channels array<array<float>>, sample_rate int"
    return with_stage(df, run, ddl, [bytes_col, name_col], "quarantine", drop=[bytes_col] if drop_bytes else [])


def wave_header(source, size: int) -> bytes:
    """A plain WAV header with the true length of a member; empty where the member is no whole PCM WAV."""
    try:
        n, rate, channels, width, _ = wave_shape(source, size)
    except (EOFError, OSError):
        return b""
    form = struct.pack("<HHIIHH", 1, channels, rate, rate * channels * width, channels * width, width * 8)
    body = min(n * channels * width, 0xFFFFFFFF)
    return b"RIFF" + struct.pack("<I", min(body + 36, 0xFFFFFFFF)) + b"WAVEfmt " + struct.pack("<I", 16) + form + b"data" + struct.pack("<I", body)


def probe_waves(df: DataFrame, bytes_col: str, name_col: str, headers: bool = False) -> DataFrame:
    """Add ``n_samples``, ``sample_rate`` and ``status`` from the chunk headers, wherever they lie.

    ``headers`` says that the column holds the headers the shard source made (``wave_header``), not whole files. Rows without a payload
    keep nulls and are no errors; a file shorter than it says is broken.
    """

    def run(head, name):
        if head is None:
            return None, None
        if name.rsplit(".", 1)[-1].lower() != PCM_SUFFIX:
            raise ValueError("not a wav")
        try:
            return wave_shape(io.BytesIO(head), int.from_bytes(head[40:44], "little") + 44 if headers and head else len(head))[:2]
        except EOFError as error:
            raise ValueError("broken wav") from error

    return with_stage(df, run, "n_samples bigint, sample_rate int", [bytes_col, name_col], "quarantine", drop=[bytes_col])


def members(df: DataFrame, cols: tuple[str, ...] = ("shard", "ordinal", "key")) -> DataFrame:
    """One row per shard member: (shard, ordinal, key, name, payload); broken shards give none."""
    rows = df.filter(F.col("error").isNull())
    return rows.select(*cols, F.explode("members").alias("name", "payload"))


def typed_members(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Columns from members by suffix: {'text.txt': 'string', 'sr.index': 'int', 'input_wav.pth': 'array<float>'}.

    Float arrays are raw little-endian float32, everything else is text cast to the type.
    """
    out = df
    arrays = [s for s, t in fields.items() if t.startswith("array")]
    for suffix, kind in fields.items():
        if suffix not in arrays:
            text = F.get(F.array(F.col("members")[suffix]), F.lit(0)).cast("string")
            out = out.withColumn(suffix, text.cast(kind))
    if arrays:
        unpack = lambda *blobs: tuple(None if b is None else np.frombuffer(b, dtype="<f4") for b in blobs)
        ddl = ", ".join(f"`{s}` array<float>" for s in arrays)
        out = with_stage(out, unpack, ddl, [F.col("members")[s] for s in arrays])
    return out


def filter_readable(df: DataFrame, bytes_col: str, name_col: str) -> DataFrame:
    """Keep rows whose payload starts like the container its suffix names.

    Only the first bytes are looked at, natively, before any decode stage.
    """
    head = lambda start, n: F.hex(F.substring(F.col(bytes_col), start, n))
    magic = {
        "wav": (head(1, 4) == "52494646") & (head(9, 4) == "57415645"),
        "flac": head(1, 4) == "664C6143",
        "ogg": head(1, 4) == "4F676753",
        "mp3": (head(1, 3) == "494433") | head(1, 2).isin("FFFB", "FFF3", "FFF2", "FFFA"),
        "m4a": head(5, 4) == "66747970",
        "wma": head(1, 4) == "3026B275",
        "sox": head(1, 4).isin("2E536F58", "586F532E"),
    }
    suffix = suffix_of(F.col(name_col))
    ok = F.lit(False)
    for name, test in magic.items():
        ok = ok | ((suffix == name) & test)
    return df.filter(F.coalesce(ok, F.lit(False)))

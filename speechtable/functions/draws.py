"""Random draws that depend only on (key, seed, stage, index).

A retried or re-partitioned task repeats them exactly, which ``rand()`` does not promise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SEED = 42
_UINT32 = 4294967296.0


def draw(key: Column, stage: str, index: int | Column = 0, seed: int = DEFAULT_SEED) -> Column:
    """Uniform double in [0, 1): the first 32 bits of md5('key|seed|stage|index')."""
    index = index if isinstance(index, Column) else F.lit(index)
    text = F.concat(
        F.coalesce(key.cast("string"), F.lit("")), F.lit(f"|{seed}|{stage}|"), index.cast("string")
    )
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(_UINT32)


def uniform(key: Column, stage: str, low, high, index: int | Column = 0, seed: int = DEFAULT_SEED) -> Column:
    """Uniform double in [low, high)."""
    low = low if isinstance(low, Column) else F.lit(float(low))
    high = high if isinstance(high, Column) else F.lit(float(high))
    return low + draw(key, stage, index, seed) * (high - low)


def below(key: Column, stage: str, n: int | Column, index: int | Column = 0, seed: int = DEFAULT_SEED) -> Column:
    """Uniform BIGINT in [0, n)."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.floor(draw(key, stage, index, seed) * n).cast("bigint")


def choice(key: Column, stage: str, values: Sequence, index: int | Column = 0, seed: int = DEFAULT_SEED) -> Column:
    """One of ``values``, each equally likely."""
    options = F.array(*[F.lit(v) for v in values])
    return F.get(options, below(key, stage, len(values), index, seed).cast("int"))


def gate(key: Column, stage: str, probability: float, seed: int = DEFAULT_SEED) -> Column:
    """True with the given probability."""
    return draw(key, f"{stage}.gate", 0, seed) < F.lit(float(probability))

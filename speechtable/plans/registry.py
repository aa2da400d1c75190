"""The registered queries and, where SQL can say the same, their DuckDB text."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechtable.plans.fixtures import SQL_VIEWS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, views: Sequence[str] = ()) -> Callable[[Query], Query]:
    """Register a query under its function name; ``views`` become CTEs before ``sql``."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            recursive = "RECURSIVE " if "/*recursive*/" in sql else ""
            ctes = ", ".join(f"{v} AS ({SQL_VIEWS[v]})" for v in views)
            body = sql.strip()
            if ctes and body.upper().startswith("WITH "):
                ctes, body = f"{ctes}, {body[5:]}", ""
            ORACLES[fn.__name__] = (f"WITH {recursive}{ctes} {body}" if ctes else body).strip()
        return fn

    return register


def samples_long(df: DataFrame, keys: Sequence[str], col: str, digits: int = 6) -> DataFrame:
    """One row per sample: the form in which both engines' waveforms are compared."""
    return df.select(*keys, F.posexplode(col).alias("pos", "value")).select(
        *keys, F.col("pos").cast("bigint").alias("pos"), F.round("value", digits).alias("value")
    )


def sql_long(source: str, keys: str = "key", col: str = "y", digits: int = 6) -> str:
    """The DuckDB twin of ``samples_long`` over a table or CTE."""
    return f"""SELECT {keys}, pos, round(value, {digits}) + 0.0 AS value FROM (
        SELECT {keys}, unnest(range(len({col}))) AS pos, unnest({col}) AS value FROM {source})"""


def sql_draw(key: str, stage: str, index: str = "0", seed: int = 42) -> str:
    """The DuckDB twin of ``draws.draw``."""
    return (
        f"(('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}|{stage}|' || CAST({index} AS VARCHAR)), 1, 8))"
        "::BIGINT / 4294967296.0::DOUBLE)"
    )


def digest(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Length, sum and position-weighted sum of a waveform: enough to tell samples and order."""
    add = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    x = F.col(col)
    return df.select(
        *keys,
        F.size(x).cast("bigint").alias("n"),
        F.round(add(x), 4).alias("total"),
        F.round(add(F.transform(x, lambda v, i: v * (i + 1))), 2).alias("weighted"),
    )


def sql_digest(source: str, keys: str = "key", col: str = "y") -> str:
    """The DuckDB twin of ``digest``."""
    return f"""SELECT {keys}, CAST(len({col}) AS BIGINT) AS n, round(coalesce(list_sum({col}), 0), 4) + 0.0 AS total,
        round(coalesce(list_sum(list_transform({col}, lambda v, i: v * i)), 0), 2) + 0.0 AS weighted FROM {source}"""


def sql_samples(source: str, col: str = "samples", keys: str = "key") -> str:
    """(keys, pos, value) rows of a waveform column in DuckDB."""
    return f"SELECT {keys}, unnest(range(len({col}))) AS pos, unnest({col}) AS value FROM {source}"


def sql_resample(source: str, rate: int, target: int, keys: str = "key") -> str:
    """Closed form of the windowed-sinc resampler over (keys, pos, value) rows, in DuckDB."""
    g = math.gcd(rate, target)
    down, up = rate // g, target // g
    if down == up:
        return f"SELECT {keys}, pos, value FROM {source}"
    cutoff = f"({min(down, up)} * 0.99::DOUBLE)"
    return f"""SELECT {keys}, pos, sum(value * {cutoff} / {down} * cos(pi() * t / 12) ** 2
            * CASE WHEN t = 0 THEN 1 ELSE sin(pi() * t) / (pi() * t) END) AS value
        FROM (SELECT i.{keys}, o.pos, i.value, (i.pos / {down}::DOUBLE - o.pos / {up}::DOUBLE) * {cutoff} AS t
              FROM {source} i JOIN (SELECT {keys}, unnest(range((n * {up} + {down - 1}) // {down})) AS pos
                    FROM (SELECT {keys}, count(*) AS n FROM {source} GROUP BY {keys})) o USING ({keys}))
        WHERE abs(t) < 6 GROUP BY {keys}, pos"""

"""Side-by-side run of registered queries in Spark and DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when both engines agree, else what differs."""
    relation = con.sql(sql)
    theirs = rows_of(relation.columns, relation.fetchall())
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} != {len(theirs[1])}"
    if not ours[1]:
        return "no rows on either side"
    bad = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None

"""Greedy merging of consecutive utterances to a target length, without a serial pass per shard.

A group starts where the last one ended and closes at the first row that brings it to the target.
That reset looks sequential, but a group starting at offset s closes at the first row whose end
reaches s + target. So each block of ordinals can be turned into a small table "incoming closing
point -> outgoing closing point" on its own; walking those tables once per shard gives every block
its incoming point, and the blocks then label their rows independently. Only lengths take part;
audio joins the labels afterwards.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechtable.operators.ordering import BLOCK

# 705,600,000 ticks per second divide evenly by all usual audio rates, so totals are exact.
TICKS = 705_600_000


def ticks(n_samples: Column, rate: Column) -> Column:
    """Duration in whole ticks, rounded only for rates that do not divide a second's ticks."""
    n, per_second = n_samples.cast("bigint"), F.lit(TICKS)
    exact = n * F.floor(per_second / rate)
    rounded = F.round(n * (per_second / rate)).cast("bigint")
    return F.coalesce(F.when(F.pmod(per_second, rate) == 0, exact).otherwise(rounded), F.lit(0)).cast("bigint")


def target_ticks(seconds: float) -> int:
    return math.ceil(round(seconds * TICKS, 6))


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[pa.Array]]:
    """Columns of each run of rows with equal first ``keys`` columns, in sorted input.

    A run may span batches; at most one run (a block, or a shard's walk table) is held.
    """
    held: list[list[pa.Array]] = []
    last = None
    joined = lambda: [pa.concat_arrays(parts) if len(parts) > 1 else parts[0] for parts in zip(*held)]
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        changed = np.zeros(n, dtype=bool)
        for column in batch.columns[:keys]:
            differs = pc.not_equal(column.slice(1), column.slice(0, n - 1))
            changed[1:] |= differs.to_numpy(zero_copy_only=False)
        first = [c[0] for c in batch.columns[:keys]]
        changed[0] = last is not None and first != last
        last = [c[n - 1] for c in batch.columns[:keys]]
        edges = [0, *np.flatnonzero(changed).tolist(), n]
        for at, (low, high) in enumerate(zip(edges, edges[1:])):
            if at and held:
                yield joined()
                held = []
            if high > low:
                held.append([c.slice(low, high - low) for c in batch.columns])
    if held:
        yield joined()


def _per_run(keys: int, fn: Callable, names: Sequence[str], numbers: int) -> Callable:
    """mapInArrow function: ``fn`` per run, with the shard as an Arrow array and numbers as NumPy.

    ``fn`` takes the shard and the next ``numbers`` columns and gives output columns in either form,
    joined to larger batches; columns after those stand beside its rows when ``names`` has them.
    """

    def whole(parts: Sequence) -> pa.Array:
        return pa.concat_arrays(parts) if isinstance(parts[0], pa.Array) else pa.array(np.concatenate(parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, rows = [], 0
        flush = lambda: pa.RecordBatch.from_arrays([whole(c) for c in zip(*ready)], names=names)
        for shard, *others in _runs(batches, keys):
            out = [*fn(shard, *(c.to_numpy() for c in others[:numbers])), *others[numbers:]][: len(names)]
            ready.append(out)
            rows += len(out[0])
            if rows >= BLOCK:
                yield flush()
                ready, rows = [], 0
        if ready:
            yield flush()

    return run


def _reach(target: int) -> Callable:
    """Per block: closing points that may come in, and what each turns into at the block's end.

    Points count from the block's start on the way in and from its end on the way out.
    """

    def run(shard, block, order, length):
        end = np.cumsum(length)
        start, total, n = end - length, end[-1], len(end)
        closes = np.searchsorted(end, start + target, side="left")
        # Follow group after group to the one open at the block's end, doubling the step each time;
        # n stands for a group that begins with the next block.
        last_group = np.append(np.where(closes < n, closes + 1, np.arange(n)), n)
        while True:
            further = last_group[last_group]
            if np.array_equal(further, last_group):
                break
            last_group = further
        leaves = np.append(start, total)[last_group] + target - total
        last = min(int(closes[0]), n - 1)
        upto, first = np.unique(end[: last + 1], return_index=True)
        m = len(upto)
        return pa.repeat(shard[0], m), np.full(m, block[0]), upto, leaves[first + 1], np.full(m, total)

    return run


def _walk(target: int) -> Callable:
    """Per shard: each block's incoming closing point and offset (a few rows per 65,536 ordinals)."""

    def run(shard, block, upto, leaves, total):
        edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        point, offset, points, offsets = target, 0, [], []
        for low, high in zip(edges, edges[1:]):
            points.append(point)
            offsets.append(offset)
            at = low + int(np.searchsorted(upto[low:high], point, side="left"))
            point = int(leaves[at]) if at < high else point - int(total[low])
            offset += int(total[low])
        return pa.repeat(shard[0], len(points)), block[edges[:-1]], np.asarray(points), np.asarray(offsets)

    return run


def _label(target: int) -> Callable:
    """Per block: the start offset of the group each row belongs to."""

    def run(shard, block, order, length, entry, offset):
        end = np.cumsum(length)
        start = end - length
        closes = np.searchsorted(end, start + target, side="left").tolist()
        starts, at = [], int(np.searchsorted(end, entry[0], side="left")) + 1
        while at < len(start):
            starts.append(at)
            at = closes[at] + 1
        sizes = np.diff([0, *starts, len(start)])
        return order, np.repeat(np.append(entry[0] - target, start[starts]), sizes) + offset[0]

    return run


def merge_groups(
    df: DataFrame, seconds: float, by: Sequence[str], order: str = "ordinal", n_samples: str = "n_samples",
    rate: str = "sample_rate", width: int = BLOCK,
) -> DataFrame:
    """(by..., order, group_start): the merge group of each row, named by its start in ticks.

    ``order`` must be unique within ``by``. Reads lengths and rates only.
    """
    target = target_ticks(seconds)
    if target < 1:
        raise ValueError("seconds must be positive")
    # One JSON string stands for the group, whatever the types of ``by``; nulls make a group too.
    shard = F.to_json(F.struct(*by), {"ignoreNullFields": "false"}) if by else F.lit("{}")
    carried = [F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]
    ordinal = F.col(order).cast("bigint")
    rows = df.select(
        shard.alias("_shard"), F.floor(ordinal / width).cast("bigint").alias("_block"), ordinal.alias("_order"),
        ticks(F.col(n_samples), F.col(rate)).alias("_ticks"), *carried,
    )
    # Both passes read the same exchange: it is planned once and reused.
    blocks = rows.repartition("_shard", "_block")
    in_order = lambda df: df.sortWithinPartitions("_shard", "_block", "_order")
    reach = in_order(blocks).mapInArrow(
        _per_run(2, _reach(target), ["_shard", "_block", "_upto", "_leaves", "_total"], 3),
        "_shard string, _block bigint, _upto bigint, _leaves bigint, _total bigint",
    )
    entry = reach.repartition("_shard").sortWithinPartitions("_shard", "_block", "_upto").mapInArrow(
        _per_run(1, _walk(target), ["_shard", "_block", "_point", "_offset"], 4),
        "_shard string, _block bigint, _point bigint, _offset bigint",
    )
    # Every block has its entry; an inner join would filter nulls below the exchange and part the two.
    entered = blocks.join(entry, ["_shard", "_block"], "left")
    columns = ["_shard", "_block", "_order", "_ticks", "_point", "_offset", *[f"_by{i}" for i in range(len(by))]]
    out = T.StructType([
        T.StructField("_order", T.LongType()), T.StructField("group_start", T.LongType()),
        *[T.StructField(f"_by{i}", df.schema[c].dataType) for i, c in enumerate(by)],
    ])
    labels = in_order(entered.select(*columns)).mapInArrow(_per_run(2, _label(target), out.names, 5), out)
    return labels.select(*[F.col(f"_by{i}").alias(c) for i, c in enumerate(by)], F.col("_order").alias(order), "group_start")


def _beside(df: DataFrame, labels: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Rows with their label; null groups are groups too."""
    names = {c: f"_label_{i}" for i, c in enumerate([*by, order])}
    renamed = labels.withColumnsRenamed(names)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    return df.join(renamed, same).drop(*names.values())


def merge_to_length(
    df: DataFrame, seconds: float, cols: Sequence[str], by: Sequence[str], order: str = "ordinal", key: str = "key",
    rates: dict[str, str] | None = None, n_samples: str | None = None, width: int = BLOCK,
) -> DataFrame:
    """Merged rows: key of the first member, waveforms concatenated and cut to int(seconds * rate).

    ``rates`` names the rate column per waveform ('sample_rate' by default); the first waveform
    decides the grouping. A tail short of the target is dropped. The input is scanned several
    times, mostly for its lengths: give a written table, and name its length column ``n_samples`` so
    that those scans leave the audio alone.
    """
    rates = {c: (rates or {}).get(c, "sample_rate") for c in cols}
    lead = cols[0]
    length = F.col(n_samples) if n_samples else F.size(lead)
    lengths = df.select(*by, order, length.alias("n_samples"), F.col(rates[lead]).alias("_rate"))
    labels = merge_groups(lengths, seconds, by, order, "n_samples", "_rate", width)
    rate_cols = sorted(set(rates.values()))
    # Empty waveforms add nothing to the concatenation and must not fill a group's list.
    member = F.when(F.size(lead) > 0, F.struct(F.col(order), *cols))
    merged = (
        _beside(df, labels, by, order)
        .groupBy(*by, "group_start")
        .agg(
            F.min_by(F.struct(F.col(key), *rate_cols), F.col(order)).alias("_first"),
            F.array_sort(F.collect_list(member)).alias("_members"),
            F.sum(ticks(F.size(lead), F.col(rates[lead]))).alias("_ticks"),
        )
        .filter(F.col("_ticks") >= target_ticks(seconds))
    )
    cut = lambda c: F.slice(
        F.flatten(F.col(f"_members.{c}")), F.lit(1), F.floor(F.lit(float(seconds)) * F.col("_first")[rates[c]]).cast("int")
    )
    return merged.select(
        *by, "group_start", F.col("_first")[key].alias(key), *[cut(c).alias(c) for c in cols],
        *[F.col("_first")[r].alias(r) for r in rate_cols], F.size("_members").alias("n_members"),
    )

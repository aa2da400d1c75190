"""Ordered numbering and running sums that never put one whole group into one task.

A plain ``row_number() over (partition by shard order by ordinal)`` sends a shard with a third
of all rows to a single task. Here the order is cut into blocks of ``width`` ordinals: rows are
numbered inside (group, block), block totals are summed once more per group, and the two join
on (group, block), the partitioning the window already has. The upper level holds one row per
block: 10^10 rows of one group are 152,588 of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from speechtable import settings

BLOCK = 1 << 16
#: Ordinals of one row that ``assign_shards`` looks up: every row goes through the shard starts of its block.
LOOKUP = 1 << 12
_BLOCK, _GROUP = "_block", "_group"


def _with_block(df: DataFrame, by: Sequence[str], ordinal: Column, width: int) -> DataFrame:
    # A struct never is null as a whole, so rows with a null group column keep matching.
    group = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))
    return df.withColumn(_GROUP, group).withColumn(_BLOCK, F.floor(ordinal / F.lit(width)).cast("bigint"))


def running(
    df: DataFrame,
    by: Sequence[str] = (),
    order: str = "ordinal",
    sums: Mapping[str, Column] | None = None,
    index: str = "row_index",
    group_size: str | None = None,
    ties: Sequence[str] = (),
    width: int = BLOCK,
) -> DataFrame:
    """Add a zero-based ``index`` and exclusive running ``sums`` per group in ``order``.

    ``order`` is an integer column; equal values are ordered by ``ties``. ``group_size`` names
    an extra column with the group's row count.
    """
    sums = dict(sums or {})
    blocks = _with_block(df, by, F.col(order), width)
    inside = W.partitionBy(_GROUP, _BLOCK).orderBy(order, *ties)
    before = inside.rowsBetween(W.unboundedPreceding, -1)
    local = blocks.withColumn(index, (F.row_number().over(inside) - 1).cast("bigint"))
    for name, value in sums.items():
        local = local.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0)))

    totals = blocks.groupBy(_GROUP, _BLOCK).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(v).alias(f"_total_{n}") for n, v in sums.items()]
    )
    upper = W.partitionBy(_GROUP).orderBy(_BLOCK).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        _GROUP,
        _BLOCK,
        F.coalesce(F.sum("_rows").over(upper), F.lit(0)).alias("_skip"),
        *[F.coalesce(F.sum(f"_total_{n}").over(upper), F.lit(0)).alias(f"_skip_{n}") for n in sums],
        *([F.sum("_rows").over(W.partitionBy(_GROUP)).alias(group_size)] if group_size else []),
    )
    out = local.join(offsets, [_GROUP, _BLOCK]).withColumn(index, F.col(index) + F.col("_skip"))
    for name in sums:
        out = out.withColumn(name, F.col(name) + F.col(f"_skip_{name}"))
    return out.drop(_GROUP, _BLOCK, "_skip", *[f"_skip_{n}" for n in sums])


def dense_ordinal(df: DataFrame, order: Sequence[str], name: str = "ordinal", unique: bool = False) -> DataFrame:
    """Number all rows 0..n-1 in any sort order, for sources that carry no ordinal.

    The sorted rows are checkpointed to the shared folder first: positions inside partitions are
    only meaningful if a retry sees the same partitions. When the order columns are ``unique``
    (and not null) only they are sorted and checkpointed, and the rest of the row joins its number.
    """
    settings.ensure_checkpoints(df.sparkSession)
    fixed = (df.select(*order) if unique else df).orderBy(*order).checkpoint(eager=True)
    # The id is (partition << 33) + position.
    placed = fixed.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    upper = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # One row per partition of the sort.
    skips = counts.select("_part", F.coalesce(F.sum("_rows").over(upper), F.lit(0)).alias("_skip"))
    position = F.col("_at") - F.shiftleft(F.col("_part"), 33)
    out = placed.join(skips, "_part").withColumn(name, (F.col("_skip") + position).cast("bigint"))
    out = out.drop("_at", "_part", "_skip")
    return df.join(out, list(order)) if unique else out


def numbered(df: DataFrame, by: Sequence[str], order: str, ties: Sequence[str] = (), **options) -> DataFrame:
    """Rows beside the columns ``running`` adds: only (by, order, ties) are numbered, wide rows meet their number by these.

    (by, order, ties) is unique; null groups are groups. Whole rows are dealt out by that key, one by one, never a block of them to a task.
    """
    sums = options.get("sums") or {}
    keys = [*by, order, *ties]
    narrow = df.select(*keys, *[v.alias(f"_in_{n}") for n, v in sums.items()])
    options = {**options, "sums": {n: F.col(f"_in_{n}") for n in sums}}
    counted = running(narrow, by, order, ties=ties, **options).drop(*[f"_in_{n}" for n in sums])
    names = {c: f"_of_{i}" for i, c in enumerate(keys)}
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    return df.join(counted.withColumnsRenamed(names), same).drop(*names.values())


def assign_batches(df: DataFrame, size: int, by: Sequence[str] = (), order: str = "ordinal", drop_last: bool = False) -> DataFrame:
    """Consecutive groups of ``size`` rows: ``batch_id`` per group and ``slot`` in the batch; ``order`` is unique in a group."""
    if size < 1:
        raise ValueError("batch size must be >= 1")
    placed = numbered(df, by, order, index="_index", group_size="_group_rows" if drop_last else None)
    out = placed.withColumn("batch_id", F.floor(F.col("_index") / size).cast("bigint")).withColumn(
        "slot", F.pmod("_index", F.lit(size)).cast("int")
    )
    if drop_last:
        out = out.filter(F.col("batch_id") < F.floor(F.col("_group_rows") / size)).drop("_group_rows")
    return out.drop("_index")


def assign_shards(df: DataFrame, max_count: int | Column, order: str = "ordinal", name: str = "shard_id", width: int = BLOCK) -> DataFrame:
    """Output shard number of each row, ``max_count`` consecutive rows per shard, without moving the rows.

    Only ordinals are numbered. Each block of ordinals then becomes one small row (its first number
    and the ordinals at which shards start), and rows look up their block: one row per 4,096
    ordinals and one value per shard, which the adaptive planner broadcasts while it is small.
    """
    if isinstance(max_count, int) and max_count < 1:
        raise ValueError("max_count must be >= 1")
    block = F.floor(F.col(order) / F.lit(min(width, LOOKUP))).cast("bigint")
    narrow = running(df.select(order), order=order, index="_index", width=width).withColumn(_BLOCK, block)
    begins = F.when(F.pmod("_index", F.lit(max_count)) == 0, F.col(order))
    blocks = narrow.groupBy(_BLOCK).agg(F.min("_index").alias("_first"), F.collect_list(begins).alias("_starts"))
    before = F.ceil(F.col("_first") / F.lit(max_count))
    inside = F.size(F.filter("_starts", lambda s: s <= F.col(order)))
    found = df.withColumn(_BLOCK, block).join(blocks, _BLOCK)
    return found.withColumn(name, (before + inside - 1).cast("bigint")).drop(_BLOCK, "_first", "_starts")


def assign_by_bytes(df: DataFrame, size_col: str, cap: int, by: Sequence[str] = (), order: str = "ordinal") -> DataFrame:
    """Output file number per row so that a file starts once the bytes before it reach the cap; ``order`` is unique in a group."""
    if cap < 1:
        raise ValueError("cap must be >= 1")
    summed = numbered(df, by, order, sums={"bytes_before": F.col(size_col).cast("bigint")}, index="_index")
    return summed.withColumn("file_id", F.floor(F.col("bytes_before") / cap).cast("bigint")).drop("_index")

"""Selecting, slicing, repeating, shuffling and uniting corpora."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechtable.functions import draws
from speechtable.operators.ordering import assign_shards, dense_ordinal, numbered, running


def _row_count(df: DataFrame) -> Column:
    """The number of rows as a scalar subquery: one value, no join."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def select_block(df: DataFrame, n: int, i: int, ordinal: str = "ordinal") -> DataFrame:
    """Worker i of n takes the i-th run of ceil(total / n) rows in order; late workers may get none.

    Ordinals are unique but may have gaps: rows are counted on a table of ordinals, and the block is a range of them.
    """
    if n < 1:
        raise ValueError("number of blocks must be >= 1")
    if n == 1:
        return df
    if not 0 <= i < n:
        raise ValueError("block index must be within [0, n)")
    counted = running(df.select(ordinal), order=ordinal, index="_index", group_size="_rows")
    inside = F.floor(F.col("_index") / F.ceil(F.col("_rows") / n)) == i
    bounds = counted.filter(inside).agg(F.min(ordinal).alias("low"), F.max(ordinal).alias("high"))
    return df.filter(F.col(ordinal).between(bounds.select("low").scalar(), bounds.select("high").scalar()))


def select_stride(df: DataFrame, n: int, i: int, ordinal: str = "ordinal") -> DataFrame:
    """Rows whose ordinal leaves remainder i; pushed down to the scan as a plain filter."""
    if n < 1 or not 0 <= i < n:
        raise ValueError("need n >= 1 and index within [0, n)")
    return df.filter(F.pmod(F.col(ordinal), F.lit(n)) == i)


def head_rows(df: DataFrame, n: int, ordinal: str = "ordinal") -> DataFrame:
    """The first n rows in source order (planned as a top-k, no full sort); of a stream, the first n to arrive."""
    if df.isStreaming:
        return df.limit(n)
    return df.orderBy(ordinal).limit(n)


def slice_chunks(df: DataFrame, parallelism: int | None, ordinal: str = "ordinal") -> DataFrame:
    """Label runs of max(total // parallelism, 1) rows in order; without parallelism all rows are one run.

    Ordinals are unique but may have gaps.
    """
    if not parallelism or parallelism < 1:
        return df.withColumn("chunk_id", F.lit(0).cast("bigint"))
    chunk = F.greatest(F.floor(_row_count(df) / F.lit(parallelism)), F.lit(1))
    return assign_shards(df, chunk, ordinal, "chunk_id")


def by_shard(df: DataFrame, n: int, shard: str = "shard", ordinal: str = "ordinal", span: int = 4096) -> DataFrame:
    """Deal shards out to n tasks; a shard longer than ``span`` ordinals is dealt out in pieces."""
    piece = F.floor(F.col(ordinal) / span)
    return df.repartition(n, F.col(shard), piece)


def repeat_rows(df: DataFrame, n: int) -> DataFrame:
    """Every row n times with its ``epoch``; rows stay where they are, no join and no shuffle."""
    if n < 1:
        raise ValueError("number of repeats must be >= 1")
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def shuffle_rows(df: DataFrame, key: str = "key", seed: int = draws.DEFAULT_SEED, globally: bool = False) -> DataFrame:
    """Order rows by a hashed draw.

    By default the draw picks the partition and sorts inside it (one exchange, no range sampling);
    ``globally`` gives one total order.
    """
    drawn = df.withColumn("shuffle_draw", draws.draw(F.col(key), "shuffle", 0, seed))
    if globally:
        return drawn.orderBy("shuffle_draw", key)
    return drawn.repartition(F.col("shuffle_draw")).sortWithinPartitions("shuffle_draw", key)


def shuffle_positions(df: DataFrame, key: str = "key", seed: int = draws.DEFAULT_SEED) -> DataFrame:
    """Position of each row in the global shuffle, numbered block-wise over the 32-bit draw."""
    drawn = df.withColumn("_draw", (draws.draw(F.col(key), "shuffle", 0, seed) * F.lit(4294967296)).cast("bigint"))
    return numbered(drawn, (), "_draw", [key], index="position").drop("_draw")


def drawn_shards(catalog: DataFrame, seed: int = draws.DEFAULT_SEED) -> DataFrame:
    """A shard catalogue (ordinal, path) in the order of a hashed draw of its paths: only paths are sorted."""
    drawn = catalog.select("path", draws.draw(F.col("path"), "shards", 0, seed).alias("_draw"))
    return dense_ordinal(drawn, ["_draw", "path"], unique=True).select("ordinal", "path")


def shuffle_buffered(df: DataFrame, size: int, key: str = "key", seed: int = draws.DEFAULT_SEED) -> DataFrame:
    """Shuffle each partition through a buffer of ``size`` rows; nothing crosses an exchange.

    Once the buffer is full, each further row takes the place its own draw names, and the row that was there leaves; at the end the rest leaves
    in the order of its draws. The same rows in the same partition leave in the same order, whoever runs the task. With shards in drawn order
    (``drawn_shards``, then ``tarshards.read_listed``) audio is read once and moves nowhere.
    """
    if size < 1:
        raise ValueError("buffer size must be >= 1")
    # Plain names on the way, since a stage of batches cannot take names with dots.
    columns = [f"c{i}" for i in range(len(df.columns))]
    drawn = df.toDF(*columns).withColumn("_draw", draws.draw(F.col(columns[df.columns.index(key)]), "buffer", 0, seed))
    schema = T.StructType([T.StructField(c, f.dataType) for c, f in zip(columns, df.schema)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            kept = held.num_rows if held is not None else 0
            rows = rows if held is None else pa.concat_tables([held, rows])
            places = np.minimum((rows["_draw"].to_numpy() * size).astype(np.int64), size - 1).tolist()
            slots, out = list(range(kept)), []
            for i in range(kept, rows.num_rows):
                if len(slots) < size:
                    slots.append(i)
                else:
                    out.append(slots[places[i]])
                    slots[places[i]] = i
            if out:
                yield from rows.take(pa.array(out)).select(columns).to_batches()
            held = rows.take(pa.array(slots, pa.int64()))
        if held is not None and held.num_rows:
            order = np.argsort(held["_draw"].to_numpy(), kind="stable")
            yield from held.take(pa.array(order)).select(columns).to_batches()

    return drawn.mapInArrow(run, schema).toDF(*df.columns)


def pending_units(
    units: DataFrame, splits: Sequence[str], completed: DataFrame, heavy: Sequence[str] = (), unit: str = "language"
) -> DataFrame:
    """(unit, split) pairs without a completion marker; units on the heavy list are flagged."""
    grid = units.select(unit).distinct().withColumn("split", F.explode(F.array(*[F.lit(s) for s in splits])))
    open_work = grid.join(completed.select(unit, "split"), [unit, "split"], "left_anti")
    return open_work.withColumn("heavy", F.col(unit).isin(*heavy) if heavy else F.lit(False))


def skip_completed(df: DataFrame, completed: DataFrame, keys: Sequence[str], force: bool = False) -> DataFrame:
    """Leave out work that already has a marker, unless forced."""
    return df if force else df.join(completed.select(*keys), list(keys), "left_anti")


def union_corpora(corpora: dict[str, DataFrame]) -> DataFrame:
    """One table from several corpora, missing columns null, ``corpus`` naming the origin."""
    named = [df.withColumn("corpus", F.lit(name)) for name, df in corpora.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def distinct_first(df: DataFrame, cols: Sequence[str], ordinal: str = "ordinal") -> DataFrame:
    """First occurrence of each key in source order; ``ordinal`` is unique.

    Keys are reduced on narrow rows, repeats before the exchange, and whole rows only meet the
    surviving ordinals (broadcast while those are few).
    """
    firsts = df.groupBy(*cols).agg(F.min(ordinal).alias("_first")).select("_first")
    return df.join(firsts, F.col(ordinal) == F.col("_first"), "left_semi")

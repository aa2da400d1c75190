import random

import pytest
from pyspark.sql import functions as F

from speechtable.operators import ordering, selection


def rows(spark, n=500, seed=1):
    rng = random.Random(seed)
    # A third of the rows and more sit in one shard; ordinals are sparse and one shard is null.
    data = [(o, rng.choice(["hot", "hot", "a", "b", None]), rng.randrange(0, 90)) for o in rng.sample(range(5000), n)]
    return data, spark.createDataFrame(data, "ordinal bigint, shard string, n bigint")


@pytest.mark.parametrize("width", [1, 7, 64, 1 << 16])
@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_running_matches_a_plain_pass(spark, width, partitions):
    data, df = rows(spark)
    got = ordering.running(
        df.repartition(partitions), ["shard"], sums={"before": F.col("n")}, group_size="size", width=width
    ).collect()
    seen, expected = {}, {}
    for o, s, n in sorted(data):
        at, total = seen.get(s, (0, 0))
        expected[o] = (at, total)
        seen[s] = (at + 1, total + n)
    assert {r.ordinal: (r.row_index, r.before) for r in got} == expected
    assert all(r["size"] == seen[r.shard][0] for r in got)


def test_running_without_groups_and_with_ties(spark):
    df = spark.createDataFrame([(5, "b"), (5, "a"), (1, "z")], "ordinal int, name string")
    got = {r.name: r.row_index for r in ordering.running(df, ties=["name"], width=2).collect()}
    assert got == {"z": 0, "a": 1, "b": 2}


def test_empty_table_keeps_schema(spark):
    df = spark.createDataFrame([], "ordinal bigint, shard string, n bigint")
    out = ordering.assign_batches(df, 4, ["shard"], drop_last=True)
    assert out.columns == ["ordinal", "shard", "n", "batch_id", "slot"] and out.count() == 0


@pytest.mark.parametrize("unique", [False, True])
def test_dense_ordinal(spark, unique):
    df = spark.createDataFrame([(f"k{i:03d}", i) for i in range(200)], "key string, i int").repartition(7)
    got = ordering.dense_ordinal(df, ["key"], unique=unique).collect()
    assert sorted((r.ordinal, r.i) for r in got) == [(i, i) for i in range(200)]


def test_batches(spark):
    df = spark.range(10).withColumnRenamed("id", "ordinal")
    got = {r.ordinal: (r.batch_id, r.slot) for r in ordering.assign_batches(df, 4).collect()}
    assert got == {i: (i // 4, i % 4) for i in range(10)}
    assert {r.ordinal for r in ordering.assign_batches(df, 4, drop_last=True).collect()} == set(range(8))
    assert ordering.assign_batches(df, 5, drop_last=True).count() == 10
    with pytest.raises(ValueError):
        ordering.assign_batches(df, 0)


def test_blocks_cover_and_late_ones_are_empty(spark):
    df = spark.range(10).withColumnRenamed("id", "ordinal")
    blocks = [sorted(r.ordinal for r in selection.select_block(df, 4, i).collect()) for i in range(4)]
    assert blocks == [[0, 1, 2], [3, 4, 5], [6, 7, 8], [9]]
    nine = df.filter("ordinal < 9")
    assert selection.select_block(nine, 6, 5).count() == 0
    for n, i in ((0, 0), (3, 3), (3, -1)):
        with pytest.raises(ValueError):
            selection.select_block(df, n, i)


def test_slices_and_limits(spark):
    df = spark.range(10).withColumnRenamed("id", "ordinal")
    chunks = {r.ordinal: r.chunk_id for r in selection.slice_chunks(df, 4).collect()}
    assert chunks == {i: i // 2 for i in range(10)}
    assert {r.chunk_id for r in selection.slice_chunks(df, 100).collect()} == set(range(10))
    assert {r.chunk_id for r in selection.slice_chunks(df, None).collect()} == {0}
    assert [r.ordinal for r in selection.head_rows(df.orderBy(F.desc("ordinal")), 3).collect()] == [0, 1, 2]
    assert selection.head_rows(df, 99).count() == 10


def test_shuffle_is_the_same_whatever_the_partitions(spark):
    df = spark.range(300).withColumn("key", F.col("id").cast("string"))
    orders = [[r.key for r in selection.shuffle_rows(df.repartition(p), globally=True).collect()] for p in (1, 3, 17)]
    assert orders[0] == orders[1] == orders[2] != sorted(orders[0])
    place = {r.key: r.position for r in selection.shuffle_positions(df).collect()}
    assert [place[k] for k in orders[0]] == list(range(300))
    assert selection.shuffle_rows(df).count() == 300


def test_first_occurrence(spark):
    df = spark.createDataFrame([(0, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0), (3, None, 4.0), (4, None, 5.0)], "ordinal int, path string, x double")
    got = sorted(selection.distinct_first(df, ["path"]).collect(), key=lambda r: r.ordinal)
    assert [(r.ordinal, r.path, r.x) for r in got] == [(0, "a", 1.0), (1, "b", 2.0), (3, None, 4.0)]


def test_pending_units(spark):
    units = spark.createDataFrame([("en",), ("ja",), ("en",)], "language string")
    done = spark.createDataFrame([("en", "train")], "language string, split string")
    got = {(r.language, r.split): r.heavy for r in selection.pending_units(units, ["train", "test"], done, ["en"]).collect()}
    assert got == {("en", "test"): True, ("ja", "train"): False, ("ja", "test"): False}


def test_size_caps(spark):
    df = spark.createDataFrame([(0, 40), (1, 40), (2, 40), (3, 100), (4, 1)], "ordinal int, size int")
    got = {r.ordinal: r.file_id for r in ordering.assign_by_bytes(df, "size", 100).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 1, 4: 2}


@pytest.mark.parametrize("width", [1, 8, 1 << 16])
@pytest.mark.parametrize("max_count", [1, 7, 1000])
def test_shard_numbers(spark, width, max_count):
    ordinals = sorted(random.Random(9).sample(range(3000), 200))
    df = spark.createDataFrame([(o,) for o in ordinals], "ordinal bigint")
    got = {r.ordinal: r.shard_id for r in ordering.assign_shards(df.repartition(5), max_count, width=width).collect()}
    assert got == {o: i // max_count for i, o in enumerate(ordinals)}


def test_buffered_shuffle_equals_its_plain_form(spark):
    import hashlib

    def draw(key):
        return int(hashlib.md5(f"{key}|42|buffer|0".encode()).hexdigest()[:8], 16) / 2**32

    def plain(keys, size):
        slots, out = [], []
        for k in keys:
            if len(slots) < size:
                slots.append(k)
            else:
                at = int(draw(k) * size)
                out.append(slots[at])
                slots[at] = k
        return out + sorted(slots, key=draw)

    df = spark.range(0, 3000, numPartitions=3).select(F.concat(F.lit("k"), "id").alias("key"), F.array(F.col("id").cast("double")).alias("a.b"))
    keys = [f"k{i}" for i in range(3000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 170)
    try:
        for size in (1, 7, 400, 5000):
            mixed = selection.shuffle_buffered(df, size)
            assert mixed.columns == df.columns and "Exchange" not in mixed._jdf.queryExecution().executedPlan().toString()
            got = [r["key"] for r in mixed.collect()]
            assert got == [k for at in (0, 1000, 2000) for k in plain(keys[at : at + 1000], size)]
            # Run again, whoever runs it: the same order.
            assert got == [r["key"] for r in selection.shuffle_buffered(df, size).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert selection.shuffle_buffered(df.limit(0), 5).collect() == []
    with pytest.raises(ValueError):
        selection.shuffle_buffered(df, 0)


def test_shards_in_drawn_order(spark):
    listed = spark.createDataFrame([(i, f"/d/{i}.tar") for i in range(50)], "ordinal long, path string")
    a, b = ([(r["ordinal"], r["path"]) for r in selection.drawn_shards(listed.repartition(n)).orderBy("ordinal").collect()] for n in (1, 5))
    assert a == b and [n for n, _ in a] == list(range(50)) and sorted(p for _, p in a) == sorted(f"/d/{i}.tar" for i in range(50)) != [p for _, p in a]

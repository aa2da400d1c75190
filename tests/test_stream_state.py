"""State of the streaming merge: restarts, size, idle groups."""

import time

import pytest
from pyspark.sql import functions as F

from speechtable.operators.merge import merge_to_length
from speechtable.sources.corpus import stream_corpus
from speechtable.streaming.merge import merge_to_length_stream
from speechtable.streaming.restore import write_stream

SCHEMA = "lane string, ordinal bigint, key string, samples array<double>, sample_rate int"


def part(spark, source, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)


def run(spark, source, out, marks, seconds=5.0, **options):
    query = write_stream(merge_to_length_stream(stream_corpus(spark, source, 1), seconds, "lane", **options), out, marks)
    query.awaitTermination()
    return query


def found(spark, out):
    return sorted(tuple(r) for r in spark.read.parquet(out).select("lane", "key", "samples", "sample_rate", "n_members").collect())


def test_restarts_inside_groups_equal_the_batch_form(spark, fresh):
    source, out, marks = fresh("in"), fresh("out"), fresh("marks")
    rows = [(f"l{i % 3}", i, f"k{i}", [float(i)] * (i * 7 % 11), (4, 8, 16)[i // 9 % 3]) for i in range(90)]
    for at in range(0, 90, 18):
        part(spark, source, rows[at : at + 18])
        run(spark, source, out, marks)  # a new query each time
    df = spark.createDataFrame(rows, SCHEMA)
    batch = merge_to_length(df, 5.0, ["samples"], ["lane"])
    assert found(spark, out) == sorted(tuple(r) for r in batch.select("lane", "key", "samples", "sample_rate", "n_members").collect()) != []


def test_state_written_per_trigger_does_not_grow_with_the_group(spark, fresh):
    source, out, marks = fresh("in"), fresh("out"), fresh("marks")
    for at in range(8):
        part(spark, source, [("a", at * 5 + i, f"k{at * 5 + i}", [0.25 * at] * 20_000, 16) for i in range(5)])
    query = run(spark, source, out, marks, seconds=1e6)
    written = [p["stateOperators"][0]["customMetrics"]["rocksdbTotalBytesWritten"] for p in query.recentProgress if p["numInputRows"]]
    assert len(written) == 8 and written[0] > 5 * 20_000 * 8 and max(written) < 1.2 * written[0]


@pytest.mark.parametrize("on_idle", ["flush", "drop"])
def test_idle_groups_leave_or_are_forgotten(spark, fresh, on_idle):
    source, out, marks = fresh("in"), fresh("out"), fresh("marks")
    options = dict(idle_seconds=3.0, on_idle=on_idle)
    part(spark, source, [("a", 0, "a0", [1.0] * 4, 4), ("b", 1, "b0", [1.0] * 4, 4)])
    run(spark, source, out, marks, **options)
    time.sleep(3.5)
    part(spark, source, [("b", 2, "b1", [2.0] * 16, 4)])
    run(spark, source, out, marks, **options)
    part(spark, source, [("a", 3, "a1", [3.0] * 20, 4)])
    run(spark, source, out, marks, **options)
    got = found(spark, out)
    # Rows that arrive in the trigger that finds a group idle still reach it first.
    assert ("b", "b0", [1.0] * 4 + [2.0] * 16, 4, 2) in got and ("a", "a1", [3.0] * 20, 4, 1) in got
    assert (("a", "a0", [1.0] * 4, 4, 1) in got) == (on_idle == "flush") and len(got) == 2 + (on_idle == "flush")


def test_idle_policies_are_checked(spark, fresh):
    source = fresh("in")
    part(spark, source, [("a", 0, "a0", [1.0], 4)])
    with pytest.raises(ValueError):
        merge_to_length_stream(stream_corpus(spark, source, 1), 1.0, "lane", on_idle="keep")
    assert spark.read.parquet(source).select(F.max("ordinal")).first()[0] == 0

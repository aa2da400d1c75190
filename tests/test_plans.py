"""What the plans must look like at scale."""

from pyspark.sql import functions as F

from speechtable.operators import audit, degrade, merge, pairing, records, selection
from speechtable.operators.ordering import running
from speechtable.plans import fixtures as fx
from speechtable.sources import corpus, ingest


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_audit_does_not_read_samples(spark, fresh):
    path = fresh("waves")
    spark.range(10).select(
        F.lit("s").alias("shard"), F.col("id").alias("n_samples"), F.lit(16).alias("sample_rate"),
        F.array(F.lit(0.0)).alias("samples"),
    ).write.parquet(path)
    scan = plan(audit.corpus_hours(corpus.read_corpus(spark, path)))
    assert "samples" not in scan.split("ReadSchema:")[1].split("\n")[0].replace("n_samples", "")


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(selection.select_stride(fx.utt(spark, sf), 5, 3).select("ordinal"))
    assert "ReadSchema: struct<doc_id:bigint>" in text and "Exchange" not in text


def test_split_filter_prunes_folders(spark, fresh):
    root = fresh("splits")
    corpus.write_split(spark.range(10).withColumn("split", F.when(F.col("id") < 5, F.lit("train")).otherwise(F.lit("valid"))), root, "r")
    read = corpus.read_corpus(spark, root, "train")
    assert "PartitionFilters: [isnotnull(split" in plan(read) and read.count() == 5


def test_small_pool_is_broadcast(spark, sf):
    text = plan(pairing.pair_noise(fx.wave(spark, sf), fx.noise_pool(spark, sf)))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text.split("BroadcastHashJoin")[0]


def test_chain_is_one_python_stage(spark, sf):
    df = degrade.degrade(fx.wave(spark, sf), fx.noise_pool(spark, sf), fx.rir_pool(spark, sf), band_rates=(8,), target=24, low=8)
    assert plan(df).count("MapInArrow") == 1


def test_repeat_and_pending_use_no_cross_join(spark, sf):
    assert "Join" not in optimized(selection.repeat_rows(fx.utt(spark, sf), 3))
    done = spark.createDataFrame([("en", "train")], "language string, split string")
    text = optimized(selection.pending_units(fx.utt(spark, sf), ["train", "test"], done))
    assert "Cross" not in text and "LeftAnti" in text


def test_head_is_a_top_k(spark, sf):
    assert "TakeOrderedAndProject" in plan(selection.head_rows(fx.utt(spark, sf), 5))


def test_numbering_windows_are_block_wise(spark, sf):
    text = plan(running(fx.utt(spark, sf), ["shard"]))
    assert "_block" in text and text.count("Window") >= 2


def test_readable_filter_runs_before_decoding(spark):
    df = spark.createDataFrame([("a.wav", b"RIFF....WAVE")], "name string, payload binary")
    text = plan(ingest.decode_waves(ingest.filter_readable(df, "payload", "name"), "payload", "name"))
    assert text.index("MapInArrow") < text.index("Filter")


def test_quarantine_reads_no_more_than_needed(spark, sf):
    good, _ = records.split_quarantine(fx.utt(spark, sf), {"no rate": F.col("sample_rate").isNull()})
    assert "text" not in plan(good.select("key")).split("ReadSchema:")[1]


def test_merge_shuffles_lengths_once(spark, sf):
    labels = merge.merge_groups(fx.utt(spark, sf).withColumn("sample_rate", F.lit(1000)), 20.0, ["shard"])
    labels.collect()
    final = plan(labels)
    assert "ReusedExchange" in final and "text" not in final.split("ReadSchema:")[1].split("\n")[0]


def test_shard_numbers_do_not_shuffle_the_rows(spark, sf):
    from speechtable.operators.ordering import assign_shards

    numbered = assign_shards(fx.wave(spark, sf).withColumnRenamed("key", "ordinal"), 100)
    numbered.collect()
    assert "BroadcastHashJoin" in plan(numbered).split("Initial Plan")[0]


def test_large_ordinals_and_negative_ones_keep_their_order(spark):
    from speechtable.operators.ordering import running

    df = spark.createDataFrame([(-(1 << 40),), (-1,), (0,), (1 << 52,), ((1 << 52) + 1,)], "ordinal bigint")
    assert [r.row_index for r in running(df).orderBy("ordinal").collect()] == [0, 1, 2, 3, 4]

"""Registered queries: waveform transforms, merging and batching."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from speechtable.functions import kernels
from speechtable.operators import merge, ordering, records, segment
from speechtable.plans import fixtures as fx
from speechtable.plans.registry import (
    digest, query, samples_long, sql_digest, sql_draw, sql_long, sql_resample, sql_samples,
)

_PEAK = "list_max(list_transform({c}, lambda v: abs(v)))"
NORMALIZED = "list_transform({c}, lambda v: (v / nullif(" + _PEAK + ", 0) + 1e-7::DOUBLE) * 0.9::DOUBLE)"


def _stereo(spark, sf):
    """Two channels of uneven length: a signal and the same backwards."""
    return fx.signal(spark, sf).select("key", F.array("samples", F.reverse("samples")).alias("channels"))


@query(
    "WITH m AS (SELECT key, list_transform(samples, lambda v, i: (v + samples[len(samples) - i + 1]) / 2) AS y FROM signal) "
    + sql_long("m"),
    ["signal"],
)
def mono_by_mean(spark, sf):
    return samples_long(segment.to_mono(_stereo(spark, sf), "mean"), ["key"], "samples")


@query("WITH m AS (SELECT key, samples AS y FROM signal) " + sql_long("m"), ["signal"])
def mono_by_first_channel(spark, sf):
    return samples_long(segment.to_mono(_stereo(spark, sf), "first"), ["key"], "samples")


def _rounded(sql: str, digits: int = 6) -> str:
    return f"SELECT * REPLACE (round(value, {digits}) + 0.0 AS value) FROM ({sql})"


@query(f"WITH x AS ({sql_samples('wave')}) " + _rounded(sql_resample("x", 16, 24)), ["wave"])
def resampled_up(spark, sf):
    return samples_long(segment.resample(fx.wave(spark, sf), 24), ["key"], "samples")


@query(f"WITH x AS ({sql_samples('signal')}) " + _rounded(sql_resample("x", 16, 6), 4), ["signal"])
def resampled_down(spark, sf):
    return samples_long(segment.resample(fx.signal(spark, sf), 6), ["key"], "samples", 4)


@query(
    f"""WITH c AS ({sql_samples('wave')}), d AS (SELECT key, pos, value / 2 AS value FROM c),
        c24 AS ({sql_resample('c', 16, 24)}), d24 AS ({sql_resample('d', 16, 24)}),
        c8 AS ({sql_resample('c24', 24, 8)}), d8 AS ({sql_resample('d24', 24, 8)})
        SELECT kind, key, pos, round(value, 6) + 0.0 AS value FROM (SELECT 'clean' AS kind, * FROM c24 UNION ALL
            SELECT 'noisy', * FROM d24 UNION ALL SELECT 'clean_low', * FROM c8 UNION ALL SELECT 'noisy_low', * FROM d8)""",
    ["wave"],
)
def rate_fan_out(spark, sf):
    halved = F.transform("samples", lambda v: v / 2)
    both = fx.wave(spark, sf).select("key", F.col("samples").alias("clean"), halved.alias("noisy"), "sample_rate")
    fanned = segment.fan_out_rates(both, 24, 8, low_suffix="_low")
    kinds = [F.struct(F.lit(c).alias("kind"), F.col(c).alias("y")) for c in ("clean", "noisy", "clean_low", "noisy_low")]
    rows = fanned.select("key", F.inline(F.array(*kinds)))
    return samples_long(rows, ["kind", "key"], "y")


def _biquad(rate: float, cutoff: float) -> tuple[float, ...]:
    w = 2 * math.pi * cutoff / rate
    alpha, cos = math.sin(w) / (2 * kernels.HIGHPASS_Q), math.cos(w)
    a0 = 1 + alpha
    return (1 + cos) / 2 / a0, -(1 + cos) / a0, -2 * cos / a0, (1 - alpha) / a0


_B0, _B1, _A1, _A2 = _biquad(16, 2.0)


# Direct recursion of the 2 Hz high-pass at 16 Hz, one step per sample, as `filtered` rows.
LOW_CUT_SQL = f"""filtered AS (SELECT key, samples, 0 AS pos, {_B0}::DOUBLE * samples[1] AS y, 0.0::DOUBLE AS y1 FROM wave
          UNION ALL SELECT key, samples, pos + 1,
            {_B0}::DOUBLE * samples[pos + 2] + {_B1}::DOUBLE * samples[pos + 1]
            + CASE WHEN pos > 0 THEN {_B0}::DOUBLE * samples[pos] ELSE 0 END - {_A1}::DOUBLE * y - {_A2}::DOUBLE * y1, y
            FROM filtered WHERE pos + 1 < len(samples))"""


@query(
    f"""WITH /*recursive*/ {LOW_CUT_SQL}
        SELECT key, CAST(pos AS BIGINT) AS pos, round(least(greatest(y, -1), 1), 6) + 0.0 AS value FROM filtered""",
    ["wave"],
)
def low_cut(spark, sf):
    return samples_long(segment.low_cut(fx.wave(spark, sf), 2.0), ["key"], "samples")


@query(f"WITH m AS (SELECT key, {NORMALIZED.format(c='samples')} AS y FROM wave) " + sql_long("m"), ["wave"])
def peak_normalized(spark, sf):
    return samples_long(segment.normalize(fx.wave(spark, sf)), ["key"], "samples")


_CROPS = f"""crops AS (SELECT key, crop, crop_start, samples[crop_start + 1 : crop_start + 32] AS y FROM (
        SELECT key, samples, crop, CAST(floor({sql_draw('key', 'crop', 'crop')} * 33) AS BIGINT) AS crop_start
        FROM (SELECT key, samples, CAST(unnest(range(2)) AS INT) AS crop FROM wave)))"""


@query(f"WITH {_CROPS} " + sql_long("crops", "key, crop, crop_start"), ["wave"])
def random_crops(spark, sf):
    crops = segment.random_crop(fx.wave(spark, sf), n_crops=2, seconds=2.0)
    return samples_long(crops, ["key", "crop", "crop_start"], "samples")


@query(
    "SELECT key, sample_rate, len(samples) AS n, round(list_sum(samples), 4) + 0.0 AS total FROM signal", ["signal"]
)
def short_crops_whole(spark, sf):
    """Waveforms shorter than the crop pass uncut."""
    crops = segment.random_crop(fx.signal(spark, sf), n_crops=30, seconds=20.0)
    total = F.aggregate("samples", F.lit(0.0), lambda s, v: s + v)
    return crops.select("key", "sample_rate", F.size("samples").cast("bigint").alias("n"), F.round(total, 4).alias("total"))


def _greedy(source: str, group: str, order: str, length: str, target: int) -> str:
    return f"""o AS (SELECT {group}, {order}, {length} AS n,
              row_number() OVER (PARTITION BY {group} ORDER BY {order}) AS rn FROM {source}),
        r AS (SELECT {group}, {order}, rn, n AS acc, 0 AS gid FROM o WHERE rn = 1
          UNION ALL SELECT o.{group}, o.{order}, o.rn, CASE WHEN r.acc >= {target} THEN o.n ELSE r.acc + o.n END,
            CASE WHEN r.acc >= {target} THEN r.gid + 1 ELSE r.gid END
          FROM r JOIN o ON o.{group} = r.{group} AND o.rn = r.rn + 1)"""


@query(
    f"""WITH /*recursive*/ {_greedy('utt', 'shard', 'ordinal', 'n_samples', 20000)}
        SELECT shard, min(ordinal) AS first_ordinal, max(ordinal) AS last_ordinal, count(*) AS n_members FROM r
        GROUP BY shard, gid""",
    ["utt"],
)
def merge_groups(spark, sf):
    rows = fx.utt(spark, sf).withColumn("sample_rate", F.lit(1000))
    groups = merge.merge_groups(rows, 20.0, ["shard"])
    return groups.groupBy("shard", "group_start").agg(
        F.min("ordinal").alias("first_ordinal"), F.max("ordinal").alias("last_ordinal"), F.count(F.lit(1)).alias("n_members")
    ).drop("group_start")


def merged_sql(clips: str, group: str) -> str:
    """Greedy groups of 160 samples over `clips` rows, concatenated and cut."""
    return f"""WITH /*recursive*/ sized AS (SELECT *, len(samples) AS n_samples FROM {clips}),
        {_greedy('sized', group, 'key', 'n_samples', 160)},
        g AS (SELECT {group}, min(key) AS key, CAST(count(*) AS INT) AS n_members,
                flatten(list(samples ORDER BY key))[1:160] AS y
            FROM r JOIN sized USING ({group}, key) GROUP BY {group}, gid HAVING sum(n_samples) >= 160)
        """ + sql_long("g", f"{group}, key, n_members")


@query(merged_sql("clips", "speaker"), ["clips"])
def merged_to_length(spark, sf):
    merged = merge.merge_to_length(fx.clips(spark, sf), 10.0, ["samples"], ["speaker"], "key")
    return samples_long(merged, ["speaker", "key", "n_members"], "samples")


@query(
    "WITH m AS (SELECT key, list_resize(samples, 1600, 0.0) AS y FROM signal) " + sql_digest("m"), ["signal"]
)
def fixed_chunks(spark, sf):
    return digest(segment.fit_chunk(fx.signal(spark, sf), 0.02), ["key"], "samples")


@query(
    """WITH m AS (SELECT key, list_resize(samples, CAST(round_even(len(samples) / 16.0::DOUBLE * 22, 0) AS BIGINT), 0.0) AS y
        FROM signal) """ + sql_digest("m"),
    ["signal"],
)
def expected_length_fit(spark, sf):
    rows = fx.signal(spark, sf).withColumn("restored", F.col("samples"))
    return digest(segment.fit_expected(rows, 22), ["key"], "restored")


@query(
    """WITH m AS (SELECT key, list_concat(list_concat(list_transform(range(40), lambda i: 0.0::DOUBLE), samples),
        list_transform(range(40), lambda i: 0.0::DOUBLE)) AS y FROM wave) """ + sql_digest("m"),
    ["wave"],
)
def edge_padded(spark, sf):
    return digest(segment.edge_pad(fx.wave(spark, sf)), ["key"], "samples")


@query(
    """WITH m AS (SELECT key, len(samples) AS n_samples,
        CASE WHEN len(samples) < 60 THEN list_resize(samples, 60, 0.0) ELSE samples END AS y FROM signal) """
    + sql_digest("m", "key, n_samples"),
    ["signal"],
)
def padded_to_max(spark, sf):
    padded = segment.pad_to(fx.signal(spark, sf), 60).withColumn("n_samples", F.col("n_samples").cast("bigint"))
    return digest(padded, ["key", "n_samples"], "samples")


@query(
    """WITH b AS (SELECT user_id, segment // 2 AS batch_id, segment % 2 AS slot, key, samples, len(samples) AS n,
            max(len(samples)) OVER (PARTITION BY user_id, segment // 2) AS longest FROM signal),
        m AS (SELECT user_id, batch_id, key, n AS true_length, list_resize(samples, longest, 0.0) AS y FROM b) """
    + sql_digest("m", "user_id, batch_id, key, true_length"),
    ["signal"],
)
def collated_batches(spark, sf):
    batched = ordering.assign_batches(fx.signal(spark, sf), 2, ["user_id"], "segment")
    batches = segment.collate(batched, ["user_id", "batch_id"])
    members = F.arrays_zip("keys", "lens", "padded")
    rows = batches.select("user_id", "batch_id", F.explode(members).alias("m")).select(
        "user_id", "batch_id", F.col("m.keys").alias("key"), F.col("m.lens").cast("bigint").alias("true_length"),
        F.col("m.padded").alias("y"),
    )
    return digest(rows, ["user_id", "batch_id", "key", "true_length"], "y")


_PAIRS = """b AS (SELECT speaker, key, samples,
        (row_number() OVER (PARTITION BY speaker ORDER BY key) - 1) // 4 AS batch_id FROM wave)"""


@query(
    f"""WITH {_PAIRS} SELECT speaker, batch_id, string_agg(CAST(key AS VARCHAR), ',' ORDER BY key) AS names, 16 AS sr,
        CAST(sum(len(samples)) AS BIGINT) AS n_clean, round(sum(list_sum(samples)) / 2, 6) + 0.0 AS noisy_total
        FROM b GROUP BY speaker, batch_id""",
    ["wave"],
)
def assembled_pairs(spark, sf):
    batched = ordering.assign_batches(fx.wave(spark, sf), 4, ["speaker"], "key")
    halved = F.transform("samples", lambda v: v / 2)
    paired = batched.withColumns({"clean": F.col("samples"), "noisy": halved})
    good, _ = segment.assemble_pairs(paired, ["speaker", "batch_id"])
    total = F.aggregate(F.flatten("noisy"), F.lit(0.0), lambda s, v: s + v)
    return good.select(
        "speaker", "batch_id", F.array_join(F.col("names").cast("array<string>"), ",").alias("names"), "sr",
        F.aggregate("lens", F.lit(0), lambda s, v: s + v).cast("bigint").alias("n_clean"),
        F.round(total, 6).alias("noisy_total"),
    )


@query(
    """WITH b AS (SELECT user_id, segment // 2 AS batch_id, len(samples) AS n FROM signal)
        SELECT user_id, batch_id, 'ragged batch' AS reason FROM b GROUP BY ALL HAVING min(n) <> max(n)""",
    ["signal"],
)
def ragged_batches(spark, sf):
    batched = ordering.assign_batches(fx.signal(spark, sf), 2, ["user_id"], "segment")
    paired = records.branch(batched, "samples")
    _, ragged = segment.assemble_pairs(paired, ["user_id", "batch_id"])
    return ragged.select("user_id", "batch_id", "reason")


def _with_gaps(spark, sf):
    """About every tenth signal silent and every seventh with a NaN in front."""
    rows, number = fx.signal(spark, sf), 3 * F.col("user_id") + F.col("segment")
    silent = F.transform("samples", lambda v: v * 0)
    broken = F.transform("samples", lambda v, i: F.when(i == 0, float("nan")).otherwise(v))
    return rows.withColumn("samples", F.when(number % 10 == 0, silent).when(number % 7 == 0, broken).otherwise(F.col("samples")))


_NUMBER = "(3 * user_id + segment)"


@query(f"SELECT key FROM signal WHERE {_NUMBER} % 10 <> 0 AND {_NUMBER} % 7 <> 0", ["signal"])
def nan_rejected(spark, sf):
    """Silence turns to null samples in normalising, and both kinds of rows go."""
    both = records.branch(segment.normalize(_with_gaps(spark, sf)), "samples")
    return records.drop_nan(both, ["clean", "noisy"], ["clean_16k", "noisy_16k"]).select("key")


@query(
    f"""WITH m AS (SELECT key, CASE WHEN {_NUMBER} % 10 = 0 THEN list_transform(samples, lambda v: 0.0::DOUBLE)
        WHEN {_NUMBER} % 7 = 0 THEN list_transform(samples, lambda v, i: CASE WHEN i = 1 THEN 0.0::DOUBLE ELSE v END) ELSE samples END AS y FROM signal) """
    + sql_long("m"),
    ["signal"],
)
def nan_replaced(spark, sf):
    return samples_long(records.nan_to_num(_with_gaps(spark, sf), "samples"), ["key"], "samples")


@query("SELECT key, len(samples) > 40 AS truncated FROM signal", ["signal"])
def truncation_flags(spark, sf):
    return records.flag_truncated(fx.signal(spark, sf), 40).select("key", "truncated")


def _uneven(spark, sf):
    """Predicted waveforms that lack up to 15 samples of their target."""
    rows = fx.wave(spark, sf)
    return rows.withColumn("predicted", F.slice("samples", F.lit(1), (64 - F.col("key") % 16).cast("int")))


@query(
    "WITH m AS (SELECT key, samples[1:64 - key % 16] AS y FROM wave WHERE key % 16 <= 9) " + sql_digest("m"), ["wave"]
)
def aligned_lengths(spark, sf):
    good, _ = records.align_lengths(_uneven(spark, sf), "samples", "predicted", tol=9)
    return digest(good, ["key"], "samples")


@query("SELECT key, 'length deviation' AS reason FROM wave WHERE key % 16 > 9", ["wave"])
def length_deviations(spark, sf):
    _, bad = records.align_lengths(_uneven(spark, sf), "samples", "predicted", tol=9)
    return bad.select("key", "reason")

"""Registered queries: pairing with pools, degradations, features and pair distances."""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import functions as F

from speechtable.functions import waves
from speechtable.operators import degrade, distance, features, ordering, pairing, records, restore, segment
from speechtable.plans import fixtures as fx
from speechtable.plans.registry import (
    digest, query, samples_long, sql_digest, sql_draw, sql_long, sql_resample, sql_samples,
)
from speechtable.plans.wave_queries import _PEAK, LOW_CUT_SQL, NORMALIZED

#: The stages, with a direct path that a 16 Hz response can hold: 0.25 s are 4 samples.
AUDIBLE = tuple(replace(s, options={"early_seconds": 0.25}) if s.name == "reverb" else s for s in degrade.STAGES)
_NOISE_N = "(SELECT count(*) FROM noise_pool)"
_RIR_N = "(SELECT count(*) FROM rir_pool)"


def _pick(pool_n: str, stage: str) -> str:
    return f"CAST(floor({sql_draw('key', stage)} * {pool_n}) AS BIGINT)"


def _noisy(spark, sf):
    return records.branch(fx.wave(spark, sf), "samples")


@query(
    f"""SELECT key, CASE WHEN {sql_draw('key', 'gain.gate')} < 0.3 THEN round(2 * list_sum(samples), 6)
        ELSE round(list_sum(samples), 6) END + 0.0 AS total FROM wave""",
    ["wave"],
)
def randomly_applied(spark, sf):
    louder = lambda df: df.withColumn("samples", waves.scaled(F.col("samples"), F.lit(2.0)))
    applied = pairing.random_apply(fx.wave(spark, sf), 0.3, louder, "gain", ["samples"])
    total = F.aggregate("samples", F.lit(0.0), lambda s, v: s + v)
    return applied.select("key", F.round(total, 6).alias("total"))


_NOISE = f"""picked AS (SELECT wave.*, noise_pool.samples AS noise, noise_pool.sample_rate AS noise_rate
        FROM wave LEFT JOIN noise_pool ON CASE WHEN {sql_draw('key', 'noise.gate')} < 0.5
            THEN {_pick(_NOISE_N, 'noise')} END = pool_idx)"""


@query(
    f"""WITH {_NOISE} SELECT key, noise_rate, round(list_sum(noise), 6) + 0.0 AS noise_total FROM picked""",
    ["wave", "noise_pool"],
)
def noise_pairs(spark, sf):
    paired = pairing.pair_noise(fx.wave(spark, sf), fx.noise_pool(spark, sf), p=0.5)
    total = F.aggregate("noise", F.lit(0.0), lambda s, v: s + v)
    return paired.select("key", "noise_rate", F.round(total, 6).alias("noise_total"))


_POOL_START = f"CAST(floor({sql_draw('key', 'crop', 'crop')} * 33) AS BIGINT)"


@query(
    f"""WITH m AS (SELECT row_number() OVER (ORDER BY key, crop) - 1 AS pool_idx,
            samples[{_POOL_START} + 1 : {_POOL_START} + 32] AS y
            FROM (SELECT key, samples, unnest(range(2)) AS crop FROM wave)) """ + sql_long("m", "pool_idx"),
    ["wave"],
)
def prepared_pool(spark, sf):
    pool = pairing.prepare_pool(fx.wave(spark, sf).withColumn("ordinal", F.col("key")), 2.0, 2)
    return samples_long(pool, ["pool_idx"], "samples")


@query(
    """WITH m AS (SELECT key, list_transform(range(64 + key % 90), lambda i: samples[(i % 64) + 1]) AS y FROM wave) """
    + sql_digest("m"),
    ["wave"],
)
def tiled_noise(spark, sf):
    return digest(pairing.tile_to(fx.wave(spark, sf), "samples", 64 + F.col("key") % 90), ["key"], "samples")


_ENERGY = "list_sum(list_transform({c}, lambda v: v * v))"
_SNR = f"(-5 + {sql_draw('key', 'snr')} * 25)"
_GAIN = f"pow(10, (10 * log10({_ENERGY.format(c='x')} / {_ENERGY.format(c='noise[1:len(x)]')}) - {_SNR}) / 20)"
_MIX = f"list_transform(range(len(x)), lambda i: x[i + 1] + gain * noise[i + 1])"


@query(
    f"""WITH {_NOISE}, g AS (SELECT key, x, noise, {_GAIN} AS gain FROM (SELECT key, samples AS x, noise FROM picked)),
        m AS (SELECT key, CASE WHEN noise IS NULL THEN x ELSE {_MIX} END AS y FROM g) """ + sql_long("m"),
    ["wave", "noise_pool"],
)
def snr_mixed(spark, sf):
    paired = pairing.pair_noise(_noisy(spark, sf), fx.noise_pool(spark, sf), p=0.5)
    tiled = pairing.tile_to(paired, "noise", F.size("noisy"))
    return samples_long(pairing.mix_snr(pairing.draw_snr(tiled)), ["key"], "noisy")


@query(
    """WITH x AS (SELECT key, unnest(range(64)) AS pos, unnest(samples) AS value FROM wave),
        half AS (SELECT key, pos, value FROM x) """
    + "SELECT key, pos, round(value, 6) + 0.0 AS value FROM ("
    + sql_resample("half", 24, 16) + ")",
    ["wave"],
)
def rate_matched_noise(spark, sf):
    rows = fx.wave(spark, sf).select("key", F.col("samples").alias("noise"), F.lit(24).alias("noise_rate"), "sample_rate")
    return samples_long(pairing.match_rate(rows, "noise", "noise_rate"), ["key"], "noise")


_RIR = f"""responses AS (SELECT key, samples, channels[CAST(floor({sql_draw('key', 'rir.channel')} * 2) AS INT) + 1] AS rir
        FROM wave JOIN rir_pool ON {_pick(_RIR_N, 'rir')} = pool_idx)"""


@query(
    f"""WITH {_RIR}, m AS (SELECT key, list_transform(rir, lambda v: v / {_PEAK.format(c='rir')}) AS y FROM responses) """
    + sql_long("m"),
    ["wave", "rir_pool"],
)
def rir_pairs(spark, sf):
    paired = pairing.pair_rir(fx.wave(spark, sf), fx.rir_pool(spark, sf), peak_normalize=True)
    return samples_long(paired, ["key"], "rir")


def _paired_rir(spark, sf):
    return pairing.pair_rir(fx.wave(spark, sf), fx.rir_pool(spark, sf))


def _convolved(source: str, x: str, h: str) -> str:
    """Direct-form convolution cut to the input's length."""
    return f"""list_transform(range(len({x})), lambda i: list_sum(list_transform(
        range(least(i + 1, len({h}))), lambda j: {h}[j + 1] * {x}[i - j + 1])))"""


@query(
    f"WITH {_RIR}, m AS (SELECT key, {_convolved('responses', 'samples', 'rir')} AS y FROM responses) " + sql_long("m"),
    ["wave", "rir_pool"],
)
def convolved(spark, sf):
    return samples_long(pairing.convolve(_paired_rir(spark, sf), "samples", "rir", "wet"), ["key"], "wet")


# 0.25 s of a 16 Hz response are 4 samples.
_EARLY = f"""started AS (SELECT *, list_position(list_transform(rir, lambda v: abs(v) > 0.1::DOUBLE * {_PEAK.format(c='rir')}), true) - 1
            AS begin FROM responses),
        early AS (SELECT *, list_transform(rir, lambda v, i: CASE WHEN i - 1 < begin + 4 THEN v ELSE 0 END) AS dry_rir
            FROM started)"""


@query(f"WITH {_RIR}, {_EARLY}, m AS (SELECT key, dry_rir AS y FROM early) " + sql_long("m"), ["wave", "rir_pool"])
def early_responses(spark, sf):
    return samples_long(pairing.early_rir(_paired_rir(spark, sf), sec=0.25), ["key"], "early")


_REVERB = f"""{_RIR}, {_EARLY},
        conv AS (SELECT key, samples, {_convolved('early', 'samples', 'rir')} AS wet,
            {_convolved('early', 'samples', 'dry_rir')} AS dry FROM early),
        matched AS (SELECT key, wet, dry, {_PEAK.format(c='samples')}
            / greatest({_PEAK.format(c='wet')}, {_PEAK.format(c='dry')}) AS f FROM conv),
        leveled AS (SELECT key, list_transform(wet, lambda v: v * f) AS wet, list_transform(dry, lambda v: v * f) AS dry
            FROM matched)"""


@query(
    f"""WITH {_REVERB} SELECT kind, key, pos, round(value, 6) + 0.0 AS value FROM (
        SELECT 'wet' AS kind, key, unnest(range(len(wet))) AS pos, unnest(wet) AS value FROM leveled UNION ALL
        SELECT 'dry', key, unnest(range(len(dry))), unnest(dry) FROM leveled)""",
    ["wave", "rir_pool"],
)
def level_matched(spark, sf):
    early = pairing.early_rir(_paired_rir(spark, sf), sec=0.25)
    wet = pairing.convolve(early, "samples", "rir", "wet")
    both = pairing.level_match(pairing.convolve(wet, "samples", "early", "dry"), "samples", "wet", "dry")
    kinds = [F.struct(F.lit(c).alias("kind"), F.col(c).alias("y")) for c in ("wet", "dry")]
    return samples_long(both.select("key", F.inline(F.array(*kinds))), ["kind", "key"], "y")


_BANDS = (8, 12, 24)


def _band_ctes(source: str, bands: tuple[int, ...]) -> str:
    """`up8`, `up12`, ...: rows of ``source`` taken to their drawn band and back."""
    parts = []
    for n, band in enumerate(bands):
        parts.append(f"""x{band} AS (SELECT key, pos, value FROM {source}
                WHERE CAST(floor({sql_draw('key', 'band')} * {len(bands)}) AS INT) = {n}),
            down{band} AS ({sql_resample(f'x{band}', 16, band)}), up{band} AS ({sql_resample(f'down{band}', band, 16)})""")
    return ", ".join(parts)



@query(
    f"WITH x AS ({sql_samples('wave')}), {_band_ctes('x', _BANDS)} SELECT key, pos, round(value, 6) + 0.0 AS value FROM ("
    + " UNION ALL ".join(f"SELECT * FROM up{b}" for b in _BANDS) + ")",
    ["wave"],
)
def band_limited(spark, sf):
    return samples_long(pairing.band_limit(_noisy(spark, sf), _BANDS), ["key"], "noisy")


_CLIP = f"""bounds AS (SELECT key, q[1] AS lo, q[2] AS hi FROM (SELECT key, [
            s[CAST(floor(a) AS INT) + 1] + (s[least(CAST(floor(a) AS INT) + 2, len(s))] - s[CAST(floor(a) AS INT) + 1]) * (a - floor(a)),
            s[CAST(floor(b) AS INT) + 1] + (s[least(CAST(floor(b) AS INT) + 2, len(s))] - s[CAST(floor(b) AS INT) + 1]) * (b - floor(b))] AS q
        FROM (SELECT key, list_sort(x) AS s, {sql_draw('key', 'clip.low')} * (1.0::DOUBLE * 0.1) * (len(x) - 1) AS a,
            (0.9::DOUBLE + {sql_draw('key', 'clip.high')} * (1.0::DOUBLE - 0.9::DOUBLE)) * (len(x) - 1) AS b FROM source)))"""


@query(
    f"""WITH source AS (SELECT key, samples AS x FROM wave), {_CLIP},
        m AS (SELECT key, list_transform(x, lambda v: least(greatest(v, lo), hi)) AS y FROM source JOIN bounds USING (key)) """
    + sql_long("m"),
    ["wave"],
)
def quantile_clipped(spark, sf):
    return samples_long(pairing.quantile_clip(_noisy(spark, sf)), ["key"], "noisy")


@query(
    """WITH c AS (SELECT key, samples, samples[key % 5 + 1 : 64 - key % 3] AS x FROM wave),
        lags AS (SELECT key, samples, x, unnest(range(64 - len(x) + 1)) AS lag FROM c),
        scored AS (SELECT *, list_sum(list_transform(range(len(x)),
            lambda i: (samples[i + lag + 1] - x[i + 1] * 0.5) ** 2)) AS err FROM lags),
        best AS (SELECT key, first(x) AS x, arg_min(lag, err) AS lag FROM scored GROUP BY key),
        m AS (SELECT key, list_transform(range(64), lambda i:
            CASE WHEN i >= lag AND i < lag + len(x) THEN x[i - lag + 1] * 0.5 ELSE 0 END) AS y FROM best) """
    + sql_long("m"),
    ["wave"],
)
def codec_aligned(spark, sf):
    """Coded copies: half as loud, with 0-4 samples missing in front and 0-2 at the end."""
    part = F.slice("samples", (F.col("key") % 5 + 1).cast("int"), (64 - F.col("key") % 5 - F.col("key") % 3).cast("int"))
    coded = fx.wave(spark, sf).withColumn("coded", F.transform(part, lambda v: v * 0.5))
    return samples_long(pairing.align_best_lag(coded, "samples", "coded"), ["key"], "coded")


def _loss_sql(source: str, n: int, seconds: float) -> str:
    return f"""spans AS (SELECT key, list({{'s': CAST(trunc(begin * 16) AS BIGINT), 'e': CAST(trunc((begin + length) * 16) AS BIGINT)}}) AS p
        FROM (SELECT key, length, {sql_draw('key', 'loss.start', 'i')} * ({seconds}::DOUBLE - length) AS begin
            FROM (SELECT key, i, (20 + {sql_draw('key', 'loss.length', 'i')} * 180) / 1000 AS length
                FROM (SELECT key, unnest(range({n})) AS i FROM {source}))) GROUP BY key)"""


@query(
    f"""WITH {_loss_sql('wave', 8, 4)}, m AS (SELECT key, list_transform(samples, lambda v, i:
        CASE WHEN len(list_filter(p, lambda w: i - 1 >= w.s AND i - 1 < w.e)) > 0 THEN 0 ELSE v END) AS y
        FROM wave JOIN spans USING (key)) """ + sql_long("m"),
    ["wave"],
)
def packet_losses(spark, sf):
    return samples_long(pairing.packet_loss(_noisy(spark, sf), per_10s=20.0), ["key"], "noisy")

def _chain_ctes(bands: tuple[int, ...] = (), codec: bool = False, seconds: int = 4) -> str:
    """`chain` (key, clean, noisy): all stages over `wave`, each where its draw says so."""
    on = lambda stage: f"{sql_draw('key', stage + '.gate')} < 0.5"
    losses = seconds * 3 // 10
    ctes = [_NOISE, _REVERB, f"""
        reverbed AS (SELECT key, CASE WHEN {on('rir')} THEN leveled.dry ELSE samples END AS clean,
            CASE WHEN {on('rir')} THEN leveled.wet ELSE samples END AS x FROM wave JOIN leveled USING (key)),
        joined AS (SELECT reverbed.*, noise FROM reverbed JOIN picked USING (key)),
        gained AS (SELECT key, clean, x, noise, {_GAIN} AS gain FROM joined),
        mixed AS (SELECT key, clean, CASE WHEN noise IS NULL THEN x ELSE {_MIX} END AS x FROM gained)"""]
    if bands:
        every = " UNION ALL ".join(f"SELECT * FROM up{b}" for b in bands)
        ctes.append(f"""to_band AS (SELECT key, unnest(range(len(x))) AS pos, unnest(x) AS value FROM mixed WHERE {on('band')}),
            {_band_ctes('to_band', bands)}, banded AS (SELECT key, list(value ORDER BY pos) AS xb FROM ({every}) GROUP BY key),
            source AS (SELECT key, clean, coalesce(xb, x) AS x FROM mixed LEFT JOIN banded USING (key))""")
    else:
        ctes.append("source AS (SELECT * FROM mixed)")
    ctes.append(_CLIP)
    coded = "list_transform(x, lambda v: round_even(v * 128, 0) / 128)" if codec else "x"
    ctes.append(f"""clipped AS (SELECT key, clean, CASE WHEN {on('clip')}
            THEN list_transform(x, lambda v: least(greatest(v, lo), hi)) ELSE x END AS x FROM source JOIN bounds USING (key)),
        coded AS (SELECT key, clean, CASE WHEN {on('codec')} THEN {coded} ELSE x END AS x FROM clipped)""")
    if losses:
        ctes.append(f"""{_loss_sql('wave', losses, seconds)},
            chain AS (SELECT key, clean, CASE WHEN {on('loss')} THEN list_transform(x, lambda v, i:
                CASE WHEN len(list_filter(p, lambda w: i - 1 >= w.s AND i - 1 < w.e)) > 0 THEN 0 ELSE v END) ELSE x END AS noisy
                FROM coded JOIN spans USING (key))""")
    else:
        ctes.append("chain AS (SELECT key, clean, x AS noisy FROM coded)")
    return ", ".join(ctes)


_FLAT = """flat AS (SELECT key, 'clean' AS kind, clean AS y FROM chain UNION ALL SELECT key, 'noisy', noisy FROM chain)"""
_RATES = {"clean": ("clean", 24), "noisy": ("noisy", 24), "clean_16k": ("clean", 8), "noisy_16k": ("noisy", 8)}


def _rates_ctes() -> str:
    """`rated` (key, kind, y): clean and noisy at 24 and, from there, 8, each normalised.

    A direct path of silence leaves nothing to normalise, and its pair goes.
    """
    ctes = []
    for side in ("clean", "noisy"):
        ctes += [f"{side}_in AS (SELECT key, unnest(range(len({side}))) AS pos, unnest({side}) AS value FROM chain)",
                 f"{side}24 AS ({sql_resample(f'{side}_in', 16, 24)})", f"{side}8 AS ({sql_resample(f'{side}24', 24, 8)})"]
    lists = " UNION ALL ".join(
        f"SELECT key, '{kind}' AS kind, list(value ORDER BY pos) AS x FROM {side}{rate} GROUP BY key"
        for kind, (side, rate) in _RATES.items()
    )
    silent = "len(list_filter(y, lambda v: v IS NULL)) > 0"
    return ", ".join([*ctes, f"""leveled4 AS (SELECT key, kind, {NORMALIZED.format(c='x')} AS y FROM ({lists})),
        rated AS (SELECT * FROM leveled4 WHERE key NOT IN (SELECT key FROM leveled4 WHERE {silent}))"""])


# Low cut, crops of 2 s and normalising; the result takes the place of `wave`.
def _prepared_ctes(crops: int, samples: int) -> str:
    start = f"CAST(floor({sql_draw('key', 'crop', 'crop')} * {65 - min(samples, 64)}) AS BIGINT)"
    return f"""{LOW_CUT_SQL.replace('FROM wave', 'FROM base')},
        cutoff AS (SELECT key, list(least(greatest(y, -1), 1) ORDER BY pos) AS samples FROM filtered GROUP BY key),
        cropped AS (SELECT key, crop, samples[{start} + 1 : {start} + {samples}] AS x
            FROM (SELECT key, samples, unnest(range({crops})) AS crop FROM cutoff)),
        wave AS (SELECT key || '-' || crop AS key, {NORMALIZED.format(c='x')} AS samples, 16 AS sample_rate FROM cropped)"""


_NATIVE_STAGES = tuple(s for s in AUDIBLE if s.name not in ("band", "codec"))


def _kinds(df):
    kinds = [F.struct(F.lit(c).alias("kind"), F.col(c).alias("y")) for c in ("clean", "noisy")]
    return samples_long(df.select("key", F.inline(F.array(*kinds))), ["kind", "key"], "y")


@query(
    f"WITH {_chain_ctes(_BANDS, codec=True)}, {_FLAT} " + sql_long("flat", "kind, key"), ["wave", "noise_pool", "rir_pool"]
)
def degradation_chain(spark, sf):
    """All stages: reverb, noise, band limit, clip, codec (a coarse quantiser) and packet loss."""

    def coarse(x, rate):
        return (x * 128).round() / 128

    rows = fx.wave(spark, sf)
    chain = degrade.degrade(
        rows, fx.noise_pool(spark, sf), fx.rir_pool(spark, sf), degrade.with_codec(coarse, AUDIBLE), band_rates=_BANDS
    )
    return _kinds(chain)


@query(
    f"WITH /*recursive*/ base AS ({fx.SQL_VIEWS['wave']}), {_prepared_ctes(2, 32)}, {_chain_ctes(_BANDS, seconds=2)}, "
    + f"{_rates_ctes()} " + sql_digest("rated", "kind, key"),
    ["noise_pool", "rir_pool"],
)
def training_pairs(spark, sf):
    """The chain with both rates and the four normalisations in its one stage."""
    rows = segment.prepare_crops(fx.wave(spark, sf), n_crops=2, seconds=2.0, cutoff=2.0)
    rows = rows.withColumn("key", F.concat_ws("-", "key", "crop"))
    pairs = degrade.degrade(
        rows, fx.noise_pool(spark, sf), fx.rir_pool(spark, sf), AUDIBLE, band_rates=_BANDS, target=24, low=8
    )
    names = ("clean", "noisy", "clean_16k", "noisy_16k")
    kinds = [F.struct(F.lit(c).alias("kind"), F.col(c).alias("y")) for c in names]
    return digest(pairs.select("key", F.inline(F.array(*kinds))), ["kind", "key"], "y")


@query(f"WITH {_chain_ctes()}, {_FLAT} " + sql_long("flat", "kind, key"), ["wave", "noise_pool", "rir_pool"])
def chosen_stages(spark, sf):
    """A user's own choice of stages: reverb, noise, clip and packet loss."""
    rows = fx.wave(spark, sf)
    return _kinds(degrade.degrade(rows, fx.noise_pool(spark, sf), fx.rir_pool(spark, sf), _NATIVE_STAGES))


@query(
    f"""WITH norm AS (SELECT key, samples, sample_rate, speaker, {NORMALIZED.format(c='samples')} AS x FROM wave),
        picked AS (SELECT key, speaker, x, noise_pool.samples AS noise FROM norm JOIN noise_pool
            ON {_pick(_NOISE_N, 'noise')} = pool_idx),
        g AS (SELECT key, speaker, x, noise, {_GAIN} AS gain FROM picked),
        mixed AS (SELECT key, speaker, x AS clean, {_MIX} AS x FROM g),
        source AS (SELECT key, x FROM mixed), {_CLIP},
        pairs AS (SELECT speaker, clean, list_transform(x, lambda v: least(greatest(v, lo), hi)) AS noisy
            FROM mixed JOIN bounds USING (key))
        SELECT speaker, count(*) AS n_pairs, round(avg(list_sum(list_transform(range(len(clean)),
            lambda i: abs(clean[i + 1] - noisy[i + 1]))) / len(clean)), 6) + 0.0 AS mean_distance
        FROM pairs GROUP BY speaker""",
    ["wave", "noise_pool"],
)
def flagship_pairs(spark, sf):
    """Normalise, branch, add pool noise at a drawn SNR, clip, drop NaN, distance per speaker."""
    rows = records.branch(segment.normalize(fx.wave(spark, sf)), "samples")
    paired = pairing.pair_noise(rows, fx.noise_pool(spark, sf))
    noisy = pairing.mix_snr(pairing.draw_snr(pairing.tile_to(paired, "noise", F.size("noisy"))))
    clipped = records.drop_nan(pairing.quantile_clip(noisy), ["clean", "noisy"])
    apart = distance.pair_distance(clipped, "clean", "noisy", "l1")
    return apart.groupBy("speaker").agg(
        F.count(F.lit(1)).alias("n_pairs"), F.round(F.avg("distance"), 6).alias("mean_distance")
    )


@query(
    """SELECT key, round(list_sum(list_transform(range(64), lambda i: abs(samples[i + 1] / 2))) / 64, 6) + 0.0 AS l1,
        round(list_sum(list_transform(range(64), lambda i: (samples[i + 1] / 2) ** 2)) / 64, 6) + 0.0 AS mse FROM wave""",
    ["wave"],
)
def pair_distances(spark, sf):
    rows = _noisy(spark, sf).withColumn("noisy", F.transform("samples", lambda v: v / 2))
    l1 = distance.pair_distance(rows, "clean", "noisy", "l1", "l1")
    both = distance.pair_distance(l1, "clean", "noisy", "mse", "mse")
    return both.select("key", F.round("l1", 6).alias("l1"), F.round("mse", 6).alias("mse"))


def _magnitude_sql(source: str, size: int, name: str) -> str:
    """(key, frame, bin, mag) of centred, reflect-padded Hann frames of 64 samples, hop size / 4."""
    hop, half = size // 4, size // 2
    at = f"(f * {hop} + w - {half})"
    return f"""{name} AS (SELECT key, f, b, sqrt(sum(v * cos(2 * pi() * b * w / {size})) ** 2
            + sum(v * sin(2 * pi() * b * w / {size})) ** 2) AS mag
        FROM (SELECT key, f, w, value * (0.5 - 0.5 * cos(2 * pi() * w / {size})) AS v
              FROM (SELECT unnest(range({64 // hop + 1})) AS f), (SELECT unnest(range({size})) AS w)
              JOIN {source} ON pos = CASE WHEN {at} < 0 THEN -{at} WHEN {at} > 63 THEN 126 - {at} ELSE {at} END),
             (SELECT unnest(range({half + 1})) AS b)
        GROUP BY key, f, b)"""


def _slaney_sql(rate: int, size: int, n_mels: int, name: str) -> str:
    """(b, m, weight) of the area-normalised mel triangles."""
    step = math.log(6.4) / 27
    top = rate / 2 * 3 / 200 if rate / 2 < 1000 else 15 + math.log(rate / 2000) / step
    return f"""{name}_hz AS (SELECT i, CASE WHEN mel < 15 THEN mel * 200 / 3 ELSE 1000 * exp({step!r}::DOUBLE * (mel - 15)) END AS hz
            FROM (SELECT i, i * {top!r}::DOUBLE / {n_mels + 1} AS mel FROM (SELECT unnest(range({n_mels + 2})) AS i))),
        {name} AS (SELECT b, l.i AS m, greatest(0, least((hz_at - l.hz) / (c.hz - l.hz), (r.hz - hz_at) / (r.hz - c.hz)))
            * 2 / (r.hz - l.hz) AS weight
            FROM (SELECT b, b * {rate}::DOUBLE / {size} AS hz_at FROM (SELECT unnest(range({size // 2 + 1})) AS b)),
            {name}_hz l JOIN {name}_hz c ON c.i = l.i + 1 JOIN {name}_hz r ON r.i = l.i + 2)"""


def _spectral_sql() -> str:
    ctes = [f"x AS ({sql_samples('wave')})", "y AS (SELECT key, pos, value / 2 + sin(pos) / 10 AS value FROM x)"]
    stft, mel = [], []
    for size, n in ((32, 5), (64, 10)):
        ctes += [_magnitude_sql("x", size, f"xm{size}"), _magnitude_sql("y", size, f"ym{size}"),
                 _slaney_sql(16000, size, n, f"bank{size}")]
        pair = f"xm{size} p JOIN ym{size} q USING (key, f, b)"
        stft.append(f"""SELECT key, avg(abs(2 * log10(greatest(p.mag, 1e-5::DOUBLE)) - 2 * log10(greatest(q.mag, 1e-5::DOUBLE))))
            + avg(abs(p.mag - q.mag)) AS d FROM {pair} GROUP BY key""")
        mel.append(f"""SELECT key, avg(abs(log10(greatest(a, 1e-5::DOUBLE)) - log10(greatest(b2, 1e-5::DOUBLE)))) AS d FROM (
            SELECT key, f, m, sum(p.mag * weight) AS a, sum(q.mag * weight) AS b2 FROM {pair} JOIN bank{size} USING (b)
            GROUP BY key, f, m) GROUP BY key""")
    return f"""WITH {', '.join(ctes)},
        s AS (SELECT key, sum(d) AS stft FROM ({' UNION ALL '.join(stft)}) GROUP BY key),
        e AS (SELECT key, sum(d) AS mel FROM ({' UNION ALL '.join(mel)}) GROUP BY key)
        SELECT key, round(mel, 6) + 0.0 AS mel_distance, round(stft, 6) + 0.0 AS stft_distance FROM s JOIN e USING (key)"""


@query(_spectral_sql(), ["wave"])
def spectral_distances(spark, sf):
    """Two scales of mel and STFT distance between a waveform and a halved, hummed copy at 16 kHz."""
    hummed = F.transform("samples", lambda v, i: v / 2 + F.sin(i.cast("double")) / 10)
    rows = fx.wave(spark, sf).select("key", F.col("samples").alias("clean"), hummed.alias("noisy"), F.lit(16000).alias("sample_rate"))
    apart = distance.spectral_distance(rows, mel_scales=((5, 32), (10, 64)), windows=(32, 64))
    return apart.select("key", F.round("mel_distance", 6).alias("mel_distance"), F.round("stft_distance", 6).alias("stft_distance"))


_SIZE, _HOP, _MELS = 16, 8, 6


def _log_mel_sql() -> str:
    """Frames of 16 samples every 8 at 16 kHz, as (key, f, m, value)."""
    mel = lambda hz: f"1127 * ln(1 + ({hz}) / 700.0::DOUBLE)"
    low, high = f"{mel('20')}", f"{mel('8000')}"
    edge = lambda k: f"({low} + (m + {k}) * ({high} - {low}) / {_MELS + 1})"
    return f"""x AS ({sql_samples('wave')}),
        framed AS (SELECT key, f, w, value - avg(value) OVER (PARTITION BY key, f) AS v
            FROM x, (SELECT unnest(range({(64 - _SIZE) // _HOP + 1})) AS f), (SELECT unnest(range({_SIZE})) AS w)
            WHERE pos = f * {_HOP} + w),
        windowed AS (SELECT key, f, w, (v - 0.97::DOUBLE * coalesce(lag(v) OVER (PARTITION BY key, f ORDER BY w), v))
            * pow(0.5 - 0.5 * cos(2 * pi() * w / {_SIZE - 1}), 0.85) AS v FROM framed),
        power AS (SELECT key, f, b, sum(v * cos(2 * pi() * b * w / {_SIZE})) ** 2 + sum(v * sin(2 * pi() * b * w / {_SIZE})) ** 2 AS p
            FROM windowed, (SELECT unnest(range({_SIZE // 2})) AS b) GROUP BY key, f, b),
        bank AS (SELECT b, m, greatest(0, least(({mel('b * 1000')} - {edge(0)}) / ({edge(1)} - {edge(0)}),
            ({edge(2)} - {mel('b * 1000')}) / ({edge(2)} - {edge(1)}))) AS weight
            FROM (SELECT unnest(range({_SIZE // 2})) AS b), (SELECT unnest(range({_MELS})) AS m)),
        mels AS (SELECT key, f, m, ln(greatest(sum(p * weight), 1.1920928955078125e-07::DOUBLE)) AS value
            FROM power JOIN bank USING (b) GROUP BY key, f, m)"""


def _mels(spark, sf):
    rows = fx.wave(spark, sf).withColumn("sample_rate", F.lit(16000))
    return features.log_mel(rows, n_mels=_MELS, frame_ms=1.0, hop_ms=0.5)


@query(
    f"WITH {_log_mel_sql()} SELECT key, CAST(f AS BIGINT) AS frame, CAST(m AS BIGINT) AS mel, round(value, 6) + 0.0 AS value FROM mels",
    ["wave"],
)
def log_mel_table(spark, sf):
    rows = features.long_features(_mels(spark, sf))
    place = [F.col(c).cast("bigint").alias(c) for c in ("frame", "mel")]
    return rows.select("key", *place, F.round("value", 6).alias("value"))


_FRAMED = """frames AS (SELECT key, CAST(unnest(range(len(samples) // 8)) AS INT) AS frame, samples FROM signal),
        long AS (SELECT key, frame, CAST(unnest(range(8)) AS INT) AS mel, unnest(samples[frame * 8 + 1 : frame * 8 + 8]) AS value FROM frames)"""


def _framed(spark, sf):
    """Each signal cut into frames of 8 values, standing for 8 mel bands."""
    count = F.floor(F.size("samples") / 8).cast("int")
    matrix = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice("samples", i * 8 + 1, F.lit(8)))
    empty = F.array().cast("array<array<double>>")
    return fx.signal(spark, sf).withColumn("features", F.when(count > 0, matrix).otherwise(empty))


@query(
    f"""WITH {_FRAMED} SELECT key, frame, mel, round((value - avg(value) OVER b) / sqrt(var_samp(value) OVER b + 1e-5), 6) + 0.0 AS value
        FROM long WINDOW b AS (PARTITION BY key, mel)""",
    ["signal"],
)
def mel_normalized(spark, sf):
    rows = features.normalize_mel(features.long_features(_framed(spark, sf)))
    return rows.withColumn("value", F.round("value", 6))


_BATCHED = """b AS (SELECT key, user_id, segment // 2 AS batch_id, len(samples) // 8 AS n, samples,
            max(len(samples) // 8) OVER (PARTITION BY user_id, segment // 2) AS longest FROM signal),
        p AS (SELECT key, n, CAST(ceil(longest / 2.0) * 2 AS BIGINT) AS target, samples FROM b)"""


@query(
    f"""WITH {_BATCHED} SELECT key, target AS n_frames, CAST(least(n, target) AS BIGINT) AS n_valid,
        round(coalesce(list_sum(samples[1 : n * 8]), 0) + (target - n) * 8, 4) + 0.0 AS total FROM p""",
    ["signal"],
)
def padded_features(spark, sf):
    batched = ordering.assign_batches(_framed(spark, sf), 2, ["user_id"], "segment")
    padded = features.pad_features(batched, ["user_id", "batch_id"], value=1.0, dims=8)
    return padded.select(
        "key", F.size("features").cast("bigint").alias("n_frames"),
        F.aggregate("attention_mask", F.lit(0), lambda s, v: s + v).cast("bigint").alias("n_valid"),
        F.round(F.aggregate(F.flatten("features"), F.lit(0.0), lambda s, v: s + v), 4).alias("total"),
    )


@query(
    f"""WITH {_BATCHED}, s AS (SELECT key, n, samples, CAST(unnest(range(target // 2)) AS BIGINT) AS frame FROM p)
        SELECT key, frame, 16 AS dims, CAST(CASE WHEN frame * 2 + 1 < n THEN 1 ELSE 0 END AS INT) AS mask,
        round(coalesce(list_sum(samples[frame * 16 + 1 : least(frame * 16 + 16, n * 8)]), 0), 4) + 0.0 AS total FROM s""",
    ["signal"],
)
def stacked_frames(spark, sf):
    batched = ordering.assign_batches(_framed(spark, sf), 2, ["user_id"], "segment")
    stacked = features.stack_frames(features.pad_features(batched, ["user_id", "batch_id"], dims=8))
    rows = stacked.select("key", "attention_mask", F.posexplode("features").alias("frame", "joined"))
    return rows.select(
        "key", F.col("frame").cast("bigint").alias("frame"), F.size("joined").alias("dims"),
        F.get("attention_mask", "frame").alias("mask"),
        F.round(F.aggregate("joined", F.lit(0.0), lambda s, v: s + v), 4).alias("total"),
    )


def half_gain(scale: float):
    """Model factory: the chunk scaled, nothing restored."""
    return lambda batch: batch * scale


@query(
    """WITH m AS (SELECT key, list_transform(samples, lambda v: v / 2) AS y FROM wave) """ + sql_long("m"), ["wave"]
)
def restored_batches(spark, sf):
    restored = restore.restore(fx.wave(spark, sf), half_gain, 16, batch_size=7, chunk_seconds=0.1, config={"scale": 0.5})
    return samples_long(restored.withColumn("restored", F.col("restored").cast("array<double>")), ["key"], "restored")


def picky(limit: float):
    """Model factory that refuses batches holding a sample above the limit."""

    def run(batch):
        if batch.max() > limit:
            raise ValueError("too loud")
        return batch

    return run


@query("SELECT key, list_max(samples) > 0.35 AS failed FROM wave", ["wave"])
def retried_rows(spark, sf):
    """A failing batch costs only its failing rows."""
    done = restore.restore(
        fx.wave(spark, sf), picky, 16, batch_size=16, chunk_seconds=0.1, on_error="quarantine", config={"limit": 0.35}
    )
    return done.select("key", F.col("status").isNotNull().alias("failed"))


@query("SELECT key, round(list_sum(samples) * 3, 6) + 0.0 AS total FROM wave", ["wave"])
def user_map(spark, sf):
    tripled = lambda df: df.withColumn("samples", F.transform("samples", lambda v: v * 3))
    out = restore.apply(fx.wave(spark, sf), tripled)
    return out.select("key", F.round(F.aggregate("samples", F.lit(0.0), lambda s, v: s + v), 6).alias("total"))


@query("SELECT key, CAST(unnest(range(1 + key % 3)) AS BIGINT) AS copy FROM wave WHERE key % 4 <> 0", ["wave"])
def user_generator(spark, sf):
    """A generator that drops every fourth row and repeats the others one to three times."""
    import pyarrow as pa

    def fan(batches):
        for batch in batches:
            rows = [(k, c) for k in batch.column("key").to_pylist() if k % 4 for c in range(1 + k % 3)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in rows], pa.int64()), pa.array([c for _, c in rows], pa.int64())], names=["key", "copy"]
            )

    return restore.apply_batches(fx.wave(spark, sf).select("key"), fan, "key bigint, copy bigint")

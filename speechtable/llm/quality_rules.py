"""Quality rules: base counts and a hashed n-gram likelihood ratio, as DataFrame expressions only.

Words and word pairs fall into ``buckets`` hash buckets. Two multinomials are counted over whole texts: the raw corpus (all rows) and the
trusted target (rows whose ids the caller trusts). A bucket's weight is the logarithm of target over raw probability, both smoothed by
``PRIOR`` counts at the target's size, so that a bucket seen rarely says little in a small corpus; it is fixed to whole millionths,
so sums do not depend on any order. A document's score is the sum of the weights of its n-grams divided by their number; it is kept if the base
rules pass and the score reaches the threshold.

Scale: trusted ids meet the documents in one join by id; the id is the only key. One pass over the joined texts explodes n-grams into a partial
aggregate of at most ``buckets`` groups per task that counts both multinomials; scoring needs no shuffle. The driver sees two
sums per bucket, a fixed number.

Null or empty texts have no words and fail the base rules. Without trusted documents all weights are zero and the base rules
decide alone. Repeated ids are rows of their own (a trusted id trusts them all); other columns are ignored.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechtable.llm import textstats

BUCKETS = 1 << 18
UNIT = 1_000_000
#: Counts added to a bucket's target count and to the count the raw corpus lets expect there.
PRIOR = 4.0
THRESHOLD = -0.3


def grams(word_col: str, buckets: int) -> Column:
    """Buckets of all single words and word pairs."""
    w = F.col(word_col)
    place = lambda h: F.pmod(h, F.lit(buckets)).cast("int")
    single = F.transform(w, lambda a: place(F.xxhash64(a)))
    pair = F.transform(textstats.tail(word_col, 1), lambda a, i: place(F.xxhash64(a, F.get(w, i + 1))))
    return F.concat(single, pair)


def bucket_counts(docs: DataFrame, text_col: str, buckets: int, flag: str) -> DataFrame:
    """(bucket, n, n_flagged) over all rows, and over those whose ``flag`` is true."""
    split = docs.select(textstats.words(F.col(text_col)).alias("_w"), F.col(flag).alias("_flag"))
    return split.select(F.explode(grams("_w", buckets)).alias("bucket"), "_flag").groupBy("bucket").agg(
        F.count("*").alias("n"), F.count_if("_flag").alias("n_flagged"))


def weights(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> list[int]:
    """Log-likelihood ratio of each bucket in millionths. ``trusted`` has the trusted ids in ``id_col``."""
    # Trusted ids grow with the corpus: one plan at every size, never a broadcast of them.
    ids = trusted.select(F.col(id_col).alias("_id")).where("_id IS NOT NULL").distinct().hint("merge")
    rows = docs.select(F.col(id_col).alias("_key"), F.col(text_col).alias("_text"))
    # Rows without an id are trusted by nobody; as one key of the join they would meet in one task.
    known = rows.where("_key IS NOT NULL").join(ids, F.col("_key") == F.col("_id"), "left").select("_text", F.col("_id").isNotNull().alias("_trusted"))
    rows = known.unionByName(rows.where("_key IS NULL").select("_text", F.lit(False).alias("_trusted")))
    counts = np.zeros((2, buckets))
    found = bucket_counts(rows, "_text", buckets, "_trusted").toArrow()
    for kind, name in enumerate(("n", "n_flagged")):
        counts[kind, found["bucket"].to_numpy()] = found[name].to_numpy()
    raw, target = counts
    if not target.sum():
        return [0] * buckets
    ratio = (target + PRIOR) / (raw * (target.sum() / raw.sum()) + PRIOR)
    return np.rint(UNIT * np.log(ratio)).astype(int).tolist()


def judge(docs: DataFrame, weight: list[int], text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score, base_failed and kept.

    Input columns of these names are replaced.
    """
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept")
    if {"_w", "_lines", "_grams", "_window", "_sorted", "_places"} & set(docs.columns):
        # Columns named like those below travel as part of one column.
        found = judge(docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text")), weight, "text", threshold)
        return found.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in added or c == text_col], *added)
    text = F.coalesce(F.col(text_col), F.lit(""))
    table = F.from_json(F.lit(json.dumps(weight, separators=(",", ":"))), "array<long>")
    df = docs.drop(*(c for c in added if c != text_col)).withColumns({"_w": textstats.words(text), "_lines": textstats.lines(text)})
    df = textstats.with_repeat_words(df, "_w", "n_repeat_words").withColumn("_grams", grams("_w", len(weight)))
    total = F.aggregate("_grams", F.lit(0).cast("long"), lambda s, b: s + F.get(table, b))
    df = df.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": textstats.chars_without(text, textstats.SPACES).cast("long"),
        "n_symbols": (F.length(text) - textstats.chars_without(text, textstats.SYMBOLS)).cast("long"),
        "n_dup_lines": textstats.duplicates("_lines").cast("long"),
        "score": F.when(F.size("_grams") > 0, total / F.size("_grams") / UNIT).otherwise(F.lit(0.0)),
    }).drop("_w", "_lines", "_grams")
    df = df.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    return df.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))

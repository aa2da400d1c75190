"""Counts of a text as Spark expressions: no Python runs below them.

Words are runs of anything but space, tab, newline, vertical tab, form feed and carriage return. A null text has no words.
Arrays are columns of their own before several expressions read them, so that each is computed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = " \t\n\x0b\f\r"
#: Regular expression of white space between words.
SPACES = "[\\x20\\x09-\\x0D]+"
#: Characters counted as symbols.
SYMBOLS = "[#*$%&|<>]+"


def settled(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet a condition on computed columns, without the condition moving below the columns it reads.

    Pushed down, it would repeat their expressions inside array functions, once per element. A filter does not pass a projection with a
    row number, and none is negative.
    """
    return df.withColumn("_number", F.monotonically_increasing_id()).where(condition & (F.col("_number") >= 0)).drop("_number")


def words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(_SPACE))
    return F.when(inner.isNull() | (inner == ""), F.array().cast("array<string>")).otherwise(F.split(inner, SPACES))


def chars_without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def lines(text: Column) -> Column:
    """\\n-split lines with a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_SPACE)) != "")


def duplicates(items: str) -> Column:
    """Elements equal to an earlier element."""
    return F.size(items) - F.size(F.array_distinct(items))


def tail(array: str, n: int) -> Column:
    """All but the last n elements."""
    return F.slice(array, F.lit(1), F.greatest(F.size(array) - n, F.lit(0)))


def with_repeat_words(df: DataFrame, word_col: str, out: str) -> DataFrame:
    """Words in three-word windows found twice or more in the row's words, the first one included.

    Windows are compared by 64-bit hashes of one row. Sorting (hash, place) puts equal windows beside each other, so a text of n words
    costs n log n; texts without a repeat stop at the distinct count.
    """
    w, found = F.col(word_col), "_window"
    df = df.withColumn(found, F.transform(tail(word_col, 2), lambda a, i: F.xxhash64(a, F.get(w, i + 1), F.get(w, i + 2))))
    df = df.withColumn("_sorted", F.when(duplicates(found) > 0, F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("_sorted")
    twin = lambda e, i: ((i > 0) & (F.get(s, F.greatest(i - 1, F.lit(0)))["h"] == e["h"])) | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False))
    df = df.withColumn("_places", F.sort_array(F.transform(F.filter("_sorted", twin), lambda e: e["i"])))
    steps = F.zip_with("_places", F.slice("_places", F.lit(2), F.greatest(F.size("_places"), F.lit(1))),
                       lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    total = F.aggregate(steps, F.lit(0), lambda s, x: s + x)
    return df.withColumn(out, F.coalesce(total, F.lit(0)).cast("long")).drop(found, "_sorted", "_places")

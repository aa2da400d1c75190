"""Keys, metadata, sample rates, schema conformance and the error policy."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechtable.functions import waves


def require_columns(df: DataFrame, audio: str, key: str | None = None) -> str | None:
    """Check the audio column; return the key column, or None (with a warning) to use the index."""
    if audio not in df.columns:
        raise ValueError(f"Column '{audio}' not found in the source table")
    if key is not None and key not in df.columns:
        warnings.warn(f"column '{key}' not found; keys fall back to the row index", stacklevel=2)
        return None
    return key


def with_key(df: DataFrame, key_col: str | None, split: str, ordinal: str = "ordinal", name: str = "key") -> DataFrame:
    """Key column as string where present, else '{split}-{ordinal:09d}'."""
    generated = F.format_string(f"{split.replace('%', '%%')}-%09d", F.col(ordinal).cast("bigint"))
    given = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    return df.withColumn(name, F.coalesce(given, generated))


def audio_column(df: DataFrame, name: str | None = None, to: str = "audio") -> DataFrame:
    """Rename the audio column to ``to``: the named one, else the first whose name contains 'audio'."""
    found = name if name is not None else next((c for c in df.columns if "audio" in c), None)
    if found is None or found not in df.columns:
        raise ValueError("no audio column found")
    return df.withColumnRenamed(found, to)


def _metadata_columns(df: DataFrame, audio_col: str, key_col: str) -> list[Column]:
    kept = [F.col(c) for c in df.columns if c not in (audio_col, key_col)]
    return [F.col(key_col).cast("string").alias(key_col), *kept]


def metadata_struct(df: DataFrame, audio_col: str, key_col: str = "key", name: str = "meta") -> DataFrame:
    """All columns but the audio gathered in one struct."""
    return df.withColumn(name, F.struct(*_metadata_columns(df, audio_col, key_col)))


def metadata_json(df: DataFrame, cols: Sequence[str], name: str = "metadata") -> DataFrame:
    """Columns as one JSON object without null fields, non-ASCII text kept as it is."""
    return df.withColumn(name, F.to_json(F.struct(*cols), {"ignoreNullFields": "true"}))


def transcript(df: DataFrame, text_col: str, name: str = "transcript") -> DataFrame:
    """The text where there is any, else null."""
    text = F.col(text_col).cast("string")
    return df.withColumn(name, F.when(F.length(text) > 0, text))


def resolve_rate(df: DataFrame, cols: Sequence[str], default: int | None = None, name: str = "sample_rate") -> DataFrame:
    """First known rate of ``cols``, else the default; unresolved rows keep null."""
    return df.withColumn(name, F.coalesce(*[F.col(c).cast("int") for c in cols], F.lit(default).cast("int")))


def branch(df: DataFrame, col: str, names: Sequence[str] = ("clean", "noisy")) -> DataFrame:
    """Copies of one column under several names."""
    return df.withColumns({n: F.col(col) for n in names})


def split_quarantine(df: DataFrame, checks: dict[str, Column], on_error: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """(good, bad) by checks {reason: condition that marks a bad row}; first reason wins.

    With on_error="fail" the first bad row met at run time fails the job with its reason.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError("on_error must be 'fail' or 'quarantine'")
    reasons = [F.when(F.coalesce(bad, F.lit(False)), F.lit(reason)) for reason, bad in checks.items()]
    marked = df.withColumn("reason", F.coalesce(*reasons, F.lit(None).cast("string")))
    if on_error == "fail":
        raised = F.when(F.col("reason").isNotNull(), F.raise_error(F.col("reason")).cast("string"))
        checked = marked.withColumn("reason", raised)
        # The filter keeps every row that did not raise and stops column pruning of the check.
        return checked.filter(F.col("reason").isNull()).drop("reason"), marked.limit(0)
    return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())


def drop_nan(df: DataFrame, cols: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """Rows whose waveforms hold no NaN or null sample; optional columns count where present."""
    present = [*cols, *[c for c in optional if c in df.columns]]
    keep = F.lit(True)
    for c in present:
        keep = keep & ~waves.has_nan(F.col(c))
    return df.filter(keep)


def nan_to_num(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, waves.finite(F.col(col)))


def flag_truncated(df: DataFrame, n: int, col: str = "samples") -> DataFrame:
    """Mark rows longer than the chunk they will be cut to."""
    return df.withColumn("truncated", F.size(col) > n)


def align_lengths(df: DataFrame, a: str, b: str, tol: int = 480) -> tuple[DataFrame, DataFrame]:
    """Cut both waveforms to the shorter; rows differing by more than ``tol`` samples are bad."""
    gap = F.abs(F.size(a) - F.size(b))
    good, bad = split_quarantine(df, {"length deviation": gap > tol})
    shorter = F.least(F.size(a), F.size(b))
    return good.withColumns({c: waves.cut(F.col(c), 0, shorter) for c in (a, b)}), bad


def conform(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Cast to the declared schema; when it does not fit, warn and keep the table as it is."""
    try:
        fitted = df.to(schema)
        fitted.schema  # the analysis error, if any, appears here and not at run time
        return fitted
    except AnalysisException as error:
        if strict:
            raise
        warnings.warn(f"table does not fit the declared schema, kept uncast: {error}", stacklevel=2)
        return df


def concat_blocks(blocks: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    """Result blocks as one table of the declared schema; no block gives an empty table of the active session."""
    if not blocks:
        return SparkSession.active().createDataFrame([], schema)
    whole = blocks[0]
    for block in blocks[1:]:
        whole = whole.unionByName(block, allowMissingColumns=True)
    return conform(whole.select(*[c for c in whole.columns if c in schema.names]), schema)


def to_object_uri(df: DataFrame, col: str, scheme: str = "s3a") -> DataFrame:
    """Manifest entries as URIs of the Hadoop scheme that fetches them."""
    bare = F.regexp_replace(F.trim(F.col(col)), r"^pipe:.*?(s3://\S+).*$", "$1")
    return df.withColumn(col, F.regexp_replace(bare, r"^s3://", f"{scheme}://"))


def _suffix(kind: T.DataType) -> str:
    # Field suffixes by value type.
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType)):
        return "pth"
    if isinstance(kind, T.StringType):
        return "txt"
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "index"
    return "pickle"


def encode_record(df: DataFrame, seed: str = "record", identity: Sequence[str] = ()) -> DataFrame:
    """Rename each column by its type's suffix and add a hashed ``__key__``.

    Waveforms stay typed arrays (the shard sink writes them as raw little-endian float32);
    other nested values become JSON. The key is made of all values, waveforms included, and of the ``identity`` columns
    (source key, ordinal, crop), which go along as they are: name them where whole rows may be equal.
    """
    encoded = []
    for field in df.drop(*identity).schema:
        value = F.col(field.name)
        suffix = _suffix(field.dataType)
        if suffix == "pickle":
            nested = isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType))
            value = F.to_json(value) if nested else value.cast("string")
        encoded.append(value.alias(f"{field.name}.{suffix}"))
    plain = F.to_json(F.struct(*[f.name for f in df.schema if _suffix(f.dataType) != "pth"]))
    # Two 64-bit hashes stand for a waveform; its samples need not become text.
    audio = [F.xxhash64(f.name, F.lit(k)).cast("string") for f in df.schema if _suffix(f.dataType) == "pth" for k in (1, 2)]
    return df.select(F.sha2(F.concat_ws("|", F.lit(seed), plain, *audio), 256).alias("__key__"), *encoded, *identity)

"""Columnar corpora: reading, streaming, export, completion markers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechtable.operators.ordering import dense_ordinal
from speechtable.sources import files


def read_corpus(
    spark: SparkSession, path: str, split: str | None = None, columns: Sequence[str] | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """A Parquet corpus, one split of it, only the named columns; unique ``order`` columns add a dense ordinal."""
    df = spark.read.parquet(path)
    if split is not None:
        df = df.filter(F.col("split") == split)
    if columns is not None:
        df = df.select(*columns)
    return dense_ordinal(df, order, unique=True) if order else df


def stream_corpus(spark: SparkSession, path: str, max_files: int, schema: T.StructType | None = None) -> DataFrame:
    """The same corpus as micro-batches of at most ``max_files`` files."""
    schema = schema or spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def export_corpus(df: DataFrame, path: str, max_rows: int | None = None, mode: str = "errorifexists") -> bool:
    """Write Parquet with at most ``max_rows`` rows per file; False, and no folder, for an empty table.

    Rows are counted by the write itself, so the table is computed once.
    """
    if mode not in ("errorifexists", "append"):
        raise ValueError("mode must be 'errorifexists' or 'append'")
    rows = Observation("export")
    writer = df.observe(rows, F.count(F.lit(1)).alias("n")).write.mode(mode)
    if max_rows is not None:
        writer = writer.option("maxRecordsPerFile", max_rows)
    writer.parquet(path)
    if rows.get["n"]:
        return True
    if mode == "errorifexists":
        system, inner = files.locate(path)
        system.delete_dir(inner)  # the empty folder this call made
    return False


def write_split(df: DataFrame, root: str, run: str, max_rows: int | None = None) -> None:
    """Write rows below split=/run= folders; a repeated run replaces only its own folders."""
    writer = df.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if max_rows is not None:
        writer = writer.option("maxRecordsPerFile", max_rows)
    writer.partitionBy("split", "run").parquet(root)


_MARKERS = T.StructType([T.StructField("unit", T.StringType()), T.StructField("split", T.StringType())])


def mark_completed(units: DataFrame, path: str) -> None:
    """Append (unit, split) markers; call it after the output is committed."""
    units.select(F.col("unit").cast("string"), F.col("split").cast("string")).write.mode("append").parquet(path)


def completed_units(spark: SparkSession, path: str) -> DataFrame:
    """Markers written so far; none when the table does not exist yet."""
    try:
        return spark.read.schema(_MARKERS).parquet(path).distinct()
    except AnalysisException:
        return spark.createDataFrame([], _MARKERS)

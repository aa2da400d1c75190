"""Continuous restoration: micro-batches in, Parquet out, resumable through the checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from speechtable.operators.restore import restore


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to Parquet until the available input is used up."""
    return (
        df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def restore_stream(
    sdf: DataFrame, model_factory: Callable[..., Callable], path: str, checkpoint: str, target_rate: int, **options
) -> StreamingQuery:
    """Restore each micro-batch and append it; a restart goes on where the checkpoint stands."""
    return write_stream(restore(sdf, model_factory, target_rate, **options), path, checkpoint)

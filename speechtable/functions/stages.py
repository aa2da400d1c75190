"""Arrow-batched waveform stages.

A stage is one ``mapInArrow`` over the frame, so several kernels run on a waveform while it is in
Python. Columns the caller no longer needs are dropped on the way in, the others pass through
untouched. Spark bounds each batch by bytes (``spark.sql.execution.arrow.maxBytesPerBatch``), so
long waveforms make small batches. (An ``arrow_udf`` column would leave other columns in the JVM,
but Spark 4.1 does not extract it when a nested lambda over structs is collapsed into its input.)
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATUS = "status"


ENGINES = ("native", "arrow")


def is_arrow(engine: str) -> bool:
    """Operators with both forms: "arrow" for waveforms (the default), "native" for short arrays without Python."""
    if engine not in ENGINES:
        raise ValueError(f"engine must be one of {ENGINES}")
    return engine == "arrow"


def sample_type(df: DataFrame, col: str) -> str:
    """Element type name of a waveform column ('float' or 'double')."""
    return df.schema[col].dataType.elementType.simpleString()


def _column(array: pa.Array):
    """Per-row access: lists give NumPy views on the batch buffer (nested ones, lists of views)."""
    if not pa.types.is_list(array.type):
        return array.to_pylist()
    numeric = pa.types.is_floating(array.type.value_type) or pa.types.is_integer(array.type.value_type)
    values = array.values.to_numpy(zero_copy_only=False) if numeric else _column(array.values)
    offsets = array.offsets.to_numpy()
    valid = array.is_valid().to_numpy(zero_copy_only=False)
    return [values[offsets[i] : offsets[i + 1]] if valid[i] else None for i in range(len(array))]


def _list_array(rows: list, item: pa.DataType) -> pa.Array:
    """List column of ``item`` from arrays, nested arrays or None, without per-sample objects."""
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([0 if r is None else len(r) for r in rows], out=offsets[1:])
    if pa.types.is_list(item):
        flat = _list_array([x for r in rows if r is not None for x in r], item.value_type)
    else:
        parts = [np.asarray(r, dtype=item.to_pandas_dtype()) for r in rows if r is not None and len(r)]
        flat = pa.array(np.concatenate(parts) if parts else [], type=item)
    mask = pa.array([r is None for r in rows]) if any(r is None for r in rows) else None
    return pa.ListArray.from_arrays(pa.array(offsets), flat, mask=mask)


def _to_arrow(rows: list, kind: pa.DataType) -> pa.Array:
    return _list_array(rows, kind.value_type) if pa.types.is_list(kind) else pa.array(rows, type=kind)


def _kept(value, kind: pa.DataType):
    """A waveform in its column's precision, so that a batch does not pile up in double."""
    if isinstance(value, np.ndarray) and pa.types.is_list(kind) and pa.types.is_float32(kind.value_type):
        return value.astype(np.float32, copy=False)
    return value


_ARROW = {"float": pa.float32(), "double": pa.float64(), "int": pa.int32(), "bigint": pa.int64(),
          "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}


def _arrow_type(t: T.DataType) -> pa.DataType:
    return pa.list_(_arrow_type(t.elementType)) if isinstance(t, T.ArrayType) else _ARROW[t.simpleString()]


def _name(c: str) -> Column:
    return F.col(f"`{c}`")


def inputs_by_name(inputs: Sequence) -> set[str]:
    return {c for c in inputs if isinstance(c, str)}


def with_batches(df: DataFrame, run: Callable, ddl: str, inputs: Sequence, drop: Sequence[str] = ()) -> DataFrame:
    """Append the fields of ``ddl``: ``run`` gets iterators over the input arrays of each batch and
    yields one list of arrays per batch. Inputs are column names, or expressions for the stage only.
    """
    fields = T.StructType.fromDDL(ddl)
    added = [f.name for f in fields]
    kept = [c for c in df.columns if c not in added and c not in drop]
    needed = [c for c in df.columns if c in kept or c in inputs_by_name(inputs)]
    expressions = [c for c in inputs if not isinstance(c, str)]
    # Positions, not names: mapInArrow cannot address names with dots.
    place = {c: i for i, c in enumerate(needed)}
    given = iter(range(len(needed), len(needed) + len(expressions)))
    taken = [place[c] if isinstance(c, str) else next(given) for c in inputs]
    passed = [place[c] for c in kept]
    names = [*kept, *added]
    schema = T.StructType([*[df.schema[c] for c in kept], *fields])

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing = []

        def arrays():
            for batch in batches:
                passing.append([batch.column(i) for i in passed])
                yield [batch.column(i) for i in taken]

        for out in run(arrays()):
            yield pa.RecordBatch.from_arrays([*passing.pop(0), *out], names=names)

    columns = [*[_name(c) for c in needed], *expressions]
    return df.select(*[c.alias(f"_c{i}") for i, c in enumerate(columns)]).mapInArrow(stage, schema)


def with_stage(
    df: DataFrame, kernel: Callable, ddl: str, inputs: Sequence, on_error: str = "fail", drop: Sequence[str] = ()
) -> DataFrame:
    """Append the fields of ``ddl`` from ``kernel(*row values)``, which returns one value per field.

    With on_error="quarantine" a raising row gets null fields and its message in ``status``; with
    "fail" the task fails.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError("on_error must be 'fail' or 'quarantine'")
    fields = T.StructType.fromDDL(ddl)
    kinds = [_arrow_type(f.dataType) for f in fields]
    keep_going = on_error == "quarantine"

    def run(batches):
        for columns in batches:
            rows, notes = [], []
            for values in zip(*(_column(c) for c in columns)):
                try:
                    rows.append([_kept(v, kind) for v, kind in zip(kernel(*values), kinds)])
                    notes.append(None)
                except Exception as error:  # a bad row, reported through its status
                    if not keep_going:
                        raise
                    rows.append((None,) * len(kinds))
                    notes.append(f"{type(error).__name__}: {error}")
            out = [_to_arrow([r[j] for r in rows], kind) for j, kind in enumerate(kinds)]
            yield [*out, pa.array(notes, type=pa.string())] if keep_going else out

    return with_batches(df, run, f"{ddl}, {STATUS} string" if keep_going else ddl, inputs, drop)

"""A user's Python function applied to every row (O-55, O-56).

Column expressions stay the fast way; this is for code that has none.  Rows go
to Python in Arrow batches, only with the columns the function reads; the other
columns pass by untouched.  No shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import ship_package

#: Rows whose Python objects are held at a time.
BATCH_ROWS = 4096


def apply_rows(df: DataFrame, fn: Callable[..., Any], inputs: Sequence[str], out: str,
               params: Mapping[str, Any] | None = None, on_error: str = "error", key: str | None = None,
               batch_rows: int = BATCH_ROWS) -> DataFrame:
    """``df`` plus the columns ``out`` (a schema like ``"cost double, label string"``),
    made by ``fn(row, **params)`` from each row's ``inputs`` (a dict).

    The function gives one value for one column, else a tuple with one value per
    column; None is null everywhere.  A null input reaches the function as None; an
    empty table never calls it.  ``params`` are bound once and sent with the job, so
    they should be small.  A row that raises, or gives a value of another type,
    fails the job with the value of ``key`` (or the inputs) in the message; with
    ``on_error="null"`` its columns are null and ``_error`` says why."""
    if on_error not in ("error", "null"):
        raise ValueError("on_error must be 'error' or 'null'")
    ship_package(df.sparkSession)
    declared = T._parse_datatype_string(out)
    added = declared.fields + ([T.StructField("_error", T.StringType())] if on_error == "null" else [])
    clash = [f.name for f in added if f.name in df.columns]
    if clash:
        raise ValueError(f"columns exist already: {clash}")
    types = list(to_arrow_schema(declared).types)
    bound, inputs, lenient, width = dict(params or {}), list(inputs), on_error == "null", len(types)

    def values(row: dict, name: str) -> tuple[tuple, str | None]:
        try:
            found = fn(row, **bound)
            found = (found,) if width == 1 else tuple(found) if found is not None else (None,) * width
            if len(found) != width:
                raise ValueError(f"{len(found)} values for {width} columns")
            for v, t in zip(found, types):
                pa.scalar(v, t)
            return found, None
        except Exception as e:
            if lenient:
                return (None,) * width, f"{type(e).__name__}: {e}"
            raise ValueError(f"the function failed for {name}: {type(e).__name__}: {e}") from e

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, batch_rows):
                batch = whole.slice(at, batch_rows)
                rows = batch.select(inputs).to_pylist()
                names = ([f"{key} = {k!r}" for k in batch[key].to_pylist()] if key else map(str, rows))
                done = [values(r, n) for r, n in zip(rows, names)]
                made = [pa.array([v[i] for v, _ in done], t) for i, t in enumerate(types)]
                if lenient:
                    made.append(pa.array([e for _, e in done], pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *[f.name for f in added]])
    return df.mapInArrow(run, T.StructType([*df.schema.fields, *added]))

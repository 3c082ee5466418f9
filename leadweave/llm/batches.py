"""Row functions over Arrow batches: columns that aren't touched pass through as they are."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_ARROW = {T.ArrayType(T.LongType()): pa.list_(pa.int64()), T.ByteType(): pa.int8(), T.StringType(): pa.string(), T.LongType(): pa.int64(), T.BooleanType(): pa.bool_(), T.IntegerType(): pa.int32()}


@contextmanager
def uncollected() -> Iterator[None]:
    """Without Python's cycle collector, which walks through all rows and caches again and again: rows hold no cycles."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def with_row_function(df: DataFrame, make: Callable[[], Callable], inputs: list[str], outputs: str, keep: list[str]) -> DataFrame:
    """``keep`` and the columns ``outputs`` (a schema of strings, numbers, booleans and lists of longs), computed row by row.

    ``make`` runs once a task and gives the function; it takes the values of ``inputs``, texts, and returns a tuple.
    """
    out = T._parse_datatype_string(outputs)
    schema = T.StructType([df.schema[c] for c in keep] + out.fields)
    kinds = [_ARROW[f.dataType] for f in out.fields]
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            with uncollected():
                # by way of numpy: many times faster than to_pylist, and texts and NULLs stay what they are
                got = [f(*row) for row in zip(*[b.column(c).to_numpy(zero_copy_only=False).tolist() for c in inputs], strict=True)]
                cols = zip(*got, strict=True) if got else [()] * len(kinds)
                out_batch = pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)
                del got, cols
            yield out_batch

    return df.select(*dict.fromkeys([*keep, *inputs])).mapInArrow(run, schema)

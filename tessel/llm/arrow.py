"""Small helpers for functions over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

#: Bytes of text that a worker takes from a batch at once, about; a longer text comes alone.
SLICE_BYTES = 1 << 20
_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32(), "double": pa.float64(), "array<long>": pa.list_(pa.int64())}


def slices(batch: pa.RecordBatch, column: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batch``, each with about ``size`` bytes in ``column``, whatever the number of rows."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    before = np.cumsum(lengths + 64) - lengths - 64
    at = 0
    while at < len(batch):
        end = max(at + 1, int(np.searchsorted(before, before[at] + size)))
        yield batch.slice(at, end - at)
        at = end


def table(columns: list, schema: str) -> pa.RecordBatch:
    """A record batch of ``columns`` with the names and types of a Spark schema string."""
    fields = [x.split() for x in schema.split(", ")]
    made = [c if isinstance(c, pa.Array) else pa.array(c, _KINDS[k]) for c, (_, k) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(made, names=[n for n, _ in fields])


def named(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever they are called."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]

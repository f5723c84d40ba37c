"""Vectors in Arrow batches: matrices from columns and back, directions and angles."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import types as T

# The task functions travel with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_AT_ONCE = 1024
SLACK = 1e-6  # radians added to a radius, above any rounding of arccos


def unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vectors in double at length one, and which of them have a direction at all."""
    vectors = vectors.astype(np.float64)
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    good = np.isfinite(norms) & (norms > 0)
    return vectors / np.where(good, norms, 1.0)[:, None], good


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Float32 vectors, one per row, from arrays of floats or from their bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        sizes = pc.binary_length(column)
        values = np.frombuffer(b"".join(column.to_pylist()), dtype=np.float32)
    else:
        sizes = pc.list_value_length(column)
        values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float32, copy=False)
    if len(column) == 0:
        return np.zeros((0, 1), np.float32)
    if pc.min(sizes) != pc.max(sizes):
        raise ValueError("vectors differ in length")
    return values.reshape(len(column), -1)


def packed(vectors: np.ndarray) -> pa.Array:
    """Rows of a matrix as their bytes, which move faster than arrays of numbers."""
    width = vectors.shape[1] * vectors.itemsize
    offsets = np.arange(0, (len(vectors) + 1) * width, width, dtype=np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(vectors))]
    return pa.Array.from_buffers(pa.binary(), len(vectors), buffers)


def angles(units: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centres.T, -1.0, 1.0))


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def schema_with(schema: T.StructType, *extra: tuple[str, T.DataType]) -> T.StructType:
    """``schema`` with ``v`` as bytes, and the extra fields."""
    fields = [T.StructField("v", T.BinaryType()) if f.name == "v" else f for f in schema.fields]
    return T.StructType(fields + [T.StructField(name, dtype) for name, dtype in extra])

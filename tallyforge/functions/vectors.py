"""Array arithmetic: column expressions, and the Arrow-to-numpy step of the vector jobs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def squared_distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    squares = F.transform(a, lambda x: x * x)
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def elementwise_min(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.least(x, y))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x
    )


def normalised(a: Column, total: Column) -> Column:
    return F.transform(a, lambda x: x / total)


def matrix(column: pa.Array, dim: int | None = None) -> np.ndarray:
    """Rows of a list column as a float matrix; null entries become NaN."""
    rows = len(column)
    if column.null_count:
        raise ValueError("a vector is null")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if dim is None:
        dim = len(flat) // rows if rows else 0
    lengths = np.diff(column.offsets.to_numpy())
    if rows and not (lengths == dim).all():
        raise ValueError(f"every vector must have {dim} entries")
    return flat.reshape(rows, dim)


def list_column(values: np.ndarray) -> pa.ListArray:
    """Float matrix as a list column, one list per row."""
    rows, dim = values.shape
    offsets = np.arange(0, (rows + 1) * dim, dim, dtype=np.int32) if dim else np.zeros(rows + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(values).ravel()))

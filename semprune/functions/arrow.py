"""Arrow <-> NumPy conversions used inside Arrow functions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def list_matrix(column, dim: int | None = None, dtype=np.float64) -> np.ndarray:
    """Rows of an Arrow list column as a 2-D array; every row must have the same length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.empty((0, dim or 0), dtype=dtype)
    if column.null_count:
        raise ValueError("null vector")
    lengths = np.diff(column.offsets.to_numpy())
    width = int(lengths[0]) if dim is None else dim
    if (lengths != width).any():
        raise ValueError(f"vectors must all have {width} components")
    values = column.flatten()
    if values.null_count:
        raise ValueError("null vector component")
    return values.to_numpy(zero_copy_only=False).reshape(n, width).astype(dtype, copy=False)


def matrix_list(matrix: np.ndarray, value_type: pa.DataType) -> pa.ListArray:
    """Rows of a 2-D array as an Arrow list column."""
    n, width = matrix.shape
    offsets = np.arange(0, (n + 1) * width, width, dtype=np.int32) if width else np.zeros(n + 1, np.int32)
    values = pa.array(np.ascontiguousarray(matrix).ravel(), type=value_type)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

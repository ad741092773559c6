"""Reading vector columns in tasks: Arrow lists to matrices, rows of one length together."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vector_column(df: DataFrame, name: str) -> Column:
    """Column ``name`` as it is if it holds floats or doubles, else cast to doubles."""
    kind = df.schema[name].dataType.simpleString()
    column = F.col(f"`{name}`")
    return column if kind in ("array<float>", "array<double>") else column.cast("array<double>")


def matrices(column: pa.ListArray):
    """``(rows, matrix)`` for each length: the finite vectors of that length, as doubles.

    Rows that are null or hold a null or non-finite component are in no matrix.
    """
    size = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    end = np.cumsum(size)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    fine = column.is_valid().to_numpy(zero_copy_only=False) & (bad[end] == bad[end - size])
    for d in np.unique(size[fine]):
        rows = np.flatnonzero(fine & (size == d))
        yield rows, flat[(end - size)[rows][:, None] + np.arange(d)]


def packed(matrix: np.ndarray, kind: str) -> pa.Array:
    """One binary value a row."""
    width = matrix.shape[1] * np.dtype(kind).itemsize
    data = np.ascontiguousarray(matrix.astype(kind)).tobytes()
    return pa.array([data[i * width:(i + 1) * width] for i in range(len(matrix))], pa.binary())


def unpacked(column, kind: str, count: int) -> np.ndarray:
    """The matrix of a column of ``packed`` rows of one length."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).reshape(count, -1) if data else np.zeros((count, 0), kind)

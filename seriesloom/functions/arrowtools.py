"""Arrow columns as numpy matrices, inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def matrix_of(column: pa.ListArray) -> np.ndarray:
    """Vectors of one common length as rows; a missing element is NaN.  The column has no NULL vector."""
    if not len(column):
        return np.empty((0, 0))
    ends = pc.min_max(pc.list_value_length(column))
    if ends["min"].as_py() != ends["max"].as_py():
        raise ValueError(f"vectors have {ends['min']} to {ends['max']} elements")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(len(column), -1)


def padded_matrix(column: pa.ListArray) -> np.ndarray:
    """Vectors of any lengths as rows, filled up with NaN; a missing element is NaN.  The column has no NULL vector."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.full((len(lengths), int(lengths.max()) if len(lengths) else 0), np.nan)
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def groups_of(columns: list[pa.Array], rows: int) -> Iterator[tuple[tuple, np.ndarray]]:
    """Row numbers of every combination of values, in order of appearance."""
    if not columns:
        yield (), np.arange(rows)
        return
    codes = np.zeros(rows, dtype=np.int64)
    for column in columns:
        encoded = column.dictionary_encode(null_encoding="encode")
        codes = codes * max(len(encoded.dictionary), 1) + encoded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    cuts = np.flatnonzero(np.diff(codes[order])) + 1
    for members in np.split(order, cuts) if rows else []:
        first = int(members[0])
        yield tuple(column[first].as_py() for column in columns), members


def list_column(matrix: np.ndarray) -> pa.ListArray:
    """Rows of a matrix as vectors."""
    rows, width = matrix.shape
    offsets = np.arange(rows + 1, dtype=np.int32) * np.int32(width)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))

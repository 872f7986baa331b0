"""Whole-column codecs between ``array<float>`` and packed little-endian half floats."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

UNPACKED = "values array<float>, overflowed int"


def _spans(column: pa.Array) -> np.ndarray:
    """Offsets of a binary or list array as int64, honouring slices."""
    raw = np.frombuffer(column.buffers()[1], dtype=np.int32)
    return raw[column.offset : column.offset + len(column) + 1].astype(np.int64)


def pack_half(values: Column) -> Column:
    """Array column → binary column, two bytes per element, missing as NaN."""

    @F.arrow_udf("binary")
    def encode(column: pa.Array) -> pa.Array:
        spans = _spans(column)
        elements = column.values.slice(spans[0], spans[-1] - spans[0])
        floats = np.asarray(elements.to_numpy(zero_copy_only=False), dtype=np.float64)
        with np.errstate(over="ignore"):
            data = floats.astype("<f2").tobytes()
        offsets = ((spans - spans[0]) * 2).astype(np.int32)
        validity = pa.array(column.is_valid()).buffers()[1] if column.null_count else None
        return pa.Array.from_buffers(
            pa.binary(), len(column), [validity, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)]
        )

    return encode(values)


def unpack_half(packed: Column) -> Column:
    """Binary column → struct of the array and the number of overflowed elements.

    NaN becomes NULL.  Half floats end at 65504, so larger inputs were packed
    as ±infinity; those become NULL too and are counted in ``overflowed``.
    """

    @F.arrow_udf(UNPACKED)
    def decode(column: pa.Array) -> pa.Array:
        spans = _spans(column)
        if np.any(np.diff(spans) % 2):
            raise ValueError("packed half floats take an even number of bytes")
        data = column.buffers()[2]
        body = b"" if data is None else memoryview(data)[spans[0] : spans[-1]]
        floats = np.frombuffer(body, dtype="<f2").astype(np.float32)
        offsets = (spans - spans[0]) // 2
        infinite = np.concatenate([[0], np.cumsum(np.isinf(floats))])
        lists = pa.ListArray.from_arrays(
            pa.array(offsets.astype(np.int32)), pa.array(floats, mask=~np.isfinite(floats))
        )
        if column.null_count:
            lists = pa.ListArray.from_arrays(
                pa.array(offsets.astype(np.int32)), lists.values, mask=column.is_null()
            )
        counts = (infinite[offsets[1:]] - infinite[offsets[:-1]]).astype(np.int32)
        return pa.StructArray.from_arrays([lists, pa.array(counts)], names=["values", "overflowed"])

    return decode(packed)

"""Arrow strings as numpy code-point arrays and back, without a call per row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def as_string_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One contiguous array of type string."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # an empty one stays chunked in some releases
        column = pa.array([], pa.string())
    return column.cast(pa.large_string()).cast(pa.string()) if not pa.types.is_string(column.type) else column


def explode(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All code points of a string column in one array, and where each row starts (one entry more than rows). A null row is empty."""
    column = as_string_array(column)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None and bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
    try:
        points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    except UnicodeDecodeError:  # bytes that are no UTF-8 become U+FFFD, row by row; not met in valid tables
        rows = [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(bounds[:-1] - bounds[0], bounds[1:] - bounds[0])]
        return explode(pa.array(rows, pa.string()))
    lead = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=lead[1:])
    return points, lead[bounds - bounds[0]]


def implode(points: np.ndarray, starts: np.ndarray, nulls: np.ndarray | None = None) -> pa.Array:
    """The inverse of explode; nulls marks the rows that are null."""
    points = points.astype(np.uint32, copy=False)
    width = np.ones(len(points), np.int64)
    for least in (0x80, 0x800, 0x10000):
        width += points >= least
    total = np.zeros(len(points) + 1, np.int64)
    np.cumsum(width, out=total[1:])
    data = points.tobytes().decode("utf-32-le").encode("utf-8")
    out = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(total[starts].astype(np.int64).tobytes()), pa.py_buffer(data))
    if nulls is not None and nulls.any():
        out = pc.if_else(pa.array(~nulls), out, pa.scalar(None, pa.large_string()))
    return out.cast(pa.string())


def per_row(marks: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sum of marks over each row."""
    total = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]

"""Vector columns as numbers: which rows take part, and arrays of one Arrow column."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(good, F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, kind=np.float64) -> np.ndarray:
    """Rows of equal length as one array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, 1), kind)
    return np.asarray(column.flatten()).astype(kind).reshape(len(column), -1)


def pack(**arrays: np.ndarray) -> bytes:
    """Arrays as one value that a row can hold."""
    import io

    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack(data: bytes) -> dict[str, np.ndarray]:
    import io

    with np.load(io.BytesIO(data)) as held:
        return dict(held.items())

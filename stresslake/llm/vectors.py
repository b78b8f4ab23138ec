"""Helpers for vector columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(vector: Column) -> Column:
    """True for an array without NULL, NaN or infinite components; NULL gives False."""
    infinity = float("inf")
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinity))
    return F.coalesce(good, F.lit(False))


def rows_of(column: pa.ChunkedArray | pa.Array, dtype: type) -> np.ndarray:
    """A list column whose lists have equal length, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(n, len(flat) // n if n else 0)

"""Vectors of floating numbers as exact integers, in Spark columns and as numpy arrays of Arrow batches."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Integer components are held within these bounds, so that products and their sums stay exact in 64 bits.
LEAST, MOST = -(1 << 24), 1 << 24


def is_finite(vector: Column) -> Column:
    """Whether a vector is there and each of its components is: false, not null, where it is null."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~odd, F.lit(False))


def to_integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, x as double, held within LEAST and MOST."""
    held = lambda x: F.least(F.greatest(x.cast("double") * scale, F.lit(float(LEAST))), F.lit(float(MOST)))
    return F.transform(vector, lambda x: F.floor(held(x)).cast("int"))


def as_array(column, dims: int) -> np.ndarray:
    """A list column of an Arrow batch or table as rows of 64-bit integers; vectors shorter than dims end in zeros."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(size) and (size == dims).all():
        return flat.reshape(len(size), dims)
    out = np.zeros((len(size), dims), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out

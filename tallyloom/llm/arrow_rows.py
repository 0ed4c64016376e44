"""Small helpers for Arrow batches of fixed-length vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite_vector(column: str) -> Column:
    """True for vectors that are not null and whose components are all finite numbers."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.col(column).isNotNull() & F.coalesce(F.forall(column, good), F.lit(False))


def matrix(column: pa.Array, rows: np.ndarray, width: int, dtype) -> np.ndarray:
    """The lists of the given rows, all of length ``width``, as a matrix."""
    values = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
    return np.asarray(values, dtype=dtype).reshape(len(rows), width)


def by_width(column: pa.Array):
    """(width, row numbers) for each length that occurs in a column of lists."""
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    for width in np.unique(lengths).tolist():
        yield width, np.flatnonzero(lengths == width)

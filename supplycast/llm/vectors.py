"""Vectors as Arrow list columns, numpy matrices and packed blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(vector: str | Column) -> Column:
    """True for vectors without null, infinite or undefined components."""
    column = F.col(vector) if isinstance(vector, str) else vector
    good = F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return column.isNotNull() & F.coalesce(good, F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """List column as a float64 matrix; shorter vectors end with zeros."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    if (sizes == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.repeat(np.arange(len(sizes)), sizes), places(sizes)] = values
    return out


def places(sizes: np.ndarray) -> np.ndarray:
    """0 .. size - 1 for each size, one after another."""
    first = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) - np.repeat(first, sizes)


def ranked_dots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices, summed from the first component on.

    Unlike a matrix product it gives a pair the same last digit in every block that holds it.
    """
    total = np.zeros(len(left))
    for k in range(left.shape[1]):
        total += left[:, k] * right[:, k]
    return total

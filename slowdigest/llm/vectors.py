"""Embedding columns as whole numbers, for the operators that need exact arithmetic."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Larger floors are set to this; sums of two still fit a long.
LARGEST = 1 << 60


def named(name: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def usable(vector: Column) -> Column:
    """Not null, and without null, infinite or undefined components; an empty vector is usable."""
    finite = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(finite, F.lit(False))


def floored(vector: Column, scale: int) -> Column:
    """``floor(scale * component)`` per component as an array of longs, kept within ``LARGEST``."""
    whole = F.transform(vector.cast("array<double>"), lambda c: F.floor(c * F.lit(float(scale))))
    return F.transform(whole, lambda c: F.greatest(F.least(c, F.lit(LARGEST)), F.lit(-LARGEST)))


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of ``width`` longs; components beyond a vector's end are 0."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out

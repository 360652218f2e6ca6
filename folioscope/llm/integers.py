"""Vectors as bounded integers, for operators whose results must be exact."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

LIMIT = 1 << 27


def usable(vector: str) -> Column:
    """Neither NULL nor with a component that is NULL or not finite."""
    odd = f"exists({vector}, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
    return F.expr(f"{vector} IS NOT NULL AND NOT {odd}")


def scaled(vector: str, scale: int) -> Column:
    """``floor(scale * x)`` per component in double precision.

    Results beyond 2^27 either way count as that bound, so that products of whole
    vectors with up to 512 components fit 63 bits.
    """
    whole = f"floor(double({scale}) * double(x))"
    return F.expr(f"transform({vector}, x -> int(greatest(least({whole}, {LIMIT}L), -{LIMIT}L)))")


def matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of an Arrow list column, all with ``dims`` integers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)

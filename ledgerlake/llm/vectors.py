"""Integer vectors from rows of floating point components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Up to here a double's floor is exact and fits a long.
_WHOLE = float(1 << 53)


def usable(column: str) -> Column:
    """Whether a vector is there and all of its components are finite numbers."""
    finite = F.forall(column, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(F.col(column).isNotNull() & finite, F.lit(False))


def floored(column: str, scale: int, dims: int, limit: int) -> Column:
    """``floor(scale * x)`` of each component, as doubles that hold integers.

    Integers are held within ``limit`` on both sides; short vectors are filled up with zeros to ``dims``.
    """

    def whole(x: Column) -> Column:
        y = x.cast("double") * F.lit(float(scale))
        inside = F.greatest(F.lit(-_WHOLE), F.least(F.lit(_WHOLE), y))
        return F.greatest(F.lit(float(-limit)), F.least(F.lit(float(limit)), F.floor(inside).cast("double")))

    missing = F.array_repeat(F.lit(0.0), F.lit(dims) - F.size(column))
    return F.concat(F.transform(column, whole), missing)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """An Arrow column of lists of ``dims`` doubles each, as a matrix."""
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), dims)

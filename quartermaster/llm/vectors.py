"""Reading vector columns in Arrow batches, shared by the vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Not null, not empty, and no component null, NaN or infinite."""
    ok = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & ok, F.lit(False))  # NaN is above infinity


def whole_rows(col: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a list column that hold `dims` finite components, and these as float64."""
    size = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
    values = pc.cast(col.flatten(), pa.float64()).to_numpy(zero_copy_only=False)  # a null becomes NaN
    row = np.repeat(np.arange(len(size)), size)
    keep = (size == dims) & (np.bincount(row[~np.isfinite(values)], minlength=len(size)) == 0)
    return np.flatnonzero(keep), values[keep[row]].reshape(-1, dims)

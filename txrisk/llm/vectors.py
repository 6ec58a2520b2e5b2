"""Integer vectors shared by the vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(col: str = "embedding") -> Column:
    """Neither null nor with a null, NaN or infinite component."""
    bad = lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf"))
    return F.col(col).isNotNull() & ~F.exists(F.col(col), bad)


def extent(vectors: DataFrame, scale: int, col: str = "embedding") -> tuple[int, int, int]:
    """Rows with a usable vector, the widest one's length and the greatest component
    of their integers in absolute value."""
    size = F.aggregate(F.col(col), F.lit(0.0), lambda m, v: F.greatest(m, F.abs(v.cast("double"))))
    n, width, most = (vectors.where(usable(col))
                      .agg(F.count(F.lit(1)), F.max(F.size(col)), F.max(size)).first())
    return n, width or 0, int((most or 0.0) * scale) + 1


def integers(scale: int, most: int, col: str = "embedding") -> Column:
    """floor(scale * x) of every component, as narrow as ``most`` allows."""
    kind = "int" if most < 1 << 31 else "long"
    return F.transform(F.col(col), lambda v: F.floor(v.cast("double") * scale).cast(kind))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows of int64, shorter ones filled up with zeros."""
    out = np.zeros((len(column), width), np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def fixed(column: pa.Array, width: int) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    return column.flatten().to_numpy().reshape(len(column), width)


def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The rows of a matrix as a column of lists."""
    n, width = values.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).ravel(), kind))

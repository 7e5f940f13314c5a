"""What the vector operators share: the rows that take part, and vectors as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole(vector: Column) -> Column:
    """A vector that is not null or empty and has neither null nor non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def same_length(rows: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """The rows whose vector has the most frequent length (the longer one of equally frequent
    ones), and that length (0 of no rows); inner products need equal lengths.
    """
    sizes = rows.groupBy(F.size(vector).alias("length")).count()
    most = sizes.orderBy(F.col("count").desc(), F.col("length").desc()).first()
    length = most["length"] if most else 0
    return rows.where(F.size(vector) == length), length


def matrix(column: pa.Array, dtype: str = "f8") -> np.ndarray:
    """Vectors of one length, without nulls, as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(column), -1)


def packed(rows: np.ndarray) -> list[bytes]:
    rows = np.ascontiguousarray(rows)
    return [r.tobytes() for r in rows]


def unpacked(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    """Binaries of one length each as rows of a matrix."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype).reshape(len(column), width)

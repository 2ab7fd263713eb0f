"""What the operators on vectors share: which vectors take part."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def common_length(vectors: DataFrame, column: str) -> tuple[int, int]:
    """(length, rows) of the most frequent length of ``column``, of equal ones the greatest; (0, 0) without rows."""
    sizes = vectors.groupBy(F.size(column).alias("size")).count()
    top = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return (top["size"], top["count"]) if top else (0, 0)


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of ``width`` numbers each, without nulls, as rows."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)

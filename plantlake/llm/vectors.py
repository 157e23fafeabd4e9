"""Vector columns as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """``(rows as (vec_id long, v array<double>), length)``: rows whose vector is there, holds only finite numbers
    and has the commonest length above 0 (of equally common ones the larger), and that length; 0 without such rows."""
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & (F.size("v") > 0))
    lengths = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    size = lengths[0]["size"] if lengths else 0
    return rows.where(F.size("v") == size), size


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of an array column without nulls, each of ``size`` numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)

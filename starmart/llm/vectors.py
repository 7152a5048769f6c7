"""Vectors of a table that can be compared."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vec) of the rows whose vector is not null or zero and holds
    only finite components; rows without an id are left out.  Vectors of
    different lengths do not compare: callers keep lengths apart."""
    vec = F.col(vector_col)
    return table.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).filter(
        F.col("vec_id").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
        & F.exists("vec", lambda x: x != 0))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column as float64 rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)

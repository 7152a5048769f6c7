"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import ship_package, write_table

__all__ = ["give_back", "ids", "pick", "rows_of", "ship_package", "table", "write_table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names: other columns cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def rows_of(docs: DataFrame) -> DataFrame:
    """The rows in one struct, ``row``: no column's name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def give_back() -> None:
    """Return freed memory to the system: Python workers stay when a task
    ends, and what they hold then is missing in the next stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def ids(column: pa.ChunkedArray, null: int) -> np.ndarray:
    """An id column as int64, nulls as ``null``."""
    return column.combine_chunks().fill_null(null).to_numpy(zero_copy_only=False).astype(np.int64)

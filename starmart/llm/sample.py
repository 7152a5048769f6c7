"""Bounded samples of labelled rows, the only data a fit may hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import write_table


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id's text, modulo ``folds``; a null id is in no fold."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def by_hash(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """About ``limit`` rows, or all if there are fewer: those whose key hash
    is in the lowest share of the hash range that holds so many."""
    count = rows.count()
    if count <= limit:
        return rows
    cut = int((limit / count) * 2 ** 31)
    return rows.filter(F.pmod(F.xxhash64(key, F.lit(17)), F.lit(2 ** 31)) < cut)


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(doc_id, text, y) of about ``limit`` labelled documents, written.
    ``labels`` is (doc_id, label); a document with two labels has the larger.
    The labels taken are bounded by ``limit``, so they can be broadcast."""
    marks = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    marks = by_hash(marks.groupBy("doc_id").agg(F.max(label).cast("int").alias("y")), "doc_id", limit)
    return write_table(docs.join(F.broadcast(marks), "doc_id").select("doc_id", "text", "y"), "labelled")

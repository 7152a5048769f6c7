"""Data-quality checks (CHK-1 ... CHK-6).

The reference enforces keys with PostgreSQL constraints, which abort a load;
here every check is a query that reports violations, computed in one pass
with partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_violations(df: DataFrame, key: str, table: str) -> DataFrame:
    """CHK-1: one row ``table, key_column, rows, null_keys, duplicate_keys``;
    ``duplicate_keys`` counts key values that occur more than once."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.lit(key).alias("key_column"),
        F.sum("n").cast("long").alias("rows"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).cast("long")
        .alias("null_keys"),
        F.count(F.when(F.col(key).isNotNull() & (F.col("n") > 1), 1)).alias("duplicate_keys"),
    )


def orphan_count(fact: DataFrame, fk: str, dim: DataFrame, pk: str, name: str) -> DataFrame:
    """CHK-2: fact rows whose foreign key has no dimension row (``left_anti``).
    The unknown member -1 has no dimension row, so it is reported too."""
    keys = dim.select(F.col(pk).alias("__pk"))
    # the fact is reduced to its distinct keys before it meets the dimension
    counted = fact.groupBy(fk).agg(F.count(F.lit(1)).alias("__n"))
    orphans = counted.join(keys, F.col(fk) == F.col("__pk"), "left_anti")
    zero = F.lit(0).cast("long")
    return orphans.agg(F.lit(name).alias("constraint_name"),
                       F.coalesce(F.sum("__n"), zero).alias("orphan_rows"),
                       F.coalesce(F.sum(F.when(F.col(fk) == -1, F.col("__n"))), zero).alias("unknown_member_rows"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """CHK-3: NULLs per column, long form ``column_name, nulls``, one pass."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "nulls")


def rows_missing(df: DataFrame, col: str) -> DataFrame:
    """CHK-4: the rows where ``col`` is NULL."""
    return df.where(F.col(col).isNull())


def duplicate_rows(df: DataFrame) -> DataFrame:
    """CHK-6: copies beyond the first of identical rows (``df.duplicated()``).
    Grouping by every column keeps it one partial aggregate."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return per_row.agg(F.sum("n").cast("long").alias("rows"),
                       F.count(F.lit(1)).alias("distinct_rows"),
                       (F.sum("n") - F.count(F.lit(1))).cast("long").alias("duplicate_rows"))


def row_count_check(source: DataFrame, target: DataFrame, name: str) -> DataFrame:
    """CHK-5: rows in the source and in the loaded target."""
    s = source.agg(F.count(F.lit(1)).alias("source_rows"))
    t = target.select(F.count(F.lit(1)).alias("c")).scalar()
    return s.select(F.lit(name).alias("table_name"), "source_rows",
                    t.alias("target_rows"), (F.col("source_rows") == t).alias("matches"))

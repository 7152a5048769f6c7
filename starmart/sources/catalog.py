"""Namespaces and tables (IO-3, IO-5 ... IO-9).

The reference keeps ``staging``, ``dwh`` and ``mart`` schemas in one
PostgreSQL database and rebuilds every table with DROP + CREATE TABLE AS.
Here they are Spark databases under a base path (a shared location on a
cluster).  A replace-load writes a new version folder, parquet files beside
the versions before it, and then points the catalog's entry to it with one
``CREATE OR REPLACE VIEW``.  Readers see the old rows or the new ones, never
a part of either: a load that dies half way leaves a folder that nothing
names.  The version before stays for readers that already planned on it;
older ones, and what dead loads left, go with the next load.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAMESPACES = ("staging", "dwh", "mart")


def create_namespaces(spark: SparkSession, base_path: str,
                      names: Iterable[str] = NAMESPACES) -> None:
    """IO-6: ``CREATE SCHEMA IF NOT EXISTS`` for each namespace."""
    for n in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {n} LOCATION '{base_path.rstrip('/')}/{n}.db'")


def list_namespaces(spark: SparkSession, names: Sequence[str] = NAMESPACES) -> DataFrame:
    """IO-7: the namespaces that exist, filtered by an IN list."""
    return spark.sql("SHOW DATABASES").where(F.col("namespace").isin(list(names)))


def _folder(spark: SparkSession, name: str) -> str:
    """Where the versions of a table stand."""
    database, _, table = name.rpartition(".")
    where = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{where.rstrip('/')}/{table.lower()}.versions"


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def _files(spark: SparkSession, folder: str):
    """The folder as a Hadoop path, and its file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, name: str) -> list[str]:
    """Version folders of a table, the oldest first, whether named or not."""
    path, files = _files(spark, _folder(spark, name))
    if not files.exists(path):
        return []
    found = [(f.getModificationTime(), f.getPath().getName()) for f in files.listStatus(path)]
    return [v for _, v in sorted(found) if v.startswith("v-")]


def current_version(spark: SparkSession, name: str) -> str | None:
    """The version folder that the catalog's entry points to."""
    if not _is_view(spark, name):
        return None
    text = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}.get("View Text", "")
    at = re.search(r"/(v-[0-9a-f]{32})`", text)
    return at.group(1) if at else None


def _drop_versions(spark: SparkSession, name: str, keep: Iterable[str | None]) -> None:
    keep = set(keep)
    for v in versions(spark, name):
        if v not in keep:
            path, files = _files(spark, f"{_folder(spark, name)}/{v}")
            files.delete(path, True)


def replace_table(df: DataFrame, name: str, partition_by: Sequence[str] = (),
                  parts: Mapping[str, str] | None = None, check: Callable[[], None] | None = None) -> None:
    """IO-3 / IO-5: replace-load (``DROP`` + ``CREATE TABLE AS``), optionally
    partitioned (the fact by order year and month, so a date filter prunes
    files).  The table is replaced at once or not at all.

    With ``parts``, entries by name, each for the rows of a condition, stand
    in for the one entry (see :mod:`starmart.operators.gate`).  ``check`` is
    called when all is written and before the switch; if it raises, the
    entries stay as they were."""
    spark = df.sparkSession
    before = current_version(spark, name)
    new = f"v-{uuid.uuid4().hex}"
    path = f"{_folder(spark, name)}/{new}"
    w = df.write.format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    folder, files = _files(spark, path)
    if partition_by and not any(f.isDirectory() for f in files.listStatus(folder)):  # no rows: leave the schema
        spark.createDataFrame([], df.schema).write.mode("append").parquet(path)
    if spark.catalog.tableExists(name) and not _is_view(spark, name):
        spark.sql(f"DROP TABLE {name}")  # loaded before there were versions
    columns = ", ".join(f"`{c}`" for c in df.columns)
    # partition values are read back from folder names: keep the columns' own types
    if partition_by:
        kinds = dict(df.dtypes)
        columns = ", ".join(f"CAST(`{c}` AS {kinds[c]}) AS `{c}`" if c in partition_by else f"`{c}`" for c in df.columns)
    if check is not None:
        check()
    # the switch; the table's own entry comes last
    for entry, where in sorted((parts or {name: ""}).items(), key=lambda e: e[0] == name):
        rows = f" WHERE {where}" if where else ""
        spark.sql(f"CREATE OR REPLACE VIEW {entry} AS SELECT {columns} FROM parquet.`{path}`{rows}")
    _drop_versions(spark, name, (before, new))


def drop_tables(spark: SparkSession, names: Iterable[str]) -> None:
    """IO-8: ``DROP TABLE IF EXISTS`` for obsolete tables, with their files."""
    for n in names:
        if _is_view(spark, n):
            spark.sql(f"DROP VIEW {n}")
            _drop_versions(spark, n, ())
        else:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def schema_listing(df: DataFrame) -> list[tuple[str, str]]:
    """IO-9: column names and types (``df.dtypes``)."""
    return list(df.dtypes)


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None,
               where: str | None = None) -> DataFrame:
    """IO-4: table read with projection and filter; both reach the parquet
    scan (column pruning, pushed filters)."""
    df = spark.table(name)
    if columns:
        df = df.select(*columns)
    return df.where(where) if where else df

"""SparkSession construction and the reliable checkpoint location."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "starmart") -> SparkSession:
    """Session with AQE, skew-join handling and UTC time; the UI stays off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    # only what the caller asks for: a cluster's own settings stand
    parts = shuffle_partitions or os.environ.get("STARMART_SHUFFLE_PARTITIONS")
    if parts:
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    if os.environ.get("STARMART_DRIVER_MEMORY"):
        builder = builder.config("spark.driver.memory", os.environ["STARMART_DRIVER_MEMORY"])
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is used
    as is.  Only a local-mode session without one (tests) gets a fresh folder
    under the system temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder of the cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="starmart-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str = "t") -> str:
    """A fresh folder for a written table, inside the shared checkpoint
    folder of the cluster (never a machine-local temp dir on a cluster)."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    """One folder per application, so that a run can drop what it wrote."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/starmart/{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> bool:
    """Delete the tables this application wrote to the shared folder; call it
    when nothing reads them any more (at the end of a batch run)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    return root.getFileSystem(conf).delete(root, True)


def write_table(df: DataFrame, name: str = "t", codec: str | None = None) -> DataFrame:
    """Materialize ``df`` as parquet in the shared folder and read it back:
    the lineage is cut, the rows survive executor loss, and later scans get
    column pruning and filter pushdown.  ``codec``: the files' compression, if
    not the session's."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=codec)
    return spark.read.parquet(path)


def write_dealt(df: DataFrame, block: str, place: str, buckets: int, name: str = "t",
                codec: str | None = None) -> DataFrame:
    """:func:`write_table` into ``buckets`` buckets by the hash of ``block``,
    each sorted by block and ``place``: joins, aggregates and windows that need
    a block's rows together read them so, without a shuffle.  The entry in the
    catalog, which tells the planner of the buckets, is dropped once it is read."""
    spark = df.sparkSession
    entry = f"starmart_{name}_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").bucketBy(buckets, block).sortBy(block, place)
    if codec:
        writer = writer.option("compression", codec)
    writer.option("path", scratch_path(spark, name)).saveAsTable(entry)
    table = spark.table(entry)
    spark.sql(f"DROP TABLE {entry}")
    return table


@contextmanager
def dealt_plans(spark: SparkSession, buckets: int | None = None):
    """Plans made inside take sides that are dealt by one of a join's keys as
    they are, and shuffle the others to meet them."""
    wanted = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
    if buckets:  # a table of fewer buckets than this would be shuffled again
        wanted["spark.sql.shuffle.partitions"] = str(buckets)
        wanted["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(buckets)
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Rows of a task over a table that is read again and again.
TASK_ROWS = 1 << 16


def spread(df: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """``df`` dealt by ``key`` into tasks of about TASK_ROWS rows, if it holds
    more: a fit that reads a written table in every round runs as many tasks as
    the table has files, and a narrow table comes out of a shuffle in few."""
    rows = df.count() if rows is None else rows
    return df if rows <= TASK_ROWS else df.repartition(-(-rows // TASK_ROWS), key)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``starmart`` importable in the Python workers of every executor
    (what ``spark-submit --py-files`` does): zip the package once per
    application and ``addPyFile`` it.  Pandas UDFs defined here are pickled
    by module reference, so the workers must be able to import it."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    import starmart

    root = os.path.dirname(os.path.abspath(starmart.__file__))
    fd, path = tempfile.mkstemp(prefix="starmart-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w") as z:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(app)

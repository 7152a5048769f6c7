"""Shards in a random order, by a two-pass external shuffle.

Pass one scatters the rows uniformly into buckets that fit a task's memory,
by a seeded hash of id and text; Spark's exchange carries them.  Pass two
brings each bucket into a fixed order, shuffles it by Fisher-Yates with a
generator seeded by the bucket, and writes it.  The buckets in a row are a
uniform order of the table; shard s of n takes its positions from
floor(s * N / n) on, so that shards differ by one row at most (the law
``rows``).  Only one number per bucket, its rows, is added up.

The order depends on the seed, the number of buckets and the rows' ids and
texts, not on how Spark deals them.  Rows repeated with the same id and text
are alike; where they are over 1/HOT of all rows, and so fewer than HOT
kinds, they are spread over the buckets one by one.

Nulls and ties: null ids and texts are values like others; a null text has
size 1 and takes a place as an empty one does.  A very long text makes its
bucket larger by itself.  Empty tables give no rows.  The caller's columns
travel in one struct, ``row``, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import write_table

BUCKET_BYTES = 16 << 20
HOT = 1024


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A uniform order of n things."""
    order = list(range(n))
    last = np.arange(n - 1, 0, -1)
    draws = np.random.Generator(np.random.PCG64([seed, bucket])).integers(0, last + 1) if n > 1 else last
    for i, j in zip(last.tolist(), draws.tolist()):
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def _mixed(table: pa.Table, seed: int) -> pa.Table:
    """One bucket, shuffled, with each row's position."""
    bucket = table["bucket"][0].as_py()
    fixed = np.lexsort((table["hash2"].to_numpy(), table["hash"].to_numpy()))
    # the row that the shuffle puts at each position
    out = table.take(pa.array(fixed[fisher_yates(len(fixed), seed, bucket)]))
    position = pa.array(np.arange(len(fixed)), pa.int64())
    return out.select(["bucket", "row", "size"]).append_column("position", position)


def scatter(docs: DataFrame, seed: int, bucket_bytes: int, id_col: str, text_col: str) -> DataFrame:
    """Pass one: bucket, two hashes, size and the row itself."""
    def col(name: str):
        return F.col("row").getField(name)

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"))
    text = F.coalesce(col(text_col), F.lit(""))
    known = col(id_col), col(text_col), col(text_col).isNull()
    rows = rows.select(
        "row", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), *known).alias("hash"), F.xxhash64(F.lit(~seed), *known).alias("hash2"))
    totals = rows.agg(F.sum("size"), F.count("*")).first()
    buckets = max(1, -(-(totals[0] or 0) // bucket_bytes))
    # rows alike that are over 1/HOT of all: fewer than HOT hashes, whatever the data
    hot = [r[0] for r in rows.groupBy("hash").count().filter(F.col("count") * HOT > max(HOT * HOT, totals[1])).collect()]
    spread = F.when(F.col("hash").isin(hot), F.xxhash64("hash", F.monotonically_increasing_id())).otherwise(F.col("hash")) \
        if hot else F.col("hash")
    return rows.withColumn("bucket", F.pmod(F.xxhash64(spread, F.lit(seed)), F.lit(buckets)))


def shuffle_shards(docs: DataFrame, shards: int, seed: int = 1, bucket_bytes: int = BUCKET_BYTES,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` (in the struct ``row``) with its size in bytes,
    its shard and its slot there, from 0 without gaps."""
    scattered = scatter(docs, seed, bucket_bytes, id_col, text_col)
    schema = T.StructType([scattered.schema[c] for c in ("bucket", "row", "size")]).add("position", "long")
    mixed = write_table(scattered.groupBy("bucket").applyInArrow(lambda t: _mixed(t, seed), schema), "mixed")
    # a row per bucket, that is one per BUCKET_BYTES of text
    counts = mixed.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    total = counts.agg(F.sum("n")).first()[0] or 0
    # written, so that the planner knows its size and decides how to join it
    firsts = write_table(counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "firsts")
    at = F.col("first") + F.col("position")
    # the last shard that begins at or before a position: floor(s * N / n) <= at
    shard = F.expr(f"cast(((first + position + 1) * {shards} - 1) div {max(total, 1)} as int)")
    placed = mixed.join(firsts, "bucket").withColumn("shard", shard)
    begin = F.expr(f"(cast(shard as bigint) * {total}) div {shards}")
    return placed.select("row", "size", "shard", (at - begin).alias("slot"))


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard, its files in the order of the slots."""
    rows = placed.select("row", "shard", "slot")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

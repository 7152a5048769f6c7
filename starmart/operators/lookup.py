"""A lookup join that no key can overload.

A key is hot when it holds over 1/HOT of the counted rows, so there are fewer
than HOT hot keys whatever the data: their few lookup rows are a broadcast
with a proven bound.  All other keys meet in a shuffle join, in which the
rows of hot keys (and rows without a key) are dealt out evenly by a hash of
``spread``, as they need no partner there.  One pass over the big side; its
counts come from partial aggregates over the key column alone, by buckets of
its hash first, so neither what is shuffled nor what reaches the driver grows
with the number of keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT = 1024
BUCKETS = 1 << 16


def hot_keys(big: DataFrame, key: str) -> list:
    """The keys of ``big`` with over 1/HOT of its rows: fewer than HOT.

    Rows are first counted in BUCKETS buckets of the keys' hash, so a task
    sends at most BUCKETS counts; only the keys of buckets with over 1/HOT of
    the rows (fewer than HOT buckets) are counted themselves."""
    held = big.select(F.col(f"`{key}`").alias("key"))
    bucket = F.when(F.col("key").isNotNull(), F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int"))
    counts = {r.bucket: r.n for r in held.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    full = [b for b, n in counts.items() if b is not None and n * HOT > total]
    if not full:
        return []
    found = held.where(bucket.isin(full)).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return [r.key for r in found.where(F.col("n") * HOT > F.lit(total)).select("key").collect()]


def lookup_join(big: DataFrame, small: DataFrame, key: str, values: Sequence[str], spread: str,
                how: str = "left", counted: DataFrame | None = None) -> DataFrame:
    """``big`` with the columns ``values`` of ``small``; a key that ``small``
    holds several times gives a row each, so it should hold few.  ``how``:
    left or inner; rows with a null key match nothing.  The names of ``big``'s
    columns are free: they travel in one struct.  ``counted``: a frame cheaper
    to read that holds ``key`` about as often as ``big`` does; its hot keys are
    taken instead (they decide where rows meet, never what they find)."""
    rows = big.select(F.struct(*[F.col(f"`{c}`") for c in big.columns]).alias("row"))
    own, spread = F.col("row").getField(key), F.xxhash64(F.col("row").getField(spread))
    table = small.select(F.col(f"`{key}`").alias("key"), F.struct(*[F.col(f"`{v}`") for v in values]).alias("found"))
    keys = hot_keys(big if counted is None else counted, key)
    alone = own.isNull()
    if keys:
        hot = big.sparkSession.createDataFrame([(k,) for k in keys], T.StructType([T.StructField("hot_key", table.schema["key"].dataType)]))
        # a hot key may have no lookup row
        few = hot.join(table.withColumnRenamed("found", "hot_found"), F.col("hot_key") == F.col("key"), "left").drop("key")
        rows = rows.join(F.broadcast(few), own == F.col("hot_key"), "left")
        alone = alone | F.col("hot_key").isNotNull()
    # the join's keys are computed where they are used: no column of theirs is moved
    cold = F.when(~alone, own)
    turn = F.when(alone, spread.bitwiseOR(F.lit(1).cast("long"))).otherwise(F.lit(0).cast("long"))
    # 0, but no constant: a constant would leave the join's keys and with it the partitioning
    zero = F.xxhash64("key").bitwiseAND(F.lit(0).cast("long"))
    rest = table.select(F.col("key").alias("cold"), zero.alias("turn"), F.col("found").alias("cold_found"))
    out = rows.join(rest, (cold == F.col("cold")) & (turn == F.col("turn")), "left")
    out = out.withColumn("found", F.coalesce("hot_found", "cold_found") if keys else F.col("cold_found"))
    if how == "inner":
        out = out.where(F.col("found").isNotNull())
    return out.select("row.*", *[F.col("found").getField(v).alias(v) for v in values])


def lookup_in_blocks(big: DataFrame, small: DataFrame, key: str, values: Sequence[str], block: str,
                     buckets: int, how: str = "left", asked: DataFrame | None = None) -> DataFrame:
    """:func:`lookup_join` for a table dealt by ``block`` into ``buckets``
    buckets: no row of ``big`` moves.  The distinct keys of each block travel
    to the lookup rows and back to their block, so a key is held by at most as
    many rows as there are blocks, however often it occurs.  ``asked``: a frame
    cheaper to read that holds the blocks and keys of ``big``, or more."""
    asked = big if asked is None else asked
    asked = asked.where(F.col(key).isNotNull()).select(F.col(block).alias("__block"), F.col(key).alias("__key")).distinct()
    table = small.select(F.col(key).alias("__own"), *values)
    found = (asked.join(table, F.col("__key") == F.col("__own")).select("__block", "__key", *values)
             .repartition(buckets, "__block"))
    return big.join(found, (F.col(block) == F.col("__block")) & (F.col(key) == F.col("__key")), how).drop("__block", "__key")

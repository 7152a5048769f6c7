"""Order-dependent operators without a single-task window.

``Window.orderBy(...)`` with no ``partitionBy`` sends every row to one task.
That is fine over months or ship modes, not over order lines, customers or
products.  The operators here keep the work distributed:

1. ``repartitionByRange`` on the full sort order, then ``sortWithinPartitions``:
   partition ``p`` holds one contiguous slice of the global order.  The order
   ends in a unique tie-break, so even a value shared by a third of all rows is
   split over many partitions.
2. Each row's partition id and position inside its partition are computed in
   the same stage as the sort and written with it as a parquet table in the
   shared checkpoint folder.  Positions are then plain columns: the two
   passes below cannot disagree, even after a lost executor, and the lineage
   is cut.
3. One small aggregate per partition (row count, or sums) is collected: its
   size is the number of partitions, never the number of rows.  Their prefix
   sums become a literal array of offsets.
4. Each row adds its partition's offset to its position inside the partition.

``rank`` needs the first row of each run of equal keys: a window inside each
partition finds it, and what a run carries over a partition border comes from
the border rows (two per partition).  Quantiles per group are aggregates on
top of the numbering, which Spark computes with map-side partial aggregation.
There is one path for every input size.  Ntiles and the quantiles of whole
columns need only single rows of an order: see ``selection``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.lookup import lookup_in_blocks
from starmart.session import dealt_plans, write_dealt, write_table

_PID = "__sm_pid"
#: The column that a table in blocks is dealt by.
BLOCK = _PID
_LOCAL = "__sm_local"
#: Ranges per shuffle partition, and steps of the histogram that cuts them.
RANGES = 4
STEPS = 4096
#: Rows of a bucket of a table that is written in blocks.
BUCKET_ROWS = 1 << 17


def _range_layout(df: DataFrame, order: Sequence[Column], num_partitions: int | None) -> DataFrame:
    """Range-partitioned, sorted rows with ``__sm_pid`` and ``__sm_local``
    (0-based position inside the partition), written and read back."""
    # without a number, the session's setting holds and AQE joins small ranges
    cut = [num_partitions] if num_partitions else []
    ranged = df.repartitionByRange(*cut, *order).sortWithinPartitions(*order)
    pid = F.spark_partition_id()
    # monotonically_increasing_id is (partition id << 33) + record number,
    # evaluated in the sorted partition
    tagged = ranged.withColumn(_PID, pid).withColumn(
        _LOCAL, F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33))
    # sorted rows pack well: these are the largest tables that are written
    return write_table(tagged, "ordered", "zstd")


def _offsets(per_partition: dict[int, object]) -> tuple[list, object]:
    """Exclusive prefix sums indexed by partition id, and the grand total, in
    the type of the sums (a partition whose values are all NULL adds nothing)."""
    size = (max(per_partition) + 1) if per_partition else 1
    offsets: list = []
    running = 0
    for pid in range(size):
        offsets.append(running)
        value = per_partition.get(pid)
        running = running if value is None else running + value
    return offsets, running


def _lookup(offsets: list, pid: Column, dtype: str = "bigint") -> Column:
    """The offset of a row's partition, as ``dtype``."""
    if dtype == "bigint":  # as one SQL text: each call to the JVM counts
        return F.element_at(F.expr(f"array({', '.join(f'{o}L' for o in offsets)})"), pid + 1)
    return F.element_at(F.array(*[F.lit(o).cast(dtype) for o in offsets]), pid + 1)


def _number(laid: DataFrame, out: str) -> tuple[DataFrame, int]:
    counts = {r[0]: r[1] for r in laid.groupBy(_PID).count().collect()}
    offsets, total = _offsets(counts)
    return laid.withColumn(out, _lookup(offsets, F.col(_PID)) + F.col(_LOCAL) + 1), total


def with_row_number(df: DataFrame, order: Sequence[Column], out: str = "rn",
                    num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """``row_number() over (order by <order>)`` computed in parallel.

    ``order`` must be a total order (end it in a unique key).  Returns the
    frame with a 1-based LONG column ``out`` and the row count.
    """
    numbered, total = _number(_range_layout(df, order, num_partitions), out)
    return numbered.drop(_PID, _LOCAL), total


def joined_row_number(big: DataFrame, small: DataFrame, key: str, other: str, order: Sequence[Column],
                      keys: DataFrame, out: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """The rows of :func:`joined_blocks` without their block."""
    return joined_blocks(big, small, key, other, order, keys, out, num_partitions).rows.drop(BLOCK)


def joined_blocks(big: DataFrame, small: DataFrame, key: str, other: str, order: Sequence[Column], keys: DataFrame,
                  out: str = "rn", num_partitions: int | None = None, lookups: dict[str, DataFrame] | None = None,
                  drop: Sequence[str] = ()) -> "Blocks":
    """``row_number() over (order by <order>)`` of the inner join of ``big``
    and ``small`` on ``key`` = ``other`` (LONG), for an order that begins with
    ``key`` ascending, and of the inner joins with the tables of ``lookups``
    (column of both sides: table).  Columns in ``drop`` are not written.

    Both sides are dealt by ranges of the key, so one shuffle of ``big`` serves
    the joins, the sort and the numbering, and neighbours in the order stay
    neighbours in the written table.  ``keys`` holds the keys of ``big`` (column
    ``key``) and is cheap to read: its histogram cuts the ranges.  The rows of
    one key meet in one task, as a join's do.
    """
    steps, step = _steps(keys, key)
    counts = {r[0]: r[1] for r in steps.groupBy("step").count().collect()}
    total, held, ranges = sum(counts.values()), 0, []
    buckets = num_partitions or max(1, -(-total // BUCKET_ROWS))
    for i in range(STEPS):
        ranges.append(held * RANGES * buckets // max(total, 1))  # by the rows before the step
        held += counts.get(i, 0)

    def block(c: str) -> Column:
        return F.get(F.expr(f"array({', '.join(map(str, ranges))})"), step(c))

    def dealt(side: DataFrame, c: str, name: str) -> DataFrame:
        return side.where(F.col(c).isNotNull()).withColumn(name, block(c)).repartition(buckets, name)

    # sides dealt by the range alone are together already: no second shuffle by range and key
    joined = dealt(big, key, BLOCK).join(
        dealt(small, other, "__sm_other"), (F.col(BLOCK) == F.col("__sm_other")) & (F.col(key) == F.col(other)))
    joined = joined.drop("__sm_other", other)
    for c, table in (lookups or {}).items():
        asked = big.where(F.col(key).isNotNull()).select(block(key).alias(BLOCK), c)
        joined = lookup_in_blocks(joined, table, c, [v for v in table.columns if v != c], BLOCK, buckets, "inner", asked)
    return number_blocks(joined, order, out, buckets, drop)


def _steps(keys: DataFrame, key: str):
    """The step of each key in a histogram between the least and the largest
    key, and what gives the step of another column's keys."""
    ends = keys.agg(F.min(key), F.max(key)).first()
    low, high = (0, 0) if ends[0] is None else ends

    def step(c: str) -> Column:
        if low == high:
            return F.lit(0)
        share = (F.col(c).cast("double") - F.lit(float(low))) / F.lit(float(high) - float(low))
        return F.floor(F.greatest(F.least(share, F.lit(1.0)), F.lit(0.0)) * (STEPS - 1)).cast("int")

    return keys.where(F.col(key).isNotNull()).select(step(key).alias("step")), step


@dataclass
class Blocks:
    """Numbered rows whose table is dealt by the column BLOCK into ``buckets``
    buckets: blocks are ranges of the order, of higher numbers for later rows."""
    rows: DataFrame
    buckets: int


def number_blocks(df: DataFrame, order: Sequence[Column], out: str, buckets: int, drop: Sequence[str] = ()) -> Blocks:
    """``row_number() over (order by <order>)`` of rows dealt by the column
    BLOCK, whose blocks are ranges of that order: rows are numbered inside
    their block, so none is moved."""
    local = F.row_number().over(Window.partitionBy(BLOCK).orderBy(*order)).cast("long") - 1
    with dealt_plans(df.sparkSession, buckets):
        laid = write_dealt(df.withColumn(_LOCAL, local).drop(*drop), BLOCK, _LOCAL, buckets, "ordered", "zstd")
    return Blocks(_number(laid, out)[0].drop(_LOCAL), buckets)


def with_rank(df: DataFrame, value_cols: Sequence[str], value_order: Sequence[Column],
              tiebreak: Sequence[Column], out: str, partition_cols: Sequence[str] = (),
              num_partitions: int | None = None) -> DataFrame:
    """``rank() over ([partition by <partition_cols>] order by <value_order>)``.

    The rank of a row is the position of the first row of its tie group,
    minus the position of the first row of its partition group, plus one.
    Both are read off the sorted layout, so a hot value joins nothing.
    """
    rn_col = f"__{out}_rn"
    order = [F.col(c).asc_nulls_last() for c in partition_cols] + list(value_order) + list(tiebreak)
    numbered, _ = _number(_range_layout(df, order, num_partitions), rn_col)
    ranked = _run_start(numbered, [*partition_cols, *value_cols], rn_col, "__tie_first")
    rank = F.col("__tie_first")
    if partition_cols:
        ranked = _run_start(ranked, list(partition_cols), rn_col, "__part_first")
        rank = rank - F.col("__part_first") + 1
    return (ranked.withColumn(out, rank.cast("long"))
            .drop(rn_col, _PID, _LOCAL, "__tie_first", "__part_first"))


def _same(a, b) -> bool:
    """Equality of two border rows' keys as Spark sees it (NaN equals NaN)."""
    return all(x == y or (x != x and y != y) for x, y in zip(a, b))


def _run_start(laid: DataFrame, keys: Sequence[str], rn: str, out: str) -> DataFrame:
    """Add ``out``: the number of the first row of the run of equal ``keys``
    that a row stands in.  ``laid`` is a numbered range layout in which equal
    keys are neighbours."""
    key = F.struct(*keys)
    rows = Window.partitionBy(_PID).orderBy(_LOCAL)
    start = (F.col(_LOCAL) == 0) | ~key.eqNullSafe(F.lag(key).over(rows))
    found = laid.withColumn(out, F.when(start, F.col(rn))).withColumn(
        out, F.max(out).over(rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    edges = found.groupBy(_PID).agg(
        F.min_by(key, _LOCAL).alias("head"), F.max_by(key, _LOCAL).alias("tail"),
        F.min(rn).alias("first"), F.max(out).alias("last")).orderBy(_PID).collect()
    carried: dict[int, int] = {}  # partitions whose first run began earlier
    tail, last = None, None
    for e in edges:
        begins = last if tail is not None and _same(tail, e["head"]) else None
        if begins is not None:
            carried[e[_PID]] = begins
        one_run = e["last"] == e["first"]
        tail, last = e["tail"], begins if one_run and begins is not None else e["last"]
    if not carried:
        return found
    size = max(carried) + 1
    begins = F.get(F.array(*[F.lit(carried.get(p)).cast("bigint") for p in range(size)]), F.col(_PID))
    first_run = F.col(out) == F.min(rn).over(Window.partitionBy(_PID))
    return found.withColumn(out, F.when(first_run & begins.isNotNull(), begins).otherwise(F.col(out)))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, "inner").drop(*[f"__r_{k}" for k in keys])


def with_running_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, Column],
                      num_partitions: int | None = None) -> tuple[DataFrame, dict]:
    """Inclusive running sums ``sum(x) over (order by <order> rows unbounded preceding)``.

    Inside one range partition the running sum is a window partitioned by the
    partition id (balanced, as the ranges are); the offsets of earlier
    partitions come from one small per-partition aggregate.  Returns the frame
    and the grand totals.
    """
    laid = _range_layout(df, order, num_partitions)
    for name, expr in sums.items():
        laid = laid.withColumn(f"__w_{name}", expr)
    per_partition = laid.groupBy(_PID).agg(*[F.sum(f"__w_{n}").alias(n) for n in sums])
    sum_types = {n: per_partition.schema[n].dataType.simpleString() for n in sums}
    agg = per_partition.collect()
    result = laid
    totals: dict = {}
    local_w = Window.partitionBy(_PID).orderBy(_LOCAL).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    for name in sums:
        per = {r[_PID]: r[name] for r in agg}
        offsets, totals[name] = _offsets(per)
        inner = F.sum(f"__w_{name}").over(local_w)
        dtype = sum_types[name]
        before = _lookup(offsets, F.col(_PID), dtype)
        # NULL until the first value, as the plain window gives it
        seen = [any(per.get(q) is not None for q in range(p)) for p in range(len(offsets))]
        held = F.element_at(F.array(*[F.lit(x) for x in seen]), F.col(_PID) + 1)
        result = result.withColumn(
            name, F.when(held, F.coalesce(before + inner, before)).otherwise(inner).cast(dtype))
    return result.drop(_PID, _LOCAL, *[f"__w_{n}" for n in sums]), totals


def grouped_exact_quantiles(df: DataFrame, group_col: str, value_col: str,
                            probs: Sequence[float], names: Sequence[str] | None = None,
                            num_partitions: int | None = None) -> DataFrame:
    """Exact quantiles per group with linear interpolation (pandas' default,
    ``quantile_cont``): one row per group, one DOUBLE column per probability.

    Rows are first counted per (group, value), a partial aggregate, so a value
    held by a third of all rows is one row here.  Running counts over
    (group, value) come from :func:`with_running_sums`; the k-th smallest value
    of a group is ``min(value) where running_count_in_group > k``.  No group
    is ever gathered into one task.
    """
    names = list(names or [f"q{int(round(p * 100)):02d}" for p in probs])
    g = F.col(group_col)
    counted = (df.where(F.col(value_col).isNotNull())
               .groupBy(g.alias("__g"), F.col(value_col).cast("double").alias("__v"))
               .agg(F.count(F.lit(1)).alias("__c")))
    cum, _ = with_running_sums(counted, [F.col("__g").asc_nulls_last(), F.col("__v").asc()],
                               {"__cum": F.col("__c")}, num_partitions)
    per_group = cum.groupBy("__g").agg((F.min(F.col("__cum") - F.col("__c"))).alias("__base"),
                                       F.sum("__c").alias("__n"))
    j = _null_safe_join(cum, per_group, ["__g"]).withColumn(
        "__pos", F.col("__cum") - F.col("__base"))
    n = F.col("__n")
    aggs, outs = [], []
    for i, p in enumerate(probs):
        h = (n - 1).cast("double") * F.lit(float(p))
        lo = F.floor(h)
        hi = F.least(lo + 1, n - 1)
        aggs += [F.min(F.when(F.col("__pos") > lo, F.col("__v"))).alias(f"__lo{i}"),
                 F.min(F.when(F.col("__pos") > hi, F.col("__v"))).alias(f"__hi{i}"),
                 F.max(h - lo).alias(f"__f{i}")]
        v_lo, v_hi, t = F.col(f"__lo{i}"), F.col(f"__hi{i}"), F.col(f"__f{i}")
        # weighted form lo * (1 - t) + hi * t, bit for bit what quantile_cont
        # computes (numpy's lerp can differ from it in the last bit)
        outs.append((v_lo * (1 - t) + v_hi * t).alias(names[i]))
    return j.groupBy("__g").agg(*aggs).select(F.col("__g").alias(group_col), *outs)

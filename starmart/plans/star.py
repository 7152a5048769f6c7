"""Star schema: four dimensions around an order-line fact (T-2 ... T-6)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions import (
    date_key,
    day_name_padded,
    day_of_week0,
    month_name_padded,
)
from starmart.operators.gate import Rules
from starmart.operators.lookup import lookup_in_blocks, lookup_join
from starmart.operators.ordered import BLOCK, number_blocks, with_row_number
from starmart.params import Params
from starmart.session import dealt_plans, write_table

CUSTOMER_ATTRS = ("city", "state", "segment", "country", "postal_code", "region", "customer_name")


def _audit(params: Params):
    # built from text: no session or process time zone is involved
    return F.lit(params.audit_ts.isoformat(sep=" ")).cast("timestamp_ntz")


def dim_customer(staging: DataFrame, params: Params, buckets: int | None = None) -> DataFrame:
    """T-2: one row per customer id; attributes of its first line (lowest row
    id; the reference's DISTINCT ON has no ORDER BY); key by customer id.

    Lines are first reduced to distinct (id, attributes) with their lowest row
    id.  That aggregate keeps a number per group, so it hashes and neither sorts
    lines nor moves more than the distinct groups of a task, also for a
    customer holding a third of all lines; ``min_by`` then reads those groups.
    Of staging lines in blocks (``buckets``: see :func:`fact_sales`) only the
    ids move: the first line is in the customer's first block.
    """
    held = staging.where(F.col("customer_id").isNotNull())
    if buckets:
        ids = (held.groupBy("customer_id").agg(F.min("row_id").alias("row_id"), F.min(BLOCK).alias("__block"))
               .drop("customer_id").withColumnRenamed("row_id", "__row").repartition(buckets, "__block"))
        with dealt_plans(staging.sparkSession, buckets):  # written: numbering reads it twice
            firsts = write_table(held.join(ids, (F.col(BLOCK) == F.col("__block")) & (F.col("row_id") == F.col("__row")))
                                 .select("customer_id", *CUSTOMER_ATTRS), "customers")
    else:
        firsts = (held.groupBy("customer_id", *CUSTOMER_ATTRS).agg(F.min("row_id").alias("row_id"))
                  .groupBy("customer_id")
                  .agg(F.min_by(F.struct(*CUSTOMER_ATTRS), F.col("row_id")).alias("a"))
                  .select("customer_id", "a.*"))
    keyed, _ = with_row_number(firsts, [F.col("customer_id").asc_nulls_last()], "customer_key",
                               params.order_partitions)
    return keyed.select("customer_key", "customer_id", "region", "postal_code", "city",
                        "customer_name", "state", "segment", "country",
                        _audit(params).alias("created_at"))


PRODUCT_ATTRS = ("product_id", "category", "sub_category", "product_name")


def dim_product(staging: DataFrame, params: Params) -> DataFrame:
    """T-3: distinct (id, category, sub-category, name); keyed by product id,
    ties broken by the other three.  With ``fanout="dedupe"`` one row per id
    (the smallest category, sub-category, name)."""
    src = staging.where(F.col("product_id").isNotNull())
    if params.fanout == "dedupe":
        rows = (src.groupBy("product_id")
                .agg(F.min(F.struct("category", "sub_category", "product_name")).alias("a"))
                .select("product_id", "a.*"))
    else:
        rows = src.select(*PRODUCT_ATTRS).distinct()
    keyed, _ = with_row_number(rows, [F.col(c).asc_nulls_last() for c in PRODUCT_ATTRS],
                               "product_key", params.order_partitions)
    return keyed.select("product_key", "category", "product_id", "sub_category", "product_name",
                        _audit(params).alias("created_at"))


def dim_date(staging: DataFrame) -> DataFrame:
    """T-4: every day that occurs as an order or a ship date (UNION: distinct).
    Its size is bounded by the calendar, not by the data."""
    days = (staging.select(F.col("order_date").alias("d"))
            .union(staging.select(F.col("ship_date").alias("d")))
            .where(F.col("d").isNotNull()).distinct())
    d = F.col("d")
    dow = day_of_week0(d)
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.weekofyear(d).alias("week_of_year"),
        dow.alias("day_of_week"),
        month_name_padded(d).alias("month_name"),
        day_name_padded(d).alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
    )


def dim_ship(staging: DataFrame, params: Params) -> DataFrame:
    """T-5: distinct ship modes without NULL and the junk values (SQL ``!=``
    also drops NULL).  A handful of modes: a single-partition window is fine."""
    modes = staging.select("ship_mode").where(F.col("ship_mode").isNotNull())
    if params.excluded_ship_modes:
        modes = modes.where(~F.col("ship_mode").isin(list(params.excluded_ship_modes)))
    modes = modes.distinct()
    return modes.select(
        F.row_number().over(Window.orderBy(F.col("ship_mode").asc_nulls_last())).cast("long")
        .alias("ship_mode_key"),
        "ship_mode",
        _audit(params).alias("created_at"),
    )


def fact_sales(staging: DataFrame, d_customer: DataFrame, d_product: DataFrame,
               d_ship: DataFrame, d_date: DataFrame, params: Params, buckets: int | None = None) -> DataFrame:
    """:func:`fact_blocks` without the block."""
    return fact_blocks(staging, d_customer, d_product, d_ship, d_date, params, buckets).drop(BLOCK)


def fact_blocks(staging: DataFrame, d_customer: DataFrame, d_product: DataFrame,
                d_ship: DataFrame, d_date: DataFrame, params: Params, buckets: int | None = None) -> DataFrame:
    """T-6: order-line fact; unresolved keys become -1 (unknown member).

    The dimensions are read from written tables, so the planner knows their
    bytes; each is broadcast only under the session's threshold.  Beyond it,
    customers and products meet the lines in lookup joins that no customer or
    product with many lines can overload (:mod:`starmart.operators.lookup`).
    Dates and ship modes are resolved before the lines are moved, and what is
    derived from a line's own columns after; the lookups' hot keys are those
    of the staging lines, so no join is repeated to count them.

    ``buckets``: the staging table is dealt by the column BLOCK into so many,
    and its blocks are ranges of (order id, row id).  Then the keys come to the
    lines and the lines stay where they are, to be numbered there; the fact
    keeps its BLOCK.
    """
    dealt = [BLOCK] if buckets else []
    s = staging.where(F.col("order_id").isNotNull()).select(
        *dealt, "row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "product_id",
        "sales", "quantity", "discount", "profit")
    # a calendar and a handful of modes: no line in a block moves for them
    few = F.broadcast if buckets else (lambda d: d)
    ship = few(d_ship.select("ship_mode", "ship_mode_key"))
    dates = few(d_date.select("date_key"))
    od = dates.select(F.col("date_key").alias("od_key"))
    sd = dates.select(F.col("date_key").alias("sd_key"))
    lines = (s.join(ship, "ship_mode", "left")
             .join(od, date_key(F.col("order_date")) == F.col("od_key"), "left")
             .join(sd, date_key(F.col("ship_date")) == F.col("sd_key"), "left")
             .select(*dealt, "row_id", "order_id", "customer_id", "product_id",
                     F.coalesce("ship_mode_key", F.lit(-1).cast("long")).alias("ship_mode_key"),
                     F.coalesce("od_key", F.lit(-1)).alias("order_date_key"),
                     F.coalesce("sd_key", F.lit(-1)).alias("ship_date_key"),
                     "sales", "quantity", "discount", "profit"))
    joined = lines
    for d, key, found in ((d_customer, "customer_id", "customer_key"), (d_product, "product_id", "product_key")):
        joined = (lookup_in_blocks(joined, d, key, [found], BLOCK, buckets) if buckets
                  else lookup_join(joined, d, key, [found], "row_id", counted=s))
        joined = joined.drop(key).withColumn(found, F.coalesce(found, F.lit(-1).cast("long")))
    # the product key tells apart the lines of an id with two names
    order = [F.col(c).asc_nulls_last() for c in ("order_id", "row_id", "product_key")]
    if buckets:
        keyed = number_blocks(joined, order, "sales_key", buckets).rows
    else:
        keyed, _ = with_row_number(joined, order, "sales_key", params.order_partitions)
    sales, profit = F.col("sales"), F.col("profit")
    return keyed.select(
        *dealt, "sales_key", "customer_key", "product_key", "ship_mode_key", "order_date_key", "ship_date_key",
        "row_id", "order_id", "sales", "quantity", "discount", "profit",
        (sales - profit).alias("cost"),
        F.when(sales > 0, profit.cast("double") / sales.cast("double") * 100)
         .otherwise(F.lit(0.0)).alias("profit_margin_pct"),
        _audit(params).alias("loaded_at"),
    )


def fact_rules() -> Rules:
    """What the fact's constraints ask for: its key, its order and its five
    references, in the order in which a line's first violation is named."""
    references = ("customer_key", "product_key", "ship_mode_key", "order_date_key", "ship_date_key")
    return Rules("sales_key", ["order_id"], {c: -1 for c in references},
                 {"discount out of range": ~F.col("discount").between(0, 1)})


def fact_sales_view(fact: DataFrame) -> DataFrame:
    """The fact with money as DOUBLE (exact decimal inside, double outside)."""
    return fact.select(
        "sales_key", "customer_key", "product_key", "ship_mode_key", "order_date_key",
        "ship_date_key", "row_id", "order_id",
        F.col("sales").cast("double").alias("sales"), "quantity",
        F.col("discount").cast("double").alias("discount"),
        F.col("profit").cast("double").alias("profit"),
        F.col("cost").cast("double").alias("cost"),
        "profit_margin_pct", "loaded_at")


@dataclass
class Star:
    staging: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    dim_ship: DataFrame
    fact: DataFrame
    # optional cache for derived tables: (name, builder) -> DataFrame
    tables: object = None
    # optional: the fact with its BLOCK, each order in one block
    fact_blocks: DataFrame | None = None


def build_star(staging: DataFrame, params: Params, buckets: int | None = None) -> Star:
    """Dimensions first, each computed and written once; then the fact.
    ``buckets``: see :func:`fact_sales`."""
    dc = write_table(dim_customer(staging, params, buckets), "dim_customer")
    dp = write_table(dim_product(staging, params), "dim_product")
    dd = write_table(dim_date(staging), "dim_date")
    ds = write_table(dim_ship(staging, params), "dim_ship")
    fact = fact_blocks(staging, dc, dp, ds, dd, params, buckets)
    return Star(staging.drop(BLOCK), dc, dp, dd, ds, fact.drop(BLOCK), fact_blocks=fact if buckets else None)

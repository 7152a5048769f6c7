"""Read the driver's parquet tables and map them onto the raw order-line
layout the pipeline expects (FIXTURES.md section 2).

The raw layout is the reference's CSV, with snake-case names:

    row_id, order_id, order_date, ship_date, ship_mode, customer_id,
    customer_name, segment, country, city, state, postal_code, region,
    product_id, category, sub_category, product_name, sales, quantity,
    discount, profit
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.ordered import BLOCK, Blocks, joined_blocks
from starmart.sources.csv_ingest import RAW_COLUMNS_ORDER

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# sort order that makes row_id a total order on lineitem (FIXTURES.md: the
# six-column order is unique at every scale factor)
ROW_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
             "l_extendedprice")


def raw_order_lines(spark: SparkSession, sf_dir: str, num_partitions: int | None = None) -> DataFrame:
    """Order lines in the raw CSV layout, one row per lineitem."""
    return raw_blocks(spark, sf_dir, num_partitions).rows.drop(BLOCK)


def raw_blocks(spark: SparkSession, sf_dir: str, num_partitions: int | None = None) -> Blocks:
    """Order lines in the raw CSV layout, one row per lineitem, in blocks of
    consecutive orders (column BLOCK beside the layout's).

    Orders meet their customers before lines meet orders, and parts come to
    the blocks that ask for them, so lines are shuffled once; AQE broadcasts
    customer or part only while its runtime size is under the threshold.  nation and region are
    the 25 and 5 rows of the TPC-H spec, so they are joined to the customers
    first.  Lines are moved and written with the tables' own columns; what is
    derived from them is computed by each reader.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        *ROW_ORDER, "l_discount", F.col("l_shipdate").cast("date").alias("l_shipdate"))
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = F.broadcast(nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey))
    customer = (read_table(spark, sf_dir, "customer")
                .select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
                .join(geo, F.col("c_nationkey") == F.col("n_nationkey")))
    part = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_type", "p_retailprice")

    orders = (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
              .select("o_orderkey", "c_custkey", "o_orderdate", "o_orderpriority", "c_name", "c_nationkey",
                      "c_mktsegment", "n_name", "r_name"))
    # order lines are fact-sized: always the distributed numbering
    blocks = joined_blocks(li, orders, "l_orderkey", "o_orderkey",
                           [F.col(c).asc_nulls_last() for c in ROW_ORDER], li, "row_id", num_partitions,
                           {"l_partkey": part}, drop=("l_linenumber", "l_suppkey"))

    discount = F.col("l_discount").cast("decimal(4,2)")
    sales = (F.col("l_extendedprice").cast("decimal(18,2)") * (F.lit(1) - discount)).cast("decimal(18,4)")
    quantity = F.col("l_quantity").cast("int")
    profit = (sales - quantity * F.col("p_retailprice").cast("decimal(18,2)")).cast("decimal(18,4)")
    return Blocks(blocks.rows.select(
        BLOCK,
        "row_id",
        F.col("l_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_shipdate").alias("ship_date"),
        F.col("o_orderpriority").alias("ship_mode"),
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("r_name").alias("country"),
        F.concat(F.col("n_name"), F.lit("_"), (F.col("c_custkey") % 4).cast("string")).alias("city"),
        F.col("n_name").alias("state"),
        F.when(F.col("c_custkey") % 97 == 0, F.lit(None).cast("string"))
         .otherwise((F.lit(10000) + F.col("c_nationkey")).cast("string")).alias("postal_code"),
        F.col("r_name").alias("region"),
        F.col("l_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("p_name").alias("product_name"),
        sales.alias("sales"),
        quantity.alias("quantity"),
        discount.alias("discount"),
        profit.alias("profit"),
    ), blocks.buckets)


RAW_COLUMNS = RAW_COLUMNS_ORDER

"""The whole reference pipeline as one Spark application:
CSV -> staging -> dwh star -> marts -> ML results, each step a replace-load
of a parquet table in its namespace (staging, dwh, mart).

    python -m starmart.plans.pipeline --csv 'data/*.csv' --warehouse s3a://.../wh

The order of the reference's scripts is kept: 0 namespaces, 1 ingest,
2 dimensions, 3 fact, 4 marts (+ checks, + obsolete drops), 5 ML.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.params import Params
from starmart.plans import churn, marts, reports
from starmart.plans.star import Star, dim_customer, dim_date, dim_product, dim_ship, fact_sales
from starmart.session import write_table
from starmart.sources import catalog, csv_ingest

# Tables the reference drops at the end of its mart script.
OBSOLETE = ("dwh.fact_sales_test", "mart.sales_quartely", "mart.sales_by_day_type",
            "mart.aggregations")


def _checks(star: Star, built: dict[str, DataFrame], params: Params) -> dict[str, DataFrame]:
    """Primary keys of dimensions, fact and marts; foreign keys of the fact."""
    return {"fk_check": reports.fk_check(star, params),
            "key_check": reports.key_check(star, params).unionByName(reports.mart_key_check(built))}


def run(spark: SparkSession, staging: DataFrame, base_path: str, params: Params,
        with_ml: bool = True, churn_rounds: int = 150) -> dict[str, DataFrame]:
    """Every step reads the tables of the step before it; derived frames that
    several steps read (customer base, features, churn frame) are written once."""
    catalog.create_namespaces(spark, base_path)
    catalog.replace_table(staging, "staging.staging_raw")
    staging = spark.table("staging.staging_raw")
    dims = {"dim_customer": dim_customer(staging, params), "dim_product": dim_product(staging, params),
            "dim_date": dim_date(staging), "dim_ship": dim_ship(staging, params)}
    for name, df in dims.items():
        catalog.replace_table(df, f"dwh.{name}")
        dims[name] = spark.table(f"dwh.{name}")
    fact = fact_sales(staging, dims["dim_customer"], dims["dim_product"], dims["dim_ship"], dims["dim_date"], params)
    d = dims["dim_date"].select("date_key", F.year("full_date").alias("order_year"),
                                F.month("full_date").alias("order_month"))
    fact = fact.join(d, F.col("order_date_key") == F.col("date_key"), "left").drop("date_key")
    # by month, with large months split: not a file per task and month
    fact = fact.hint("rebalance", "order_year", "order_month")
    catalog.replace_table(fact, "dwh.fact_sales", partition_by=("order_year", "order_month"))
    cache: dict[str, DataFrame] = {}

    def written(name: str, build) -> DataFrame:
        if name not in cache:
            cache[name] = write_table(build(), name)
        return cache[name]

    star = Star(staging, dims["dim_customer"], dims["dim_product"], dims["dim_date"], dims["dim_ship"],
                spark.table("dwh.fact_sales").drop("order_year", "order_month"), written)
    built = marts.build_marts(star, params)
    for name, df in built.items():
        catalog.replace_table(df, f"mart.{name}")
        built[name] = spark.table(f"mart.{name}")
    tables = dict(built)
    tables["row_count_report"] = marts.row_count_report(built)
    tables.update(_checks(star, built, params))
    catalog.drop_tables(spark, OBSOLETE)
    if with_ml:
        cm = churn.train(star, params, max_iter=churn_rounds)
        catalog.replace_table(churn.ml_results(star, params, cm), "mart.customers_ML_results")
        tables["customers_ML_results"] = spark.table("mart.customers_ML_results")
    return tables


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--csv", required=True)
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--as-of", default=dt.date.today().isoformat())
    a = ap.parse_args()
    from starmart.session import drop_scratch, get_session

    spark = get_session()
    params = Params(as_of=dt.date.fromisoformat(a.as_of))
    out = run(spark, csv_ingest.stage_csv(spark, a.csv, params), a.warehouse, params)
    out["row_count_report"].show()
    drop_scratch(spark)


if __name__ == "__main__":
    main()

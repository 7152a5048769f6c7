"""The pipeline end to end through the catalog (IO-3 ... IO-9), and the
streaming ingest on landing files."""

import datetime as dt

from pyspark.sql import functions as F

from starmart.params import Params
from starmart.plans import pipeline
from starmart.sources import catalog, csv_ingest
from starmart.streaming import ingest
from tests.conftest import line

D = dt.date
P = Params(as_of=D(2021, 12, 31), current_year=2021, bad_row_ids=())


def _staging(make_staging):
    rows = [line(i, 100 + i // 3, D(2021, 1 + i % 12, 1 + i % 28), customer_id=i % 6,
                 product_id=i % 5, sales=f"{20 + i}.5", profit=f"{i % 7 - 2}.25",
                 discount="0.2" if i % 4 == 0 else "0") for i in range(1, 60)]
    return make_staging(rows)


def test_pipeline_tables(spark, make_staging, tmp_path):
    out = pipeline.run(spark, _staging(make_staging), str(tmp_path / "wh"), P, with_ml=False)
    names = {r.namespace for r in catalog.list_namespaces(spark).collect()}
    assert {"staging", "dwh", "mart"} <= names
    counts = {r.table_name: r.rows for r in out["row_count_report"].collect()}
    assert counts["executive_summary"] == 1 and counts["customers"] == 6
    assert [r.orphan_rows for r in out["fk_check"].collect()] == [0] * 5
    assert all(r.null_keys == 0 and r.duplicate_keys == 0 for r in out["key_check"].collect())
    # the fact is partitioned by order year / month: a filter prunes partitions
    fact = catalog.read_table(spark, "dwh.fact_sales", ["sales_key", "sales"],
                              "order_year = 2021 AND order_month = 3")
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "order_month" in plan
    assert fact.count() == 5
    assert ("sales_key", "bigint") in catalog.schema_listing(spark.table("dwh.fact_sales"))
    catalog.drop_tables(spark, ["dwh.fact_sales"])
    assert not spark.catalog.tableExists("dwh.fact_sales")


def test_pipeline_with_machine_learning_from_csv(spark, make_staging, tmp_path):
    """CSV with text ids to the ML results; few boosting rounds."""
    staged = make_staging([
        line(i, 100 + i // 2, D(2021, 1 + i % 12, 1 + i % 28), customer_id=i % 40, product_id=i % 5,
             sales=f"{20 + i * 7 % 90}.5", profit=f"{i % 7 - 2}.25", discount="0.2" if i % 4 == 0 else "0",
             segment=("Consumer", "Corporate")[i % 40 % 2]) for i in range(1, 400)])
    text = staged.withColumn("customer_id", F.concat(F.lit("CG-"), "customer_id"))
    csv_ingest.export_csv(text, str(tmp_path / "csv"))
    out = pipeline.run(spark, csv_ingest.stage_csv(spark, str(tmp_path / "csv"), P), str(tmp_path / "wh"), P,
                       churn_rounds=3)
    rows = out["customers_ML_results"].collect()
    assert rows and all(r.customer_id.startswith("CG-") and 0 <= r.churn_probability <= 1 for r in rows)
    assert {r.final_cluster_label for r in rows} == {"Occasional Buyers", "Loyal High-Value Customers"}
    assert sum(r["rows"] for r in out["row_count_report"].collect()) > 0


def test_streaming_ingest_is_incremental(spark, make_staging, tmp_path):
    staged = _staging(make_staging)
    landing, target, ck = (str(tmp_path / x) for x in ("landing", "out", "ck"))
    csv_ingest.export_csv(staged.where("row_id <= 30"), landing + "/a")
    q = ingest.start_staging_load(spark, landing + "/*", target, ck, P)
    q.awaitTermination()
    assert spark.read.parquet(target).count() == 30
    csv_ingest.export_csv(staged.where("row_id > 30"), landing + "/b")
    q = ingest.start_staging_load(spark, landing + "/*", target, ck, P)
    q.awaitTermination()
    got = spark.read.parquet(target)
    assert got.count() == 59  # each file once, none repeated
    assert got.agg(F.sum("sales")).first()[0] == staged.agg(F.sum("sales")).first()[0]

"""The load gate: counts of the write equal the checks, bad rows are set aside."""

import pytest
from pyspark.sql import functions as F

from starmart.operators import quality
from starmart.operators.gate import Rules, Violations, gated_load
from starmart.sources import catalog


@pytest.fixture
def space(spark, tmp_path):
    catalog.create_namespaces(spark, str(tmp_path), ("gated",))
    yield "gated"
    spark.sql("DROP DATABASE gated CASCADE")


def rows(spark):
    data = [(i, i % 4 if i % 10 else -1, f"n{i}" if i % 7 else None, float(i - 3)) for i in range(60)]
    data += [(5, 1, "again", 1.0), (5, 1, "again", 1.0), (None, 2, "no key", 1.0)]
    return spark.createDataFrame(data, "id long, dim long, name string, amount double").repartition(3)


def rules():
    return Rules("id", ["name"], {"dim": -1}, {"negative amount": F.col("amount") < 0})


def test_counts_equal_the_checks(spark, space):
    df, dims = rows(spark), spark.range(4).withColumnRenamed("id", "pk")
    got = gated_load(df, f"{space}.fact", rules())
    key = quality.key_violations(df, "id", "fact").first()
    orphans = quality.orphan_count(df, "dim", dims, "pk", "fk").first()
    nulls = {r.column_name: r.nulls for r in quality.null_counts(df).collect()}
    assert got["rows"] == key.rows == df.count()
    assert got["null key id"] == key.null_keys == 1
    assert got["repeated key id"] == 3 and key.duplicate_keys == 1
    assert got["orphan dim"] == orphans.orphan_rows
    assert {c: got[f"nulls {c}"] for c in nulls} == nulls and got["null name"] == nulls["name"]
    assert got["negative amount"] == 3


def test_rows_are_set_aside_with_a_reason(spark, space):
    df = rows(spark)
    got = gated_load(df, f"{space}.fact", rules())
    kept, bad = spark.table(f"{space}.fact"), spark.table(f"{space}.fact_quarantine")
    assert kept.count() == got["accepted"] and bad.count() == got["quarantined"] == got["rows"] - got["accepted"]
    fine = df.where("id IS NOT NULL AND id <> 5 AND name IS NOT NULL AND dim <> -1 AND amount >= 0")
    assert sorted(map(str, kept.select(*df.columns).collect())) == sorted(map(str, fine.collect()))
    by = {r.violation: r["count"] for r in bad.groupBy("violation").count().collect()}
    assert by["null key id"] == 1 and by["repeated key id"] == 3 and sum(by.values()) == got["quarantined"]
    assert [r.violation for r in bad.where("id = 0").collect()] == ["null name"]  # the first of its reasons


def test_too_many_violations_leave_the_table(spark, space):
    clean = spark.createDataFrame([(1, 1, "a", 1.0), (2, 2, "b", 2.0)], "id long, dim long, name string, amount double")
    assert gated_load(clean, f"{space}.fact", rules(), allowed=0)["quarantined"] == 0
    with pytest.raises(Violations, match="rows break the rules"):
        gated_load(rows(spark), f"{space}.fact", rules(), allowed=5)
    assert spark.table(f"{space}.fact").count() == 2 and spark.table(f"{space}.fact_quarantine").count() == 0
    assert gated_load(rows(spark), f"{space}.fact", rules(), ["dim"], allowed=50)["quarantined"] <= 50
    plan = spark.table(f"{space}.fact").where("dim = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "quarantined" in plan


def test_no_rows(spark, space):
    got = gated_load(rows(spark).limit(0), f"{space}.fact", rules())
    assert got["rows"] == got["quarantined"] == 0
    assert spark.table(f"{space}.fact").collect() == [] and spark.table(f"{space}.fact").columns[:2] == ["id", "dim"]

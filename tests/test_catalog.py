"""Replace-loads that switch at once (IO-3, IO-5) and what they leave behind."""

import pytest
from pyspark.sql import functions as F

from starmart.sources import catalog


@pytest.fixture
def space(spark, tmp_path):
    catalog.create_namespaces(spark, str(tmp_path), ("loads",))
    yield "loads"
    spark.sql("DROP DATABASE loads CASCADE")


def test_load_that_dies_half_way_leaves_the_old_table(spark, space):
    name = f"{space}.t"
    catalog.replace_table(spark.range(100).selectExpr("id", "id % 3 AS g"), name)
    first = catalog.current_version(spark, name)
    reader = spark.table(name)
    # the last partition fails after the others have written their files
    broken = spark.range(0, 1000, 1, 4).selectExpr(
        "id", "CASE WHEN id = 999 THEN cast(raise_error('lost') AS bigint) ELSE id % 5 END AS g")
    with pytest.raises(Exception, match="lost"):
        catalog.replace_table(broken, name)
    assert catalog.current_version(spark, name) == first
    assert spark.table(name).count() == 100 and reader.count() == 100
    assert spark.table(name).columns == ["id", "g"]


def test_versions_kept_and_dropped(spark, space):
    name = f"{space}.t"
    seen = []
    for n in (5, 6, 7):
        catalog.replace_table(spark.range(n).withColumn(f"c{n}", F.lit(n)), name)
        seen.append(catalog.current_version(spark, name))
        assert spark.table(name).count() == n and spark.table(name).columns == ["id", f"c{n}"]
    assert len(set(seen)) == 3
    # the version before stays for its readers; older ones are gone
    assert set(catalog.versions(spark, name)) == set(seen[1:])
    catalog.drop_tables(spark, [name, name])
    assert not spark.catalog.tableExists(name) and catalog.versions(spark, name) == []


def test_reader_of_the_version_before(spark, space):
    name = f"{space}.t"
    catalog.replace_table(spark.range(50), name)
    reader = spark.table(name)
    catalog.replace_table(spark.range(3), name)
    assert reader.count() == 50 and spark.table(name).count() == 3


def test_table_may_read_itself(spark, space):
    name = f"{space}.t"
    catalog.replace_table(spark.range(10), name)
    catalog.replace_table(spark.table(name).where("id > 6"), name)
    assert sorted(r.id for r in spark.table(name).collect()) == [7, 8, 9]


def test_partitions_keep_types_and_prune(spark, space):
    name = f"{space}.p"
    df = spark.range(40).selectExpr("id", "cast(id % 4 AS string) AS code", "cast(id % 2 AS long) AS half")
    catalog.replace_table(df, name, partition_by=("code", "half"))
    assert dict(spark.table(name).dtypes) == dict(df.dtypes)
    assert catalog.read_table(spark, name, ["id"], "code = '3'").count() == 10
    plan = catalog.read_table(spark, name, ["id"], "half = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(half" in plan


def test_table_loaded_before_there_were_versions(spark, space):
    name = f"{space}.old"
    spark.range(4).write.format("parquet").saveAsTable(name)
    catalog.replace_table(spark.range(9), name)
    assert spark.table(name).count() == 9

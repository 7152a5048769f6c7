"""The distributed ordering operators against Spark's single-partition
windows, on data with heavy ties and a hot value."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators.ordered import (
    grouped_exact_quantiles,
    joined_row_number,
    with_rank,
    with_row_number,
    with_running_sums,
)
from starmart.operators.selection import Key, exact_quantiles, ntiles


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 3000
    v = rng.integers(0, 50, n).astype(float)
    v[: n // 3] = 17.0  # a third of all rows share one value
    g = rng.choice(["a", "b", "c"], n, p=[0.6, 0.3, 0.1])
    rows = [(i, float(v[i]), str(g[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, v double, g string")


def test_row_number_matches_window(skewed):
    order = [F.col("v").desc(), F.col("id").asc()]
    ours, total = with_row_number(skewed, order, "rn", num_partitions=7)
    ref = skewed.withColumn("rn_ref", F.row_number().over(Window.orderBy(*order)))
    j = ours.join(ref, ["id", "v", "g"])
    assert total == 3000
    assert j.where(F.col("rn") != F.col("rn_ref")).count() == 0
    assert j.count() == 3000


@pytest.mark.parametrize("buckets", [5, 7, 10])
def test_ntile_matches_window(skewed, buckets):
    order = [F.col("v").asc(), F.col("id").asc()]
    ours = ntiles(skewed, buckets, {"t": [Key("v"), Key("id")]})
    ref = skewed.withColumn("t_ref", F.ntile(buckets).over(Window.orderBy(*order)))
    assert ours.join(ref, "id").where(F.col("t") != F.col("t_ref")).count() == 0


def test_ntile_fewer_rows_than_buckets(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0)], "id long, v double")
    out = ntiles(df, 5, {"t": [Key("v", descending=True), Key("id")]})
    assert sorted((r.id, r.t) for r in out.collect()) == [(1, 1), (2, 2), (3, 3)]


def test_rank_global_and_partitioned(skewed):
    ours = with_rank(skewed, ["v"], [F.col("v").desc()], [F.col("id")], "r", num_partitions=6)
    ref = skewed.withColumn("r_ref", F.rank().over(Window.orderBy(F.col("v").desc())))
    assert ours.join(ref, "id").where(F.col("r") != F.col("r_ref")).count() == 0
    ours_p = with_rank(skewed, ["v"], [F.col("v").desc()], [F.col("id")], "r",
                       partition_cols=["g"], num_partitions=6)
    ref_p = skewed.withColumn(
        "r_ref", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc())))
    assert ours_p.join(ref_p, "id").where(F.col("r") != F.col("r_ref")).count() == 0


def test_rank_null_values_first_when_descending(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0), (3, 3.0), (4, 1.0)], "id long, v double")
    out = with_rank(df, ["v"], [F.col("v").desc_nulls_first()], [F.col("id")], "r",
                    num_partitions=2)
    assert sorted((r.id, r.r) for r in out.collect()) == [(1, 1), (2, 2), (3, 2), (4, 4)]


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_rank_of_a_run_over_many_partitions(spark, parts):
    """One value and one group span whole range partitions; NaN and NULL too."""
    rows = [(i, float("nan") if i % 10 == 0 else None if i % 11 == 0 else 5.0 if i % 4 else float(i % 3),
             "hot" if i % 5 else None) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, v double, g string")
    for keys in ([], ["g"]):
        ours = with_rank(df, ["v"], [F.col("v").desc_nulls_first()], [F.col("id")], "r", keys, parts)
        w = (Window.partitionBy(*keys) if keys else Window).orderBy(F.col("v").desc_nulls_first())
        ref = {r.id: r.x for r in df.withColumn("x", F.rank().over(w)).collect()}
        assert {r.id: r.r for r in ours.collect()} == ref


@pytest.mark.parametrize("parts", [1, 3, 8])
@pytest.mark.parametrize("kind", ["double", "decimal(12,3)", "bigint"])
def test_running_sums_keep_their_type(spark, parts, kind):
    df = spark.range(1000).select("id", F.when(F.col("id") % 7 != 0, (F.col("id") % 13 - 6) * F.lit(0.75)).cast(kind).alias("v"))
    ours, total = with_running_sums(df, [F.col("id").asc()], {"cum": F.col("v")}, parts)
    w = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ref = df.withColumn("ref", F.sum("v").over(w))
    assert ours.schema["cum"].dataType == ref.schema["ref"].dataType
    assert ours.join(ref, "id").where(~F.col("cum").eqNullSafe(F.col("ref"))).count() == 0
    assert total["cum"] == df.agg(F.sum("v")).first()[0]


def test_running_sums(skewed):
    order = [F.col("v").asc(), F.col("id").asc()]
    ours, tot = with_running_sums(skewed, order, {"cum": F.col("v")}, num_partitions=5)
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ref = skewed.withColumn("cum_ref", F.sum("v").over(w))
    assert ours.join(ref, "id").where(F.abs(F.col("cum") - F.col("cum_ref")) > 1e-9).count() == 0
    assert tot["cum"] == pytest.approx(skewed.agg(F.sum("v")).first()[0])


def test_exact_quantiles_match_numpy(skewed):
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(skewed, "v", probs, [f"p{i}" for i in range(len(probs))]).first()
    vals = np.array([r.v for r in skewed.select("v").collect()])
    for i, p in enumerate(probs):
        assert got[f"p{i}"] == pytest.approx(np.percentile(vals, p * 100), abs=1e-12)


def test_grouped_quantiles_match_numpy(skewed):
    got = {r.g: r for r in grouped_exact_quantiles(skewed, "g", "v", [0.1, 0.5, 0.9],
                                                   ["a", "b", "c"], 4).collect()}
    pdf = skewed.toPandas()
    for g, sub in pdf.groupby("g"):
        exp = np.percentile(sub.v.to_numpy(), [10, 50, 90])
        assert [got[g].a, got[g].b, got[g].c] == pytest.approx(list(exp), abs=1e-12)


def test_hot_value_is_spread_over_partitions(skewed):
    """A third of the rows share one value; ordering ends in the unique id,
    so the range layout still splits them evenly (no straggler task)."""
    from starmart.operators.ordered import _PID, _range_layout

    laid = _range_layout(skewed, [F.col("v").asc(), F.col("id").asc()], 8)
    sizes = [r["count"] for r in laid.groupBy(_PID).count().collect()]
    assert sum(sizes) == 3000 and len(sizes) == 8
    assert max(sizes) < 0.2 * 3000  # the hot value alone would be a third


def test_joined_row_number_matches_the_window_over_the_join(spark):
    rng = np.random.default_rng(3)
    keys = [None, -5, 10 ** 12, *rng.integers(0, 60, 700).tolist()]
    big = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i long")
    # keys that come twice, a null one and one that no line has
    small = spark.createDataFrame([(k, f"s{k}") for k in [None, -5, 999, *range(5, 60), 7, 7]], "o long, s string")
    order = [F.col("k").asc_nulls_last(), F.col("i").asc_nulls_last()]
    ours = joined_row_number(big, small, "k", "o", order, big.select("k"), "rn", 3)
    assert ours.columns == ["k", "i", "s", "rn"]
    ref = big.join(small, F.col("k") == F.col("o")).drop("o").withColumn("rn", F.row_number().over(Window.orderBy(*order)))
    assert sorted((r.k, r.i, r.s) for r in ours.collect()) == sorted((r.k, r.i, r.s) for r in ref.collect())
    assert [(r.k, r.i, r.rn) for r in ours.orderBy("rn").collect()] == [(r.k, r.i, r.rn) for r in ref.orderBy("rn").collect()]


def test_joined_row_number_without_rows(spark):
    big = spark.createDataFrame([], "k long, i long")
    small = spark.createDataFrame([(1, "a")], "o long, s string")
    assert joined_row_number(big, small, "k", "o", [F.col("k"), F.col("i")], big, "rn", 2).count() == 0


def test_a_written_table_is_dealt_into_tasks_by_its_rows(spark, monkeypatch):
    from starmart import session

    monkeypatch.setattr(session, "TASK_ROWS", 100)
    rows = spark.range(1000).coalesce(1)
    assert session.spread(rows, "id").rdd.getNumPartitions() == 10
    assert session.spread(rows.limit(100), "id").rdd.getNumPartitions() == 1

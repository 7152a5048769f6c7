"""Tables in blocks: lines are shuffled once, and what the star build gives is
what it gives over staging lines that are not in blocks."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators import ordered
from starmart.operators.lookup import lookup_in_blocks, lookup_join
from starmart.operators.ordered import BLOCK, joined_blocks
from starmart.params import FIXTURE_PARAMS as P
from starmart.plans import marts, star
from starmart.session import dealt_plans
from starmart.sources import testdata
from starmart.sources.csv_ingest import clean


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def tables(spark, tmp_path):
    """A folder of odd tables: keys that repeat, are null or find nothing, a
    product with two names, a customer with a third of all lines."""
    rng = np.random.default_rng(5)

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    write("region", [(0, "Europe")], "r_regionkey int, r_name string")
    write("nation", [(i, f"n{i}", 0) for i in range(3)], "n_nationkey int, n_name string, n_regionkey int")
    write("customer", [(i, f"c{i}", (i or 0) % 4, "s") for i in [None, *range(1, 40), 7]],
          "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")
    write("part", [(i, f"p{i}", "b", "t", (i or 0) + 0.5) for i in [None, *range(1, 30)]] + [(3, "other", "b", "t", 9.25)],
          "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double")
    custs = [1 if i % 3 == 0 else int(rng.integers(1, 45)) for i in range(120)]
    write("orders", [(i if i != 50 else None, c, dt.datetime(2000, 1, 1 + i % 28), f"p{i % 3}") for i, c in enumerate(custs)],
          "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string")
    lines = [(int(rng.integers(0, 130)) if i % 40 else None, i % 4, int(rng.integers(1, 33)) if i % 30 else None, 1, 2.0,
              100.25 + i, 0.05, dt.datetime(2000, 2, 1 + i % 28)) for i in range(900)]
    write("lineitem", lines, "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_quantity double, "
                             "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz")
    return str(tmp_path)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_joined_blocks_number_the_join_and_its_lookups(spark, no_broadcast):
    rng = np.random.default_rng(3)
    keys = [None, -5, 70, *rng.integers(0, 60, 700).tolist()]
    big = spark.createDataFrame([(k, i, i % 9 if i % 50 else None) for i, k in enumerate(keys)], "k long, i long, a long")
    small = spark.createDataFrame([(k, f"s{k}") for k in [None, -5, 999, *range(5, 60), 7, 7]], "o long, s string")
    table = spark.createDataFrame([(a, f"t{a}{n}") for a in (0, 1, 2, 3, 5, None) for n in range(1 + a % 2 if a else 1)], "a long, t string")
    order = [F.col(c).asc_nulls_last() for c in ("k", "i", "s", "t")]
    ours = joined_blocks(big, small, "k", "o", order, big.select("k"), "rn", 3, {"a": table}, drop=("i",))
    ref = (big.join(small, F.col("k") == F.col("o")).drop("o").join(table, "a")
           .withColumn("rn", F.row_number().over(Window.orderBy(*order))))
    assert "i" not in ours.rows.columns and ours.buckets == 3
    columns = ["k", "a", "s", "t", "rn"]
    assert _rows(ours.rows.select("rn", "k", "a", "s")) == _rows(ref.select("rn", "k", "a", "s"))
    assert _rows(ours.rows.select(*columns[:4])) == _rows(ref.select(*columns[:4]))
    blocks = [r[BLOCK] for r in ours.rows.orderBy("rn").collect()]
    assert blocks == sorted(blocks) and len(set(blocks)) > 3


def test_lookup_in_blocks_moves_keys_only(spark, no_broadcast):
    big = spark.createDataFrame([(i // 3, i, None if i % 11 == 0 else 5 if i % 3 else i % 20) for i in range(600)], "k long, i long, key long")
    small = spark.createDataFrame([(k, f"v{k}") for k in [*range(2, 15), 4, None]], "key long, v string")
    head = spark.range(200).withColumnRenamed("id", "o")
    laid = joined_blocks(big, head, "k", "o", [F.col("k"), F.col("i")], big, "rn", 4)
    with dealt_plans(spark, laid.buckets):
        out = lookup_in_blocks(laid.rows, small, "key", ["v"], BLOCK, laid.buckets)
        plan = out._jdf.queryExecution().executedPlan().toString()
        ours = _rows(out.select("i", "key", "v"))
    # the keys of the blocks to the lookup rows, these, and what is found to the blocks
    assert sum(" Exchange " in row or "- Exchange " in row for row in plan.splitlines()) == 3
    assert ours == _rows(lookup_join(big, small, "key", ["v"], "i").select("i", "key", "v"))


def test_star_in_blocks_gives_the_rows_of_the_plain_star(spark, tables, no_broadcast, monkeypatch):
    monkeypatch.setattr(ordered, "BUCKET_ROWS", 200)
    raw = testdata.raw_blocks(spark, tables)
    assert raw.buckets == 5
    params = P.with_(bad_row_ids=(3, 4, 200))
    plain = star.build_star(clean(raw.rows.drop(BLOCK), params), params)
    ours = star.build_star(clean(raw.rows, params), params, raw.buckets)
    assert ours.staging.columns == plain.staging.columns and ours.fact.columns == plain.fact.columns
    for name in ("dim_customer", "dim_product", "dim_date", "dim_ship", "fact"):
        got, want = getattr(ours, name), getattr(plain, name)
        assert got.schema.simpleString() == want.schema.simpleString()
        assert _rows(got) == _rows(want) and want.count() > 0
    got, want = marts.compute_customer_base(ours, params), marts.compute_customer_base(plain, params)
    assert got.schema.simpleString() == want.schema.simpleString() and _rows(got) == _rows(want)


def test_star_lines_are_shuffled_once(spark, tables, no_broadcast, monkeypatch):
    """Raw lines go through one exchange as whole rows, the fact's through none."""
    monkeypatch.setattr(ordered, "BUCKET_ROWS", 200)
    plans = []
    real = ordered.write_dealt

    def seen(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString().splitlines())
        return real(df, *args)

    monkeypatch.setattr(ordered, "write_dealt", seen)
    raw = testdata.raw_blocks(spark, tables)
    star.build_star(clean(raw.rows, P), P, raw.buckets)
    assert len(plans) == 2

    def above(plan, scan):
        """How often the rows of a scan are shuffled on their way up."""
        at = max(i for i, row in enumerate(plan) if scan(row))
        depth, moves = len(plan[at]) - len(plan[at].lstrip(" :+-")), 0
        for row in reversed(plan[:at]):
            own = len(row) - len(row.lstrip(" :+-"))
            if own < depth:
                depth, moves = own, moves + row.lstrip(" :+-").startswith("Exchange")
        return moves

    assert above(plans[0], lambda row: "FileScan" in row and "l_extendedprice" in row) == 1
    assert above(plans[1], lambda row: "FileScan" in row and "l_extendedprice" in row) == 0

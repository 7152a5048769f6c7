"""Lookup joins without hot keys and connected components by contraction."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.operators import components as contraction
from starmart.operators import lookup
from starmart.operators.components import components
from starmart.operators.lookup import lookup_join


@pytest.mark.parametrize("how,hot", [("left", 8), ("inner", 8), ("left", 1), ("inner", 1)])
def test_lookup_join_equals_plain_join(spark, monkeypatch, how, hot):
    """Hot, cold, missing and null keys; columns named as the operator's own."""
    monkeypatch.setattr(lookup, "HOT", hot)
    rows = [(i, None if i % 11 == 0 else 1 if i % 3 else 2 if i % 2 else i % 50 + 100, i) for i in range(600)]
    big = spark.createDataFrame(rows, "id long, key long, found int").repartition(4)
    small = spark.createDataFrame([(1, "one", 1.0)] + [(i, f"n{i}", float(i)) for i in range(100, 140)], "key long, name string, value double")
    got = lookup_join(big, small, "key", ["name", "value"], "id", how)
    want = big.join(small, "key", how).select("id", "key", "found", "name", "value")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    monkeypatch.setattr(lookup, "HOT", 8)
    assert set(lookup.hot_keys(big, "key")) == {1, 2}  # 2 has no lookup row


def test_hot_key_is_spread(spark):
    """Three quarters of the rows share a key: without broadcasts by size and
    without skew handling, no task of the join gets over twice the median."""
    rows = spark.range(0, 40000, 1, 4).selectExpr("id", "CASE WHEN id % 4 > 0 THEN 7 ELSE id % 3000 END AS key")
    small = spark.range(3000).selectExpr("id AS key", "concat('n', id) AS name")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = lookup_join(rows, small, "key", ["name"], "id").withColumn("task", F.spark_partition_id())
        held = sorted(r.n for r in out.groupBy("task").agg(F.count("name").alias("n")).collect())
        assert sum(held) == 40000 and len(held) == 8 and held[-1] <= 2 * held[4]
        assert out.where("name IS NULL OR name <> concat('n', key)").count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _truth(n, edges):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for u, v in edges:
            m = min(label[u], label[v])
            if label[u] != m or label[v] != m:
                label[u] = label[v] = m
                changed = True
    return label


@pytest.mark.parametrize("shape,few", [("chain", 10), ("star", 0), ("random", 5), ("mixed", 1 << 16)])
def test_components(spark, monkeypatch, shape, few):
    monkeypatch.setattr(contraction, "FEW", few)
    g = np.random.default_rng(4)
    n = 200
    edges = {"chain": [(i, i + 1) for i in range(n - 1)], "star": [(7, i) for i in range(n)],
             "random": [tuple(map(int, g.integers(0, n, 2))) for _ in range(110)],
             "mixed": [(i, i + 1) for i in range(0, 90)] + [(150, i) for i in range(100, 199)] + [(5, 5), (150, 199)]}[shape]
    links = spark.createDataFrame(edges + edges[:20], "u long, v long")
    label = _truth(n, edges)
    ends = {x for u, v in edges if u != v for x in (u, v)}
    assert {r.node: r.component for r in components(links).collect()} == {x: label[x] for x in ends}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
    assert components(spark.createDataFrame([(1, 1), (None, 2)], "u long, v long")).collect() == []

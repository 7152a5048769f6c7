"""Exact selection by histogram refinement against sorted rows."""

import datetime as dt
import functools
import math
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.operators import selection
from starmart.operators.selection import Key, column_quantiles, is_after, ntiles, rows_at

SCHEMA = ("id long, n long, d double, m decimal(18,4), s string, t timestamp, day date, b boolean")


def rows(n=400, seed=1):
    g = np.random.default_rng(seed)
    words = ["", "a", "a\u0000", "ab", "abc", "abcdefgh", "abcdefgi", "b", "ä", "z" * 40, "z" * 39 + "y"]
    out = []
    for i in range(n):
        out.append((i, None if i % 17 == 0 else int(g.choice([-(2 ** 62), -5, 0, 7, 8, 2 ** 62, int(g.integers(0, 90))])),
                    None if i % 13 == 0 else float(g.choice([-math.inf, -1e300, -1.5, 0.0, 1e-300, 3.25, 1e300, math.inf, math.nan, g.normal()])),
                    Decimal(int(g.integers(-10 ** 6, 10 ** 6))) / 10000 + (10 ** 13 if i % 5 == 0 else 0),
                    None if i % 19 == 0 else str(g.choice(words)), dt.datetime(2020, 1, 1) + dt.timedelta(microseconds=int(g.integers(0, 10 ** 13))),
                    dt.date(2020, 1, 1) + dt.timedelta(days=int(g.integers(0, 50))), None if i % 23 == 0 else bool(i % 3)))
    return out


def in_order(data, keys, names):
    """The rows sorted by plain comparison."""
    def compare(x, y):
        for k in keys:
            a, b = x[names.index(k.column)], y[names.index(k.column)]
            if a is None or b is None:
                if a is None and b is None:
                    continue
                return -1 if (a is None) == k.nulls_first else 1
            if isinstance(a, float):  # NaN stands above every number
                a, b = (a != a, 0 if a != a else a), (b != b, 0 if b != b else b)
            if isinstance(a, str):
                a, b = a.encode(), b.encode()
            if a != b:
                return -1 if (a < b) != k.descending else 1
        return 0
    return sorted(data, key=functools.cmp_to_key(compare))


@pytest.mark.parametrize("bins", [1024, 3])
@pytest.mark.parametrize("column", ["n", "d", "m", "s", "t", "day", "b"])
def test_rows_at(spark, monkeypatch, column, bins):
    monkeypatch.setattr(selection, "BINS", bins)
    monkeypatch.setattr(selection, "FEW", 0 if bins == 3 else 20)  # 0: refine to single rows
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(3).cache()
    names, ranks = df.columns, [1, 30, 200, 201, 400, 401, 0]
    for keys in ([Key(column), Key("id")], [Key(column, True, True), Key("id", True)]):
        if bins == 3 and keys[0].descending:
            continue
        want = in_order(data, keys, names)
        got = rows_at(df, [(keys, r) for r in ranks])
        for r, found in zip(ranks, got):
            if not 1 <= r <= 400:
                assert found is None
                continue
            assert found[1] == want[r - 1][0], (column, r)
            v = want[r - 1][names.index(column)]
            assert found[0] == v or (v != v and found[0] != found[0])


def test_scopes_and_after(spark):
    data = rows(200, 2)
    df = spark.createDataFrame(data, SCHEMA)
    keys = [Key("s", nulls_first=True), Key("id")]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    odd = F.col("id") % 2 == 1
    found = rows_at(df, [(keys, 40), (keys, 40)], [odd, None])
    sub = in_order([r for r in data if r[0] % 2], keys, df.columns)
    assert found[0] == (sub[39][4], sub[39][0])
    want = in_order(data, keys, df.columns)
    after = {r.id for r in df.where(is_after(keys, found[1], kinds)).collect()}
    assert after == {r[0] for r in want[40:]}


def test_hot_value_and_many_targets(spark):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7.5D ELSE cast(id AS double) END AS v")
    out = ntiles(df, 10, {"up": [Key("v"), Key("id")], "down": [Key("v", True, True), Key("id")]}).collect()
    up = sorted(out, key=lambda r: (r.v, r.id))
    assert [r.up for r in up] == [1 + i // 300 for i in range(3000)]
    down = sorted(out, key=lambda r: (-r.v, r.id))
    assert [r.down for r in down] == [1 + i // 300 for i in range(3000)]


def test_no_range_exchange(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS v")
    plan = ntiles(df, 5, {"t": [Key("v"), Key("id")]})._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan and "Exchange" not in plan and "Window" not in plan


def test_column_quantiles(spark):
    df = spark.createDataFrame([(float(i * i % 101), None, i if i % 4 else None) for i in range(200)],
                               "a double, none double, c int")
    got = column_quantiles(df, ["a", "none", "c"], [0.0, 0.3, 0.5, 1.0])
    for values, found in ((np.array([i * i % 101 for i in range(200)], float), got[0]),
                          (np.array([i for i in range(200) if i % 4], float), got[2])):
        assert found == pytest.approx(list(np.percentile(values, [0, 30, 50, 100])), abs=1e-12)
    assert got[1] == [None] * 4
    assert column_quantiles(df.limit(0), ["a"], [0.5]) == [[None]]

"""The driver contract, and Spark-vs-DuckDB parity at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="testdata not present")


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_sales" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.oracle_sql()) >= 60


@pytest.mark.parametrize("name", ["fact_sales", "customers", "product_sales", "customer_cohorts",
                                  "executive_summary", "describe", "roc_curve"])
def test_oracle_parity(spark, name):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    dorder = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    srows = sorted((tuple(r[i] for i in order) for r in sdf.collect()), key=repr)
    drows = sorted((tuple(r[i] for i in dorder) for r in rel.fetchall()), key=repr)
    assert srows == drows


def test_flagship_plan_prunes_and_broadcasts(spark):
    """The monthly mart reads only the fact columns it uses, broadcasts the
    date dimension and aggregates partially before the shuffle."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        E.queries()["sales_monthly"](spark, SF).explain("formatted")
    plan = buf.getvalue()
    assert "BroadcastHashJoin" in plan
    fact_scans = [ln for ln in plan.splitlines() if "ReadSchema" in ln and "order_date_key" in ln]
    assert fact_scans and all("loaded_at" not in ln and "row_id" not in ln for ln in fact_scans)
    assert plan.count("HashAggregate") >= 2


def test_fits_run_together_and_each_once(monkeypatch):
    import threading

    from starmart import registry as R

    met, seen = threading.Barrier(2, timeout=20), []

    def fit(spark, sf_dir, method, i):
        seen.append((method, i))
        met.wait()  # nobody gets past alone

    monkeypatch.setattr(R, "_star", lambda spark, sf_dir: None)
    monkeypatch.setattr(R.segmentation, "features_frame", lambda *a: None)
    monkeypatch.setattr(R, "_labelled", fit)
    R._fit_together(None, "", ["kmeans", "dbscan"])
    assert sorted(seen) == [("dbscan", 0), ("dbscan", 3), *[("kmeans", i) for i in range(4)]]

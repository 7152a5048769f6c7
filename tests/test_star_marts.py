"""Star schema and marts on hand-made frames (FIXTURES.md section 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart.params import Params
from starmart.plans import marts, reports
from starmart.plans.star import build_star
from tests.conftest import line

D = dt.date
P = Params(as_of=D(2021, 12, 31), current_year=2021, bad_row_ids=())


def test_fanout_keep_and_dedupe(make_staging):
    rows = [line(1, 100, D(2021, 1, 4), product_id=7, product_name="Chair A"),
            line(2, 101, D(2021, 1, 5), product_id=7, product_name="Chair B"),
            line(3, 102, D(2021, 1, 6), product_id=8, product_name="Desk")]
    st = make_staging(rows)
    keep = build_star(st, P)
    assert keep.dim_product.count() == 3
    assert keep.fact.count() == 5  # each line of product 7 matches two dim rows
    dedupe = build_star(st, P.with_(fanout="dedupe"))
    assert dedupe.dim_product.count() == 2
    assert dedupe.fact.count() == 3
    name = dedupe.dim_product.where("product_id = 7").first().product_name
    assert name == "Chair A"


def test_unknown_members_and_fk_check(make_staging):
    rows = [line(1, 100, D(2021, 1, 4)),
            line(2, 101, D(2021, 1, 4), customer_id=None, ship_mode="sas"),
            line(3, 102, D(2021, 1, 4), product_id=None),
            line(4, 103, None, ship_mode=None)]
    star = build_star(make_staging(rows), P)
    f = {r.row_id: r for r in star.fact.collect()}
    assert f[2].customer_key == -1 and f[2].ship_mode_key == -1
    assert f[3].product_key == -1
    assert f[4].order_date_key == -1 and f[4].ship_mode_key == -1
    fk = {r.constraint_name: r for r in reports.fk_check(star, P).collect()}
    assert fk["fk_customer"].orphan_rows == 1 and fk["fk_customer"].unknown_member_rows == 1
    assert fk["fk_ship"].orphan_rows == 2
    assert fk["fk_order_date"].orphan_rows == 1
    assert [r.ship_mode for r in star.dim_ship.collect()] == ["Standard"]


def test_repeat_customer_first_line_wins(make_staging):
    rows = [line(5, 100, D(2021, 1, 4), city="Lyon"),
            line(2, 101, D(2021, 2, 4), city="Nice"),
            line(9, 102, D(2021, 3, 4), city="Paris")]
    star = build_star(make_staging(rows), P)
    assert star.dim_customer.first().city == "Nice"
    assert star.dim_customer.count() == 1


def test_calendar(make_staging):
    days = [D(2021, 1, 3), D(2021, 1, 2), D(2020, 12, 31), D(2021, 1, 4)]
    rows = [line(i + 1, 100 + i, d) for i, d in enumerate(days)]
    dd = {r.full_date: r for r in build_star(make_staging(rows), P).dim_date.collect()}
    sun, sat = dd[D(2021, 1, 3)], dd[D(2021, 1, 2)]
    assert (sun.day_of_week, sun.is_weekend, sun.week_of_year) == (0, True, 53)
    assert (sat.day_of_week, sat.is_weekend) == (6, True)
    assert dd[D(2021, 1, 4)].is_weekend is False and dd[D(2021, 1, 4)].week_of_year == 1
    assert sun.day_name == "Sunday   " and len(sun.month_name) == 9
    assert sun.month_name == "JANUARY  " and sun.date_key == 20210103


def test_zero_sales_margin(make_staging):
    rows = [line(1, 100, D(2021, 1, 4), sales="0", profit="-5"),
            line(2, 101, D(2021, 1, 4), sales="50", profit="10")]
    star = build_star(make_staging(rows), P)
    m = {r.row_id: r.profit_margin_pct for r in star.fact.collect()}
    assert m == {1: 0.0, 2: pytest.approx(20.0)}
    only_zero = build_star(make_staging(rows[:1]), P)
    daily = marts.sales_daily(only_zero, P).first()
    assert daily.profit_margin_pct is None and daily.discount_sales_pct is None


def test_month_gap_lag_skips_missing_month(make_staging):
    rows = [line(1, 100, D(2021, 1, 10), sales="100"), line(2, 101, D(2021, 2, 10), sales="200"),
            line(3, 102, D(2021, 4, 10), sales="300"), line(4, 103, D(2021, 5, 10), sales="150")]
    m = {r.month: r for r in marts.sales_monthly(build_star(make_staging(rows), P), P).collect()}
    assert m[1].prev_month_sales is None
    assert m[4].prev_month_sales == 200.0  # March is absent
    assert m[4].monthly_sales_growth_pct == pytest.approx(50.0)
    assert m[5].monthly_sales_growth_pct == pytest.approx(-50.0)
    assert m[1].target_achievement_pct == pytest.approx(100 / 125000 * 100)


def test_cohort_return_gives_negative_churn(make_staging):
    rows = [line(1, 100, D(2021, 1, 5), customer_id=1), line(2, 101, D(2021, 1, 6), customer_id=2),
            line(3, 102, D(2021, 2, 5), customer_id=2), line(4, 103, D(2021, 3, 5), customer_id=1),
            line(5, 104, D(2021, 3, 6), customer_id=2), line(6, 105, D(2021, 3, 7), customer_id=3)]
    c = {r.cohort_month: r for r in marts.customer_cohorts(build_star(make_staging(rows), P),
                                                            P).collect()}
    jan, feb, mar = c[D(2021, 1, 1)], c[D(2021, 2, 1)], c[D(2021, 3, 1)]
    assert (jan.active_customers, jan.new_customers, jan.prev_month_active) == (2, 2, None)
    assert jan.churn_rate_pct is None
    assert (feb.active_customers, feb.returning_customers, feb.churned_customers) == (1, 1, 1)
    assert (mar.active_customers, mar.new_customers, mar.returning_customers) == (3, 1, 2)
    assert mar.churned_customers == -1  # customer 1 came back after a gap
    assert mar.retention_rate_pct == pytest.approx(200.0)


def test_single_day_customer(make_staging):
    rows = [line(1, 100, D(2021, 6, 1), customer_id=1, sales="700"),
            line(2, 101, D(2021, 6, 1), customer_id=1, sales="300"),
            line(3, 102, D(2021, 1, 1), customer_id=2, sales="365"),
            line(4, 103, D(2021, 12, 31), customer_id=2, sales="365")]
    star = build_star(make_staging(rows), P)
    c = {r.customer_id: r for r in marts.customers(star, P).collect()}
    assert c[1].customer_lifetime_days == 0 and c[1].ltv_projected_annual == 1000.0
    assert c[2].customer_lifetime_days == 364
    assert c[2].ltv_projected_annual == pytest.approx(730 / 364 * 365)
    assert c[1].total_orders == 2 and c[1].is_repeat_customer
    assert c[2].days_since_last_purchase == 0 and c[2].customer_status == "Very Active"
    from starmart.plans.analytics import ml_input

    assert [r.customer_id for r in ml_input(star, P).collect()] == [2]


def test_rank_ties_and_rfm_with_fewer_rows_than_buckets(make_staging):
    rows = [line(1, 100, D(2021, 1, 4), customer_id=1, product_id=1, sales="50"),
            line(2, 101, D(2021, 1, 4), customer_id=2, product_id=2, sales="50"),
            line(3, 102, D(2021, 1, 4), customer_id=3, product_id=3, sales="10")]
    star = build_star(make_staging(rows), P)
    ps = {r.product_id: r for r in marts.product_sales(star, P).collect()}
    assert (ps[1].sales_rank, ps[2].sales_rank, ps[3].sales_rank) == (1, 1, 3)
    assert ps[3].rank_in_category == 3
    c = {r.customer_id: r.rfm_spending_score for r in marts.customers(star, P).collect()}
    assert c == {1: 1, 2: 2, 3: 3}


def test_invariants_daily_monthly_executive(make_staging):
    rows = [line(i, 100 + i // 2, D(2021, 1 + i % 12, 1 + i % 27), customer_id=i % 5,
                 product_id=i % 7, sales=f"{10 + i}.25", profit=f"{i % 9 - 3}.5",
                 discount="0.1" if i % 3 else "0") for i in range(1, 80)]
    star = build_star(make_staging(rows), P)
    total = star.fact.agg(F.sum("sales")).first()[0]
    daily = marts.sales_daily(star, P).agg(F.sum("total_sales")).first()[0]
    monthly = marts.sales_monthly(star, P).agg(F.sum("total_sales"),
                                               F.sum("total_quantity")).first()
    ex = marts.executive_summary(star, P).first()
    assert daily == pytest.approx(float(total)) and monthly[0] == pytest.approx(float(total))
    assert ex.total_sales == pytest.approx(float(total))
    assert monthly[1] == star.fact.agg(F.sum("quantity")).first()[0]
    coh = marts.customer_cohorts(star, P).collect()
    assert all(r.new_customers + r.returning_customers == r.active_customers for r in coh)
    assert sum(r.new_customers for r in coh) == star.dim_customer.count()
    assert ex.total_number_customers == 5 and ex.active_customers + 0 <= 5


def test_each_dimension_is_computed_once(spark, make_staging):
    """The fact is joined from written dimensions, not from their plans."""
    rows = [line(i, 10 + i, D(2021, 1, 1 + i), customer_id=i, product_id=i) for i in range(1, 6)]
    star = build_star(make_staging(rows), P)
    for d in (star.dim_customer, star.dim_product, star.dim_date, star.dim_ship, star.fact):
        assert d.inputFiles() and "Join" not in d._jdf.queryExecution().executedPlan().toString()


def test_sales_key_order_is_total_with_two_names(spark, make_staging):
    rows = [line(1, 10, D(2021, 1, 1), product_name="A"), line(2, 11, D(2021, 1, 2), product_name="B")]
    fact = build_star(make_staging(rows), P).fact.orderBy("sales_key").collect()
    assert [(f.sales_key, f.row_id, f.product_key) for f in fact] == [(1, 1, 1), (2, 1, 2), (3, 2, 1), (4, 2, 2)]


def test_scratch_of_a_run_can_be_dropped(spark):
    """In a folder of its own: other tests' tables stay."""
    import os

    from starmart import session

    own = session._scratch_root
    session._scratch_root = lambda s: own(s) + "-drop-test"
    try:
        path = session.scratch_path(spark, "x")
        spark.range(3).write.parquet(path)
        local = path.removeprefix("file:")
        assert os.path.isdir(local) and session.drop_scratch(spark) and not os.path.exists(local)
    finally:
        session._scratch_root = own


def test_hot_keys_are_counted_on_the_staging_lines_and_no_line_is_sorted_for_a_customer(spark, make_staging, monkeypatch):
    from conftest import D, line
    from starmart.operators import lookup
    from starmart.params import FIXTURE_PARAMS
    from starmart.plans import star

    staging = make_staging([line(i, i // 2, D(2020, 1, 1 + i % 5), customer_id=i % 7, product_id=i % 3) for i in range(1, 40)])
    plans, real, numbered = [], lookup.hot_keys, star.with_row_number

    def seen(df, key):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, key)

    def firsts(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return numbered(df, *args)

    monkeypatch.setattr(lookup, "hot_keys", seen)
    built = star.build_star(staging, FIXTURE_PARAMS)
    assert built.fact.count() == 39
    assert len(plans) == 2 and not any("Join" in p for p in plans)
    plans.clear()
    monkeypatch.setattr(star, "with_row_number", firsts)
    star.dim_customer(staging, FIXTURE_PARAMS)
    lowest = [row for row in plans[0].splitlines() if "Aggregate" in row][-1]
    assert "HashAggregate" in lowest


def test_distinct_on_takes_one_whole_line(spark, make_staging):
    from conftest import D, line
    from starmart.params import FIXTURE_PARAMS
    from starmart.plans import reports, star

    staging = make_staging([line(4, 40, D(2020, 1, 4), city="A"), line(2, 20, D(2020, 1, 2), city="B"),
                            line(3, 30, D(2020, 1, 3), city="A"), line(9, 90, D(2020, 1, 9), customer_id=2, city=None)])
    st = star.Star(staging, None, None, None, None, None)
    got = sorted(tuple(r) for r in reports.distinct_on(st, FIXTURE_PARAMS).collect())
    assert got == [(1, 2, 20, "B", D(2020, 1, 2)), (2, 9, 90, None, D(2020, 1, 9))]

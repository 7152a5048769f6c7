"""Aggregate marts over the star (T-7 ... T-13).

Money stays an exact decimal through every sum and becomes a DOUBLE only at
the end, so results do not depend on how partitions are combined.  Averages
are written as ``sum / count`` for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions import days_between, month_start, pct, safe_div
from starmart.operators.ordered import BLOCK, with_rank
from starmart.operators.selection import Key, ntiles
from starmart.params import Params
from starmart.plans.star import Star
from starmart.session import write_table


# The reference's labels.
STATUS_LABELS = ("Very Active", "Active", "At Risk", "Dormant", "Lost")
TIER_LABELS = ("VIP", "High Value", "Medium Value", "Low Value")
DAY_TYPES = ("Weekend", "Weekday")
METRIC_SCOPE = "Overall Business"


def _d(c: Column) -> Column:
    return c.cast("double")


def _avg(c: str) -> Column:
    return safe_div(_d(F.sum(c)), F.count(c))


def _current_year(params: Params) -> Column:
    return F.when(F.col("year") == params.current_year, True).otherwise(False)


def _dated(fact: DataFrame, d_date: DataFrame, how: str = "left") -> DataFrame:
    return fact.join(d_date, fact.order_date_key == d_date.date_key, how)


def _time_measures() -> list[Column]:
    """Aggregates shared by the daily and the monthly mart (AG-2 ... AG-10)."""
    disc_sales = F.sum(F.when(F.col("discount") > 0, F.col("sales")).otherwise(F.lit(0)))
    return [
        F.countDistinct("order_id").alias("numbers_of_orders"),
        _d(F.sum("sales")).alias("total_sales"),
        _d(F.sum("profit")).alias("total_profit"),
        _d(F.sum("cost")).alias("total_costs"),
        F.sum("quantity").cast("long").alias("total_quantity"),
        _avg("sales").alias("avg_order_value"),
        pct(_d(F.sum("profit")), _d(F.sum("sales"))).alias("profit_margin_pct"),
        F.countDistinct("customer_key").alias("active_customers"),
        _d(disc_sales).alias("sales_with_discount"),
        _d(F.sum(F.when(F.col("discount") == 0, F.col("sales")).otherwise(F.lit(0))))
        .alias("sales_without_discount"),
        pct(_d(disc_sales), _d(F.sum("sales"))).alias("discount_sales_pct"),
    ]


def sales_daily(star: Star, params: Params) -> DataFrame:
    """T-7: one row per order day."""
    keys = ["full_date", "year", "month", "month_name", "quarter", "day_name", "is_weekend"]
    agg = _dated(star.fact, star.dim_date).groupBy(*keys).agg(*_time_measures())
    return agg.select(
        *keys,
        F.when(F.col("is_weekend"), DAY_TYPES[0]).otherwise(DAY_TYPES[1]).alias("day_type"),
        _current_year(params).alias("is_current_year"),
        "numbers_of_orders", "total_sales", "total_profit", "total_costs", "total_quantity",
        "avg_order_value", "profit_margin_pct", "active_customers", "sales_with_discount",
        "sales_without_discount", "discount_sales_pct",
    ).orderBy(F.col("full_date").asc_nulls_last())


def sales_monthly(star: Star, params: Params) -> DataFrame:
    """T-8: one row per month, growth against the previous month present
    (a LAG over the aggregated months: one row per month, a tiny window)."""
    keys = ["year", "month", "month_name", "quarter"]
    agg = _dated(star.fact, star.dim_date).groupBy(*keys).agg(*_time_measures())
    w = Window.orderBy(F.col("year").asc_nulls_last(), F.col("month").asc_nulls_last())
    prev = F.lag("total_sales").over(w)
    return agg.select(
        *keys,
        _current_year(params).alias("is_current_year"),
        prev.alias("prev_month_sales"),
        pct(F.col("total_sales") - prev, prev).alias("monthly_sales_growth_pct"),
        "numbers_of_orders", "total_sales", "total_profit", "total_costs", "total_quantity",
        "active_customers", "avg_order_value", "profit_margin_pct", "sales_with_discount",
        "sales_without_discount", "discount_sales_pct",
        F.lit(params.monthly_target).alias("monthly_target"),
        (F.col("total_sales") / F.lit(params.monthly_target) * 100).alias("target_achievement_pct"),
    ).orderBy(F.col("year").asc_nulls_last(), F.col("month").asc_nulls_last())


def product_sales(star: Star, params: Params) -> DataFrame:
    """T-9: one row per (category, sub-category, product id), with global
    sales / profit ranks and the rank inside the category (distributed)."""
    group = ["category", "sub_category", "product_id"]
    p = star.dim_product.select("product_key", *group, "product_name")
    # lines are reduced by product key before they meet the names; orders are
    # counted over distinct key and order pairs, as an id can have two keys
    per_key = star.fact.groupBy("product_key").agg(
        F.sum("sales").alias("__sales"), F.sum("profit").alias("__profit"), F.sum("cost").alias("__cost"),
        F.count("sales").alias("__n"), F.sum("discount").alias("__disc"),
        F.count("discount").alias("__disc_n"), F.sum("quantity").alias("__q"))
    sums = per_key.join(p, "product_key", "left").groupBy(*group).agg(
        F.min("product_name").alias("product_name"),
        F.sum("__sales").alias("__sales"), F.sum("__profit").alias("__profit"),
        _d(F.sum("__cost")).alias("total_costs"),
        safe_div(_d(F.sum("__sales")), F.sum("__n")).alias("avg_sale_price"),
        (safe_div(_d(F.sum("__disc")), F.sum("__disc_n")) * 100).alias("avg_discount_pct"),
        F.sum("__q").cast("long").alias("total_quantity"),
    )
    orders = (star.fact.select("product_key", "order_id").distinct()
              .join(p.drop("product_name"), "product_key", "left")
              .groupBy(*[F.col(g).alias(f"__{g}") for g in group])
              .agg(F.countDistinct("order_id").alias("times_ordered")))
    agg = sums.join(orders, [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group]).drop(*[f"__{g}" for g in group])
    # the aggregate is written once (it is the mart's CREATE TABLE AS); the
    # three rankings then read that table instead of re-aggregating the fact
    agg = write_table(agg, "product_sales_agg")
    tie = [F.col(c).asc_nulls_last() for c in ("product_id", "category", "sub_category")]
    n = params.order_partitions
    ranked = with_rank(agg, ["__sales"], [F.col("__sales").desc_nulls_first()], tie,
                       "sales_rank", num_partitions=n)
    ranked = with_rank(ranked, ["__profit"], [F.col("__profit").desc_nulls_first()], tie,
                       "profit_rank", num_partitions=n)
    ranked = with_rank(ranked, ["__sales"], [F.col("__sales").desc_nulls_first()], tie,
                       "rank_in_category", partition_cols=["category"], num_partitions=n)
    return ranked.select(
        "category", "sub_category", "product_name", "product_id", "times_ordered",
        _d(F.col("__sales")).alias("total_sales"), _d(F.col("__profit")).alias("total_profit"),
        "total_costs", "avg_sale_price", "avg_discount_pct", "total_quantity",
        pct(_d(F.col("__profit")), _d(F.col("__sales"))).alias("profit_margin_pct"),
        "sales_rank", "profit_rank", "rank_in_category",
        F.lit(params.as_of).alias("last_updated"),
    ).orderBy(F.col("total_sales").desc_nulls_first(), F.col("product_id").asc_nulls_last())


CUSTOMER_KEYS = ["customer_id", "customer_name", "segment", "region", "state", "city"]


def customer_base(star: Star, params: Params) -> DataFrame:
    """The customer base, materialized once when the star carries a table
    cache (see :func:`compute_customer_base`)."""
    if star.tables is not None:
        return star.tables("customer_base", lambda: compute_customer_base(star, params))
    return compute_customer_base(star, params)


def compute_customer_base(star: Star, params: Params) -> DataFrame:
    """One row per customer: lines with a known date, reduced by customer key
    before they meet the customer names (the unknown member -1 has none).
    ``total_sales`` and ``total_profit`` stay exact decimals here."""
    c = star.dim_customer.select("customer_key", *CUSTOMER_KEYS)
    d = star.dim_date.select("date_key", "full_date")
    if star.fact_blocks is None:
        agg = _dated(star.fact, d, "inner").groupBy("customer_key").agg(
            F.max("full_date").alias("last_purchase_date"),
            F.min("full_date").alias("first_purchase_date"),
            F.countDistinct("order_id").alias("total_orders"),
            F.sum("profit").alias("total_profit"),
            F.sum("sales").alias("total_sales"),
            _avg("sales").alias("avg_order_value"),
            _avg("discount").alias("avg_discount_rate"),
        )
    else:
        # an order is in one block: its lines are reduced there, and its block counts it
        orders = _dated(star.fact_blocks, d, "inner").groupBy(BLOCK, "customer_key", "order_id").agg(
            F.max("full_date").alias("last"), F.min("full_date").alias("first"),
            *[f(c).alias(f"{f.__name__}_{c}") for c in ("profit", "sales", "discount") for f in (F.sum, F.count)])
        kinds = {f.name: f.dataType for f in orders.schema.fields}

        def total(c: str) -> Column:
            # exact, in the type that a sum over the lines has
            return F.sum(c).cast(kinds[c])

        agg = orders.groupBy("customer_key").agg(
            F.max("last").alias("last_purchase_date"),
            F.min("first").alias("first_purchase_date"),
            F.count("order_id").alias("total_orders"),
            total("sum_profit").alias("total_profit"),
            total("sum_sales").alias("total_sales"),
            safe_div(_d(total("sum_sales")), F.sum("count_sales")).alias("avg_order_value"),
            safe_div(_d(total("sum_discount")), F.sum("count_discount")).alias("avg_discount_rate"),
        )
    measures = [x for x in agg.columns if x != "customer_key"]
    return agg.join(c, "customer_key", "left").select(*CUSTOMER_KEYS, *measures).withColumns({
        "days_since_last_purchase": days_between(F.lit(params.as_of), F.col("last_purchase_date")),
        "customer_lifetime_days": days_between(F.col("last_purchase_date"),
                                               F.col("first_purchase_date")),
    })


def customer_flags(base: DataFrame, params: Params) -> DataFrame:
    """Flags, status, tier and lifetime value of each customer (PF-6, F-11)."""
    days = F.col("days_since_last_purchase")
    sales = F.col("total_sales")
    c1, c2, c3, c4 = params.status_cuts
    t1, t2, t3 = params.tier_cuts
    life = F.col("customer_lifetime_days")
    return base.withColumns({
        "profit_margin_pct": pct(_d(F.col("total_profit")), _d(sales)),
        "is_active": F.coalesce(days <= params.active_days, F.lit(False)),
        "is_repeat_customer": F.coalesce(F.col("total_orders") > 1, F.lit(False)),
        "customer_status": F.when(days <= c1, STATUS_LABELS[0]).when(days <= c2, STATUS_LABELS[1])
        .when(days <= c3, STATUS_LABELS[2]).when(days <= c4, STATUS_LABELS[3])
        .otherwise(STATUS_LABELS[4]),
        "value_tier": F.when(sales >= t1, TIER_LABELS[0]).when(sales >= t2, TIER_LABELS[1])
        .when(sales >= t3, TIER_LABELS[2]).otherwise(TIER_LABELS[3]),
        "ltv_total": _d(sales),
        "ltv_projected_annual": F.when(life > 0, _d(sales) / life * 365).otherwise(_d(sales)),
    })


CUSTOMER_COLUMNS = [
    "customer_id", "customer_name", "segment", "region", "state", "city", "avg_discount_rate",
    "last_purchase_date", "first_purchase_date", "days_since_last_purchase",
    "customer_lifetime_days", "total_sales", "total_profit", "total_orders", "avg_order_value",
    "profit_margin_pct", "is_active", "is_repeat_customer", "customer_status", "value_tier",
    "ltv_total", "ltv_projected_annual", "rfm_spending_score", "rfm_recency_score",
    "rfm_frequency_score", "last_updated",
]


def with_rfm(df: DataFrame, params: Params) -> DataFrame:
    """RFM scores, 1 is best on every axis: spend desc, recency asc,
    frequency desc; ties broken by customer id.  Only the cut rows of the
    three orders are looked for; no customer is moved."""
    cid = Key("customer_id")
    return ntiles(df, params.rfm_buckets, {
        "rfm_spending_score": [Key("total_sales", descending=True, nulls_first=True), cid],
        "rfm_recency_score": [Key("days_since_last_purchase"), cid],
        "rfm_frequency_score": [Key("total_orders", descending=True, nulls_first=True), cid]})


def customers(star: Star, params: Params) -> DataFrame:
    """T-10: the customer mart (26 columns)."""
    df = with_rfm(customer_flags(customer_base(star, params), params), params)
    return df.withColumns({
        "total_sales": _d(F.col("total_sales")),
        "total_profit": _d(F.col("total_profit")),
        "last_updated": F.lit(params.as_of),
    }).select(*CUSTOMER_COLUMNS)


def customer_cohorts(star: Star, params: Params) -> DataFrame:
    """T-11: monthly active / new / returning customers, churn and retention.

    The first purchase is a per-customer ``min`` (partial aggregate); the
    monthly activity is reduced to distinct (month, customer) pairs before it
    meets the first-purchase table, so no fact-sized join is needed.
    """
    d = star.dim_date.select("date_key", "full_date", "year", "month")
    first = (star.fact.groupBy("customer_key").agg(F.min("order_date_key").alias("first_key"))
             .join(d, F.col("first_key") == F.col("date_key"))
             .select("customer_key", month_start(F.col("full_date")).alias("first_purchase_month")))
    activity = (star.fact.select("customer_key", "order_date_key")
                .join(d, F.col("order_date_key") == F.col("date_key"))
                .select(month_start(F.col("full_date")).alias("cohort_month"), "year", "month",
                        "customer_key")
                .distinct()
                .join(first, "customer_key"))
    # (cohort_month, customer_key) is unique here, so COUNT equals COUNT DISTINCT
    counts = activity.groupBy("cohort_month", "year", "month").agg(
        F.count("customer_key").alias("active_customers"),
        F.count(F.when(F.col("cohort_month") == F.col("first_purchase_month"), 1))
        .alias("new_customers"),
        F.count(F.when(F.col("cohort_month") > F.col("first_purchase_month"), 1))
        .alias("returning_customers"),
    )
    w = Window.orderBy(F.col("cohort_month").asc_nulls_last())  # one row per month
    prev = F.lag("active_customers").over(w)
    churned = prev - (F.col("active_customers") - F.col("new_customers"))
    return counts.select(
        "cohort_month", "year", "month", "active_customers", "new_customers",
        "returning_customers",
        prev.alias("prev_month_active"),
        churned.alias("churned_customers"),
        F.when(prev == 0, F.lit(0.0)).otherwise(_d(churned) / prev * 100).alias("churn_rate_pct"),
        F.when(prev == 0, F.lit(0.0)).otherwise(_d(F.col("returning_customers")) / prev * 100)
        .alias("retention_rate_pct"),
    ).orderBy(F.col("cohort_month").asc_nulls_last())


def executive_summary(star: Star, params: Params) -> DataFrame:
    """T-12: one row of overall KPIs.  The customer ratios are uncorrelated
    scalar subqueries over the customer mart (``DataFrame.scalar``), which
    Catalyst merges into one aggregate; no join is involved."""
    cust = customer_flags(customer_base(star, params), params)
    n_all = cust.select(F.count(F.lit(1))).scalar()
    n_active = cust.select(F.count(F.when(F.col("is_active"), 1))).scalar()
    n_repeat = cust.select(F.count(F.when(F.col("is_repeat_customer"), 1))).scalar()
    avg_ltv = cust.select(safe_div(_d(F.sum("total_sales")), F.count("total_sales"))).scalar()
    f = star.fact
    agg = f.agg(
        F.countDistinct("order_id").alias("total_number_orders"),
        F.countDistinct("customer_key").alias("total_number_customers"),
        F.countDistinct("product_key").alias("total_number_products"),
        F.sum("sales").alias("__sales"),
        F.sum("profit").alias("__profit"),
        F.sum("cost").alias("__cost"),
        F.sum("quantity").cast("long").alias("total_quantity"),
        (_avg("discount") * 100).alias("avg_discount_pct"),
        F.count(F.when(F.col("discount") > 0, 1)).alias("discounted_orders"),
        F.count(F.lit(1)).alias("__lines"),
    )
    sales = _d(F.col("__sales"))
    return agg.select(
        F.lit(METRIC_SCOPE).alias("metric_scope"),
        F.lit(params.as_of).alias("last_updated"),
        "total_number_orders", "total_number_customers", "total_number_products",
        pct(_d(n_active), _d(n_all)).alias("active_customer_pct"),
        pct(_d(n_repeat), _d(n_all)).alias("repeat_customer_pct"),
        n_active.alias("active_customers"),
        n_repeat.alias("repeat_customers"),
        avg_ltv.alias("avg_customer_ltv"),
        sales.alias("total_sales"),
        _d(F.col("__profit")).alias("total_profit"),
        _d(F.col("__cost")).alias("total_costs"),
        "total_quantity",
        safe_div(sales, F.col("total_number_customers")).alias("sales_per_customer"),
        safe_div(sales, F.col("total_number_orders")).alias("sales_per_order"),
        "avg_discount_pct",
        pct(_d(F.col("__profit")), sales).alias("profit_margin_pct"),
        "discounted_orders",
        pct(_d(F.col("discounted_orders")), F.col("__lines")).alias("discount_penetration_pct"),
    )


MART_NAMES = ("sales_daily", "sales_monthly", "product_sales", "customers", "customer_cohorts",
              "executive_summary")


def row_count_report(marts: dict[str, DataFrame]) -> DataFrame:
    """T-13: ``table_name, rows`` for each mart (UNION ALL of counts)."""
    parts = [marts[name].agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"))
             for name in MART_NAMES if name in marts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def written_marts(star: Star, params: Params) -> dict[str, DataFrame]:
    """The marts, each written once where the star carries a table cache."""
    built = build_marts(star, params)
    if star.tables is None:
        return {name: write_table(df, name) for name, df in built.items()}
    return {name: star.tables(f"mart_{name}", lambda df=df: df) for name, df in built.items()}


def build_marts(star: Star, params: Params) -> dict[str, DataFrame]:
    return {
        "sales_daily": sales_daily(star, params),
        "sales_monthly": sales_monthly(star, params),
        "product_sales": product_sales(star, params),
        "customers": customers(star, params),
        "customer_cohorts": customer_cohorts(star, params),
        "executive_summary": executive_summary(star, params),
    }

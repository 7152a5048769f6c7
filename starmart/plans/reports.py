"""Single-operator reports over the star and the marts (SURVEY 2.2 ... 2.8,
2.12) and the dashboard queries (D-1 ... D-8).

Each function takes the :class:`Star` and :class:`Params` and returns a
DataFrame over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions import (
    date_key,
    day_name_padded,
    day_of_week0,
    days_between,
    month_name_padded,
    month_start,
    pct,
)
from starmart.operators import quality
from starmart.operators.ordered import with_rank
from starmart.operators.selection import Key, ntiles
from starmart.params import Params
from starmart.plans import marts
from starmart.plans.star import Star
from starmart.sources.csv_ingest import RAW_COLUMNS_ORDER


def _d(c):
    return c.cast("double")


def _customers_flagged(star: Star, params: Params) -> DataFrame:
    return marts.customer_flags(marts.customer_base(star, params), params)


# --- projections, predicates, CASE ------------------------------------------
def rfm_scores(star: Star, params: Params) -> DataFrame:
    """RFM quintiles of every customer, 1 best, and their sum (W-6)."""
    base = marts.customer_base(star, params)
    scored = marts.with_rfm(base, params)
    return scored.select(
        "customer_id", _d(F.col("total_sales")).alias("total_sales"), "days_since_last_purchase",
        "total_orders", "rfm_spending_score", "rfm_recency_score", "rfm_frequency_score",
        (F.col("rfm_spending_score") + F.col("rfm_recency_score") + F.col("rfm_frequency_score"))
        .alias("rfm_total"))


def customer_status(star: Star, params: Params) -> DataFrame:
    """Recency flags and status (PF-4, PF-6)."""
    return _customers_flagged(star, params).select(
        "customer_id", "days_since_last_purchase", "is_active", "is_repeat_customer",
        "customer_status")


def value_tier(star: Star, params: Params) -> DataFrame:
    """Value tier and projected lifetime value (PF-6, F-11)."""
    return _customers_flagged(star, params).select(
        "customer_id", "ltv_total", "customer_lifetime_days", "value_tier",
        "ltv_projected_annual")


# --- windows ------------------------------------------------------------------
def lag_growth(star: Star, params: Params) -> DataFrame:
    """LAG per partition (W-4/W-5 per region): month-on-month sales growth of
    each region.  The window runs on the (region, month) aggregate."""
    c = star.dim_customer.select("customer_key", "region")
    d = star.dim_date.select("date_key", "year", "month")
    # lines are reduced to (customer, month) before they meet the customers
    monthly = (star.fact.join(d, F.col("order_date_key") == F.col("date_key"))
               .groupBy("customer_key", "year", "month").agg(F.sum("sales").alias("__s")))
    agg = (monthly.join(c, "customer_key", "left")
           .groupBy("region", "year", "month").agg(_d(F.sum("__s")).alias("total_sales")))
    w = Window.partitionBy("region").orderBy(F.col("year").asc_nulls_last(),
                                             F.col("month").asc_nulls_last())
    prev = F.lag("total_sales").over(w)
    return agg.select("region", "year", "month", "total_sales", prev.alias("prev_month_sales"),
                      pct(F.col("total_sales") - prev, prev).alias("growth_pct"))


def rank_global(star: Star, params: Params) -> DataFrame:
    """RANK over all customers by sales, descending (W-2, distributed)."""
    base = marts.customer_base(star, params).select("customer_id", "total_sales")
    ranked = with_rank(base, ["total_sales"], [F.col("total_sales").desc_nulls_first()],
                       [F.col("customer_id").asc_nulls_last()], "sales_rank",
                       num_partitions=params.order_partitions)
    return ranked.select("customer_id", _d(F.col("total_sales")).alias("total_sales"),
                         "sales_rank")


def rank_in_category(star: Star, params: Params) -> DataFrame:
    """RANK per category by quantity sold (W-3, distributed with a partition)."""
    p = star.dim_product.select("product_key", "category", "product_id")
    sold = star.fact.groupBy("product_key").agg(F.sum("quantity").alias("__q"))
    agg = (sold.join(p, "product_key", "left")
           .groupBy("category", "product_id")
           .agg(F.sum("__q").cast("long").alias("total_quantity")))
    ranked = with_rank(agg, ["total_quantity"], [F.col("total_quantity").desc_nulls_first()],
                       [F.col("product_id").asc_nulls_last()], "quantity_rank",
                       partition_cols=["category"], num_partitions=params.order_partitions)
    return ranked.select("category", "product_id", "total_quantity", "quantity_rank")


def ntile_global(star: Star, params: Params) -> DataFrame:
    """NTILE(10) over every order line by sales, descending (W-6 at fact scale)."""
    f = star.fact.select("sales_key", "sales")
    tiled = ntiles(f, 10, {"sales_decile": [Key("sales", descending=True, nulls_first=True), Key("sales_key")]})
    return tiled.select("sales_key", _d(F.col("sales")).alias("sales"), "sales_decile")


def distinct_on(star: Star, params: Params) -> DataFrame:
    """DISTINCT ON (customer) with the lowest row id (W-7): ``min_by`` over the
    lines of a customer and city, whose buffers are numbers and so hashed, then
    over the few cities of a customer."""
    s = star.staging.where(F.col("customer_id").isNotNull())
    row = F.col("row_id")
    first = s.groupBy("customer_id", "city").agg(
        F.min(row).alias("row_id"), *[F.min_by(c, row).alias(c) for c in ("order_id", "order_date")])
    first = first.groupBy("customer_id").agg(
        F.min_by(F.struct("row_id", "order_id", "city", "order_date"), row).alias("a"))
    return first.select("customer_id", F.col("a.row_id").alias("first_row_id"),
                        F.col("a.order_id").alias("first_order_id"),
                        F.col("a.city").alias("first_city"),
                        F.col("a.order_date").alias("first_order_date"))


# --- joins ----------------------------------------------------------------------
def role_playing_dates(star: Star, params: Params) -> DataFrame:
    """dim_date joined twice, as order and as ship date (J-3)."""
    d = star.dim_date.select("date_key", "full_date", "year")
    od = d.select(F.col("date_key").alias("od_key"), F.col("full_date").alias("od"),
                  F.col("year").alias("order_year"))
    sd = d.select(F.col("date_key").alias("sd_key"), F.col("full_date").alias("sd"),
                  F.col("year").alias("ship_year"))
    j = (star.fact.join(od, F.col("order_date_key") == F.col("od_key"))
         .join(sd, F.col("ship_date_key") == F.col("sd_key")))
    return j.groupBy("order_year", "ship_year").agg(
        F.count(F.lit(1)).alias("lines"),
        _d(F.sum("sales")).alias("total_sales"),
        (_d(F.sum(days_between(F.col("sd"), F.col("od")))) / F.count(F.lit(1)))
        .alias("avg_ship_days"))


def left_join_unknown_member(star: Star, params: Params) -> DataFrame:
    """Fact LEFT JOIN customer; lines without a customer row count as
    'Unknown' (J-1, PF-9)."""
    c = star.dim_customer.select("customer_key", "segment")
    per_key = star.fact.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("__n"), F.sum("sales").alias("__s"))
    j = per_key.join(c, "customer_key", "left")
    return j.groupBy(F.coalesce(F.col("segment"), F.lit("Unknown")).alias("segment")).agg(
        F.sum("__n").alias("lines"),
        F.coalesce(F.sum(F.when(F.col("customer_key") == -1, F.col("__n"))), F.lit(0).cast("long"))
        .alias("unknown_key_lines"),
        _d(F.sum("__s")).alias("total_sales"))


def scalar_subqueries(star: Star, params: Params) -> DataFrame:
    """Each customer against uncorrelated scalar subqueries (J-6): share of
    all sales and whether above the average customer."""
    base = marts.customer_base(star, params).select("customer_id", "total_sales")
    total = base.select(F.sum("total_sales")).scalar()
    avg = base.select(_d(F.sum("total_sales")) / F.count("total_sales")).scalar()
    return base.select("customer_id", _d(F.col("total_sales")).alias("total_sales"),
                       (_d(F.col("total_sales")) / _d(total) * 100).alias("sales_share_pct"),
                       (_d(F.col("total_sales")) > avg).alias("above_average"))


# --- aggregates ---------------------------------------------------------------
def conditional_sums(star: Star, params: Params) -> DataFrame:
    """SUM(CASE ...) by ship mode (AG-7, AG-10)."""
    s = star.dim_ship.select("ship_mode_key", "ship_mode")
    j = star.fact.join(s, "ship_mode_key", "left")
    with_disc = F.sum(F.when(F.col("discount") > 0, F.col("sales")).otherwise(F.lit(0)))
    return j.groupBy("ship_mode").agg(
        _d(with_disc).alias("sales_with_discount"),
        _d(F.sum(F.when(F.col("discount") == 0, F.col("sales")).otherwise(F.lit(0))))
        .alias("sales_without_discount"),
        pct(_d(with_disc), _d(F.sum("sales"))).alias("discount_sales_pct"))


def conditional_distinct(star: Star, params: Params) -> DataFrame:
    """COUNT(DISTINCT CASE ...) by year (AG-9)."""
    d = star.dim_date.select("date_key", "year")
    j = star.fact.join(d, F.col("order_date_key") == F.col("date_key"))
    return j.groupBy("year").agg(
        F.countDistinct(F.when(F.col("discount") > 0, F.col("customer_key")))
        .alias("customers_with_discount"),
        F.countDistinct(F.when(F.col("discount") == 0, F.col("customer_key")))
        .alias("customers_without_discount"),
        F.countDistinct("customer_key").alias("customers"))


def pivot_share(star: Star, params: Params) -> DataFrame:
    """Normalised value counts unstacked, 0-filled (AG-14): share of each
    segment within each customer status."""
    cust = _customers_flagged(star, params)
    from starmart.plans.analytics import levels as level_list

    levels = level_list(cust, "segment")
    counts = cust.groupBy("customer_status").pivot("segment", levels).count().na.fill(0)
    total = sum((F.col(f"`{lv}`") for lv in levels), F.lit(0))
    return counts.select("customer_status",
                         *[(_d(F.col(f"`{lv}`")) / total).alias(lv) for lv in levels])


def crosstab(star: Star, params: Params) -> DataFrame:
    """Segment x state contingency counts of the ML customers, long form (AG-16)."""
    from starmart.plans.analytics import ml_input

    return ml_input(star, params).groupBy("segment", "state").agg(
        F.count(F.lit(1)).alias("customers"))


def value_counts(star: Star, params: Params) -> DataFrame:
    """value_counts of the tier (AG-13)."""
    return (_customers_flagged(star, params).groupBy("value_tier")
            .agg(F.count(F.lit(1)).alias("customers"))
            .orderBy(F.col("customers").desc(), F.col("value_tier")))


# --- sets, scalar functions ---------------------------------------------------
def union_distinct_dates(star: Star, params: Params) -> DataFrame:
    """UNION (distinct) of order and ship dates, counted per year (U-2)."""
    s = star.staging
    days = (s.select(F.col("order_date").alias("d")).union(s.select(F.col("ship_date").alias("d")))
            .where(F.col("d").isNotNull()).distinct())
    return days.groupBy(F.year("d").alias("year")).agg(F.count(F.lit(1)).alias("distinct_days"))


def union_all_counts(star: Star, params: Params) -> DataFrame:
    """UNION ALL of row counts of staging, dimensions and fact (U-3, AG-5)."""
    tables = [("staging", star.staging), ("dim_customer", star.dim_customer),
              ("dim_product", star.dim_product), ("dim_date", star.dim_date),
              ("dim_ship", star.dim_ship), ("fact_sales", star.fact)]
    parts = [df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("rows"))
             for n, df in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def date_parts(star: Star, params: Params) -> DataFrame:
    """Calendar functions on every distinct ship date (F-1 ... F-8)."""
    d = F.col("ship_date")
    days = star.staging.select("ship_date").where(d.isNotNull()).distinct()
    return days.select(
        d, date_key(d).alias("date_key"), F.weekofyear(d).alias("iso_week"),
        day_of_week0(d).alias("day_of_week"), month_name_padded(d).alias("month_name"),
        day_name_padded(d).alias("day_name"), month_start(d).alias("month_start"),
        days_between(F.lit(params.as_of), d).alias("days_to_as_of"))


def top_k(star: Star, params: Params, k: int = 10) -> DataFrame:
    """Top k customers by sales (S-2): ORDER BY + LIMIT, planned as
    TakeOrderedAndProject (a per-partition top k, then a merge of k rows each)."""
    base = marts.customer_base(star, params)
    return (base.orderBy(F.col("total_sales").desc_nulls_first(),
                         F.col("customer_id").asc_nulls_last())
            .limit(k)
            .select("customer_id", "customer_name", _d(F.col("total_sales")).alias("total_sales")))


# --- quality checks -------------------------------------------------------------
def null_counts(star: Star, params: Params, raw: DataFrame) -> DataFrame:
    """NULLs per column before (raw lines) and after cleaning (staging) (CHK-3)."""
    before = quality.null_counts(raw, RAW_COLUMNS_ORDER).withColumnRenamed("nulls", "nulls_before")
    after = quality.null_counts(star.staging, RAW_COLUMNS_ORDER).withColumnRenamed(
        "nulls", "nulls_after")
    return before.join(after, "column_name")


def key_check(star: Star, params: Params) -> DataFrame:
    """Primary keys unique and not null (CHK-1), for dimensions and fact."""
    checks = [quality.key_violations(star.dim_customer, "customer_key", "dim_customer"),
              quality.key_violations(star.dim_customer, "customer_id", "dim_customer"),
              quality.key_violations(star.dim_product, "product_key", "dim_product"),
              quality.key_violations(star.dim_date, "date_key", "dim_date"),
              quality.key_violations(star.dim_ship, "ship_mode_key", "dim_ship"),
              quality.key_violations(star.dim_ship, "ship_mode", "dim_ship"),
              quality.key_violations(star.fact, "sales_key", "fact_sales")]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def mart_key_check(built: dict[str, DataFrame]) -> DataFrame:
    """Primary keys of the written marts unique and not null (CHK-1)."""
    keys = (("product_sales", "product_id"), ("customers", "customer_id"),
            ("customer_cohorts", "cohort_month"), ("executive_summary", "metric_scope"))
    checks = [quality.key_violations(built[mart], key, mart) for mart, key in keys]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def fk_check(star: Star, params: Params) -> DataFrame:
    """Foreign keys of the fact that resolve to no dimension row (CHK-2)."""
    f = star.fact
    checks = [quality.orphan_count(f, "customer_key", star.dim_customer, "customer_key",
                                   "fk_customer"),
              quality.orphan_count(f, "product_key", star.dim_product, "product_key",
                                   "fk_product"),
              quality.orphan_count(f, "ship_mode_key", star.dim_ship, "ship_mode_key", "fk_ship"),
              quality.orphan_count(f, "order_date_key", star.dim_date, "date_key",
                                   "fk_order_date"),
              quality.orphan_count(f, "ship_date_key", star.dim_date, "date_key",
                                   "fk_ship_date")]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


# --- dashboard (D-1 ... D-8) ---------------------------------------------------------
def customer_kpis(star: Star, params: Params) -> DataFrame:
    """D-1: customers, repeat rate, average lifetime value."""
    c = _customers_flagged(star, params)
    return c.agg(F.count(F.lit(1)).alias("customers"),
                 F.count(F.when(F.col("is_repeat_customer"), 1)).alias("repeat_customers"),
                 pct(_d(F.count(F.when(F.col("is_repeat_customer"), 1))),
                     _d(F.count(F.lit(1)))).alias("repeat_rate_pct"),
                 (_d(F.sum("total_sales")) / F.count("total_sales")).alias("avg_ltv"))


def status_breakdown(star: Star, params: Params) -> DataFrame:
    """D-2: customers and sales per status."""
    c = _customers_flagged(star, params)
    return c.groupBy("customer_status").agg(F.count(F.lit(1)).alias("customers"),
                                            _d(F.sum("total_sales")).alias("total_sales"))


def yoy_growth(star: Star, params: Params) -> DataFrame:
    """D-4: yearly sales and growth against the previous year present."""
    d = star.dim_date.select("date_key", "year")
    y = (star.fact.join(d, F.col("order_date_key") == F.col("date_key"))
         .groupBy("year").agg(F.sum("sales").alias("__s")))
    prev = F.lag("__s").over(Window.orderBy(F.col("year").asc_nulls_last()))  # one row per year
    return y.select("year", _d(F.col("__s")).alias("total_sales"),
                    _d(prev).alias("prev_year_sales"),
                    pct(_d(F.col("__s") - prev), _d(prev)).alias("yoy_growth_pct"))


def discount_impact(star: Star, params: Params) -> DataFrame:
    """D-5: lines, sales and margin per discount band."""
    disc = F.col("discount")
    band = (F.when(disc == 0, "0 none").when(disc <= 0.05, "1 up to 5%")
            .otherwise("2 above 5%"))
    return star.fact.groupBy(band.alias("discount_band")).agg(
        F.count(F.lit(1)).alias("lines"), _d(F.sum("sales")).alias("total_sales"),
        _d(F.sum("profit")).alias("total_profit"),
        pct(_d(F.sum("profit")), _d(F.sum("sales"))).alias("profit_margin_pct"))


def revenue_by_region(star: Star, params: Params) -> DataFrame:
    """D-6: sales and profit per customer region."""
    c = star.dim_customer.select("customer_key", "region")
    per_key = star.fact.groupBy("customer_key").agg(F.sum("sales").alias("__s"), F.sum("profit").alias("__p"))
    return (per_key.join(c, "customer_key", "left").groupBy("region")
            .agg(_d(F.sum("__s")).alias("total_sales"), _d(F.sum("__p")).alias("total_profit"),
                 F.count("customer_key").alias("customers")))


def category_profit(star: Star, params: Params) -> DataFrame:
    """D-7: products, revenue and profit per category (from the product mart's
    groups)."""
    p = star.dim_product.select("product_key", "category", "product_id")
    per_key = star.fact.groupBy("product_key").agg(F.sum("sales").alias("__s"), F.sum("profit").alias("__p"))
    return per_key.join(p, "product_key", "left").groupBy("category").agg(
        F.countDistinct("product_id").alias("products"), _d(F.sum("__s")).alias("total_sales"),
        _d(F.sum("__p")).alias("total_profit"),
        pct(_d(F.sum("__p")), _d(F.sum("__s"))).alias("profit_margin_pct"))


def top_sellers(star: Star, params: Params, k: int = 10) -> DataFrame:
    """D-8: products with sales_rank <= k from the product mart."""
    ps = marts.product_sales(star, params)
    return ps.where(F.col("sales_rank") <= k).select("product_id", "product_name", "category",
                                                     "total_sales", "sales_rank")

"""Customer analytics on top of the customer mart: the ML input (IO-4),
statistics inputs, feature preparation (ML-1 ... ML-3), stand-in labels for
checking the cluster measures, and the churn label and split (CH-1, CH-3).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.selection import Key, column_quantiles, is_after, rows_at
from starmart.params import Params
from starmart.plans import marts
from starmart.plans.star import Star


# The feature lists of the reference notebook.
NUMERIC_COLS = ("total_orders", "total_sales", "total_profit", "days_since_last_purchase",
                "customer_lifetime_days", "avg_discount_rate")
# the last clustering pass leaves out recency and discount
REDUCED_COLS = ("total_orders", "total_sales", "total_profit", "customer_lifetime_days")
# churn features: recency defines the label, so it is left out
CHURN_COLS = ("total_orders", "total_sales", "total_profit", "avg_discount_rate",
              "customer_lifetime_days")

ML_COLUMNS = ("customer_id", "customer_name", "segment", "city", "state", "total_orders",
              "total_sales", "total_profit", "days_since_last_purchase", "customer_lifetime_days",
              "avg_discount_rate")


def ml_input(star: Star, params: Params) -> DataFrame:
    """IO-4: the customer mart's columns for ML, customers with a lifetime
    of more than 0 days.  Built from the customer base (the RFM windows are
    not needed here); the filter sits on the aggregate and stays there."""
    base = marts.customer_base(star, params).where(F.col("customer_lifetime_days") > 0)
    return base.select(*[F.col(c).cast("double").alias(c) if c in ("total_sales", "total_profit")
                         else F.col(c) for c in ML_COLUMNS])


def levels(df: DataFrame, col: str) -> list[str]:
    """Sorted distinct values of a categorical column (one row per level
    reaches the driver: they name output columns)."""
    return sorted(r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().collect())


def dummies(df: DataFrame, col: str, lv: Sequence[str] | None = None,
            drop_first: bool = True) -> tuple[DataFrame, list[str]]:
    """ML-1 (``get_dummies(drop_first=True)``): one 0/1 column per level
    except the alphabetically first, named ``<col>_<level>``."""
    lv = list(lv if lv is not None else levels(df, col))
    keep = lv[1:] if drop_first else lv
    names = [f"{col}_{v}" for v in keep]
    out = df.withColumns({n: F.when(F.col(col) == v, 1).otherwise(0) for n, v in zip(names, keep)})
    return out, names


def standard_scaled(df: DataFrame, cols: Sequence[str], prefix: str = "z_") -> DataFrame:
    """ML-2 (StandardScaler): ``(x - mean) / std_pop``; a constant column
    scales to 0.  Mean and deviation are uncorrelated scalar subqueries."""
    out = {}
    for c in cols:
        mean = df.select(F.avg(F.col(c).cast("double"))).scalar()
        sd = df.select(F.stddev_pop(F.col(c).cast("double"))).scalar()
        out[f"{prefix}{c}"] = F.when(sd != 0, (F.col(c).cast("double") - mean) / sd).otherwise(
            F.lit(0.0))
    return df.withColumns(out)


def clustering_frame(star: Star, params: Params, numeric: Sequence[str] = NUMERIC_COLS
                     ) -> tuple[DataFrame, list[str]]:
    """ML-3: scaled numerics + segment dummies; returns the frame and the
    feature column names (all DOUBLE)."""
    df = ml_input(star, params)
    df, dummy_cols = dummies(df, "segment")
    df = standard_scaled(df, numeric)
    feats = [f"z_{c}" for c in numeric] + dummy_cols
    return df.withColumns({c: F.col(c).cast("double") for c in dummy_cols}), feats


def recency_label(df: DataFrame, params: Params) -> DataFrame:
    """Deterministic stand-in labels for checking the cluster measures: the
    status bands of recency (0 = Very Active ... 4 = Lost)."""
    c1, c2, c3, c4 = params.status_cuts
    d = F.col("days_since_last_purchase")
    return df.withColumn("label", F.when(d <= c1, 0).when(d <= c2, 1).when(d <= c3, 2)
                         .when(d <= c4, 3).otherwise(4))


def churn_labelled(star: Star, params: Params) -> DataFrame:
    """CH-1: churn = 1 when recency is above the exact median of the ML
    customers (found by histogram refinement)."""
    df = ml_input(star, params)
    med = column_quantiles(df, ["days_since_last_purchase"], [0.5])[0][0]
    return df.withColumn("churn", F.when(F.col("days_since_last_purchase") > F.lit(med), 1).otherwise(0))


def stratified_split(df: DataFrame, id_col: str = "customer_id", test_frac: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """CH-3: ``split`` = 'test' for exactly ``round(test_frac * n)`` rows of
    each class: the first in the order of a seeded hash of the id.  The last
    of them is found by histogram refinement; no row is moved."""
    label = "churn"
    hashed = df.withColumn("__u", F.substring(
        F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string"))), 1, 8))
    order = [Key("__u"), Key(id_col)]
    # one row per class
    sizes = df.groupBy(label).agg(F.round(F.lit(test_frac) * F.count(F.lit(1))).cast("long")).collect()
    inside = [F.col(label).eqNullSafe(F.lit(c)) for c, _ in sizes]
    lasts = rows_at(hashed, [(order, quota) for _, quota in sizes], inside)
    kinds = {f.name: f.dataType for f in hashed.schema.fields}
    test = F.lit(False)
    for own, last in zip(inside, lasts):
        if last is not None:
            test = test | (own & ~is_after(order, last, kinds))
    return hashed.withColumn("split", F.when(test, "test").otherwise("train")).drop("__u")


def churn_standin(df: DataFrame) -> DataFrame:
    """Deterministic stand-in predictions for checking the metrics: score
    ``1 / (1 + total_orders)``, predict churn below the typical order count."""
    return df.withColumns({
        "label": F.col("churn"),
        "score": F.lit(1.0) / (F.col("total_orders") + 1),
        "prediction": F.when(F.col("total_orders") <= 9, 1).otherwise(0),
    })

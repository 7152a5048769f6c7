"""Churn prediction (CH-1 ... CH-9, T-14).

Label: recency above the median.  Features: five numerics + segment dummies
(recency is left out, it defines the label).  Model: second-order boosted
trees (:mod:`starmart.operators.boosting`) with the reference's settings
(depth 4, rate 0.1, 150 rounds, a share of 0.8 of the rows and of the columns
drawn per tree).  Split: exact per class, by a seeded hash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators import boosting
from starmart.params import Params
from starmart.plans import analytics, segmentation
from starmart.plans.star import Star


@dataclass
class ChurnModel:
    model: boosting.Model
    feature_names: list[str]
    data: DataFrame  # every ML customer with features, label and split


def churn_frame(star: Star, params: Params) -> tuple[DataFrame, list[str]]:
    def build():
        df = analytics.churn_labelled(star, params)
        df, dummy_cols = analytics.dummies(df, "segment")
        df = analytics.stratified_split(df)
        feats = list(analytics.CHURN_COLS) + dummy_cols
        return df.withColumns({c: F.col(c).cast("double") for c in feats})

    df = star.tables("churn_frame", build) if star.tables is not None else build()
    feats = list(analytics.CHURN_COLS) + [c for c in df.columns if c.startswith("segment_")]
    return df, feats


def train(star: Star, params: Params, max_iter: int = 150, seed: int = 42) -> ChurnModel:
    """CH-4: fit on the train split."""
    df, feats = churn_frame(star, params)
    model = boosting.fit(df.where(F.col("split") == "train"), "customer_id", feats, "churn", rounds=max_iter, seed=seed)
    return ChurnModel(model, feats, df)


def predict(cm: ChurnModel, df: DataFrame) -> DataFrame:
    """CH-5: class and probability of churn."""
    out = boosting.predict(df, cm.model, cm.feature_names)
    return out.withColumns({"label": F.col("churn"), "prediction": (F.col("score") > 0.5).cast("int")})


def holdout_predictions(cm: ChurnModel) -> DataFrame:
    return predict(cm, cm.data.where(F.col("split") == "test"))


def feature_importance(cm: ChurnModel) -> DataFrame:
    """CH-7: importances (mean gain, as shares) with feature names, ranked
    (d rows, d features)."""
    imp = cm.model.importance()
    spark = cm.data.sparkSession
    rows = sorted(zip(cm.feature_names, (float(v) for v in imp)), key=lambda t: (-t[1], t[0]))
    return spark.createDataFrame([(i + 1, f, v) for i, (f, v) in enumerate(rows)],
                                 "rank int, feature string, importance double")


def churn_scores(cm: ChurnModel) -> DataFrame:
    """CH-8: every ML customer scored (the training rows too, as in the
    reference, so it is not an out-of-sample list)."""
    return predict(cm, cm.data).select(
        "customer_id", "customer_name", F.col("total_orders").cast("long").alias("total_orders"),
        "total_sales",
        "days_since_last_purchase", F.col("score").alias("churn_probability"), "churn")


def top_risk(cm: ChurnModel, k: int = 10) -> DataFrame:
    """CH-9: the k customers most likely to churn, probability in percent
    to one place (half to even, as pandas rounds)."""
    s = churn_scores(cm)
    top = s.orderBy(F.col("churn_probability").desc(), F.col("customer_id")).limit(k)
    return top.withColumn("churn_probability", F.bround(F.col("churn_probability") * 100, 1))


def ml_results(star: Star, params: Params, cm: ChurnModel) -> DataFrame:
    """T-14: customer_id, final_cluster, final_cluster_label,
    churn_probability, churn."""
    seg = segmentation.final_segmentation(star, params).select(
        "customer_id", "final_cluster", "final_cluster_label")
    sc = churn_scores(cm).select("customer_id", "churn_probability", "churn")
    return seg.join(sc, "customer_id").select("customer_id", "final_cluster",
                                              "final_cluster_label", "churn_probability", "churn")

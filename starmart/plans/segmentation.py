"""Customer segmentation (ML-4, ML-6 ... ML-10, ML-16, ML-17).

The reference fits five methods for k = 3, 4, 2 and for k = 2 on reduced
features, each pass overwriting the previous labels; here every run is a
function ``(frame, features, method, k) -> labels`` and nothing is
overwritten.  MLlib estimators run executor-parallel; the methods without a
built-in are in :mod:`starmart.operators`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators import hierarchy
from starmart.operators import kmedoids as km
from starmart.params import Params
from starmart.plans import analytics
from starmart.plans.star import Star
from starmart.session import spread

# The reference's names of the two final segments, by rising sales.
FINAL_LABELS = ("Occasional Buyers", "Loyal High-Value Customers")

# the four passes of the notebook: (k, feature set)
PASSES = ((3, "full"), (4, "full"), (2, "full"), (2, "reduced"))


def features_frame(star: Star, params: Params, feature_set: str = "full"
                   ) -> tuple[DataFrame, list[str]]:
    """Scaled numerics + segment dummies, materialized once (MLlib iterates
    over it), with a ``features`` vector."""
    numeric = analytics.NUMERIC_COLS if feature_set == "full" else analytics.REDUCED_COLS

    def build():
        df, feats = analytics.clustering_frame(star, params, numeric)
        # the fits read this table in every round: as many tasks as its rows ask for
        return VectorAssembler(inputCols=feats, outputCol="features").transform(spread(df, "customer_id"))

    if star.tables is not None:
        df = star.tables(f"features_{feature_set}", build)
    else:
        df = build()
    feats = [f"z_{c}" for c in numeric] + [c for c in df.columns if c.startswith("segment_")]
    return df, feats


def kmeans(df: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """ML-6: k-means|| start, seed 42."""
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(df)
    return model.transform(df)


def bisecting(df: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """ML-8 from the top: divisive bisecting k-means."""
    model = BisectingKMeans(k=k, seed=seed, featuresCol="features",
                            predictionCol="cluster").fit(df)
    return model.transform(df)


def gmm(df: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """ML-9: Gaussian mixture, full covariance."""
    model = GaussianMixture(k=k, seed=seed, featuresCol="features", predictionCol="cluster",
                            probabilityCol="cluster_probability").fit(df)
    return model.transform(df).drop("cluster_probability")


def kmedoids(df: DataFrame, feats: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """ML-10: K-Medoids over all rows (see :mod:`starmart.operators.kmedoids`)."""
    return km.kmedoids(df, "customer_id", feats, k, seed)


def ward_tree(df: DataFrame, feats: Sequence[str], seed: int = 42) -> hierarchy.Hierarchy:
    """ML-8 from the bottom: Ward's linkage with merge heights, over bounded
    summaries of the rows (see :mod:`starmart.operators.hierarchy`)."""
    return hierarchy.fit(df, "customer_id", feats, seed=seed)


def ward(df: DataFrame, feats: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    return hierarchy.assign(df.drop("features"), feats, ward_tree(df, feats, seed), k)


METHODS = {"kmeans": kmeans, "bisecting": bisecting, "gmm": gmm}


def cluster(df: DataFrame, feats: Sequence[str], method: str, k: int, seed: int = 42
            ) -> DataFrame:
    if method == "kmedoids":
        return kmedoids(df, feats, k, seed)
    if method == "ward":
        return ward(df, feats, k, seed)
    if method == "dbscan":
        from starmart.operators.dbscan import dbscan

        return dbscan(df, "customer_id", feats)
    return METHODS[method](df, k, seed)


def elbow(df: DataFrame, feats: Sequence[str], ks: Sequence[int] = range(1, 11), seed: int = 42
          ) -> DataFrame:
    """ML-7: SSE for each k.  k = 1 is ``sum n * var_pop`` (KMeans rejects
    k = 1); for k >= 2 the training cost of the fit, without another pass."""
    rows = []
    for k in ks:
        if k == 1:
            cost = df.agg(sum((F.count(c) * F.var_pop(c) for c in feats), F.lit(0.0))).first()[0]
        else:
            cost = KMeans(k=k, seed=seed, featuresCol="features").fit(df).summary.trainingCost
        rows.append((int(k), float(cost)))
    return df.sparkSession.createDataFrame(rows, "k int, sse double")


def pca2(df: DataFrame, feats: Sequence[str]) -> DataFrame:
    """ML-4: first two principal components of the centred features
    (Spark's PCA projects uncentred data, so centre first; signs arbitrary)."""
    centred = df.withColumns({f"c_{c}": F.col(c) - df.select(F.avg(c)).scalar() for c in feats})
    vec = VectorAssembler(inputCols=[f"c_{c}" for c in feats], outputCol="cvec").transform(centred)
    out = PCA(k=2, inputCol="cvec", outputCol="pcs").fit(vec).transform(vec)
    arr = vector_to_array(out["pcs"])
    return out.select("customer_id", arr[0].alias("pc1"), arr[1].alias("pc2"))


def final_segments(df: DataFrame, labels: Sequence[str] = FINAL_LABELS) -> DataFrame:
    """ML-17: cluster ids are arbitrary, so clusters are renumbered by rising
    mean total sales and named (k-row mapping, k a parameter)."""
    order = (df.groupBy("cluster").agg(F.avg("total_sales").alias("m"))
             .orderBy("m", "cluster").collect())
    remap = {r["cluster"]: i for i, r in enumerate(order)}
    final = F.lit(None).cast("int")
    for old, new in remap.items():
        final = F.when(F.col("cluster") == old, F.lit(new)).otherwise(final)
    name = F.lit(None).cast("string")
    for i, lab in enumerate(labels):
        name = F.when(F.col("final_cluster") == i, F.lit(lab)).otherwise(name)
    return df.withColumn("final_cluster", final).withColumn("final_cluster_label", name)


def final_segmentation(star: Star, params: Params, seed: int = 42) -> DataFrame:
    """The reference's choice: K-Medoids, k = 2, reduced features."""
    df, feats = features_frame(star, params, "reduced")

    def build():
        return kmedoids(df, feats, 2, seed).withColumn("cluster", F.col("cluster").cast("int"))

    # the labels of the last pass, fitted once
    last = f"labels_kmedoids_{len(PASSES) - 1}"
    return final_segments(star.tables(last, build) if star.tables is not None else build())

"""Cluster-quality measures and cluster profiles (ML-12 ... ML-16).

Everything is O(n * k): per-cluster sums reach the points through a join with
that k-row table or as one array of k structs from a scalar subquery, never
through pairs of points.
Feature columns are plain DOUBLE columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import write_table


def _sq_norm(cols: Sequence[str], prefix: str = "") -> Column:
    return sum((F.col(f"{prefix}{c}") * F.col(f"{prefix}{c}") for c in cols), F.lit(0.0))


def centroids(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """``label, n, m_<col>...`` : size and mean of each cluster."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"),
                                 *[F.avg(c).alias(f"m_{c}") for c in cols])


def calinski_harabasz(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """ML-13: ``(B / (k - 1)) / (W / (n - k))``, B between- and W within-
    cluster sums of squares.  B comes from the k-row centroid table alone
    (``sum_c n_c m_c^2 - (sum_c n_c m_c)^2 / n`` per feature), W from the
    points joined to their centroid.  One row ``calinski_harabasz``."""
    cen = centroids(df, label, cols)
    within = df.join(cen, label).agg(
        F.sum(sum(((F.col(c) - F.col(f"m_{c}")) ** 2 for c in cols), F.lit(0.0))).alias("w"))
    between = cen.agg(*[F.sum(F.col("n") * F.col(f"m_{c}") * F.col(f"m_{c}")).alias(f"a_{c}")
                        for c in cols],
                      *[F.sum(F.col("n") * F.col(f"m_{c}")).alias(f"b_{c}") for c in cols],
                      F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    b = sum((F.col(f"a_{c}") - F.col(f"b_{c}") * F.col(f"b_{c}") / F.col("n") for c in cols),
            F.lit(0.0))
    w = within.select("w").scalar()
    k, n = F.col("k"), F.col("n")
    return between.select(
        F.when((k > 1) & (w != 0), (b / (k - 1)) / (w / (n - k)))
        .otherwise(F.lit(1.0)).alias("calinski_harabasz"))


def _cluster_array(stats: DataFrame, fields: Sequence[str]) -> Column:
    """The rows of a per-cluster table as one array of structs: a scalar
    subquery, so it stays off the driver (every point is held against every
    cluster, as in any k-means ``predict``)."""
    return stats.select(F.sort_array(F.collect_list(F.struct(*fields)))).scalar()


def davies_bouldin(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """ML-14: mean over clusters of the worst ``(s_i + s_j) / d(c_i, c_j)``,
    s the mean Euclidean distance of a cluster's points to its centroid.
    The pairwise part runs over the k centroids inside one array."""
    cen = centroids(df, label, cols)
    dist = F.sqrt(sum(((F.col(c) - F.col(f"m_{c}")) ** 2 for c in cols), F.lit(0.0)))
    scatter = df.join(cen, label).groupBy(label).agg(F.avg(dist).alias("s"))
    cs = cen.join(scatter, label).select(
        F.col(label).alias("c"), "s", F.array(*[F.col(f"m_{c}") for c in cols]).alias("m"))
    cs = cs.withColumn("__all", _cluster_array(cs, ["c", "s", "m"]))
    others, own_m = F.col("__all"), F.col("m")

    def ratio(e):
        d = F.sqrt(F.aggregate(F.zip_with(own_m, e["m"], lambda p, q: (p - q) * (p - q)),
                               F.lit(0.0), lambda acc, v: acc + v))
        return F.when(d != 0, (F.col("s") + e["s"]) / d)

    worst = F.array_max(F.transform(F.filter(others, lambda e: e["c"] != F.col("c")), ratio))
    return cs.agg(F.avg(worst).alias("davies_bouldin"))


def silhouette_squared(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """ML-12 (squared Euclidean, as Spark's ClusteringEvaluator defines it),
    in O(n * k): the summed squared distance of x to cluster C is
    ``n_C |x|^2 - 2 x . S_C + Q_C``.  a(x) leaves x itself out; a point
    alone in its cluster scores 0.  The k cluster sums reach every point as
    one literal array of k structs."""
    stats = df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(c) for c in cols]).alias("s"),
        F.sum(_sq_norm(cols)).alias("q"))
    df = df.withColumn("__all", _cluster_array(stats.withColumnRenamed(label, "c"), ["c", "n", "q", "s"]))
    arr = F.col("__all")
    x = F.array(*[F.col(c) for c in cols])
    x2 = _sq_norm(cols)

    def mean_d(e):
        dot = F.aggregate(F.zip_with(x, e["s"], lambda p, q: p * q), F.lit(0.0),
                          lambda acc, v: acc + v)
        return (e["n"] * x2 - 2 * dot + e["q"]) / e["n"]

    own = F.filter(arr, lambda e: e["c"] == F.col(label))[0]
    own_n = own["n"]
    a = mean_d(own) * own_n / F.when(own_n > 1, own_n - 1)
    b = F.array_min(F.transform(F.filter(arr, lambda e: e["c"] != F.col(label)), mean_d))
    s = (F.when(own_n <= 1, F.lit(0.0))
         .when(a < b, 1 - a / b)
         .when(a > b, b / a - 1)
         .otherwise(F.lit(0.0)))
    return df.agg(F.avg(s).alias("silhouette"))


def silhouette_builtin(df: DataFrame, label: str, cols: Sequence[str]) -> float:
    """The same measure from MLlib's ClusteringEvaluator (a driver float)."""
    vec = VectorAssembler(inputCols=list(cols), outputCol="__features").transform(df)
    ev = ClusteringEvaluator(featuresCol="__features", predictionCol=label,
                             metricName="silhouette", distanceMeasure="squaredEuclidean")
    return ev.evaluate(vec.withColumn(label, F.col(label).cast("double")))


def cluster_profile(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """ML-16: size and feature means of each cluster (AG-12 unrounded, AG-13)."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("size"),
                                 *[F.avg(c).alias(f"mean_{c}") for c in cols])


def segment_mix(df: DataFrame, label: str | Sequence[str], segment: str = "segment") -> DataFrame:
    """ML-16 / AG-14 long form: share of each segment inside each cluster
    (``label``: the column, or columns, that name a cluster)."""
    label = [label] if isinstance(label, str) else list(label)
    counts = df.groupBy(*label, segment).agg(F.count(F.lit(1)).alias("c"))
    tot = counts.groupBy(*label).agg(F.sum("c").alias("t"))
    return counts.join(tot, label).select(
        *label, segment, (F.col("c").cast("double") / F.col("t")).alias("share"))


def _sum_array(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def _squares(a: Column, b: Column) -> Column:
    """Squared distance of two arrays."""
    return _sum_array(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)))


def labelling_scores(rows: DataFrame, keys: Sequence[str], label: str, dims: int,
                     withheld: Column | None = None) -> DataFrame:
    """ML-12 ... ML-15 of every labelling in ``rows`` (``keys`` name the
    labelling, ``x`` is the point's array of ``dims`` doubles): silhouette
    (squared Euclidean), Calinski-Harabasz and Davies-Bouldin, NULL with fewer
    than two clusters.  Labellings with a cluster for which ``withheld`` holds
    are left out.

    Two passes over the points, whatever the number of labellings: sizes and
    sums of all clusters, a written table with a row each; then every point
    meets the sums of its labelling's clusters.
    """
    keys = list(keys)
    x = F.col("x")
    stats = rows.groupBy(*keys, label).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(x[i]) for i in range(dims)]).alias("s"),
        F.sum(_sum_array(F.transform(x, lambda v: v * v))).alias("q"))
    if withheld is not None:
        stats = stats.join(stats.where(withheld).select(*keys).distinct(), keys, "left_anti")
    stats = write_table(stats, "cluster_stats")
    clusters = stats.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(
        F.col(label).alias("c"), "n", "q", "s"))).alias("all"))
    points = rows.join(clusters, keys).withColumn("own", F.filter("all", lambda e: e["c"] == F.col(label))[0])
    x2 = _sum_array(F.transform(x, lambda v: v * v))

    def mean_d(e: Column) -> Column:
        dot = _sum_array(F.zip_with(x, e["s"], lambda p, q: p * q))
        return (e["n"] * x2 - 2 * dot + e["q"]) / e["n"]

    own, n = F.col("own"), F.col("own.n")
    points = points.withColumns({
        "a": mean_d(own) * n / F.when(n > 1, n - 1),
        "b": F.array_min(F.transform(F.filter("all", lambda e: e["c"] != F.col(label)), mean_d)),
        "d2": _squares(x, F.transform(own["s"], lambda v: v / n))})
    a, b = F.col("a"), F.col("b")
    s = F.when(n <= 1, F.lit(0.0)).when(a < b, 1 - a / b).when(a > b, b / a - 1).otherwise(F.lit(0.0))
    spread = points.groupBy(*keys, label).agg(
        F.sum(s).alias("sil"), F.sum("d2").alias("w"), F.avg(F.sqrt("d2")).alias("scatter"))
    parts = stats.join(spread, [*keys, label]).withColumn("m", F.transform("s", lambda v: v / F.col("n")))
    total = parts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("clusters"), F.sum("n").alias("rows"), F.sum("sil").alias("sil"), F.sum("w").alias("w"),
        sum((F.sum(F.col("s")[i] * F.col("m")[i]) for i in range(dims)), F.lit(0.0)).alias("own2"),
        F.array(*[F.sum(F.col("s")[i]) for i in range(dims)]).alias("s"),
        F.collect_list(F.struct(F.col(label).alias("c"), "scatter", "m")).alias("all"))
    k, n, w = F.col("clusters"), F.col("rows"), F.col("w")
    between = F.col("own2") - _sum_array(F.transform("s", lambda v: v * v)) / n

    def worst(e: Column) -> Column:
        def ratio(o: Column) -> Column:
            d = F.sqrt(_squares(e["m"], o["m"]))
            return F.when(d != 0, (e["scatter"] + o["scatter"]) / d)
        return F.array_max(F.transform(F.filter("all", lambda o: o["c"] != e["c"]), ratio))

    ratios = F.filter(F.transform("all", worst), lambda v: v.isNotNull())
    many = k > 1
    return total.select(
        *keys, F.when(many, F.col("sil") / n).alias("silhouette"),
        F.when(many & (w != 0), (between / (k - 1)) / (w / (n - k))).when(many, F.lit(1.0)).alias("calinski_harabasz"),
        F.when(many & (F.size(ratios) > 0), _sum_array(ratios) / F.size(ratios)).alias("davies_bouldin"))


def all_scores(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """Silhouette (squared Euclidean), Calinski-Harabasz and Davies-Bouldin of
    one labelling, one row; all NULL with fewer than two clusters."""
    rows = df.select(F.lit(0).alias("one"), label, F.array(*cols).alias("x"))
    return labelling_scores(rows, ["one"], label, len(cols)).drop("one")

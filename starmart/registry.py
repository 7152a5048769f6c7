"""Named queries: the Spark callable and, where SQL can express it, the
DuckDB oracle string that must give the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import oracle
from starmart.operators import classification, cluster_eval, gate, hierarchy, iforest, quality, stats
from starmart.params import FIXTURE_PARAMS as P
from starmart.plans import analytics, marts, reports, segmentation, star
from starmart.plans import churn as churn_plan
from starmart.plans.warehouse import fixture_raw, fixture_star, memo
from starmart.session import scratch_path, ship_package
from starmart.sources import catalog, csv_ingest
from starmart.streaming import ingest as stream_ingest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)  # the Python workers import starmart
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _star(spark, sf_dir):
    return fixture_star(spark, sf_dir, P)


# --- star schema ----------------------------------------------------------
@register("dim_customer", oracle.DIMS["dim_customer"])
def q_dim_customer(spark, sf_dir):
    return _star(spark, sf_dir).dim_customer


@register("dim_product", oracle.DIMS["dim_product"])
def q_dim_product(spark, sf_dir):
    return _star(spark, sf_dir).dim_product


@register("dim_date", oracle.DIMS["dim_date"])
def q_dim_date(spark, sf_dir):
    return _star(spark, sf_dir).dim_date


@register("dim_ship", oracle.DIMS["dim_ship"])
def q_dim_ship(spark, sf_dir):
    return _star(spark, sf_dir).dim_ship


@register("fact_sales", oracle.DIMS["fact_sales"])
def q_fact_sales(spark, sf_dir):
    return star.fact_sales_view(_star(spark, sf_dir).fact)


# --- marts ----------------------------------------------------------------
@register("sales_daily", oracle.MARTS["sales_daily"])
def q_sales_daily(spark, sf_dir):
    return marts.sales_daily(_star(spark, sf_dir), P)


@register("sales_monthly", oracle.MARTS["sales_monthly"])
def q_sales_monthly(spark, sf_dir):
    return marts.sales_monthly(_star(spark, sf_dir), P)


@register("product_sales", oracle.MARTS["product_sales"])
def q_product_sales(spark, sf_dir):
    return marts.product_sales(_star(spark, sf_dir), P)


@register("customers", oracle.MARTS["customers"])
def q_customers(spark, sf_dir):
    return marts.customers(_star(spark, sf_dir), P)


@register("customer_cohorts", oracle.MARTS["customer_cohorts"])
def q_customer_cohorts(spark, sf_dir):
    return marts.customer_cohorts(_star(spark, sf_dir), P)


@register("executive_summary", oracle.MARTS["executive_summary"])
def q_executive_summary(spark, sf_dir):
    return marts.executive_summary(_star(spark, sf_dir), P)


@register("row_count_report", oracle.MARTS["row_count_report"])
def q_row_count_report(spark, sf_dir):
    return marts.row_count_report(marts.written_marts(_star(spark, sf_dir), P))


@register("mart_key_check", oracle.REPORTS["mart_key_check"])
def q_mart_key_check(spark, sf_dir):
    return reports.mart_key_check(marts.written_marts(_star(spark, sf_dir), P))


# --- single-operator reports and dashboard (exact oracle) ------------------------


_SIMPLE = ["rfm_scores", "customer_status", "value_tier", "lag_growth", "rank_global",
           "rank_in_category", "ntile_global", "distinct_on", "role_playing_dates",
           "left_join_unknown_member", "scalar_subqueries", "conditional_sums",
           "conditional_distinct", "pivot_share", "crosstab", "value_counts",
           "union_distinct_dates", "union_all_counts", "date_parts", "top_k", "key_check",
           "fk_check", "customer_kpis", "status_breakdown", "yoy_growth", "discount_impact",
           "revenue_by_region", "category_profit", "top_sellers"]


def _simple(name):
    fn = getattr(reports, name)
    return lambda spark, sf_dir: fn(_star(spark, sf_dir), P)


for _n in _SIMPLE:
    register(_n, oracle.REPORTS[_n])(_simple(_n))


@register("null_counts", oracle.REPORTS["null_counts"])
def q_null_counts(spark, sf_dir):
    return reports.null_counts(_star(spark, sf_dir), P, fixture_raw(spark, sf_dir, P))


def _ml(spark, sf_dir):
    return analytics.ml_input(_star(spark, sf_dir), P)


@register("ml_input", oracle.REPORTS["ml_input"])
def q_ml_input(spark, sf_dir):
    return _ml(spark, sf_dir)


@register("duplicate_rows", oracle.REPORTS["duplicate_rows"])
def q_duplicate_rows(spark, sf_dir):
    return quality.duplicate_rows(_ml(spark, sf_dir))


def _round(df, cols, digits=6):
    """Interpolated quantiles are rounded for the engine comparison: DuckDB's
    interpolation and ours can differ in the last bit."""
    return df.withColumns({c: F.round(c, digits) for c in cols})


@register("describe", oracle.REPORTS["describe"])
def q_describe(spark, sf_dir):
    return _round(stats.describe(_ml(spark, sf_dir), analytics.NUMERIC_COLS, digits=4), ["q25", "q50", "q75"])


@register("zscore_outliers", oracle.REPORTS["zscore_outliers"])
def q_zscore_outliers(spark, sf_dir):
    return stats.zscore_outliers(_ml(spark, sf_dir), analytics.NUMERIC_COLS, "customer_id",
                                 digits=9)


@register("histogram", oracle.REPORTS["histogram"])
def q_histogram(spark, sf_dir):
    return stats.histogram(_ml(spark, sf_dir), analytics.NUMERIC_COLS, bins=oracle.HIST_BINS)


@register("boxplot", oracle.REPORTS["boxplot"])
def q_boxplot(spark, sf_dir):
    return _round(stats.boxplot_stats(_ml(spark, sf_dir), analytics.NUMERIC_COLS),
                  ["q1", "median", "q3", "iqr"])


@register("exact_quantiles", oracle.REPORTS["exact_quantiles"])
def q_exact_quantiles(spark, sf_dir):
    return _round(stats.quantile_table(_ml(spark, sf_dir), analytics.NUMERIC_COLS, [0.0, 0.25, 0.5, 0.75, 1.0],
                                       ["q00", "q25", "q50", "q75", "q100"]), ["q25", "q50", "q75"])


@register("correlation", oracle.REPORTS["correlation"])
def q_correlation(spark, sf_dir):
    return stats.correlation_long(_ml(spark, sf_dir), analytics.NUMERIC_COLS, digits=9)


@register("chi_square", oracle.REPORTS["chi_square"])
def q_chi_square(spark, sf_dir):
    return stats.chi_square_stat(_ml(spark, sf_dir), "segment", "state", digits=6)


@register("chi_square_test", oracle.REPORTS["chi_square_test"])
def q_chi_square_test(spark, sf_dir):
    """ST-7 with its p-value; rounded for the engine comparison."""
    return stats.chi_square_test(_ml(spark, sf_dir), "segment", "state").withColumns(
        {"statistic": F.round("statistic", 6), "p_value": F.round("p_value", 6)})


@register("density_curve", oracle.REPORTS["density_curve"])
def q_density_curve(spark, sf_dir):
    """ST-4 on total sales; rounded for the engine comparison (sums of
    kernels in a different order differ in the last bits)."""
    kde = stats.kde_curve(_ml(spark, sf_dir), "total_sales", grid_size=oracle.KDE_POINTS)
    return kde.withColumns({"x": F.round("x", 6), "density": F.round("density", 15)})


@register("dummies", oracle.REPORTS["dummies"])
def q_dummies(spark, sf_dir):
    df, cols = analytics.dummies(_ml(spark, sf_dir), "segment")
    return df.select("customer_id", "segment", *cols)


def _feats(spark, sf_dir):
    df, feats = analytics.clustering_frame(_star(spark, sf_dir), P)
    return analytics.recency_label(df, P), feats


@register("scaled_features", oracle.REPORTS["scaled_features"])
def q_scaled_features(spark, sf_dir):
    df, _ = _feats(spark, sf_dir)
    return df.select("customer_id", *[F.round(f"z_{c}", 9).alias(f"z_{c}")
                                      for c in analytics.NUMERIC_COLS])


@register("silhouette", oracle.REPORTS["silhouette"])
def q_silhouette(spark, sf_dir):
    df, feats = _feats(spark, sf_dir)
    return cluster_eval.silhouette_squared(df, "label", feats).select(
        F.round("silhouette", 6).alias("silhouette"))


@register("calinski_harabasz", oracle.REPORTS["calinski_harabasz"])
def q_calinski_harabasz(spark, sf_dir):
    df, feats = _feats(spark, sf_dir)
    return cluster_eval.calinski_harabasz(df, "label", feats).select(
        F.round("calinski_harabasz", 6).alias("calinski_harabasz"))


@register("davies_bouldin", oracle.REPORTS["davies_bouldin"])
def q_davies_bouldin(spark, sf_dir):
    df, feats = _feats(spark, sf_dir)
    return cluster_eval.davies_bouldin(df, "label", feats).select(
        F.round("davies_bouldin", 6).alias("davies_bouldin"))


@register("cluster_profile", oracle.REPORTS["cluster_profile"])
def q_cluster_profile(spark, sf_dir):
    df, _ = _feats(spark, sf_dir)
    prof = cluster_eval.cluster_profile(df, "label", analytics.NUMERIC_COLS)
    # AG-12: means to 2 places, half to even as pandas rounds
    return prof.select("label", "size", *[F.bround(f"mean_{c}", 2).alias(f"mean_{c}")
                                          for c in analytics.NUMERIC_COLS])


@register("segment_mix", oracle.REPORTS["segment_mix"])
def q_segment_mix(spark, sf_dir):
    df, _ = _feats(spark, sf_dir)
    return cluster_eval.segment_mix(df, "label")


def _churned(spark, sf_dir):
    return analytics.churn_labelled(_star(spark, sf_dir), P)


@register("churn_label", oracle.REPORTS["churn_label"])
def q_churn_label(spark, sf_dir):
    return _churned(spark, sf_dir).select("customer_id", "days_since_last_purchase", "churn")


@register("stratified_split", oracle.REPORTS["stratified_split"])
def q_stratified_split(spark, sf_dir):
    return analytics.stratified_split(_churned(spark, sf_dir)).select(
        "customer_id", "churn", "split")


def _standin(spark, sf_dir):
    return analytics.churn_standin(_churned(spark, sf_dir))


@register("confusion_matrix", oracle.REPORTS["confusion_matrix"])
def q_confusion_matrix(spark, sf_dir):
    return classification.confusion(_standin(spark, sf_dir))


@register("class_report", oracle.REPORTS["class_report"])
def q_class_report(spark, sf_dir):
    return classification.class_report(_standin(spark, sf_dir))


@register("roc_auc", oracle.REPORTS["roc_auc"])
def q_roc_auc(spark, sf_dir):
    return classification.roc_auc(_standin(spark, sf_dir), num_partitions=P.order_partitions)


@register("roc_curve", oracle.REPORTS["roc_curve"])
def q_roc_curve(spark, sf_dir):
    return classification.roc_curve(_standin(spark, sf_dir), num_partitions=P.order_partitions)


# --- machine learning (rows-only: not expressible in SQL or not deterministic
# across engines; unit tests in tests/ check them against brute force) ---------


def _labelled(spark, sf_dir, method, i):
    """Features + labels of one method on one of the notebook's passes,
    fitted once per application and kept as a written table."""
    st = _star(spark, sf_dir)
    k, fs = segmentation.PASSES[i]
    df, feats = segmentation.features_frame(st, P, fs)

    def build():
        return segmentation.cluster(df, feats, method, k).withColumn(
            "cluster", F.col("cluster").cast("int"))

    # DBSCAN takes no k: passes on the same features share its labels
    name = f"labels_{method}_{fs}" if method == "dbscan" else f"labels_{method}_{i}"
    return st.tables(name, build), feats, k, fs


#: Fits that run at once: most of a fit's jobs are too small for all cores.
FITS = 4


def _fit_together(spark, sf_dir, methods):
    """The labels of these methods' passes, several fits at once; each is
    written once per application."""
    for fs in ("full", "reduced"):
        segmentation.features_frame(_star(spark, sf_dir), P, fs)
    kept = {(m, segmentation.PASSES[i][1] if m == "dbscan" else i): (m, i)  # DBSCAN's are shared
            for m in methods for i in reversed(range(len(segmentation.PASSES)))}
    with ThreadPoolExecutor(FITS) as pool:
        # the longest first
        jobs = sorted(kept.values(), key=lambda j: (j[0] != "dbscan", j[0] != "gmm", j))
        list(pool.map(lambda j: _labelled(spark, sf_dir, *j), jobs))


def _passes(spark, sf_dir, method):
    _fit_together(spark, sf_dir, [method])
    out = None
    for i in range(len(segmentation.PASSES)):
        lab, _, k, fs = _labelled(spark, sf_dir, method, i)
        part = lab.select(F.lit(i + 1).alias("pass"), F.lit(k).alias("k"),
                          F.lit(fs).alias("features"), "customer_id", "cluster")
        out = part if out is None else out.unionByName(part)
    return out


for _m in ("kmeans", "bisecting", "ward", "gmm", "kmedoids", "dbscan"):
    register(_m, oracle.REPORTS.get(_m))(lambda spark, sf_dir, _m=_m: _passes(spark, sf_dir, _m))


@register("merge_heights")
def q_merge_heights(spark, sf_dir):
    """The merges of Ward's hierarchy over all customers, which a dendrogram
    draws (ML-8)."""
    df, feats = segmentation.features_frame(_star(spark, sf_dir), P, "full")
    return hierarchy.linkage(df, "customer_id", feats)


@register("elbow")
def q_elbow(spark, sf_dir):
    df, feats = segmentation.features_frame(_star(spark, sf_dir), P, "full")
    return segmentation.elbow(df, feats)


@register("pca")
def q_pca(spark, sf_dir):
    """The first two components of the full and of the reduced features."""
    out = None
    for fs in ("full", "reduced"):
        df, feats = segmentation.features_frame(_star(spark, sf_dir), P, fs)
        part = segmentation.pca2(df, feats).select(F.lit(fs).alias("features"), "customer_id", "pc1", "pc2")
        out = part if out is None else out.unionByName(part)
    return out


METHOD_NAMES = ("kmeans", "bisecting", "ward", "gmm", "kmedoids", "dbscan")


def _labellings(spark, sf_dir, columns):
    """Every method's and pass's labels in one frame; ``columns(feats)`` are
    the further columns of a labelling with these features."""
    _fit_together(spark, sf_dir, METHOD_NAMES)
    out = None
    for method in METHOD_NAMES:
        for i in range(len(segmentation.PASSES)):
            lab, feats, k, _ = _labelled(spark, sf_dir, method, i)
            part = lab.select(F.lit(method).alias("method"), F.lit(i + 1).alias("pass"), F.lit(k).alias("k"),
                              "cluster", *columns(feats))
            out = part if out is None else out.unionByName(part)
    return out


@register("cluster_scores")
def q_cluster_scores(spark, sf_dir):
    """Silhouette, Calinski-Harabasz and Davies-Bouldin of every method and
    pass (ML-12 ... ML-15; DBSCAN with noise is skipped, as the reference does)."""
    _, full = segmentation.features_frame(_star(spark, sf_dir), P, "full")

    def point(feats):  # a feature that a pass leaves out adds nothing to any distance
        return [F.array(*[F.col(f"`{c}`") if c in feats else F.lit(0.0) for c in full]).alias("x")]

    noise = (F.col("method") == "dbscan") & (F.col("cluster") == -1)
    return cluster_eval.labelling_scores(_labellings(spark, sf_dir, point), ["method", "pass", "k"], "cluster",
                                         len(full), noise)


@register("cluster_profiles")
def q_cluster_profiles(spark, sf_dir):
    """ML-16 for every method and pass: cluster sizes and feature means
    (2 places, half to even, as the reference prints them)."""
    rows = _labellings(spark, sf_dir, lambda _: analytics.NUMERIC_COLS)
    return rows.groupBy("method", "pass", "k", "cluster").agg(
        F.count(F.lit(1)).alias("size"), *[F.bround(F.avg(c), 2).alias(f"mean_{c}") for c in analytics.NUMERIC_COLS])


@register("cluster_segment_mix")
def q_cluster_segment_mix(spark, sf_dir):
    """ML-16 for every method and pass: the share of each customer segment
    inside each cluster."""
    return cluster_eval.segment_mix(_labellings(spark, sf_dir, lambda _: ["segment"]), ["method", "pass", "k", "cluster"])


@register("isolation_forest")
def q_isolation_forest(spark, sf_dir):
    ml = _ml(spark, sf_dir)
    return iforest.isolation_forest(ml, "customer_id", analytics.NUMERIC_COLS).select("customer_id", "score", "anomaly")


def _churn_model(spark, sf_dir):
    st = _star(spark, sf_dir)
    return memo(spark, sf_dir, "churn_model", P, lambda: churn_plan.train(st, P))


@register("churn_scores")
def q_churn_scores(spark, sf_dir):
    return churn_plan.churn_scores(_churn_model(spark, sf_dir))


@register("churn_model_metrics")
def q_churn_model_metrics(spark, sf_dir):
    """CH-6 on the held-out split of the trained model."""
    pred = churn_plan.holdout_predictions(_churn_model(spark, sf_dir))
    auc = classification.roc_auc(pred, num_partitions=P.order_partitions).select(
        "roc_auc").scalar()
    return classification.confusion(pred).withColumn("roc_auc", auc)


@register("churn_class_report")
def q_churn_class_report(spark, sf_dir):
    """CH-6b on the held-out split of the trained model."""
    return classification.class_report(churn_plan.holdout_predictions(_churn_model(spark, sf_dir)))


@register("churn_roc_curve")
def q_churn_roc_curve(spark, sf_dir):
    """CH-6d on the held-out split of the trained model."""
    return classification.roc_curve(churn_plan.holdout_predictions(_churn_model(spark, sf_dir)),
                                    num_partitions=P.order_partitions)


@register("churn_features", oracle.REPORTS["churn_features"])
def q_churn_features(spark, sf_dir):
    """CH-2: the feature frame of the churn model with label and split."""
    df, feats = churn_plan.churn_frame(_star(spark, sf_dir), P)
    return df.select("customer_id", *feats, "churn", "split")


@register("catalog_round_trip", oracle.REPORTS["catalog_round_trip"])
def q_catalog_round_trip(spark, sf_dir):
    """IO-3, IO-4, IO-5: the monthly mart replace-loaded into a catalog table,
    twice, and read back with projection and filter."""
    name = f"starmart_{os.path.basename(scratch_path(spark)).replace('-', '_')}"
    catalog.create_namespaces(spark, scratch_path(spark, "catalog"), (name,))
    mart = marts.sales_monthly(_star(spark, sf_dir), P)
    for _ in range(2):  # the second load replaces the first
        catalog.replace_table(mart, f"{name}.sales_monthly")
    return catalog.read_table(spark, f"{name}.sales_monthly", ["year", "month", "total_sales"],
                              f"year = {P.current_year}")


@register("load_gate", oracle.REPORTS["load_gate"])
def q_load_gate(spark, sf_dir):
    """CHK-1, CHK-2, CHK-3 in the write pass: the fact loaded through the
    gate, and how many lines its table and its quarantine hold, by reason."""
    name = f"starmart_{os.path.basename(scratch_path(spark)).replace('-', '_')}"
    catalog.create_namespaces(spark, scratch_path(spark, "catalog"), (name,))
    gate.gated_load(_star(spark, sf_dir).fact, f"{name}.fact_sales", star.fact_rules())
    held = spark.table(f"{name}.fact_sales").select("violation").unionByName(
        spark.table(f"{name}.fact_sales_quarantine").select("violation"))
    return held.groupBy(F.coalesce("violation", F.lit("accepted")).alias("outcome")).agg(F.count(F.lit(1)).alias("lines"))


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    return churn_plan.feature_importance(_churn_model(spark, sf_dir))


@register("top_risk")
def q_top_risk(spark, sf_dir):
    return churn_plan.top_risk(_churn_model(spark, sf_dir))


@register("customers_ml_results")
def q_customers_ml_results(spark, sf_dir):
    return churn_plan.ml_results(_star(spark, sf_dir), P, _churn_model(spark, sf_dir))


@register("cluster_distribution")
def q_cluster_distribution(spark, sf_dir):
    """D-3: customers per final segment."""
    seg = segmentation.final_segmentation(_star(spark, sf_dir), P)
    return seg.groupBy("final_cluster", "final_cluster_label").agg(
        F.count(F.lit(1)).alias("customers"))


# --- ingestion: the reference's CSV layout, written from the given tables and
# read back through the same path a raw file takes (IO-1, IO-2, T-1, CHK-5) ---


def _money_out(df):
    return df.withColumns({c: F.col(c).cast("double") for c in ("sales", "discount", "profit")})


def _exported_csv(spark, sf_dir):
    def build():
        path = scratch_path(spark, "csv")
        csv_ingest.export_csv(fixture_raw(spark, sf_dir, P), path)
        return path
    return memo(spark, sf_dir, "exported_csv", P, build)


def _csv_staging(spark, sf_dir):
    return csv_ingest.stage_csv(spark, _exported_csv(spark, sf_dir), P)


@register("csv_staging", oracle.REPORTS["csv_staging"])
def q_csv_staging(spark, sf_dir):
    return _money_out(_csv_staging(spark, sf_dir))


@register("load_rejects", oracle.REPORTS["load_rejects"])
def q_load_rejects(spark, sf_dir):
    """IO-1, IO-2, PF-3: a real CSV dialect (doubled quotes, commas) with bad
    dates, numbers, row ids and ship modes seeded into the given lines: what
    the load rejects, and what it keeps, by kind."""
    text = csv_ingest.read_sales_text(spark, memo(
        spark, sf_dir, "seeded_csv", P, lambda: csv_ingest.export_seeded(
            fixture_raw(spark, sf_dir, P), scratch_path(spark, "csv"))))
    staged = csv_ingest.clean(csv_ingest.typed(text), P.with_(bad_row_ids=(5,)))
    counts = csv_ingest.reject_counts(text).select(
        F.concat(F.lit("rejected "), "column_name").alias("kind"), F.col("rejects").alias("rows"))
    kept = [("staged", F.count(F.lit(1))), ("quoted", F.count(F.when(F.col("product_name").startswith('A ", "'), 1))),
            ("ship_mode sas", F.count(F.when(F.col("ship_mode") == "sas", 1))),
            ("without sales", F.count(F.when(F.col("sales").isNull(), 1)))]
    row = staged.agg(*[c.alias(n) for n, c in kept])
    return counts.unionByName(row.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("kind"), F.col(f"`{n}`").alias("rows")) for n, _ in kept])).alias("k")).select("k.*"))


@register("stream_staging", oracle.REPORTS["stream_staging"])
def q_stream_staging(spark, sf_dir):
    """The same load as a Structured Streaming file source (availableNow)."""
    target, ck = scratch_path(spark, "stream_out"), scratch_path(spark, "stream_ck")
    q = stream_ingest.start_staging_load(spark, _exported_csv(spark, sf_dir), target, ck, P)
    q.awaitTermination()
    return _money_out(spark.read.parquet(target))


@register("load_row_count", oracle.REPORTS["load_row_count"])
def q_load_row_count(spark, sf_dir):
    return quality.row_count_check(fixture_raw(spark, sf_dir, P), _csv_staging(spark, sf_dir),
                                   "staging_raw")


@register("distinct_values", oracle.REPORTS["distinct_values"])
def q_distinct_values(spark, sf_dir):
    """U-4: distinct values of the categorical columns (the profiling step)."""
    st = _star(spark, sf_dir).staging
    parts = [csv_ingest.distinct_values(st, c).select(F.lit(c).alias("column_name"),
                                                       F.col(c).cast("string").alias("value"))
             for c in csv_ingest.CATEGORICAL_COLUMNS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("rows_missing", oracle.REPORTS["rows_missing"])
def q_rows_missing(spark, sf_dir):
    """CHK-4: raw lines without a postal code (before the fill)."""
    return quality.rows_missing(fixture_raw(spark, sf_dir, P), "postal_code").select(
        "row_id", "customer_id", "city", "state")


@register("first_rows", oracle.REPORTS["first_rows"])
def q_first_rows(spark, sf_dir):
    """S-3: the first five rows of the ML input (``df.head()``), by customer id."""
    return _ml(spark, sf_dir).orderBy("customer_id").limit(5)

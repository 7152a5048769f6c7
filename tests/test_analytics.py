"""Statistics, cluster measures, custom clusterings and classification
measures against brute-force numpy references on small frames."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.functions.special import chi2_sf
from starmart.operators import classification, cluster_eval, iforest, kmedoids, stats


@pytest.fixture(scope="module")
def blobs(spark):
    """Three separated clusters of 39 points plus 3 far points (120 rows)."""
    rng = np.random.default_rng(3)
    centres = np.array([[0.0, 0.0, 0.0], [8.0, 8.0, 0.0], [0.0, 8.0, 8.0]])
    pts, lab = [], []
    for i, c in enumerate(centres):
        pts.append(c + rng.normal(0, 0.5, (39, 3)))
        lab += [i] * 39
    pts.append(np.array([[30.0, -30.0, 30.0], [-30.0, 30.0, -30.0], [40.0, 40.0, 40.0]]))
    lab += [0, 1, 2]
    x = np.vstack(pts)
    rows = [(i, int(lab[i]), *map(float, x[i])) for i in range(len(x))]
    return spark.createDataFrame(rows, "id long, label int, a double, b double, c double"), x, \
        np.array(lab)


COLS = ["a", "b", "c"]


def test_kmedoids_recovers_blobs(blobs):
    df, x, lab = blobs
    med = kmedoids.fit_medoids(df, "id", COLS, 3)
    for m in med:  # every medoid is a data point
        assert np.min(np.abs(x - np.array(m)).sum(axis=1)) < 1e-12
    got = dict(kmedoids.assign(df, COLS, med).select("id", "cluster").collect())
    core = range(117)
    for b in range(3):
        assert len({got[i] for i in core if lab[i] == b}) == 1
    assert len({got[i] for i in core}) == 3


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_kmedoids_cost_against_exhaustive_search(spark, seed):
    """Within 5 % of the best pair of rows, without any structure to find."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(150, 2))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    best = min(np.minimum(d[:, i], d[:, j]).sum() for i in range(150) for j in range(i + 1, 150))
    df = spark.createDataFrame([(f"id{i}", *map(float, v)) for i, v in enumerate(x)], "id string, a double, b double")
    med = kmedoids.fit_medoids(df, "id", ["a", "b"], 2)
    assert kmedoids.total_cost(df, ["a", "b"], med) <= 1.05 * best


def test_kmedoids_with_one_cluster_and_equal_rows(spark):
    df = spark.createDataFrame([(i, 1.0, 2.0) for i in range(20)], "id long, a double, b double")
    assert kmedoids.fit_medoids(df, "id", ["a", "b"], 1) == [[1.0, 2.0]]
    assert {r.cluster for r in kmedoids.kmedoids(df, "id", ["a", "b"], 2).collect()} == {0}


def test_stratified_split_is_exact_per_class(spark):
    from starmart.plans.analytics import stratified_split

    df = spark.createDataFrame([(f"c{i}", int(i % 7 == 0)) for i in range(403)], "customer_id string, churn int")
    for parts in (1, 3):
        out = stratified_split(df.repartition(parts)).groupBy("churn", "split").count().collect()
        got = {(r.churn, r["split"]): r["count"] for r in out}
        n1 = sum(i % 7 == 0 for i in range(403))
        assert got[1, "test"] == round(0.2 * n1) and got[0, "test"] == round(0.2 * (403 - n1))
        assert sum(got.values()) == 403


def test_isolation_forest_ranks_planted_outliers_first(blobs):
    df, x, lab = blobs
    out = iforest.isolation_forest(df, "id", COLS, contamination=0.025, n_trees=100,
                                   max_samples=64)
    ranked = [r.id for r in out.orderBy("score", "id").limit(3).collect()]
    assert sorted(ranked) == [117, 118, 119]
    assert sorted(r.id for r in out.where("anomaly = -1").collect()) == [117, 118, 119]


def test_silhouette_ch_db_match_numpy(blobs):
    df, x, lab = blobs
    k = 3
    # squared Euclidean silhouette, brute force
    d2 = ((x[:, None] - x[None]) ** 2).sum(-1)
    s = []
    for i in range(len(x)):
        own = lab == lab[i]
        a = d2[i, own].sum() / (own.sum() - 1)
        b = min(d2[i, lab == c].mean() for c in range(k) if c != lab[i])
        s.append((b - a) / max(a, b))
    got = cluster_eval.silhouette_squared(df, "label", COLS).first().silhouette
    assert got == pytest.approx(np.mean(s), rel=1e-9)
    assert cluster_eval.silhouette_builtin(df, "label", COLS) == pytest.approx(np.mean(s), rel=1e-6)
    # Calinski-Harabasz and Davies-Bouldin
    g = x.mean(0)
    cen = np.array([x[lab == c].mean(0) for c in range(k)])
    nc = np.array([(lab == c).sum() for c in range(k)])
    b_ss = (nc * ((cen - g) ** 2).sum(1)).sum()
    w_ss = sum(((x[lab == c] - cen[c]) ** 2).sum() for c in range(k))
    ch = (b_ss / (k - 1)) / (w_ss / (len(x) - k))
    assert cluster_eval.calinski_harabasz(df, "label", COLS).first()[0] == pytest.approx(ch)
    sc = np.array([np.sqrt(((x[lab == c] - cen[c]) ** 2).sum(1)).mean() for c in range(k)])
    dbi = np.mean([max((sc[i] + sc[j]) / np.linalg.norm(cen[i] - cen[j])
                       for j in range(k) if j != i) for i in range(k)])
    assert cluster_eval.davies_bouldin(df, "label", COLS).first()[0] == pytest.approx(dbi)


def test_kde_matches_brute_force(blobs):
    df, x, _ = blobs
    out = sorted(stats.kde_curve(df, "a", grid_size=50).collect(), key=lambda r: r.point)
    v = x[:, 0]
    bw = v.std(ddof=1) * len(v) ** (-0.2)
    for r in out[::7]:
        exp = np.exp(-0.5 * ((r.x - v) / bw) ** 2).sum() / (len(v) * bw * math.sqrt(2 * math.pi))
        assert r.density == pytest.approx(exp, rel=1e-9)


def test_chi_square_against_full_table(spark):
    rng = np.random.default_rng(5)
    a = rng.choice(["x", "y", "z"], 300)
    b = rng.choice(["p", "q", "r", "s"], 300, p=[0.5, 0.3, 0.19, 0.01])
    df = spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "a string, b string")
    got = stats.chi_square_test(df, "a", "b").first()
    tab = np.array([[np.sum((a == i) & (b == j)) for j in "pqrs"] for i in "xyz"], float)
    e = tab.sum(1, keepdims=True) * tab.sum(0, keepdims=True) / tab.sum()
    assert got.statistic == pytest.approx(((tab - e) ** 2 / e).sum())
    assert got.dof == 6
    assert 0 <= got.p_value <= 1


def test_chi2_sf_known_values():
    assert chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert chi2_sf(18.307038053275146, 10) == pytest.approx(0.05, rel=1e-9)
    assert chi2_sf(0.0, 4) == 1.0


@pytest.fixture(scope="module")
def scores(spark):
    rows = [(1, 0.9, 1), (2, 0.8, 1), (3, 0.8, 0), (4, 0.6, 1), (5, 0.5, 0), (6, 0.5, 0),
            (7, 0.4, 1), (8, 0.3, 0), (9, 0.2, 0), (10, 0.8, 1)]
    return spark.createDataFrame(rows, "id long, score double, label int").withColumn(
        "prediction", (F.col("score") >= 0.5).cast("int"))


def test_roc_auc_and_curve_brute_force(scores):
    pdf = scores.toPandas()
    pos, neg = pdf[pdf.label == 1].score.to_numpy(), pdf[pdf.label == 0].score.to_numpy()
    exp = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    assert classification.roc_auc(scores, num_partitions=3).first().roc_auc == pytest.approx(exp)
    curve = sorted(classification.roc_curve(scores, num_partitions=3).collect(),
                   key=lambda r: -r.threshold)
    for r in curve:
        assert r.tpr == pytest.approx((pos >= r.threshold).mean())
        assert r.fpr == pytest.approx((neg >= r.threshold).mean())
    assert (curve[-1].fpr, curve[-1].tpr) == (1.0, 1.0)


def test_confusion_and_report(scores):
    c = classification.confusion(scores).first()
    assert (c.tn, c.fp, c.fn, c.tp) == (2, 3, 1, 4)
    assert c.accuracy == pytest.approx(0.6) and c.precision_churn == pytest.approx(4 / 7)
    rep = {r.class_name: r for r in classification.class_report(scores).collect()}
    assert rep["1"].precision == pytest.approx(4 / 7) and rep["1"].recall == pytest.approx(0.8)
    assert rep["0"].support == 5 and rep["accuracy"].f1_score == pytest.approx(0.6)
    assert rep["macro avg"].recall == pytest.approx((0.8 + 0.4) / 2)
    f0, f1 = 2 * (2 / 3) * 0.4 / (2 / 3 + 0.4), 2 * (4 / 7) * 0.8 / (4 / 7 + 0.8)
    assert rep["weighted avg"].f1_score == pytest.approx((f0 * 5 + f1 * 5) / 10)


def _dbscan_reference(x, eps, min_samples):
    """Brute-force DBSCAN with the same conventions (ids = row positions)."""
    d2 = ((x[:, None] - x[None]) ** 2).sum(-1)
    nb = d2 <= eps * eps
    core = nb.sum(1) >= min_samples
    comp = -np.ones(len(x), int)
    for i in np.flatnonzero(core):
        if comp[i] >= 0:
            continue
        stack, comp[i] = [i], i
        while stack:
            j = stack.pop()
            for k in np.flatnonzero(nb[j] & core):
                if comp[k] < 0:
                    comp[k] = i
                    stack.append(k)
    firsts = sorted({comp[i] for i in np.flatnonzero(core)})
    label = {c: n for n, c in enumerate(firsts)}
    out = -np.ones(len(x), int)
    for i in range(len(x)):
        if core[i]:
            out[i] = label[comp[i]]
        else:
            near = [label[comp[j]] for j in np.flatnonzero(nb[i] & core)]
            out[i] = min(near) if near else -1
    return out


@pytest.mark.parametrize("block", [4096, 40, 7])
def test_dbscan_matches_brute_force(spark, blobs, block):
    from starmart.operators.dbscan import dbscan

    df, x, _ = blobs
    rng = np.random.default_rng(11)
    # a chain of sparse points between two blobs, and a few isolated ones
    extra = np.vstack([np.linspace([0, 0, 0], [8, 8, 0], 12) + rng.normal(0, 0.05, (12, 3)),
                       rng.uniform(-20, 20, (6, 3))])
    x2 = np.vstack([x, extra])
    rows = [(i, *map(float, x2[i])) for i in range(len(x2))]
    df2 = spark.createDataFrame(rows, "id long, a double, b double, c double")
    for eps, ms in ((1.2, 5), (0.8, 4)):
        got = dict(dbscan(df2, "id", COLS, eps=eps, min_samples=ms, block=block)
                   .select("id", "cluster").collect())
        exp = _dbscan_reference(x2, eps, ms)
        assert [got[i] for i in range(len(x2))] == list(exp)


def test_all_scores_agree_with_single_measures(blobs):
    df, _, _ = blobs
    r = cluster_eval.all_scores(df, "label", COLS).first()
    assert r.silhouette == pytest.approx(
        cluster_eval.silhouette_squared(df, "label", COLS).first()[0], rel=1e-9)
    assert r.calinski_harabasz == pytest.approx(
        cluster_eval.calinski_harabasz(df, "label", COLS).first()[0], rel=1e-9)
    assert r.davies_bouldin == pytest.approx(
        cluster_eval.davies_bouldin(df, "label", COLS).first()[0], rel=1e-9)


def test_final_segments_are_named_by_rising_sales(spark):
    from starmart.plans.segmentation import FINAL_LABELS, final_segments

    rows = [(1, 1, 900.0), (2, 1, 1100.0), (3, 0, 50.0), (4, 0, 70.0)]
    df = spark.createDataFrame(rows, "customer_id long, cluster int, total_sales double")
    got = {r.customer_id: (r.final_cluster, r.final_cluster_label)
           for r in final_segments(df).collect()}
    assert got[3] == (0, FINAL_LABELS[0]) and got[1] == (1, FINAL_LABELS[1])


def test_dbscan_with_text_ids(spark, blobs):
    from starmart.operators.dbscan import dbscan

    df, x, _ = blobs
    df = df.select("id", *COLS)
    plain = dict(dbscan(df, "id", COLS, eps=1.2, min_samples=5).select("id", "cluster").collect())
    named = df.withColumn("id", F.concat(F.lit("CG-"), F.lpad(F.col("id").cast("string"), 5, "0")))
    got = dict(dbscan(named, "id", COLS, eps=1.2, min_samples=5, block=16).select("id", "cluster").collect())
    assert {int(k[3:]): v for k, v in got.items()} == plain


def test_dbscan_chains_copies_and_odd_rows(spark):
    """A chain over many blocks is one cluster; equal points and clashing
    names are allowed; null and non-finite features are noise; no rows."""
    from starmart.operators.dbscan import dbscan

    rows = [(i, float(i), 0.0, i) for i in range(60)] + [(100 + i, 500.0, 500.0, i) for i in range(30)]
    rows += [(200, None, 0.0, 0), (201, float("nan"), 0.0, 0), (202, float("inf"), 0.0, 0), (203, 300.0, 0.0, 0)]
    df = spark.createDataFrame(rows, "id long, a double, b double, num int")
    for block in (8, 3):
        got = dict(dbscan(df, "id", ["a", "b"], eps=1.0, min_samples=3, block=block).select("id", "cluster").collect())
        assert {got[i] for i in range(60)} == {0} and {got[100 + i] for i in range(30)} == {1}
        assert [got[i] for i in (200, 201, 202, 203)] == [-1] * 4
    assert dbscan(df.limit(0), "id", ["a", "b"]).collect() == []
    few = dbscan(df.where("id < 2 OR id = 203"), "id", ["a", "b"], eps=1.0, min_samples=3)
    assert [r.cluster for r in few.collect()] == [-1] * 3


def test_labelling_scores_equal_single_measures(spark, blobs):
    """Several labellings in one pass, one with noise, one with one cluster."""
    df, x, _ = blobs
    runs = {"blobs": F.col("label"), "thirds": (F.col("id") % 3).cast("int"),
            "alone": F.when(F.col("id") == 5, 9).otherwise(F.col("label")), "one": F.lit(4),
            "noise": F.when(F.col("id") == 7, -1).otherwise(F.col("label"))}
    rows = None
    for name, label in runs.items():
        part = df.select(F.lit(name).alias("run"), label.cast("int").alias("cluster"), F.array(*COLS).alias("x"))
        rows = part if rows is None else rows.unionByName(part)
    withheld = (F.col("run") == "noise") & (F.col("cluster") == -1)
    got = {r.run: r for r in cluster_eval.labelling_scores(rows, ["run"], "cluster", 3, withheld).collect()}
    assert set(got) == set(runs) - {"noise"}
    assert (got["one"].silhouette, got["one"].calinski_harabasz, got["one"].davies_bouldin) == (None, None, None)
    for name in ("blobs", "thirds", "alone"):
        one = df.withColumn("cluster", runs[name].cast("int"))
        for measure, value in (("silhouette", cluster_eval.silhouette_squared), ("davies_bouldin", cluster_eval.davies_bouldin),
                               ("calinski_harabasz", cluster_eval.calinski_harabasz)):
            assert got[name][measure] == pytest.approx(value(one, "cluster", COLS).first()[0], rel=1e-9)


def test_segment_mix_shares_sum_to_one(spark):
    df = spark.createDataFrame([(i, i % 3, ("a", "b")[i % 5 == 0]) for i in range(100)], "id long, cluster int, segment string")
    total = {}
    for r in cluster_eval.segment_mix(df, "cluster").collect():
        total[r.cluster] = total.get(r.cluster, 0) + r.share
    assert total == pytest.approx({0: 1.0, 1: 1.0, 2: 1.0})


def test_dbscan_gathers_the_few_points_of_many_blocks(spark, monkeypatch):
    from starmart.operators import dbscan as db

    rng = np.random.default_rng(5)
    dense = rng.normal(0, 0.1, (300, 2))
    far = np.column_stack([rng.uniform(-50, 50, 24), rng.uniform(-50, 50, 24)])  # a lone point in most blocks
    x = np.concatenate([dense, far])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "customer_id long, a double, b double")
    held, real = [], db._near_pairs_between
    monkeypatch.setattr(db, "_near_pairs_between", lambda left, right, e: held.append((left.count(), right.count())) or real(left, right, e))
    got = {r.customer_id: r.cluster for r in db.dbscan(df, "customer_id", ["a", "b"], eps=1.0, min_samples=5, block=16).collect()}
    near = ((x[:, None] - x[None]) ** 2).sum(-1) <= 1.0
    core = near.sum(1) >= 5
    assert all((got[i] == 0) == bool(core[i] or (near[i] & core).any()) for i in range(len(x)))
    assert held[0][0] <= 4 and held[1][0] <= 4 and held[0][1] > 15  # of some 20 blocks


def test_dbscan_compares_only_points_outside_the_largest_component(spark, monkeypatch):
    from starmart.operators import dbscan as db

    rng = np.random.default_rng(6)
    dense = rng.normal(0, 0.5, (400, 2))
    small = np.concatenate([rng.uniform(-40, 40, 2) + rng.normal(0, 0.1, (6, 2)) for _ in range(6)])  # in blocks of dense points
    x = np.concatenate([dense, small])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "customer_id long, a double, b double")
    held, real = [], db._near_pairs_between
    monkeypatch.setattr(db, "_near_pairs_between", lambda left, right, e: held.append((left.count(), right.count())) or real(left, right, e))
    got = {r.customer_id: r.cluster for r in db.dbscan(df, "customer_id", ["a", "b"], eps=1.0, min_samples=5, block=16).collect()}
    want = _dbscan_reference(x, 1.0, 5)
    assert [got[i] for i in range(len(x))] == [want[i] for i in range(len(x))]
    assert len(held) == 3 and held[1][0] <= 4 and held[1][1] > 20  # the 36 points meet the blocks, no block as a whole

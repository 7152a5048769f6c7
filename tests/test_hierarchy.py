"""Ward's hierarchy against a naive version over all rows."""

import numpy as np
import pytest

from starmart.operators import hierarchy as H

COLS = ["a", "b"]


def naive(x):
    """Heights and the partitions after each merge, every pair tried."""
    groups = [[i] for i in range(len(x))]
    heights, cuts = [], []
    while len(groups) > 1:
        best = None
        for i in range(len(groups)):
            for j in range(i + 1, len(groups)):
                p, q = x[groups[i]], x[groups[j]]
                d = 2 * len(p) * len(q) / (len(p) + len(q)) * ((p.mean(0) - q.mean(0)) ** 2).sum()
                if best is None or d < best[0]:
                    best = d, i, j
        d, i, j = best
        groups[i] = groups[i] + groups.pop(j)
        heights.append(np.sqrt(d))
        cuts.append({frozenset(g) for g in groups})
    return heights, cuts


def points(n=60, seed=1):
    g = np.random.default_rng(seed)
    return g.normal(size=(n, 2)) + g.integers(0, 3, n)[:, None] * 4


def frame(spark, x):
    return spark.createDataFrame([(f"id{i}", *map(float, v)) for i, v in enumerate(x)], "id string, a double, b double").repartition(3)


def partition(rows):
    out = {}
    for r in rows:
        out.setdefault(r.cluster, set()).add(int(r.id[2:]))
    return {frozenset(g) for g in out.values()}


def test_exact_where_every_row_is_its_own_summary(spark):
    x = points()
    df = frame(spark, x)
    tree = H.fit(df, "id", COLS)
    heights, cuts = naive(x)
    assert [m[2] for m in tree.merges] == pytest.approx(heights)
    assert tree.size.tolist() == [1] * 60 and tree.sse == pytest.approx(np.zeros(60), abs=1e-9)
    assert [m[3] for m in tree.merges][-1] == 60
    for k in (1, 2, 3, 7, 60):
        want = cuts[59 - k] if k < 60 else {frozenset([i]) for i in range(60)}
        assert partition(H.assign(df, COLS, tree, k).collect()) == want


def test_copies_make_one_summary(spark):
    """Equal rows weigh in by their number, as linkage over all rows does."""
    x = np.vstack([np.repeat([[0.0, 0.0]], 30, 0), [[1.0, 0.0], [5.0, 5.0], [5.5, 5.0]]])
    tree = H.fit(frame(spark, x), "id", COLS)
    heights = naive(x)[0]
    assert [m[2] for m in tree.merges] == pytest.approx(heights[-3:])


def test_summaries_hold_all_rows(spark):
    x = points(900, 4)
    df = frame(spark, x)
    tree = H.fit(df, "id", COLS, summaries=50)
    assert tree.size.sum() == 900 and len(tree.merges) == len(tree.size) - 1
    inside = tree.sse.sum()
    total = ((x - x.mean(0)) ** 2).sum()
    # merge costs and the spread inside the summaries add up to all the spread
    assert inside + sum(m[2] ** 2 / 2 for m in tree.merges) == pytest.approx(total)
    truth = np.round(x.mean(1) / 4).astype(int)
    got = {int(r.id[2:]): r.cluster for r in H.assign(df, COLS, tree, 3).collect()}
    clusters = [np.bincount(truth[[i for i in got if got[i] == c]].clip(0)) for c in range(3)]
    assert sum(c.max() for c in clusters) > 0.9 * 900


def test_no_rows_and_one_row(spark):
    df = frame(spark, points(1))
    assert H.fit(df, "id", COLS).merges == [] and H.fit(df.limit(0), "id", COLS).merges == []
    assert [r.cluster for r in H.assign(df, COLS, H.fit(df, "id", COLS), 2).collect()] == [0]
    assert H.linkage_table(df, H.fit(df, "id", COLS)).collect() == []


def test_linkage_covers_all_rows(spark):
    """Rounds over chunks give the merges of a linkage over every row, also
    where there are more rows than a summary holds."""
    x = np.vstack([points(560, 7), np.full((20, 2), 2.5)])
    got = sorted(H.linkage(frame(spark, x), "id", COLS, chunk=64, last=400).collect())
    size = np.r_[np.ones(560), 20]  # equal rows are one leaf
    want = H.ward(size, x[:561])
    assert len(got) == 560 and [r.step for r in got] == list(range(1, 561))
    assert [r.height for r in got] == pytest.approx([m[2] for m in want])
    assert sorted(r.rows for r in got) == sorted(m[3] for m in want) and got[-1].rows == 580
    # every cluster is merged once, and holds the rows of its two ends
    ends = [e for r in got for e in (r.left_cluster, r.right_cluster)]
    assert sorted(ends) == list(range(2 * 561 - 2)) and all(r.left_cluster < r.right_cluster < 560 + r.step for r in got)
    rows = {560 + r.step: r.rows for r in got}
    made = [r for r in got if r.left_cluster > 560]
    assert made and all(r.rows == rows[r.left_cluster] + rows[r.right_cluster] for r in made)


def test_linkage_of_a_grid_and_of_few_rows(spark):
    """Ties everywhere: rounds go on, and costs add up to all the spread."""
    x = np.array([[i, j] for i in range(12) for j in range(12)], float)
    got = H.linkage(frame(spark, x), "id", COLS, chunk=32, last=60).collect()
    assert len(got) == 143
    assert sum(r.height ** 2 / 2 for r in got) == pytest.approx(((x - x.mean(0)) ** 2).sum())
    df = frame(spark, points(1))
    assert H.linkage(df, "id", COLS).collect() == [] and H.linkage(df.limit(0), "id", COLS).collect() == []

"""Boosted trees against a plain numpy version, split by split."""

import numpy as np
import pytest

from starmart.operators import boosting as B
from starmart.operators import partials


def data(n=500, seed=3):
    g = np.random.default_rng(seed)
    x = np.column_stack([g.normal(size=n), g.integers(0, 6, n), g.normal(size=n) ** 2, g.integers(0, 2, n)]).astype(float)
    y = (x[:, 0] + 0.7 * x[:, 1] - x[:, 2] + g.normal(size=n) > 1).astype(int)
    return x, y


NAMES = ["a", "b", "c", "d"]


def frame(spark, x, y):
    rows = [(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y int").repartition(3)


def grow(bins, y, margin, use, columns, depth, rate, reg, least):
    """One tree by definition: every row, feature and bin tried one by one."""
    tree = {}

    def node(at, rows, level):
        p = 1 / (1 + np.exp(-margin[rows]))
        g, h = p - y[rows], p * (1 - p)
        tree[at] = [-1, 0, -rate * g.sum() / (h.sum() + reg)]
        best = None
        for f in columns if level < depth else ():
            for b in range(bins[:, f].max() + 1):
                left = bins[rows, f] <= b
                if h[left].sum() < least or h[~left].sum() < least:
                    continue
                gain = (g[left].sum() ** 2 / (h[left].sum() + reg) + g[~left].sum() ** 2 / (h[~left].sum() + reg)
                        - g.sum() ** 2 / (h.sum() + reg)) / 2
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = gain, f, b, left
        if best:
            tree[at][:2] = best[1:3]
            node(2 * at + 1, rows[best[3]], level + 1)
            node(2 * at + 2, rows[~best[3]], level + 1)

    node(0, np.flatnonzero(use), 0)
    return tree


@pytest.mark.parametrize("stride,merges", [(2, 1), (15, 32)])
def test_trees_match_definition(spark, monkeypatch, stride, merges):
    monkeypatch.setattr(B, "STRIDE", stride)
    monkeypatch.setattr(partials, "MERGES", merges)
    x, y = data()
    df = frame(spark, x, y)
    model = B.fit(df, "id", NAMES, "y", rounds=4, depth=3, bins=8)
    keys = {r.id: r.k for r in df.selectExpr("id", "xxhash64(42, id) AS k").collect()}
    keys = np.array([keys[i] for i in range(len(x))])
    bins, margin = model.bins(x).astype(int), np.full(len(x), np.log(y.mean() / (1 - y.mean())))
    assert model.base == pytest.approx(margin[0])
    for number, tree in enumerate(model.trees):
        want = grow(bins, y, margin, B.drawn(keys, number, 42, 0.8), B.columns_of(number, 42, 4, 0.8), 3, 0.1, 1.0, 1.0)
        for at, (f, b, w) in want.items():
            assert tree.feature[at] == f and (f < 0 or tree.bin[at] == b)
            assert tree.weight[at] == pytest.approx(w, abs=1e-9)
        assert set(np.flatnonzero(tree.feature >= 0)) == {a for a, v in want.items() if v[0] >= 0}
        margin = margin + tree.margin(bins)
    got = {r.id: r.score for r in B.predict(df, model, NAMES).collect()}
    assert [got[i] for i in range(len(x))] == pytest.approx(list(1 / (1 + np.exp(-margin))), abs=1e-9)


def test_learns_and_ranks_features(spark):
    x, y = data(900, 5)
    model = B.fit(frame(spark, x[:600], y[:600]), "id", NAMES, "y", rounds=30)
    p = model.probability(x[600:])
    pos, neg = p[y[600:] == 1], p[y[600:] == 0]
    assert np.mean(pos[:, None] > neg[None]) > 0.88
    assert model.importance().sum() == pytest.approx(1) and model.importance()[3] == min(model.importance())


def test_draws():
    keys = np.arange(20000) * 7919
    a, b = B.drawn(keys, 0, 1, 0.8), B.drawn(keys, 1, 1, 0.8)
    assert abs(a.mean() - 0.8) < 0.02 and abs((a & b).mean() - 0.64) < 0.02
    assert len(B.columns_of(3, 1, 10, 0.8)) == 8 and (B.columns_of(3, 1, 10, 0.8) != B.columns_of(4, 1, 10, 0.8)).any()


def test_odd_rows(spark):
    """Nulls and NaN go right; one class, one row and no row give a constant."""
    x, y = data(120, 8)
    x[:30, 0] = np.nan
    df = frame(spark, x, y).selectExpr("id", "a", "CASE WHEN id % 5 = 0 THEN null ELSE b END AS b", "c", "d", "CASE WHEN id = 7 THEN null ELSE y END AS y")
    model = B.fit(df, "id", NAMES, "y", rounds=3)
    assert all(0 < r.score < 1 for r in B.predict(df, model, NAMES).collect())
    for part in (df.where("y = 1"), df.where("id = 3"), df.limit(0)):
        model = B.fit(part, "id", NAMES, "y", rounds=2)
        assert all((t.feature < 0).all() for t in model.trees)
        assert B.predict(part, model, NAMES).count() == part.count()


def test_rows_are_read_packed(spark, monkeypatch):
    """A level's job reads a few packed rows, which hold every row once."""
    kept, real = [], B.write_table
    monkeypatch.setattr(B, "write_table", lambda df, name: kept.append(real(df, name)) or kept[-1])
    monkeypatch.setattr(B, "STRIDE", 2)
    df = spark.range(5000).selectExpr("id", "cast(id % 97 AS double) a", "cast(id % 7 AS double) b", "cast(id % 97 > 40 AS int) y")
    model = B.fit(df.repartition(3), "id", ["a", "b"], "y", rounds=5, depth=2)
    assert len(model.trees) == 5 and len(kept) == 3  # margins are renewed after two and four trees
    for table in kept:
        rows = table.collect()
        assert len(rows) == 3 and sum(r.rows for r in rows) == 5000
        assert all(len(r.margin) == 8 * r.rows and len(r.cut) == 4 * r.rows for r in rows)


def test_nodes_follow_the_splits_row_by_row():
    g = np.random.default_rng(3)
    tree = B.Tree.empty(3)
    for i, (f, b) in {0: (1, 4), 1: (0, 2), 2: (2, 7), 4: (1, 1), 5: (0, 5)}.items():
        tree.feature[i], tree.bin[i] = f, b
    bins = g.integers(0, 9, (500, 3)).astype(np.int16)
    for row, node in zip(bins, tree.nodes(np.asfortranarray(bins)).tolist()):
        at = 0
        while at < 7 and tree.feature[at] >= 0:
            at = 2 * at + 1 + int(row[tree.feature[at]] > tree.bin[at])
        assert node == at

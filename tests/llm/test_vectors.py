"""Vector search and near-dedup against brute force."""

import numpy as np
import pytest

from starmart.llm import near_vectors as V
from starmart.llm.vp_search import Tree, nearest, search

SCHEMA = "vec_id long, embedding array<float>, label int"


def fixture(n=400, d=12, seed=0):
    g = np.random.default_rng(seed)
    x = g.normal(size=(n, d)) * g.uniform(0.5, 3, (n, 1))
    x[50:90] = x[3] + g.normal(size=(40, d)) * 0.05  # a group of near copies
    x[90:95] = x[4]  # equal vectors
    x[95] = x[5] * 7  # equal direction
    return x.astype(np.float32)


def rows_of(x):
    odd = [(1000, None, 0), (1001, [0.0] * x.shape[1], 0), (1002, [float("nan")] + [1.0] * (x.shape[1] - 1), 0),
           (1003, [None] + [1.0] * (x.shape[1] - 1), 0), (1004, [float("inf")] * x.shape[1], 0), (1005, [1.0], 0),
           (1006, [], 0)]
    return [(i, v.tolist(), 1) for i, v in enumerate(x)] + odd


def brute_nearest(x, queries, k):
    out = {}
    y = x.astype(float)
    for q in queries:
        s = np.array([sum(a * b for a, b in zip(y[q], y[j])) for j in range(len(y))])
        order = [j for j in sorted(range(len(y)), key=lambda j: (-s[j], j)) if j != q][:k]
        out[q] = [(j, s[j]) for j in order]
    return out


@pytest.mark.parametrize("shard_rows,query_rows", [(16384, 512), (150, 7)])
def test_exact_search(spark, shard_rows, query_rows):
    x = fixture()
    table = spark.createDataFrame(rows_of(x), SCHEMA).repartition(3)
    got = {}
    for r in nearest(table, 20, "vec_id % 20 = 0", shard_rows=shard_rows, query_rows=query_rows).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute_nearest(x, range(0, 400, 20), 20)
    assert set(got) == set(want)
    for q, found in got.items():
        assert [(v, s) for _, v, s in sorted(found)] == want[q]
        assert [r for r, _, _ in sorted(found)] == list(range(1, 21))


def test_fewer_candidates_than_k_and_empty(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0], 0), (1, [2.0, 1.0], 0), (20, [0.5, 0.5], 0)], SCHEMA)
    got = [tuple(r) for r in nearest(table, 20, "vec_id % 20 = 0").orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 4.0), (0, 2, 20, 1.5), (20, 1, 0, 1.5), (20, 2, 1, 1.5)]
    assert nearest(table.limit(0), 20, "vec_id % 20 = 0").count() == 0


def test_smaller_factors_prune_more():
    g = np.random.default_rng(4)
    centre = g.normal(size=(40, 8)) * 4
    x = (centre[g.integers(0, 40, 4000)] + g.normal(size=(4000, 8)) * 0.3)
    norm = (x ** 2).sum(1)
    order, tree = Tree.build(np.c_[x, np.sqrt(np.maximum(norm.max() - norm, 0))])
    z, ids = x[order], np.arange(4000)[order]
    q, own = x[:100], np.arange(100)
    truth = [set(np.argsort(-np.where(np.arange(4000) == i, -np.inf, x @ x[i]), kind="stable")[:10].tolist()) for i in range(100)]
    work, recall = [], []
    for factor in (1.0, 0.8, 0.5):
        rows, found, _, n = search(z, ids, tree, q, own, 10, factor)
        work.append(n)
        recall.append(np.mean([len(truth[i] & set(found[rows == i].tolist())) / 10 for i in range(100)]))
    assert recall[0] == 1.0 and work[0] < 0.9 * 100 * 4000
    assert work[0] >= work[1] >= work[2] and recall[0] >= recall[1] >= recall[2]


def brute_links(x, least):
    y = x.astype(float)
    y /= np.linalg.norm(y, axis=1)[:, None]
    near = y @ y.T >= least
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    for _ in range(len(x)):
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(x))])
        if (new == label).all():
            break
        label = new
    return near.sum(1), label


@pytest.mark.parametrize("block,bucket_rows", [(1024, 2048), (16, 8)])
def test_near_dedup(spark, block, bucket_rows):
    x = fixture()
    table = spark.createDataFrame(rows_of(x), SCHEMA).repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in
           V.near_dedup(table, block=block, bucket_rows=bucket_rows).collect()}
    degree, label = brute_links(x, 0.95)
    assert len(got) == len(x) + 7
    assert [got[i] for i in range(len(x))] == [(int(d), int(c), i == c) for i, (d, c) in enumerate(zip(degree, label))]
    assert all(got[i] == (0, i, True) for i in range(1000, 1007))
    assert degree.max() > 30


def test_near_dedup_empty_and_null_ids(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert V.near_dedup(empty).count() == 0
    table = spark.createDataFrame([(None, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [1.0, 0.0], 0)], SCHEMA)
    got = sorted((tuple(r) for r in V.near_dedup(table).collect()), key=repr)
    assert got == sorted([(None, 0, None, None), (2, 1, 2, True), (3, 1, 2, False)], key=repr)


def test_recall_at_the_threshold():
    """Pairs at a cosine of exactly 0.95 in 64 dimensions share a bucket."""
    g = np.random.default_rng(0)
    a = g.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    z = g.normal(size=a.shape)
    z -= (z * a).sum(1)[:, None] * a
    z /= np.linalg.norm(z, axis=1)[:, None]
    b = 0.95 * a + np.sqrt(1 - 0.95 ** 2) * z
    signs = np.random.default_rng(3).choice([-1.0, 1.0], size=(V.TABLES, 2, 3, 64))
    for parts in (1, 128):  # from the coarsest to the finest buckets
        p, q = V.buckets(a, signs, parts, V.PROBES), V.buckets(b, signs, parts, V.PROBES)
        hit = [len(set(x[x >= 0]) & set(y[y >= 0])) > 0 for x, y in zip(p, q)]
        assert np.mean(hit) > 0.995


def test_two_lengths_are_searched_and_linked_each(spark):
    """55 % of the vectors have 12 components and 45 % have 6; both sides
    give what the SQL's condition len(a.e) = len(b.e) does."""
    x, y = fixture(110), fixture(96, 6, 1)[:90]
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)]
                                  + [(1000 + i, v.tolist(), 1) for i, v in enumerate(y)], SCHEMA).repartition(3)
    got = {}
    for r in nearest(table, 5, "vec_id % 20 = 0", shard_rows=40, query_rows=3).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    links = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in V.near_dedup(table, block=16, bucket_rows=8).collect()}
    for z, base in ((x, 0), (y, 1000)):
        for q, want in brute_nearest(z, range(0, len(z), 20), 5).items():
            assert [(v - base, s) for _, v, s in sorted(got[base + q])] == want
        degree, label = brute_links(z, 0.95)
        assert degree.max() > 30
        assert [links[base + i] for i in range(len(z))] == [
            (int(n), base + int(c), i == c) for i, (n, c) in enumerate(zip(degree, label))]
    assert len(got) == 6 + 5


def test_hadamard_is_orthogonal():
    h = V.hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16))

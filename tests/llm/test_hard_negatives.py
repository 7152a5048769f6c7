"""Hard negatives against brute force over every row."""

import math

import numpy as np
import pytest

from starmart.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n=300, d=8, seed=0, spread=0.6):
    """Clustered vectors with several labels, equal rows and zero rows."""
    g = np.random.default_rng(seed)
    x = g.normal(size=(6, d))[g.integers(0, 6, n)] + g.normal(size=(n, d)) * spread
    x[40:60] = x[0]
    x[60:63] = 0
    return [(i, v.astype(np.float32).tolist(), int(i % 5)) for i, v in enumerate(x)]


def brute(rows, is_anchor, positives, negatives, low, high):
    use = []
    for i, v, label in rows:
        if None in (i, v, label) or any(c is None or not math.isfinite(c) for c in v):
            continue
        use.append((i, [math.floor(256 * float(np.float32(c))) for c in v], label))
    out = []
    for i, a, label in use:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v)), j, other) for j, v, other in use if j != i and len(v) == len(a))
        for p, j, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [(-n, k) for n, k, other in scored if other != label and low * -p <= 100 * -n <= high * -p]
            out += [(i, j, r + 1, k, -p, n) for r, (n, k) in enumerate(fit[:negatives])]
    return sorted(out)


def run(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = H.mine(table, "vec_id % 10 = 0", 5, 3, 50, 95, **options)
    return sorted(tuple(r) for r in found.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("cell_values,block_rows", [(1 << 20, 256), (400, 4)])
def test_matches_brute_force(spark, cell_values, block_rows):
    rows = vectors()
    want = brute(rows, lambda i: i % 10 == 0, 5, 3, 50, 95)
    assert len(want) > 200
    assert run(spark, rows, cell_values=cell_values, block_rows=block_rows) == want


def test_odd_rows(spark):
    """Nulls, non-finite components, other lengths, empty vectors, huge
    components, negative and zero scores."""
    rows = vectors(120, 4, 1, 2.0)
    rows += [(1000, None, 1), (1001, [1.0, None, 1.0, 1.0], 1), (1002, [float("nan")] * 4, 1), (1003, [float("inf")] * 4, 1),
             (1004, [1.0] * 4, None), (None, [1.0] * 4, 1), (1010, [], 1), (1011, [], 1), (1012, [], 2),
             (1020, [1.0, 2.0], 0), (1021, [1.0, 2.5], 0), (1022, [0.7, 1.9], 3), (1030, [5.0], 0)]
    want = brute(rows, lambda i: i % 10 == 0, 5, 3, 50, 95)
    rows.append((1040, [1e30] * 4, 1))  # its scores do not fit a long: takes no part
    assert run(spark, rows) == want
    assert (1010, 1011, 1, 1012, 0, 0) in want and any(r[0] == 1020 for r in want)


def test_hot_label_and_copies(spark):
    """A third of the rows alike, one label on nearly all."""
    rows = [(i, v, 0 if i % 7 else 1) for i, v, _ in vectors(240, 6, 3)]
    rows = [(i, rows[5][1] if i % 3 == 0 else v, label) for i, v, label in rows]
    assert run(spark, rows, cell_values=300, block_rows=5) == brute(rows, lambda i: i % 10 == 0, 5, 3, 50, 95)


def test_repeated_rows(spark):
    """Rows repeated are candidates each; rows with the anchor's id are not."""
    rows = vectors(60, 5, 4)
    doubled = rows + [r for r in rows if r[0] % 10]  # every row but the anchors, twice
    assert run(spark, doubled) == brute(doubled, lambda i: i % 10 == 0, 5, 3, 50, 95)


def test_empty_and_without_anchors(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 0), (2, [2.0], 1)]) == []


def test_walk_ends_early_and_is_certified():
    """In clustered data the list is left long before its end."""
    g = np.random.default_rng(2)
    centres = g.normal(size=(20, 16)) * 8
    x = np.floor(256 * (centres[np.repeat(np.arange(20), 1000)] + g.normal(size=(20000, 16)) * 0.3))
    members = x[:40]
    order, bound = H.shared_list(members, H.directions(members)[1].mean(0), x)
    assert (np.diff(bound) <= 0).all()
    scores = members @ x[order].T
    length = np.sqrt((members ** 2).sum(1))
    assert (scores <= length[:, None] * bound[None] + 0.5).all()  # the bound holds everywhere
    places = []
    products = H.products

    def counted(a, b):
        places.append(len(b))
        return products(a, b)

    H.products = counted
    try:
        ids, zeros = np.arange(20000), np.zeros(20000, np.int64)
        centroid = H.directions(H.directions(members)[1].sum(0)[None])[1][0]
        best = H.walk_positives(members, ids[:40], zeros[:40], centroid, x, ids, zeros, 5)
    finally:
        H.products = products
    assert sum(places) < 8000
    want = members @ x.T
    want[np.arange(40), np.arange(40)] = -np.inf
    top = -np.sort(-want, 1)[:, :5]
    for m in range(40):
        assert best.score[best.who == m].tolist() == top[m].astype(int).tolist()


def test_products_are_exact():
    a = np.array([[2.0 ** 30 + 1, 3.0, -(2.0 ** 29)]])
    x = np.array([[2.0 ** 30 - 1, 5.0, 7.0], [1.0, 1.0, 1.0]])
    assert H.products(a, x).tolist() == [[(2 ** 30 + 1) * (2 ** 30 - 1) + 15 - 7 * 2 ** 29, 2 ** 30 + 4 - 2 ** 29]]

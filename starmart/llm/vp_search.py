"""Nearest neighbours by inner product with a vantage-point tree per shard.

A shard turns largest inner product into smallest Euclidean distance: every
vector x gets the component sqrt(M^2 - |x|^2), M the shard's longest norm,
and a query gets 0.  Its tree splits the vectors at the median distance to a
vantage point and keeps the range of distances on either side.

Queries come in blocks.  A block's distances to all vantage points of a shard
bound, by the triangle inequality, every leaf from below.  Queries open their
most promising leaves first and then every leaf whose bound is at most
``factor`` times the distance of the k-th best so far: 1 is exact, smaller
factors prune more.  Each (shard, block) pair is one task's work; the index is
written once; the k best of all shards are the result.

Nulls and ties: see ``vectors.usable`` for what takes part.  Ties go to the
smaller id.  Shards and blocks hold vectors of one length, and meet only
those of the same length.  Repeated rows are candidates each; a query's own id is not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import write_table
from starmart.llm.vectors import matrix, usable

SHARD_ROWS = 16_384
QUERY_ROWS = 512
LEAF_ROWS = 128
FIRST_LEAVES = 2  # opened before any pruning
_INDEX = "shard long, n long, dim long, ids binary, vectors binary, tree binary"
_FOUND = "query_id long, vec_id long, score double"


class Tree:
    """``start``/``end`` of each node's rows, children (0: none), vantage
    rows, and the distance range of each child's rows to its vantage point."""

    FIELDS = ("start", "end", "left", "right", "vantage", "low_l", "high_l", "low_r", "high_r")

    def __init__(self, nodes: np.ndarray):
        self.nodes = nodes  # one row per node, one column per field
        for i, f in enumerate(self.FIELDS):
            col = nodes[:, i]
            setattr(self, f, col if i > 4 else col.astype(np.int64))

    @staticmethod
    def build(x: np.ndarray, leaf_rows: int = LEAF_ROWS) -> tuple[np.ndarray, Tree]:
        """The rows' new order, and the tree over rows in that order."""
        order = np.arange(len(x))
        nodes, todo = [], [(0, len(x), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            me = len(nodes)
            nodes.append([a, b, 0, 0, 0, 0, 0, 0, 0])
            if parent >= 0:
                nodes[parent][2 + side] = me
            if b - a <= leaf_rows:
                continue
            own = order[a:b].copy()
            far = ((x[own] - x[own[0]]) ** 2).sum(1)
            v = int(np.argmax(far))  # far from an arbitrary row: splits well
            d = np.sqrt(((x[own] - x[own[v]]) ** 2).sum(1))
            by = np.argsort(d, kind="stable")
            order[a:b], d = own[by], d[by]
            half = (b - a) // 2
            nodes[me][4] = int(own[v])
            nodes[me][5:] = [d[0], d[half - 1], d[half], d[-1]]
            todo += [(a + half, b, me, 1), (a, a + half, me, 0)]
        place = np.empty(len(x), np.int64)
        place[order] = np.arange(len(x))
        table = np.array(nodes, np.float64)
        inner = table[:, 2] > 0
        table[inner, 4] = place[table[inner, 4].astype(np.int64)]
        return order, Tree(table)

    def bounds(self, to_vantage: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaves, and for every query a lower bound of its distance to each
        (``to_vantage``: distances to the vantage points of ``inner`` nodes)."""
        low = np.zeros((len(to_vantage), len(self.start)))
        for k, i in enumerate(inner):
            d = to_vantage[:, k]
            for child, lo, hi in ((self.left[i], self.low_l[i], self.high_l[i]), (self.right[i], self.low_r[i], self.high_r[i])):
                low[:, child] = np.maximum(low[:, i], np.maximum(lo - d, d - hi))
        leaves = np.flatnonzero(self.left == 0)
        return leaves, low[:, leaves]


def search(x: np.ndarray, ids: np.ndarray, tree: Tree, q: np.ndarray, own: np.ndarray, k: int,
           factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query row, id, score) of the k best per query, and the number of
    distances that were computed.  ``x`` is in the tree's order."""
    norm = (x ** 2).sum(1)
    top = norm.max()
    x2, q2 = np.sqrt(np.maximum(top - norm, 0)), (q ** 2).sum(1)
    inner = np.flatnonzero(tree.left > 0)
    v = tree.vantage[inner]
    # |q - v|^2 with the query's extra component 0
    to_v = np.sqrt(np.maximum(q2[:, None] + (norm[v] + x2[v] ** 2)[None] - 2 * q @ x[v].T, 0))
    leaves, low = tree.bounds(to_v, inner)
    slack = 1e-7 * np.sqrt(top + q2)  # rounding of the bounds
    best = np.full((len(q), k), -np.inf)
    visited = np.zeros(low.shape, bool)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    work = 0

    def open_leaf(j: int, rows: np.ndarray) -> None:
        nonlocal work
        a, b = tree.start[leaves[j]], tree.end[leaves[j]]
        s = q[rows] @ x[a:b].T
        s[own[rows][:, None] == ids[a:b][None]] = -np.inf
        work += s.size
        r, c = np.nonzero((s >= best[rows, -1:] - 1e-9 * np.abs(best[rows, -1:]).clip(1e-300, 1e300) - 1e-300) & (s > -np.inf))
        found.append((rows[r], a + c, s[r, c]))
        both = np.concatenate([best[rows], s], 1)
        best[rows] = -np.sort(-np.partition(both, both.shape[1] - k, 1)[:, -k:], 1)
        visited[rows, j] = True

    order = np.argsort(low, 1, kind="stable")
    for r in range(min(FIRST_LEAVES, len(leaves))):
        for j in np.unique(order[:, r]):
            open_leaf(int(j), np.flatnonzero(order[:, r] == j))
    for j in np.argsort(low.mean(0), kind="stable"):
        kth = best[:, -1]
        tau = np.sqrt(np.maximum(q2 + top - 2 * np.where(np.isinf(kth), 0, kth), 0))
        reach = np.isinf(kth) | (low[:, j] <= factor * tau + slack)
        rows = np.flatnonzero(reach & ~visited[:, j])
        if len(rows):
            open_leaf(int(j), rows)
    rows, at, s = (np.concatenate(c) for c in zip(*found))
    keep = s >= best[rows, -1] - 1e-9 * np.abs(best[rows, -1]).clip(1e-300, 1e300) - 1e-300
    rows, at = rows[keep], at[keep]
    exact = np.empty(len(rows))
    for i in range(0, len(rows), 8192):  # sums in the order of the components
        r, c = rows[i:i + 8192], at[i:i + 8192]
        exact[i:i + 8192] = np.cumsum(q[r] * x[c], axis=1)[:, -1]
    by = np.lexsort((ids[at], -exact, rows))
    rows, at, exact = rows[by], at[by], exact[by]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
    use = rank < k
    return rows[use], ids[at[use]], exact[use], work


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Written index of ``vectors.usable`` rows, one row per shard and length."""
    shards = max(1, -(-vectors.count() // shard_rows))

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids = table["vec_id"].to_numpy()
        by = np.argsort(ids, kind="stable")
        x, ids = matrix(table["vec"].combine_chunks())[by], ids[by]
        norm = (x ** 2).sum(1)
        order, tree = Tree.build(np.c_[x, np.sqrt(np.maximum(norm.max() - norm, 0))])
        return pa.table({"shard": [key[0].as_py()], "n": [len(x)], "dim": [x.shape[1]],
                         "ids": pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
                         "vectors": pa.array([x[order].astype("<f8").tobytes()], pa.binary()),
                         "tree": pa.array([tree.nodes.astype("<f8").tobytes()], pa.binary())})

    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard")
    return write_table(vectors.select(shard, F.size("vec").alias("dim"), "vec_id", "vec").groupBy("shard", "dim").applyInArrow(run, _INDEX), "vp_index")


def nearest(table: DataFrame, k: int, queries: str, id_col: str = "vec_id", vector_col: str = "embedding",
            factor: float = 1.0, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that the SQL condition
    ``queries`` (over vec_id) takes, its k nearest rows found."""
    vectors = usable(table, id_col, vector_col)
    index = build_index(vectors, shard_rows)
    asked = vectors.filter(queries)
    blocks = max(1, -(-asked.count() // query_rows))

    def block(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        x = matrix(part["vec"].combine_chunks())
        return pa.table({"dim": pa.array([x.shape[1]], pa.int64()), "query_ids": pa.array([part["vec_id"].to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "queries": pa.array([x.astype("<f8").tobytes()], pa.binary())})

    by = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(blocks)).alias("block")
    packed = write_table(asked.select(by, F.size("vec").alias("dim"), "vec_id", "vec").groupBy("block", "dim").applyInArrow(
        block, "dim long, query_ids binary, queries binary"), "queries")
    count = index.agg(F.max("shard")).first()[0]
    if count is None:
        return index.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                x = np.frombuffer(r["vectors"]).reshape(r["n"], r["dim"])
                q, own = np.frombuffer(r["queries"]).reshape(-1, r["dim"]), np.frombuffer(r["query_ids"], "<i8")
                tree = Tree(np.frombuffer(r["tree"]).reshape(-1, len(Tree.FIELDS)))
                rows, ids, score, _ = search(x, np.frombuffer(r["ids"], "<i8"), tree, q, own, k, factor)
                yield pa.RecordBatch.from_arrays([pa.array(own[rows]), pa.array(ids), pa.array(score)],
                                                 ["query_id", "vec_id", "score"])

    cells = packed.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count))))
    found = cells.join(index, ["shard", "dim"]).drop("shard").repartition(
        F.xxhash64("query_ids"), F.xxhash64("ids")).mapInArrow(run, _FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

"""K-Medoids (ML-10) over all rows, without a sample.

Start: greedily, the row that lowers the summed distance of all rows most,
among ``pool`` rows drawn by hash (a few far outliers cannot hold a start, as
they can with k-means).

A round is one job.  Its kernel (numpy over Arrow batches) assigns a task's
rows to their nearest medoid and keeps, per cluster,

* the summed distance to each of the cluster's candidates,
* the moments of a Weiszfeld step, which moves the cluster's centre to its
  geometric median,
* and the ``shortlist`` distinct points nearest to that centre.

Tasks' results are merged on Spark in ``MERGES`` groups per cluster, whose
rows alone reach the driver: their number does not grow with the data.  The
cheapest candidate is the next medoid, the shortlist the next candidates.
Rounds end when neither medoids nor candidates change.  Every sum covers all
rows.  The result is a local optimum, as with PAM's alternate method; tests
hold its cost against exhaustive search.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Point = tuple[float, ...]

#: Groups per cluster in which tasks' results are merged before the driver.
MERGES = 32
_PARTIAL = "cluster int, part int, sums array<double>, near array<double>"


def _distance(cols: Sequence[str], point: Sequence[float]) -> Column:
    # as one SQL text: each call to the JVM counts
    parts = [f"(`{c}` - ({float(v)!r}D)) * (`{c}` - ({float(v)!r}D))" for c, v in zip(cols, point)]
    return F.expr(f"sqrt({' + '.join(parts)})")


def _distances(x: np.ndarray, points: Sequence[Point]) -> np.ndarray:
    """(rows, points) Euclidean distances from plain differences."""
    out = np.empty((len(x), len(points)))
    for j, p in enumerate(points):
        d = x - np.asarray(p)
        out[:, j] = np.sqrt(np.einsum("ij,ij->i", d, d))
    return out


def _nearest(near: np.ndarray, n: int) -> np.ndarray:
    """The first n distinct rows (distance, *point) by distance, then point."""
    near = np.unique(near, axis=0)  # sorted by column, the distance first
    return near[:n]


def _reduced(df: DataFrame, cols: Sequence[str], clusters: int, sums: int, shortlist: int, kernel) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per cluster, the sums and the nearest points over all rows.
    ``kernel(x)`` yields (cluster, sums, (distance, *point) rows) of a batch."""
    width = len(cols) + 1

    def merged(into: dict, cluster: int, total: np.ndarray, near: np.ndarray) -> None:
        if cluster in into:
            total = into[cluster][0] + total
            near = np.concatenate([into[cluster][1], near])
        into[cluster] = total, _nearest(near, shortlist)

    def rows(found: dict, part: int) -> dict:
        kept = sorted(found)
        return {"cluster": pa.array(kept, pa.int32()), "part": pa.array([part] * len(kept), pa.int32()),
                "sums": pa.array([found[c][0].tolist() for c in kept], pa.list_(pa.float64())),
                "near": pa.array([found[c][1].ravel().tolist() for c in kept], pa.list_(pa.float64()))}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns])
            for cluster, total, near in kernel(x):
                merged(found, cluster, total, near)
        yield pa.RecordBatch.from_pydict(rows(found, TaskContext.get().partitionId() % MERGES))

    def merge(table: pa.Table) -> pa.Table:
        found: dict = {}
        for r in table.to_pylist():
            merged(found, r["cluster"], np.array(r["sums"]), np.array(r["near"]).reshape(-1, width))
        return pa.table(rows(found, 0))

    total = {}
    parts = df.mapInArrow(scan, _PARTIAL).groupBy("cluster", "part").applyInArrow(merge, _PARTIAL)
    for r in sorted(parts.collect()):
        merged(total, r.cluster, np.array(r.sums), np.array(r.near).reshape(-1, width))
    return [total.get(c, (np.zeros(sums), np.zeros((0, width)))) for c in range(clusters)]


def _start(df: DataFrame, id_col: str, cols: Sequence[str], k: int, seed: int, pool: int) -> list[Point]:
    """PAM's greedy build over a bounded pool; every cost is over all rows."""
    drawn = df.orderBy(F.xxhash64(F.lit(seed), F.col(id_col)), id_col).limit(pool).select(*cols).collect()
    points = list(dict.fromkeys(tuple(float(v) for v in r) for r in drawn))
    features = df.select(*cols)
    chosen: list[Point] = []
    for _ in range(min(k, len(points))):
        def kernel(x: np.ndarray, chosen=tuple(chosen)):
            d = _distances(x, points)
            if chosen:
                d = np.minimum(d, _distances(x, chosen).min(1)[:, None])
            yield 0, d.sum(0), np.zeros((0, x.shape[1] + 1))

        costs, _ = _reduced(features, cols, 1, len(points), 0, kernel)[0]
        chosen.append(points[int(np.argmin(costs))])
    return chosen


def fit_medoids(df: DataFrame, id_col: str, cols: Sequence[str], k: int, seed: int = 42,
                shortlist: int = 16, pool: int = 64, max_iter: int = 30) -> list[list[float]]:
    """k rows (feature vectors) that are a local optimum of the summed
    distance of all rows to their nearest one."""
    cols = list(cols)
    df = df.select(id_col, *[F.col(c).cast("double").alias(c) for c in cols])
    medoids = _start(df, id_col, cols, k, seed, pool)
    if not medoids:
        return []
    features, dims = df.select(*cols), len(cols)
    centres, options = [np.array(m) for m in medoids], [[m] for m in medoids]
    most = shortlist + 1  # a cluster's candidates: its medoid and the shortlist
    for _ in range(max_iter):
        def kernel(x: np.ndarray, medoids=tuple(medoids), centres=tuple(centres), options=tuple(options)):
            label = np.argmin(_distances(x, medoids), 1)
            for c in np.unique(label).tolist():
                own = x[label == c]
                cost = np.zeros(most)
                cost[:len(options[c])] = _distances(own, options[c]).sum(0)
                d = _distances(own, [centres[c]])[:, 0]
                w = 1 / np.maximum(d, 1e-9)
                yield c, np.r_[cost, w.sum(), w @ own], np.column_stack([d, own])

        found = _reduced(features, cols, len(medoids), most + 1 + dims, shortlist, kernel)
        before = medoids, options
        medoids, options = [], []
        for c, (sums, near) in enumerate(found):
            costs, held = sums[:most], before[1][c]
            # the first of a cluster's candidates is its medoid: others must be cheaper
            best = int(np.argmin([v * (1 if j == 0 else 1 + 1e-12) for j, v in enumerate(costs[:len(held)])]))
            medoids.append(held[best])
            if sums[most] > 0:
                centres[c] = sums[most + 1:] / sums[most]
            others = [tuple(p[1:]) for p in near.tolist()]
            options.append([held[best], *[p for p in others if p != held[best]]])
        if (medoids, [set(o) for o in options]) == (before[0], [set(o) for o in before[1]]):
            break
    return [list(m) for m in medoids]


def total_cost(df: DataFrame, cols: Sequence[str], medoids: Sequence[Sequence[float]]) -> float:
    """Summed distance of all rows to their nearest medoid."""
    d = [_distance(cols, m) for m in medoids]
    return df.agg(F.sum(F.least(*d) if len(d) > 1 else d[0])).first()[0]


def assign(df: DataFrame, cols: Sequence[str], medoids: Sequence[Sequence[float]],
           out: str = "cluster") -> DataFrame:
    """Label each row with the index of its nearest medoid (first on ties)."""
    dists = [_distance(cols, m) for m in medoids]
    best = F.least(*dists) if len(dists) > 1 else dists[0]
    label = F.lit(None).cast("int")
    for i in reversed(range(len(dists))):
        label = F.when(dists[i] == best, F.lit(i)).otherwise(label)
    return df.withColumn(out, label)


def kmedoids(df: DataFrame, id_col: str, cols: Sequence[str], k: int, seed: int = 42,
             out: str = "cluster") -> DataFrame:
    return assign(df, cols, fit_medoids(df, id_col, cols, k, seed), out)

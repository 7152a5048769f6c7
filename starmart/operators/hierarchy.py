"""Ward's hierarchy with merge heights (ML-8) over clustering features.

:func:`linkage` gives the merges of all rows, exact at every size.

For the labels of a cut (:func:`fit`, :func:`assign`) rows are summarised by the nearest of at most ``summaries`` rows drawn by
hash: one job adds up the rows, sums and squares of each.  Ward's linkage
runs over these bounded summaries, each weighted by its rows, by chains of
nearest neighbours.  With no more distinct rows than summaries every one is
its own summary and the hierarchy is exact; beyond that it is exact above the
summaries, whose own spread (``sse``) tells what they hide.

Heights are those of the usual linkage tables: sqrt(2 a b / (a + b)) times
the distance of the centroids of clusters of a and b rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.ordered import with_row_number
from starmart.operators.partials import added
from starmart.session import write_table

SUMMARIES = 512
#: Of the whole linkage: most clusters of a chunk, those that the driver merges at last, most visitors of a task.
CHUNK = 1 << 16
LAST = 8192
VISITORS = 1 << 17
#: Clusters of a tile, and rows of which the cuts between chunks are read.
TILE = 128
SAMPLE = 1 << 15
_BASE = (1 << 40) - 1


@dataclass
class Hierarchy:
    seeds: np.ndarray  # (summary, feature): the rows that draw the summaries
    size: np.ndarray  # rows of each summary
    centre: np.ndarray
    sse: np.ndarray  # spread inside each summary
    merges: list[tuple[int, int, float, int]]  # left, right, height, rows: as linkage tables number them

    def labels(self, k: int) -> np.ndarray:
        """Cluster of each summary in the cut into k clusters, numbered by
        their first summary."""
        n = len(self.size)
        up = list(range(n + len(self.merges)))
        for i, (a, b, _, _) in enumerate(self.merges[:max(0, n - k)]):
            up[a] = up[b] = n + i
        root = []
        for i in range(n):
            while up[i] != i:
                i = up[i]
            root.append(i)
        number = {r: j for j, r in enumerate(dict.fromkeys(root))}
        return np.array([number[r] for r in root])


def _nearest(x: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    for i in range(0, len(x), 1024):  # bounds the temporaries
        d = np.zeros((len(x[i:i + 1024]), len(seeds)))
        for k in range(x.shape[1]):
            diff = x[i:i + 1024, k, None] - seeds[None, :, k]
            d += diff * diff
        out[i:i + 1024] = d.argmin(1)
    return out


def _matrix(b: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns])


def _chain(size: np.ndarray, centre: np.ndarray) -> list[tuple[int, int, float]]:
    """Merges (left, right, height) of weighted points by chains of nearest
    neighbours, in the order found.  A cluster has the number of its first point."""
    n, c = size.astype(float).copy(), centre.astype(float).copy()
    alive, left, start, chain = np.ones(len(n), bool), len(n), 0, []
    # the clusters that are searched, by feature; those that are gone lie at infinity and are dropped now and then
    at = place = np.arange(len(n))
    own_n, own_c = n.copy(), np.ascontiguousarray(c.T)
    found: list[tuple[int, int, float]] = []
    while left > 1:
        if not chain:
            while not alive[start]:
                start += 1
            chain.append(start)
        x = chain[-1]
        cost = _costs(n[x], c[x], own_n, own_c)
        cost[place[x]] = np.inf
        i = int(np.argmin(cost))
        y = int(at[i])
        if len(chain) > 1 and cost[place[chain[-2]]] <= cost[i]:
            y = chain[-2]
        if len(chain) < 2 or y != chain[-2]:
            chain.append(y)
            continue
        chain = chain[:-2]
        found.append((x, y, float(np.sqrt(2 * cost[place[y]]))))
        keep, gone = min(x, y), max(x, y)
        c[keep] = (n[x] * c[x] + n[y] * c[y]) / (n[x] + n[y])
        n[keep] = n[x] + n[y]
        own_c[:, place[keep]], own_n[place[keep]] = c[keep], n[keep]
        own_c[:, place[gone]], alive[gone] = np.inf, False
        left -= 1
        if left < len(at) * 3 // 4:
            at = np.flatnonzero(alive)
            own_n, own_c = n[at], np.ascontiguousarray(c[at].T)
            place = np.full(len(n), -1)
            place[at] = np.arange(len(at))
    return found


def _costs(n, c, others_n: np.ndarray, others_c: np.ndarray) -> np.ndarray:
    """What merges of clusters (``n`` rows, centre ``c``, or columns of them)
    with others cost; ``others_c`` is by feature.  From plain differences and
    the same to the last bit whichever side asks."""
    out = np.zeros(np.broadcast_shapes(np.shape(n), others_n.shape))
    for k, v in enumerate(c):
        diff = others_c[k] - v
        diff *= diff
        out += diff
    out *= n * others_n / (n + others_n)
    return out


def ward(size: np.ndarray, centre: np.ndarray) -> list[tuple[int, int, float, int]]:
    """Merges of weighted points in the order of their heights."""
    found = _chain(size, centre)
    found.sort(key=lambda m: m[2])
    # number the clusters in the order of their heights
    up: dict[int, int] = {}

    def top(a: int) -> int:
        while a in up:
            a = up[a]
        return a

    merges, rows = [], {i: int(s) for i, s in enumerate(size)}
    for i, (x, y, height) in enumerate(found):
        a, b = sorted((top(x), top(y)))
        new = len(size) + i
        up[a] = up[b] = new
        rows[new] = rows[a] + rows[b]
        merges.append((a, b, height, rows[new]))
    return merges


def fit(df: DataFrame, id_col: str, cols: Sequence[str], summaries: int = SUMMARIES, seed: int = 42) -> Hierarchy:
    cols = list(cols)
    x = df.select(F.col(id_col), *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    names = [f"x{i}" for i in range(len(cols))]
    drawn = x.orderBy(F.xxhash64(F.lit(seed), F.col(id_col)), id_col).limit(summaries).select(*names).collect()
    seeds = np.array(list(dict.fromkeys(tuple(r) for r in drawn))).reshape(-1, len(cols))
    m, d = seeds.shape
    if not m:
        return Hierarchy(seeds, np.zeros(0), seeds, np.zeros(0), [])

    def kernel(b: pa.RecordBatch) -> np.ndarray:
        v = _matrix(b)
        at = _nearest(v, seeds)
        out = np.zeros((m, d + 2))
        out[:, 0] = np.bincount(at, minlength=m)
        for k in range(d):
            out[:, 1 + k] = np.bincount(at, v[:, k] - seeds[at, k], m)
        out[:, d + 1] = np.bincount(at, ((v - seeds[at]) ** 2).sum(1), m)
        return out.ravel()

    total = added(x.select(*names), kernel, m * (d + 2)).reshape(m, d + 2)
    n, shift = total[:, 0], total[:, 1:d + 1] / total[:, :1]  # every seed is a row, so none is empty
    return Hierarchy(seeds, n, seeds + shift, total[:, d + 1] - n * (shift ** 2).sum(1), ward(n, seeds + shift))


def assign(df: DataFrame, cols: Sequence[str], tree: Hierarchy, k: int, out: str = "cluster") -> DataFrame:
    """``df`` with each row's cluster in the cut into k clusters."""
    columns, labels = df.columns, tree.labels(k).astype(np.int32)
    dims = len(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            *own, packed = b.columns
            x = packed.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            yield pa.RecordBatch.from_arrays([*own, pa.array(labels[_nearest(x, tree.seeds)])], [*columns, out])

    held = df.select("*", F.array(*[F.col(f"`{c}`").cast("double") for c in cols]).alias("__x"))
    return held.mapInArrow(run, df.select("*", F.lit(0).alias(out)).schema)


def linkage_table(df: DataFrame, tree: Hierarchy) -> DataFrame:
    """One row per merge: step, left, right, height, rows."""
    rows = [(i + 1, a, b, h, n) for i, (a, b, h, n) in enumerate(tree.merges)]
    return df.sparkSession.createDataFrame(rows, "step int, left_cluster int, right_cluster int, height double, rows long")


@dataclass
class _Cuts:
    """Chunks: the leaves of a tree of cuts, in heap order."""

    dim: np.ndarray
    value: np.ndarray
    depth: int

    def chunks(self, x: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[rows, self.dim[node]] > self.value[node])
        return node - (2 ** self.depth - 1)


def _cuts(x: np.ndarray, depth: int) -> _Cuts:
    """Median cuts of the widest features of ``x``.  They only decide which
    clusters meet in a task."""
    dim, value = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, np.inf)
    held = {0: x}
    for node in range(2 ** depth - 1):
        v = held.pop(node)
        if len(v):
            dim[node] = k = int(np.argmax(v.max(0) - v.min(0)))
            value[node] = np.median(v[:, k])
        right = v[:, dim[node]] > value[node]
        held[2 * node + 1], held[2 * node + 2] = v[~right], v[right]
    return _Cuts(dim, value, depth)


def _tiles(x: np.ndarray, node: np.ndarray) -> list[np.ndarray]:
    """Rows of ``x`` in tiles of neighbours, each by rising node."""
    out, todo = [], [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        if len(rows) <= TILE:
            if len(rows):
                out.append(rows[np.argsort(node[rows], kind="stable")])
            continue
        v = x[rows]
        k = int(np.argmax(v.max(0) - v.min(0)))
        order = np.argpartition(v[:, k], len(rows) // 2)
        todo += [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]
    return out


def _least_costs(n, lo: np.ndarray, hi: np.ndarray, box_n: np.ndarray, box_lo: np.ndarray, box_hi: np.ndarray) -> np.ndarray:
    """What a merge of clusters in the box (lo, hi), of at least ``n`` rows,
    with one in other boxes costs at least."""
    gap = np.maximum(0, np.maximum(box_lo - hi, lo - box_hi))
    return n * box_n / (n + box_n) * (gap * gap).sum(-1) * (1 - 1e-12)


def _search(ask: tuple, best: np.ndarray, near: np.ndarray, given: tuple) -> None:
    """The nearest of the ``given`` clusters (node, n, x) of those that
    ``ask``, if nearer than the best known, which are renewed in place; of
    equals the smallest node.  No cluster meets itself."""
    q_node, q_n, q_x = ask
    node, n, x = given
    tiles = _tiles(x, node)
    if not tiles:
        return
    lo, hi = (np.array([f(x[t], axis=0) for t in tiles]) for f in (np.min, np.max))
    least = np.array([n[t].min() for t in tiles])
    held = [(node[t], n[t], np.ascontiguousarray(x[t].T)) for t in tiles]
    for rows in _tiles(q_x, q_node):
        v = q_x[rows]
        far = _least_costs(q_n[rows].min(), v.min(0), v.max(0), least, lo, hi)
        for j in np.argsort(far, kind="stable").tolist():
            if far[j] > best[rows].max():
                break
            r = rows[_least_costs(q_n[rows], v, v, least[j], lo[j], hi[j]) <= best[rows]]
            if not len(r):
                continue
            t_node, t_n, t_x = held[j]
            cost = _costs(q_n[r, None], q_x[r].T[:, :, None], t_n, t_x)
            cost[q_node[r, None] == t_node] = np.inf
            i = cost.argmin(1)
            got, at = cost[np.arange(len(r)), i], t_node[i]
            better = (got < best[r]) | ((got == best[r]) & (at < near[r]))
            best[r[better]], near[r[better]] = got[better], at[better]


def _columns(table: pa.Table | pa.RecordBatch, names: Sequence[str]) -> tuple:
    return (table["node"].to_numpy(), table["n"].to_numpy(),
            np.column_stack([table[c].to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table[c].to_numpy()
                             for c in names]))


def _with_nearest(state: DataFrame, names: Sequence[str], left: int, chunk: int) -> DataFrame:
    """``state`` with ``near`` and ``best`` (the nearest cluster and what the
    merge with it costs) where they were null.

    Clusters are dealt into chunks of neighbours.  Each first searches its
    own chunk; then it visits the chunks whose boxes (one per order of
    magnitude of the clusters' rows) may hold a nearer one.
    """
    dims = len(names)
    depth = max(0, (-(-left // min(chunk, max(left // 32, 1024))) - 1).bit_length())
    drawn = state.select(*names)
    if left > SAMPLE:
        drawn = state.where(F.pmod(F.xxhash64("node", F.lit(left)), F.lit(left)) < SAMPLE).select(*names)
    cuts = _cuts(np.array(drawn.collect(), float).reshape(-1, dims), depth)
    schema = "node long, n double, key double, " + ", ".join(f"{c} double" for c in names) + ", near long, best double, chunk long, asks boolean"
    fields = [f.split()[0] for f in schema.split(", ")]

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = cuts.chunks(_columns(b, names)[2])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at)], [*b.schema.names, "chunk"])

    def own(table: pa.Table) -> pa.Table:
        given = _columns(table, names)
        near, best = (table[c].to_numpy(zero_copy_only=False).astype(float) for c in ("near", "best"))
        asks = np.isnan(best)
        known, cost = np.full(asks.sum(), np.iinfo(np.int64).max), np.full(asks.sum(), np.inf)
        _search(tuple(v[asks] for v in given), cost, known, given)
        best[asks] = cost
        held = table["near"].combine_chunks().fill_null(-1).to_numpy(zero_copy_only=False).copy()
        held[asks] = known
        return pa.table({**{c: table[c] for c in fields[:3 + dims]}, "near": held, "best": best, "chunk": table["chunk"], "asks": asks})

    inside = state.mapInArrow(dealt, state.select("*", F.lit(0).cast("long").alias("chunk")).schema)
    first = write_table(inside.groupBy("chunk").applyInArrow(own, schema), "linkage_own")
    boxes = np.array([tuple(r) for r in first.groupBy("chunk", F.floor(F.log2("n")).alias("class")).agg(
        F.min("n"), *[F.min(c) for c in names], *[F.max(c) for c in names]).drop("class").collect()], float)
    # the boxes of a chunk are together
    boxes = boxes[np.argsort(boxes[:, 0], kind="stable")]
    chunks, starts = np.unique(boxes[:, 0].astype(np.int64), return_index=True)

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, n, x = _columns(b, names)
            best, at = b["best"].to_numpy(), b["chunk"].to_numpy()
            for i in range(0, len(n), 1024):  # bounds the temporaries
                part = slice(i, i + 1024)
                v = x[part, None]
                far = np.minimum.reduceat(_least_costs(n[part, None], v, v, boxes[:, 1], boxes[:, 2:2 + dims], boxes[:, 2 + dims:]), starts, 1)
                row, to = np.nonzero((far <= best[part, None]) & (chunks != at[part, None]))
                took = b.take(pa.array(row + i))
                yield pa.RecordBatch.from_arrays([*took.columns, pa.array(chunks[to])], [*took.schema.names, "to"])

    asking = first.where("asks").select("node", "n", *names, "near", "best", "chunk")
    guests = write_table(asking.mapInArrow(visits, asking.select("*", F.lit(0).cast("long").alias("to")).schema), "linkage_guests")
    most = {r[0]: -(-r[1] // VISITORS) for r in guests.groupBy("to").count().collect()}
    if not most:
        return first.select(*fields[:5 + dims])
    # a chunk's visitors are split where they are many, and meet a copy of it each
    parts = F.create_map(*[F.lit(v) for item in most.items() for v in item])
    guests = guests.withColumn("part", F.pmod(F.xxhash64("node"), F.element_at(parts, F.col("to"))))
    hosts = first.where(F.col("chunk").isin(list(most))).select("node", "n", *names, "chunk").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.element_at(parts, F.col("chunk")).cast("long") - 1)))

    def visit(guest: pa.Table, host: pa.Table) -> pa.Table:
        ask, given = _columns(guest, names), _columns(host, names)
        near, best = (guest[c].to_numpy().copy() for c in ("near", "best"))
        _search(ask, best, near, given)
        return pa.table({"node": ask[0], "better_best": best, "better_near": near})

    better = guests.groupBy("to", "part").cogroup(hosts.groupBy("chunk", "part")).applyInArrow(
        visit, "node long, better_best double, better_near long")
    better = better.groupBy("node").agg(F.min(F.struct("better_best", "better_near")).alias("better"))
    out = first.join(better, "node", "left")
    return out.select("node", "n", "key", *names, F.coalesce("better.better_near", "near").alias("near"),
                      F.coalesce("better.better_best", "best").alias("best"))


def linkage(df: DataFrame, id_col: str, cols: Sequence[str], seed: int = 42, chunk: int = CHUNK, last: int = LAST) -> DataFrame:
    """Ward's linkage over all rows, exact: a row per merge (step, left_cluster,
    right_cluster, height, rows).  Equal rows are one leaf that weighs in by
    their number; leaves are numbered in the order of a hash of their first id.

    Ward's costs are reducible, so clusters that are each other's nearest
    neighbours may be merged in any order: a round merges all such pairs, and
    others keep their neighbour unless it was merged (Sumengen et al., 2021).
    The driver makes the merges of the last ``last`` clusters.  A task holds a
    chunk and ``VISITORS`` more; without any structure to prune, a search is
    quadratic in the clusters.
    """
    names = [f"x{i}" for i in range(len(cols))]
    x = df.select(F.xxhash64(F.lit(seed), F.col(id_col)).alias("hash"), F.col(id_col).alias("id"),
                  *[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(cols, names)])
    leaves = x.groupBy(*names).agg(F.count(F.lit(1)).cast("double").alias("n"), F.min(F.struct("hash", "id")).alias("first"))
    numbered, total = with_row_number(leaves, [F.col("first.hash"), F.col("first.id")], "place")
    state = numbered.select((F.col("place") - 1).alias("node"), "n", F.lit(0.0).alias("key"), *names,
                            F.lit(None).cast("long").alias("near"), F.lit(None).cast("double").alias("best"))
    made: list[DataFrame] = []
    left, turn = total, 0
    record = ["node", "n", "key", "left", "right", "height"]
    while left > last:
        turn += 1
        ends = F.least("node", "near").alias("left"), F.greatest("node", "near").alias("right")
        found = _with_nearest(state, names, left, chunk)
        # both ends of a pair of mutual neighbours give it, any other cluster is alone
        pairs = found.groupBy(*ends).agg(
            F.count(F.lit(1)).alias("ends"), F.min("node").alias("first"), F.sum("n").alias("n"), F.max("key").alias("key"),
            *[(F.sum(F.col("n") * F.col(c)) / F.sum("n")).alias(f"m_{c}") for c in names],
            *[F.first(c).alias(c) for c in names], F.first("best").alias("best"))
        pairs = write_table(pairs, "linkage_pairs")
        both, height = pairs.where("ends = 2"), F.sqrt(2 * F.col("best"))
        node = F.lit(turn << 40) + F.col("left").bitwiseAND(F.lit(_BASE))
        merged = both.select(node.alias("node"), "n", F.greatest("key", height).alias("key"), "left", "right", height.alias("height"),
                             *[F.col(f"m_{c}").alias(c) for c in names])
        made.append(merged.select(*record))
        gone = both.select(F.explode(F.array("left", "right")).alias("gone"))
        alone = pairs.where("ends = 1").select(
            F.col("first").alias("node"), "n", "key", *names,
            F.when(F.col("first") == F.col("left"), F.col("right")).otherwise(F.col("left")).alias("near"), "best")
        alone = alone.join(gone, F.col("near") == F.col("gone"), "left")
        kept = F.col("gone").isNull()
        nothing = [F.lit(None).cast("long").alias("near"), F.lit(None).cast("double").alias("best")]
        state = merged.select("node", "n", "key", *names, *nothing).unionByName(alone.select(
            "node", "n", "key", *names, F.when(kept, F.col("near")).alias("near"), F.when(kept, F.col("best")).alias("best")))
        state = write_table(state, "linkage")
        before, left = left, state.count()
        if left == before:  # rounding left a ring of neighbours: all search again
            state = state.select("node", "n", "key", *names, *nothing)
    held = sorted(tuple(r)[:3 + len(names)] for r in state.collect())
    made.append(df.sparkSession.createDataFrame(
        _last(held, (turn + 1) << 40), "node long, n double, key double, left long, right long, height double"))
    union = made[0]
    for part in made[1:]:
        union = union.unionByName(part)
    steps, _ = with_row_number(union, [F.col("key"), F.col("node")], "step")
    for end in ("left", "right"):  # a cluster is merged once: no key is hot
        numbers = steps.select(F.col("node").alias(end), (F.col("step") + (total - 1)).alias(f"{end}_number"))
        steps = steps.join(numbers, end, "left").withColumn(f"{end}_number", F.coalesce(f"{end}_number", end))
    low, high = F.least("left_number", "right_number"), F.greatest("left_number", "right_number")
    return steps.select(F.col("step").cast("int").alias("step"), low.cast("int").alias("left_cluster"),
                        high.cast("int").alias("right_cluster"), "height", F.col("n").cast("long").alias("rows"))


def _last(held: list[tuple], first: int) -> list[tuple]:
    """(node, rows, key, left, right, height) of the merges of all ``held``
    clusters (node, rows, key, *centre), numbered from ``first``.  ``key`` is
    the height, but never below that of a cluster inside."""
    node, size, key = ([r[i] for r in held] for i in range(3))
    out = []
    centre = np.array([r[3:] for r in held], float)
    for i, (x, y, height) in enumerate(_chain(np.array(size, float), centre)):
        keep = min(x, y)
        size[keep], key[keep] = size[x] + size[y], max(height, key[x], key[y])
        out.append((first + i, size[keep], key[keep], node[x], node[y], height))
        node[keep] = first + i
    return out

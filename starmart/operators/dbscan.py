"""DBSCAN (ML-11): eps-neighbourhoods with ``<=``, the point itself counted
(scikit-learn's conventions); noise is -1.

Rows are numbered along a Z-order curve of their features and packed into
blocks of ``block`` neighbours on that curve, each with its bounding box.
Boxes tell which pairs of blocks can hold neighbours at all; such a pair is
one task's work (two blocks in memory), inside which boxes of tiles prune
once more.  No row reaches the
driver, and no pair of rows leaves a task.

1. **Counts** inside each block prove most points of dense data to be core.
   The others are gathered into blocks of their own, which alone meet the
   blocks near them, and only those points' counts come back.
2. **Links**: the core points of a block fall into local components; blocks
   next to each other on the curve are linked and contracted first
   (:mod:`components`).  Every link that is left has an end outside the largest
   component; those points are gathered into blocks of their own, too, which
   alone meet the blocks near them, unless both hold one and the same
   component.  A pair returns a spanning forest.
3. **Borders**, gathered the same way, take the smallest cluster id among their core neighbours
   (scikit-learn takes whichever cluster reaches them first).

Cluster ids are numbered by the smallest id of their core points.  ``id_col``
is unique and of any orderable type.  Rows with a null or non-finite feature
are noise.  Without any structure to prune, the work is quadratic in the
rows, as for any exact method; the memory of a task stays two blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.components import components
from starmart.operators.ordered import with_row_number
from starmart.session import write_table

BLOCK = 4096
TILE = 256
_PACKED = "block long, nums binary, x binary, labels binary, lo array<double>, hi array<double>, low long, high long"


def _z_order(cols: Sequence[str], lows: Sequence[float], highs: Sequence[float]) -> Column:
    """A row's place on the Z-order curve of its first 62 features."""
    used = list(zip(cols, lows, highs))[:62]
    bits = max(1, min(16, 62 // len(used)))
    terms = []
    for i, (c, lo, hi) in enumerate(used):
        if hi > lo:
            level = f"cast((`{c}` - ({lo!r}D)) / ({hi!r}D - ({lo!r}D)) * {(1 << bits) - 1} AS bigint)"
            terms += [f"shiftleft(shiftright({level}, {b}) & 1L, {b * len(used) + i})" for b in range(bits)]
    return F.expr(" | ".join(terms) if terms else "0L")


def _pack(rows: DataFrame, cols: Sequence[str], label: str, name: str) -> DataFrame:
    """Written table: a row per block with numbers, features, labels, their box
    and the least and the greatest label."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("num")
        x = np.column_stack([table[c].to_numpy() for c in cols])
        return pa.table({
            "block": [table["block"][0].as_py()], "nums": pa.array([table["num"].to_numpy().astype("<i8").tobytes()], pa.binary()),
            "x": pa.array([x.astype("<f8").tobytes()], pa.binary()),
            "labels": pa.array([table["label"].to_numpy().astype("<i8").tobytes()], pa.binary()),
            "lo": [x.min(0).tolist()], "hi": [x.max(0).tolist()],
            "low": [pc.min(table["label"]).as_py()], "high": [pc.max(table["label"]).as_py()]})

    rows = rows.select("block", "num", F.col(label).cast("long").alias("label"), *cols)
    return write_table(rows.groupBy("block").applyInArrow(run, _PACKED), name)


class _Block:
    """A packed block's points, in tiles with their boxes."""

    def __init__(self, table: pa.Table, dims: int):
        r = {c.rpartition("_")[2]: v for c, v in table.to_pylist()[0].items()}  # a pair's sides have a prefix
        self.nums, self.labels = (np.frombuffer(r[c], "<i8") for c in ("nums", "labels"))
        self.x = np.frombuffer(r["x"], "<f8").reshape(-1, dims)
        self.firsts = np.arange(0, len(self.x), TILE)
        self.lo, self.hi = np.minimum.reduceat(self.x, self.firsts), np.maximum.reduceat(self.x, self.firsts)

    def tiles(self) -> Iterator[slice]:
        return (slice(i, min(i + TILE, len(self.x))) for i in self.firsts.tolist())

    def near(self, x: np.ndarray, eps2: float) -> list[slice]:
        """Tiles whose box lies within eps of the box of ``x``."""
        gap = np.maximum(0, np.maximum(self.lo - x.max(0), x.min(0) - self.hi))
        ok = (gap * gap).sum(1) <= eps2
        return [t for t, use in zip(self.tiles(), ok) if use]


def _within(a: np.ndarray, b: np.ndarray, eps2: float) -> np.ndarray:
    """Which points of ``a`` and ``b`` lie within eps (plain differences, so
    that pairs on the border are not lost)."""
    d2 = np.zeros((len(a), len(b)))
    for k in range(a.shape[1]):
        d = a[:, k, None] - b[None, :, k]
        d2 += d * d
    return d2 <= eps2


def _counts(a: np.ndarray, b: _Block, eps2: float, enough: int) -> np.ndarray:
    """Neighbours in ``b`` of each point of ``a``; points with enough of them
    are not counted on."""
    out = np.zeros(len(a), np.int64)
    for i in range(0, len(a), TILE):
        x, c = a[i:i + TILE], out[i:i + TILE]
        for t in b.near(x, eps2):
            open_ = np.flatnonzero(c < enough)
            if not len(open_):
                break
            c[open_] += _within(x[open_], b.x[t], eps2).sum(1)
    return out


class _Forest:
    """Union-find over labels; ``edges`` are the links that joined two trees."""

    def __init__(self):
        self.up: dict[int, int] = {}
        self.edges: list[tuple[int, int]] = []

    def find(self, a: int) -> int:
        while self.up.get(a, a) != a:
            self.up[a] = a = self.up.get(self.up[a], self.up[a])
        return a

    def join(self, a: int, b: int) -> None:
        x, y = self.find(a), self.find(b)
        if x != y:
            self.up[max(x, y)] = min(x, y)
            self.edges.append((a, b))


def _link(a: _Block, b: _Block, eps2: float) -> _Forest:
    """A spanning forest of the labels of ``a`` and ``b`` that touch."""
    forest = _Forest()
    for s in a.tiles():
        for t in b.near(a.x[s], eps2):
            la, lb = (np.array([forest.find(v) for v in labels.tolist()]) for labels in (a.labels[s], b.labels[t]))
            if la.min() == la.max() == lb.min() == lb.max():
                continue
            (us, i), (vs, j) = (np.unique(labels, return_inverse=True) for labels in (la, lb))
            touching = np.zeros((len(us), len(vs)), bool)
            r, c = np.nonzero(_within(a.x[s], b.x[t], eps2))
            touching[i[r], j[c]] = True
            r, c = np.nonzero(touching)
            for u, v in zip(us[r].tolist(), vs[c].tolist()):
                forest.join(u, v)
    return forest


def _gap2() -> Column:
    """Squared distance of the boxes (lo, hi) and (lo2, hi2)."""
    sides = F.transform(F.arrays_zip("lo", "hi", "lo2", "hi2"), lambda s: F.greatest(
        F.lit(0.0), s["lo"] - s["hi2"], s["lo2"] - s["hi"]))
    return F.aggregate(sides, F.lit(0.0), lambda acc, v: acc + v * v)


def _next_pairs(packed: DataFrame, eps2: float) -> DataFrame:
    """Pairs of blocks next to each other on the curve whose boxes lie within eps."""
    other = packed.select(F.col("block").alias("b"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    return packed.join(other, F.col("block") + 1 == F.col("b")).where(_gap2() <= eps2).select(F.col("block").alias("a"), "b")


def _gathered(points: DataFrame, cols: Sequence[str], label: str, name: str, block: int) -> DataFrame:
    """``points``, a few of each block, packed closely along the curve into
    blocks of their own: their number follows that of the points."""
    close, _ = with_row_number(points.select("num", F.col(label).alias("label"), *cols), [F.col("num")], "place")
    return _pack(close.withColumn("block", F.expr(f"(place - 1) div {block}")), cols, "label", name)


def _near_pairs_between(left: DataFrame, right: DataFrame, eps2: float) -> DataFrame:
    """Written pairs (a, b) of a block of ``left`` and one of ``right`` whose
    boxes lie within eps."""
    ones = left.select(F.col("block").alias("a"), "lo", "hi")
    others = right.select(F.col("block").alias("b"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    return write_table(ones.crossJoin(others).where(_gap2() <= eps2).select("a", "b"), "block_pairs")


def _meet(pairs: DataFrame, left: DataFrame, right: DataFrame, dims: int, run: Callable, schema: str) -> DataFrame:
    """``run(a, b)`` for every pair whose blocks ``left`` and ``right`` hold."""
    fields = [f.split() for f in schema.split(", ")]

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        columns = run(_Block(a, dims), _Block(b, dims)) if len(a) and len(b) else [np.zeros(0, np.int64)] * len(fields)
        return pa.table({name: pa.array(c, pa.int64()) for (name, _), c in zip(fields, columns)})

    def held(side: DataFrame, end: str) -> DataFrame:
        return side.select(F.col("block").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in ("nums", "x", "labels")])

    # a block travels only for pairs whose other block is held, too
    pairs = pairs.join(left.select(F.col("block").alias("a")), "a", "left_semi").join(
        right.select(F.col("block").alias("b")), "b", "left_semi").select("a", "b")
    ones = pairs.join(held(left, "a"), "a")
    others = pairs.select(F.col("a").alias("a2"), F.col("b").alias("b2")).join(held(right, "b2"), "b2")
    return ones.groupBy("a", "b").cogroup(others.groupBy("a2", "b2")).applyInArrow(cell, schema)


def _core_points(points: DataFrame, packed: DataFrame, cols: Sequence[str], eps2: float, enough: int,
                 block: int) -> DataFrame:
    """``points`` with ``core``, written."""
    dims = len(cols)

    def inside(table: pa.Table) -> pa.Table:
        b = _Block(table, dims)
        return pa.table({"num": pa.array(b.nums), "own": pa.array(_counts(b.x, b, eps2, enough))})

    own = write_table(packed.groupBy("block").applyInArrow(inside, "num long, own long"), "own_counts")
    proven = write_table(points.join(own, "num"), "own")
    open_ = proven.where(F.col("own") < enough)
    lost = _gathered(open_, cols, "block", "unproven", block)

    def across(a: _Block, b: _Block) -> list[np.ndarray]:
        found = _counts(a.x, b, eps2, enough)
        hit = (found > 0) & (a.labels != (b.nums[0] - 1) // block)  # their own block is counted
        return [a.nums[hit], found[hit]]

    both = _near_pairs_between(lost, packed, eps2)
    late = _meet(both, lost, packed, dims, across, "num long, found long").groupBy("num").agg(F.sum("found").alias("found"))
    core = F.col("own") + F.coalesce("found", F.lit(0)) >= enough
    return write_table(proven.join(late, "num", "left").select("num", "block", "id", *cols, core.alias("core")), "core")


def _core_components(cores: DataFrame, cols: Sequence[str], eps2: float, block: int) -> DataFrame:
    """(num, block, id, *cols, label) of the core points: the smallest number
    of their component."""
    dims = len(cols)

    def local(table: pa.Table) -> pa.Table:
        b = _Block(table, dims)
        forest = _link(b, b, eps2)
        return pa.table({"num": pa.array(b.nums), "label": pa.array([forest.find(v) for v in b.nums.tolist()], pa.int64())})

    def touch(a: _Block, b: _Block) -> list[np.ndarray]:
        edges = np.array(_link(a, b, eps2).edges, np.int64).reshape(-1, 2)
        return [edges[:, 0], edges[:, 1]]

    def contracted(labelled: DataFrame, some: DataFrame, ones: DataFrame, others: DataFrame | None = None) -> DataFrame:
        found = components(_meet(some, ones, ones if others is None else others, dims, touch, "u long, v long"))
        renamed = found.select(F.col("node").alias("label"), "component")
        return write_table(labelled.join(renamed, "label", "left").withColumn(
            "label", F.coalesce("component", "label")).drop("component"), "labelled")

    packed = _pack(cores, cols, "num", "cores")
    inside = packed.groupBy("block").applyInArrow(local, "num long, label long")
    labelled = write_table(cores.drop("core").join(inside, "num"), "labelled")
    packed = _pack(labelled, cols, "label", "cores")
    labelled = contracted(labelled, _next_pairs(packed, eps2), packed)
    # a link that is left has an end outside the largest component: those points alone meet the blocks near them
    largest = labelled.groupBy("label").count().orderBy(F.col("count").desc(), "label").first()
    apart = labelled.where(F.col("label") != (largest.label if largest else 0))
    if apart.isEmpty():
        return labelled
    packed, apart = _pack(labelled, cols, "label", "cores"), _gathered(apart, cols, "label", "apart", block)
    # blocks that hold one and the same component need no comparison
    low = apart.select(F.col("block").alias("a"), "low", "high")
    other = packed.select(F.col("block").alias("b"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    mixed = _near_pairs_between(apart, packed, eps2).join(low, "a").join(other, "b").where(
        "least(low, low2) < greatest(high, high2)").select("a", "b")
    return contracted(labelled, mixed, apart, packed)


def dbscan(df: DataFrame, id_col: str, cols: Sequence[str], eps: float = 3.0, min_samples: int = 5,
           block: int = BLOCK, out: str = "cluster") -> DataFrame:
    names, eps2 = list(cols), float(eps) ** 2
    cols = [f"x{i}" for i in range(len(names))]
    points = df.select(F.col(f"`{id_col}`").alias("id"), *[F.col(f"`{n}`").cast("double").alias(c) for n, c in zip(names, cols)])
    points = points.where(" AND ".join(f"abs({c}) < double('infinity')" for c in cols))
    ends = points.agg(F.count(F.lit(1)), *[f(c) for f in (F.min, F.max) for c in cols]).first()
    if not ends[0]:
        return df.withColumn(out, F.lit(-1))
    curve = _z_order(cols, ends[1:len(cols) + 1], ends[len(cols) + 1:])
    points, _ = with_row_number(points.withColumn("curve", curve), [F.col("curve"), F.col("id")], "num")
    points = write_table(points.drop("curve").withColumn("block", F.expr(f"(num - 1) div {block}")), "points")
    packed = _pack(points, cols, "num", "blocks")
    flagged = _core_points(points, packed, cols, eps2, min_samples, block)
    cores = _core_components(flagged.where("core"), cols, eps2, block)
    # cluster ids by the smallest id of a component's core points
    firsts, _ = with_row_number(cores.groupBy("label").agg(F.min("id").alias("first")), [F.col("first")], "place")
    cores = write_table(cores.join(firsts.select("label", (F.col("place") - 1).alias("cluster")), "label"), "clusters")

    def nearest(a: _Block, b: _Block) -> list[np.ndarray]:
        best = np.full(len(a.x), np.iinfo(np.int64).max)
        for s in a.tiles():
            for t in b.near(a.x[s], eps2):
                hit = _within(a.x[s], b.x[t], eps2)
                best[s] = np.minimum(best[s], np.where(hit, b.labels[t][None], np.iinfo(np.int64).max).min(1))
        found = best < np.iinfo(np.int64).max
        return [a.nums[found], best[found]]

    rest = _gathered(flagged.where("NOT core"), cols, "num", "rest", block)
    named = _pack(cores, cols, "cluster", "cores")
    borders = _meet(_near_pairs_between(rest, named, eps2), rest, named, len(cols), nearest, "num long, cluster long")
    borders = borders.groupBy("num").agg(F.min("cluster").alias("cluster"))
    labels = cores.select("id", "cluster").unionByName(flagged.join(borders, "num").select("id", "cluster"))
    labels = labels.select(F.col("id").alias("__dbscan_id"), F.col("cluster").alias("__dbscan_cluster"))
    return (df.join(labels, F.col(f"`{id_col}`") == F.col("__dbscan_id"), "left")
            .withColumn(out, F.coalesce("__dbscan_cluster", F.lit(-1)).cast("int"))
            .drop("__dbscan_id", "__dbscan_cluster"))

"""Second-order gradient boosting on histograms (CH-4): logistic loss, trees
of bounded depth, rows and columns drawn per tree, regularised leaves.

Features are cut into at most ``bins`` bins at approximate quantiles (one
aggregate).  A level of a tree is one job: every task adds the gradients and
hessians of its rows up per (node, feature, bin) and sends one array
(:mod:`partials`); the driver picks the splits from their sum.  What travels does not grow with the rows.  Rows are kept in a written
table, up to ``PACK`` of them in a packed row, so that a job does not move them
to Python value by value.  Their margins are renewed every ``STRIDE`` trees; in
between, tasks add the newest trees on the fly.

A split puts bins up to b to the left, that is values below the b-th cut;
null and NaN go right.  Gain, leaf weight and stopping follow the second-order
formulas with L2 weight ``reg`` and least hessian ``min_child``.  The first
margin is the log-odds of the label.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.partials import added
from starmart.session import spread, write_table

BINS = 64
STRIDE = 15
#: Rows of a packed row.
PACK = 1 << 15
_PACKED = "rows int, y binary, key binary, margin binary, cut binary"


@dataclass
class Tree:
    """A tree in heap order: children of node i are 2i + 1 and 2i + 2;
    ``feature`` is -1 at leaves."""

    feature: np.ndarray
    bin: np.ndarray
    weight: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n), np.zeros(n))

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """Where rows (of bin numbers, best laid out by feature) stand so far."""
        node = np.zeros(len(bins), np.uint8 if len(self.feature) < 256 else np.int64)
        for level in range(len(self.feature).bit_length() - 1):
            below = node.copy()
            for i in range(2 ** level - 1, 2 ** (level + 1) - 1):
                if self.feature[i] >= 0:  # whole columns at a time: node i goes on to 2i + 1 or 2i + 2
                    below += (node == i) * ((bins[:, self.feature[i]] > self.bin[i]) + node.dtype.type(i + 1))
            node = below
        return node.astype(np.int64)

    def margin(self, bins: np.ndarray) -> np.ndarray:
        return self.weight[self.nodes(bins)]


@dataclass
class Model:
    cuts: list[np.ndarray]  # per feature
    base: float
    trees: list[Tree] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, i], "right") for i, c in enumerate(self.cuts)]).astype(np.int16)

    def probability(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        margin = np.full(len(x), self.base)
        for t in self.trees:
            margin += t.margin(b)
        return 1 / (1 + np.exp(-margin))

    def importance(self) -> np.ndarray:
        """Mean gain of each feature's splits, as shares of their sum."""
        total, splits = np.zeros(len(self.cuts)), np.zeros(len(self.cuts))
        for t in self.trees:
            inner = t.feature >= 0
            np.add.at(total, t.feature[inner], t.gain[inner])
            np.add.at(splits, t.feature[inner], 1)
        mean = total / np.maximum(splits, 1)
        return mean / mean.sum() if mean.sum() > 0 else mean


def drawn(keys: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    """Which rows, by their hash, a tree is grown on."""
    z = keys.astype(np.uint64) + np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z >> np.uint64(11)).astype(np.float64) < share * 2.0 ** 53


def columns_of(tree: int, seed: int, features: int, share: float) -> np.ndarray:
    """The columns a tree may split on."""
    g = np.random.Generator(np.random.PCG64([seed, tree]))
    return np.sort(g.permutation(features)[:max(1, round(share * features))])


def best_split(g: np.ndarray, h: np.ndarray, columns: Sequence[int], reg: float, min_child: float
               ) -> tuple[float, int, int] | None:
    """(gain, feature, bin) of the best split of a node from its histograms
    (feature, bin); the first of equals."""
    best = None
    for f in columns:
        gl, hl = np.cumsum(g[f])[:-1], np.cumsum(h[f])[:-1]
        gr, hr = g[f].sum() - gl, h[f].sum() - hl
        gain = (gl ** 2 / (hl + reg) + gr ** 2 / (hr + reg) - g[f].sum() ** 2 / (h[f].sum() + reg)) / 2
        gain[(hl < min_child) | (hr < min_child)] = -np.inf
        b = int(np.argmax(gain)) if len(gain) else 0
        if len(gain) and gain[b] > 1e-12 and (best is None or gain[b] > best[0]):
            best = float(gain[b]), int(f), b
    return best


def fit(df: DataFrame, id_col: str, features: Sequence[str], label: str, rounds: int = 150, depth: int = 4,
        rate: float = 0.1, row_share: float = 0.8, column_share: float = 0.8, reg: float = 1.0,
        min_child: float = 1.0, seed: int = 42, bins: int = BINS) -> Model:
    """Boosted trees for the 0/1 column ``label``; rows without one are left out."""
    d = len(features)
    df = df.where(F.col(label).isNotNull())
    probs = [i / bins for i in range(1, bins)]
    start = df.agg(F.count(F.lit(1)), F.avg(F.col(label).cast("double")), *[
        F.percentile_approx(F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")), probs, 10_000) for f in features]).first()
    size, start = start[0], start[1:]
    share = min(max(start[0] if start[0] is not None else 0.5, 1e-6), 1 - 1e-6)
    # a cut at the smallest value would leave nothing to its left, but costs nothing either
    model = Model([np.unique(np.array(q or [], float)) for q in start[1:]], float(np.log(share / (1 - share))))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for i in range(0, b.num_rows, PACK):
                held.append(b.slice(i, PACK))
                size += held[-1].num_rows
                if size >= PACK:
                    yield packed(held)
                    held, size = [], 0
        if size:
            yield packed(held)

    def packed(batches: Sequence[pa.RecordBatch]) -> pa.RecordBatch:
        y, key, *x = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in batches]) for i in range(d + 2))
        cut = model.bins(np.column_stack(x).astype(float)) if d else np.zeros((len(y), 0), np.int16)
        return _packed(y, key, np.full(len(y), model.base), cut)

    source = df.select(F.col(label).cast("double").alias("y"), F.xxhash64(F.lit(seed), F.col(id_col)).alias("key"),
                       *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    # every level reads all rows: by as many tasks as rows ask for
    rows = write_table(spread(source, "key", size).mapInArrow(prepare, _PACKED), "boosting")
    tasks = rows.rdd.getNumPartitions()
    most = bins + 1

    pending: list[Tree] = []
    for number in range(rounds):
        if len(pending) == STRIDE:
            rows, tasks = _renewed(rows, tuple(pending))
            pending = []
        tree, columns = Tree.empty(depth), columns_of(number, seed, d, column_share)
        open_ = [0]
        for level in range(depth):
            first = 2 ** level - 1

            def kernel(b: pa.RecordBatch, tree=tree, open_=tuple(open_), first=first, level=level, trees=tuple(pending)):
                out = np.zeros((2, d, 2 ** level * most))
                is_open = np.isin(np.arange(len(tree.feature)), open_)
                for y, key, margin, cut in _unpacked(b, trees):
                    node = tree.nodes(cut)
                    use = np.flatnonzero(drawn(key, number, seed, row_share) & is_open[node])
                    p = 1 / (1 + np.exp(-margin[use]))
                    g, h = p - y[use], p * (1 - p)
                    cell = (node[use] - first) * most
                    for f in columns:
                        at = cell + cut[use, f]
                        out[0, f] += np.bincount(at, g, out.shape[2])
                        out[1, f] += np.bincount(at, h, out.shape[2])
                return out.ravel()

            total = added(rows, kernel, 2 * d * 2 ** level * most, tasks).reshape(2, d, 2 ** level, most)
            g, h = total[0].transpose(1, 0, 2), total[1].transpose(1, 0, 2)
            follow = []
            for node in open_:
                own_g, own_h = g[node - first], h[node - first]
                c = columns[0]
                if level == 0:
                    tree.weight[0] = -rate * own_g[c].sum() / (own_h[c].sum() + reg)
                split = best_split(own_g, own_h, columns, reg, min_child)
                if split is None:
                    continue
                tree.gain[node], tree.feature[node], tree.bin[node] = split
                f, b = split[1:]
                for child, side in ((2 * node + 1, slice(None, b + 1)), (2 * node + 2, slice(b + 1, None))):
                    tree.weight[child] = -rate * own_g[f][side].sum() / (own_h[f][side].sum() + reg)
                    follow.append(child)
            open_ = follow
            if not open_:
                break
        model.trees.append(tree)
        pending.append(tree)
    return model


def _packed(y: np.ndarray, key: np.ndarray, margin: np.ndarray, cut: np.ndarray) -> pa.RecordBatch:
    """One packed row; the bin numbers lie by feature."""
    parts = y.astype("<f8"), key.astype("<i8"), margin.astype("<f8"), cut.astype("<i2").T
    return pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int32()), *[pa.array([v.tobytes()], pa.binary()) for v in parts]],
                                      ["rows", "y", "key", "margin", "cut"])


def _unpacked(b: pa.RecordBatch, trees: Sequence[Tree]) -> Iterator[tuple[np.ndarray, ...]]:
    """(y, key, margin, bin numbers) of each packed row, the margins with those of ``trees``."""
    for i in range(b.num_rows):
        rows = b.column(0)[i].as_py()
        y, key, margin, cut = (np.frombuffer(b.column(j)[i].as_buffer(), t) for j, t in ((1, "<f8"), (2, "<i8"), (3, "<f8"), (4, "<i2")))
        cut = cut.reshape(-1, rows).T
        for t in trees:
            margin = margin + t.margin(cut)
        yield y, key, margin, cut


def _renewed(rows: DataFrame, trees: tuple[Tree, ...]) -> tuple[DataFrame, int]:
    """The written rows with the margins of ``trees`` added."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _unpacked(b, trees):
                yield _packed(*part)

    rows = write_table(rows.mapInArrow(run, _PACKED), "boosting")
    return rows, rows.rdd.getNumPartitions()


def predict(df: DataFrame, model: Model, features: Sequence[str], out: str = "score") -> DataFrame:
    """``df`` with the probability of label 1."""
    columns = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            *own, packed = b.columns
            x = packed.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, len(features))
            yield pa.RecordBatch.from_arrays([*own, pa.array(model.probability(x))], [*columns, out])

    held = df.select(*[F.col(f"`{c}`") for c in columns], F.array(*[F.col(f).cast("double") for f in features]).alias("__x"))
    schema = df.select("*", F.lit(0.0).alias(out)).schema
    return held.mapInArrow(run, schema)

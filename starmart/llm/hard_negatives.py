"""Hard negatives of anchors, from candidate lists that anchor clusters share.

Anchors are clustered by direction.  For a cluster with centroid c, whose
members lie within the angle b of it, a candidate x at the angle t to c can
score at most |a| |x| cos(max(0, t - b)) with a member a.  The candidates are
sorted by |x| cos(max(0, t - b)) once per cluster; every member walks that
list from the top and stops where its bound times |a| falls under what the
member still needs.  Nothing behind that place can enter its result, so the
result is exact.

Two walks: the first takes each anchor's best positives (rows of its label),
the second, for each positive, the best rows of other labels whose score lies
in a share window of the positive's score.

On Spark: candidates are dealt into shards and anchors into blocks of one
cluster, both of bounded bytes, by a row number fixed in a written table, so
that no id, label or group of copies can load one task.  Blocks are gathered
into parcels; each (shard, parcel) pair is one task's work, and shards and
parcels are of like size, which keeps the copies in the shuffle few.  Every
pair returns at most ``positives`` rows per anchor, or ``negatives`` rows per
positive, which a ranked window cuts.

The centroids are fitted on a bounded sample of the anchors (``FIT_ROWS``, by
hash), at most ``MAX_CLUSTERS`` of them; they steer the order alone.

Components x become floor(scale * x), scores are integers.  Nulls and ties:
rows with a null id, label or vector or a null or non-finite component take
no part, nor do rows whose integer vector is longer than 2^31, whose scores
might not fit a long.  Zero and empty vectors take part, with score 0.
Vectors of different lengths do not meet.  Ties go to the smaller id.
Repeated rows are anchors and candidates each; rows with the anchor's id are
not its candidates.  Empty tables give no rows.  Only the three columns named
are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import write_table
from starmart.llm.vectors import matrix

CELL_VALUES = 1 << 20  # vector components of a shard, and of a parcel (8 MB each)
BLOCK_ROWS = 256  # anchors that share a walk
CHUNK = 2048  # list places that a walk takes at a time
FIT_ROWS = 16_384
MAX_CLUSTERS = 256
_EXACT = float(1 << 53)

_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def integer_rows(table: DataFrame, scale: int, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """(row, vec_id, label, dim, vec): usable rows with integer components
    (as doubles) and a number of their own."""
    x = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("string").alias("label"), x.alias("x"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull()
                       & F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < float("inf"))))
    rows = rows.select("vec_id", "label", F.transform("x", lambda v: F.floor(F.lit(float(scale)) * v).cast("double")).alias("vec"))
    rows = rows.filter(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v) < float(1 << 62))
    return write_table(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label",
                                   F.size("vec").cast("long").alias("dim"), "vec"), "integer_rows")


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and unit vectors; a zero vector keeps its zeros."""
    length = np.sqrt((x ** 2).sum(1))
    return length, x / np.where(length > 0, length, 1)[:, None]


def fit_centroids(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Spherical k-means: unit centroids."""
    _, u = directions(x)
    draw = np.random.Generator(np.random.PCG64(seed))
    c = u[draw.permutation(len(u))[:k]]
    for _ in range(rounds):
        near = np.argmax(u @ c.T, 1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, u)
        length, unit = directions(sums)
        c = np.where(length[:, None] > 0, unit, c)
    return c


def centroids_by_length(anchors: DataFrame) -> dict[int, np.ndarray]:
    """Centroids for each vector length, from a bounded sample of anchors."""
    counts = dict(anchors.groupBy("dim").count().collect())  # a row per vector length
    total = sum(counts.values())
    out = {}
    for dim, n in counts.items():
        rows = max(1, FIT_ROWS * n // total)
        drawn = anchors.filter(F.col("dim") == dim).orderBy(F.xxhash64("row"), "row").limit(rows).select("vec")
        x = vectors(drawn.toArrow()["vec"].combine_chunks(), dim)
        out[dim] = fit_centroids(x, int(min(MAX_CLUSTERS, max(1, n // BLOCK_ROWS), len(x))))
    return out


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products, as int64."""
    top = np.sqrt((a ** 2).sum(1).max(initial=0) * (x ** 2).sum(1).max(initial=0))
    if top * max(1, a.shape[1]) < _EXACT:  # no partial sum leaves the integers a double holds
        return (a @ x.T).astype(np.int64)
    return a.astype(np.int64) @ x.astype(np.int64).T


def shared_list(members: np.ndarray, centroid: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The candidates' order for a cluster, and at each place the largest
    score per unit of a member's length from there on, with room for rounding."""
    _, u = directions(members)
    zero = ~members.any(1)
    widest = np.arccos(np.clip((u @ centroid), -1, 1), where=~zero, out=np.zeros(len(u))).max(initial=0)
    length, unit = directions(x)
    angle = np.arccos(np.clip(unit @ centroid, -1, 1))
    bound = length * np.cos(np.maximum(0, angle - widest))
    bound = bound + 1e-6 * length
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


class Best:
    """The ``k`` best (score, smaller id) of each of ``n`` walkers so far."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.who, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(n, np.iinfo(np.int64).min)  # the k-th score, once there are k

    def add(self, who: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        who, score, ids = (np.concatenate(c) for c in ((self.who, who), (self.score, score), (self.ids, ids)))
        by = np.lexsort((ids, -score, who))
        who, score, ids = who[by], score[by], ids[by]
        rank = np.arange(len(who)) - np.searchsorted(who, who)
        use = rank < self.k
        self.who, self.score, self.ids = who[use], score[use], ids[use]
        full = rank == self.k - 1
        self.floor[who[full]] = score[full]


def walk_positives(a: np.ndarray, a_id: np.ndarray, a_label: np.ndarray, centroid: np.ndarray,
                   x: np.ndarray, ids: np.ndarray, labels: np.ndarray, k: int) -> Best:
    """Each member's k best rows of its own label and another id."""
    order, bound = shared_list(a, centroid, x)
    length = np.sqrt((a ** 2).sum(1))
    best = Best(len(a), k)
    for i in range(0, len(order), CHUNK):
        # a member goes on while a later row may tie with its k-th or beat it
        on = np.flatnonzero(length * bound[i] + 1e-6 * np.abs(length * bound[i]) + 0.5 >= best.floor)
        if not len(on):
            break
        at = order[i:i + CHUNK]
        s = products(a[on], x[at])
        take = (a_label[on][:, None] == labels[at][None]) & (a_id[on][:, None] != ids[at][None]) & (s >= best.floor[on][:, None])
        r, c = np.nonzero(take)
        best.add(on[r], s[r, c], ids[at[c]])
    return best


def walk_negatives(a: np.ndarray, a_label: np.ndarray, of: np.ndarray, low: np.ndarray, high: np.ndarray,
                   centroid: np.ndarray, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, k: int) -> Best:
    """For each target (of member ``of``), the k best rows of another label
    whose score is from ``low`` to ``high``."""
    order, bound = shared_list(a, centroid, x)
    length = np.sqrt((a ** 2).sum(1))[of]
    best = Best(len(of), k)
    for i in range(0, len(order), CHUNK):
        need = np.maximum(best.floor, low)
        on = np.flatnonzero((length * bound[i] + 1e-6 * np.abs(length * bound[i]) + 0.5 >= need) & (low <= high))
        if not len(on):
            break
        at = order[i:i + CHUNK]
        members, mine = np.unique(of[on], return_inverse=True)
        s = products(a[members], x[at])
        other = a_label[members][:, None] != labels[at][None]
        for j in range(0, len(on), BLOCK_ROWS):  # targets of a member share its scores
            t, m = on[j:j + BLOCK_ROWS], mine[j:j + BLOCK_ROWS]
            sm = s[m]
            r, c = np.nonzero(other[m] & (sm >= need[t][:, None]) & (sm <= high[t][:, None]))
            best.add(t[r], sm[r, c], ids[at[c]])
    return best


def _by_length(values: dict[int, int]) -> Column:
    """A number per vector length; a table of embeddings has few lengths."""
    out = F.lit(1).cast("long")
    for dim, v in values.items():
        out = F.when(F.col("dim") == dim, F.lit(int(v)).cast("long")).otherwise(out)
    return out


def _clustered(anchors: DataFrame, centroids: dict[int, np.ndarray]) -> DataFrame:
    """Anchors with the cluster whose centroid is nearest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            near = np.zeros(len(dims), np.int64)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = vectors(b.column("vec").take(pa.array(at)), int(d))
                near[at] = np.argmax(directions(x)[1] @ centroids[int(d)].T, 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near)], [*b.schema.names, "cluster"])

    return anchors.mapInArrow(run, "row long, vec_id long, label string, dim long, vec array<double>, cluster long")


def vectors(column: pa.Array, dim: int) -> np.ndarray:
    return matrix(column) if dim else np.zeros((len(column), 0))


def _packed(rows: DataFrame, place: str, name: str) -> DataFrame:
    """Written table with one row per length and ``place``."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        x = vectors(table["vec"].combine_chunks(), key[0].as_py())

        def raw(values: np.ndarray, kind: str) -> pa.Array:
            return pa.array([values.astype(kind).tobytes()], pa.binary())

        return pa.table({"dim": [key[0].as_py()], place: [key[1].as_py()], "rows": raw(table["row"].to_numpy(), "<i8"),
                         "ids": raw(table["vec_id"].to_numpy(), "<i8"), "blocks": raw(table["block"].to_numpy(), "<i8"),
                         "clusters": raw(table["cluster"].to_numpy(), "<i8"),
                         "labels": pa.array([table["label"].to_pylist()], pa.list_(pa.string())), "x": raw(x, "<i4")})

    fields = f"dim long, {place} long, rows binary, ids binary, blocks binary, clusters binary, labels array<string>, x binary"
    columns = "row", "vec_id", "label", "vec", "block", "cluster"
    return write_table(rows.select("dim", place, *columns).groupBy("dim", place).applyInArrow(run, fields), name)


class _Cell:
    """A packed shard or parcel, unpacked."""

    def __init__(self, table: pa.Table):
        r = table.to_pylist()[0]
        self.rows, self.ids, self.blocks, self.clusters = (
            np.frombuffer(r[c], "<i8") for c in ("rows", "ids", "blocks", "clusters"))
        self.x = np.frombuffer(r["x"], "<i4").reshape(len(self.ids), r["dim"]).astype(np.float64)
        self.labels, self.dim, self.raw = r["labels"], r["dim"], r


def _codes(*lists: list[str]) -> list[np.ndarray]:
    number: dict[str, int] = {}
    return [np.array([number.setdefault(v, len(number)) for v in some], np.int64) for some in lists]


def _columns(**columns: np.ndarray) -> pa.Table:
    return pa.table({k: pa.array(v, pa.int64()) for k, v in columns.items()})


def mine(table: DataFrame, anchors: str, positives: int, negatives: int, low: int, high: int, scale: int = 256,
         id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None,
         cell_values: int = CELL_VALUES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each row that the SQL condition ``anchors`` (over
    vec_id) takes and each of its ``positives`` best rows of its label, the
    first ``negatives`` rows of other labels whose score is from ``low`` to
    ``high`` percent of the positive's."""
    rows = integer_rows(table, scale, id_col, vector_col, F.col("label") if label is None else label)
    asked = rows.filter(anchors)
    centroids = centroids_by_length(asked)
    if not centroids:
        return table.sparkSession.createDataFrame([], _RESULT)
    counts = dict(rows.filter(F.col("dim").isin(list(centroids))).groupBy("dim").count().collect())
    grouped = write_table(_clustered(asked, centroids), "anchors")
    sizes = grouped.groupBy("dim", "cluster").count().collect()  # at most MAX_CLUSTERS rows per length

    # numbers of blocks, each of one cluster, and of the parcels and shards that hold them
    first: dict[tuple[int, int], tuple[int, int]] = {}
    used: dict[int, int] = {}
    for dim, cluster, n in sorted(sizes):
        first[dim, cluster] = used.get(dim, 0), -(-n // block_rows)
        used[dim] = sum(first[dim, cluster])
    per = {d: max(1, cell_values // (block_rows * max(d, 1))) for d in used}
    parcels = {d: -(-used[d] // per[d]) for d in used}
    shards = {d: -(-n * max(d, 1) // cell_values) for d, n in counts.items()}
    plan = table.sparkSession.createDataFrame([(d, c, f, b) for (d, c), (f, b) in first.items()],
                                              "dim long, cluster long, first long, blocks long")
    dealt = grouped.join(F.broadcast(plan), ["dim", "cluster"]).withColumn(
        "block", F.col("first") + F.pmod(F.xxhash64("row"), F.col("blocks"))).withColumn(
        "parcel", F.floor(F.col("block") / _by_length(per)))
    parcel_rows = _packed(dealt, "parcel", "parcels")
    zero = F.lit(0).cast("long")
    dealt = rows.filter(F.col("dim").isin(list(centroids))).withColumns(
        {"shard": F.pmod(F.xxhash64("row", F.lit(3)), _by_length(shards)), "block": zero, "cluster": zero})
    shard_rows = _packed(dealt, "shard", "shards")
    # every shard meets every parcel of its length, once
    cells = shard_rows.withColumn("parcel", F.explode(F.sequence(zero, _by_length(parcels) - 1)))
    key = "dim", "shard", "parcel"

    def meet(side: DataFrame, run, *fields: str) -> DataFrame:
        copies = side.withColumn("shard", F.explode(F.sequence(zero, _by_length(shards) - 1)))

        def cell(left: pa.Table, right: pa.Table) -> pa.Table:
            if not len(left) or not len(right):  # a shard or parcel that no row was dealt to
                return _columns(**dict.fromkeys(fields, np.zeros(0, np.int64)))
            return run(_Cell(left), _Cell(right))

        return cells.groupBy(*key).cogroup(copies.groupBy(*key)).applyInArrow(
            cell, ", ".join(f"{f} long" for f in fields))

    def find_positives(x: _Cell, a: _Cell) -> pa.Table:
        parcel, (x_label, a_label) = a.raw["parcel"], _codes(x.labels, a.labels)
        found = []
        for b in np.unique(a.blocks):
            m = np.flatnonzero(a.blocks == b)
            best = walk_positives(a.x[m], a.ids[m], a_label[m], centroids[a.dim][a.clusters[m[0]]],
                                  x.x, x.ids, x_label, positives)
            at = m[best.who]
            found.append(_columns(dim=np.full(len(at), a.dim), parcel=np.full(len(at), parcel), anchor=a.rows[at],
                                  anchor_id=a.ids[at], positive_id=best.ids, positive_score=best.score))
        return pa.concat_tables(found)

    found = meet(parcel_rows, find_positives, "dim", "parcel", "anchor", "anchor_id", "positive_id", "positive_score")
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    targets = write_table(found.withColumn("place", F.row_number().over(order).cast("long"))
                          .filter(F.col("place") <= positives), "targets")

    def pack_targets(k: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        values = {c: pa.array([part[c].to_numpy().astype("<i8").tobytes()], pa.binary())
                  for c in ("anchor", "place", "positive_score")}
        return pa.table({"dim": [k[0].as_py()], "parcel": [k[1].as_py()], **values})

    packed = targets.groupBy("dim", "parcel").applyInArrow(
        pack_targets, "dim long, parcel long, anchor binary, place binary, positive_score binary")
    aimed = write_table(parcel_rows.join(packed, ["dim", "parcel"]), "aimed")

    def find_negatives(x: _Cell, a: _Cell) -> pa.Table:
        x_label, a_label = _codes(x.labels, a.labels)
        anchor, place, score = (np.frombuffer(a.raw[c], "<i8") for c in ("anchor", "place", "positive_score"))
        by = np.argsort(a.rows)
        of = by[np.searchsorted(a.rows[by], anchor)]  # the member of each target
        least = np.array([-(-low * p // 100) for p in score.tolist()], np.int64)
        most = np.array([high * p // 100 for p in score.tolist()], np.int64)
        found = []
        for b in np.unique(a.blocks):
            m = np.flatnonzero(a.blocks == b)
            t = np.flatnonzero(a.blocks[of] == b)
            best = walk_negatives(a.x[m], a_label[m], np.searchsorted(m, of[t]), least[t], most[t],
                                  centroids[a.dim][a.clusters[m[0]]], x.x, x.ids, x_label, negatives)
            at = t[best.who]
            found.append(_columns(anchor=anchor[at], place=place[at], negative_id=best.ids, negative_score=best.score))
        return pa.concat_tables(found)

    mined = meet(aimed, find_negatives, "anchor", "place", "negative_id", "negative_score")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    mined = mined.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return mined.join(targets, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

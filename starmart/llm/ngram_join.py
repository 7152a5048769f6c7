"""Exact n-gram Jaccard join with token-combination prefixes.

A document's set holds its distinct word n-grams (as 64-bit hashes); two
documents link when 100 * intersection >= percent * union.

1. Copies: texts with the same words form one class, whose smallest id stands
   for it from here on.
2. Counts: ``exchange.shared`` gives each block the corpus counts of those of
   its n-grams that occur at least twice.  All n-grams are in one global
   order: count, then hash.
3. Signatures: n-grams with a count up to ``rare`` are single tokens.  More
   frequent ones fall into 32 classes by hash, and a class is indexed by its
   2-token combinations.  A set with ``miss`` tokens to spare extends its
   prefix until the classes, each less the one token that can stay without a
   partner, hold miss + 1 tokens: then two sets that link share a signature.
   Sets too small to pay for that use single tokens in an index of their own,
   which the next larger sizes enter too.  An n-gram that occurs once is no
   signature; a document with enough of them sends nothing.
4. Candidates: documents with shared signatures gather under the smallest
   document of their buckets; only pairs of such groups are listed, so a
   group of near copies is one row, not its square.
5. Verification: group pairs are cut into cells of at most 256 x 256 sets,
   checked in numpy; a cell returns a spanning forest of its links.
6. Components of the forests, copies added.

Nulls and ties: null and empty texts and texts without words have the empty
set and link with nothing.  Rows with a null id get their set size and a null
component.  Rows that share an id are one document to the links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm import exchange as X
from starmart.llm import words as W
from starmart.llm.common import give_back, ids, pick, write_table
from starmart.llm.graph import components
from starmart.llm.joins import join_counted

RARE = 512  # the largest count of a single-token signature
CLASSES = 32  # of frequent n-grams
CELL = 256  # sets on a side of a verification cell
_NO_ID = np.iinfo(np.int64).min
_SETS = "doc_id long, digest binary, n_shingles long, sigs array<long>, tokens binary"


def _sets(table: pa.Table, n: int) -> tuple[list[np.ndarray], list[bytes | None]]:
    """Each text's sorted distinct n-gram hashes and its word digest."""
    w = W.words(*W.utf8(table["text"]), lower=True)
    grams = W.windows(w.hash, n)
    out, digests = [], []
    for a, b in zip(w.first[:-1], w.first[1:]):
        if a == b:
            out.append(np.zeros(0, np.uint64))
            digests.append(None)
            continue
        s = np.sort(grams[a:b - n + 1]) if b - a >= n else W.windows(w.hash[a:b], int(b - a))
        out.append(s[np.r_[True, s[1:] != s[:-1]]])
        digests.append(xxhash.xxh3_128_digest(w.hash[a:b].tobytes()))
    return out, digests


def shortest(percent: int, classes: int = CLASSES) -> int:
    """Smallest set size whose prefix can always pay for all classes."""
    n = 1
    while n - classes < n - -(-percent * n // 100) + 1:
        n += 1
    return n


def signatures(tokens: np.ndarray, count: np.ndarray, percent: int, rare: int = RARE,
               classes: int = CLASSES) -> np.ndarray:
    """Signatures of one set from its tokens and their corpus counts."""
    n = len(tokens)
    need = n - -(-percent * n // 100) + 1  # one more than the tokens to spare
    if np.count_nonzero(count < 2) >= need:
        return np.zeros(0, np.uint64)
    order = np.lexsort((tokens, count))
    t, c = tokens[order], count[order]
    floor, out = shortest(percent, classes), []
    if n * percent <= (floor - 1) * 100:  # may link with a set of the small sizes
        out.append(W.mix(t[:need][c[:need] >= 2] ^ W.U(0x5851F42D4C957F2D)))
    if n >= floor:
        kind = np.where(c > rare, (t % W.U(classes)).astype(np.int64), -1)
        pays = kind < 0  # all but the first token of each class count
        for g in range(classes):
            pays[np.flatnonzero(kind == g)[1:]] = True
        p = int(np.searchsorted(np.cumsum(pays), need)) + 1
        t, c, kind = t[:p], c[:p], kind[:p]
        out.append(t[(kind < 0) & (c >= 2)])
        for g in np.unique(kind[kind >= 0]):
            own = t[kind == g]
            i, j = np.triu_indices(len(own), 1)
            out.append(W.mix(own[i] * W.U(0x9E3779B97F4A7C15) + own[j]))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _verify(percent: int):
    def cell(left: list, right: list | None) -> list[tuple[int, int]]:
        """Forest of the links of a cell: (larger, smaller) ids."""
        every = left + (right or [])
        doc = np.array([r[0] for r in every])
        size = np.array([len(r[1]) for r in every])
        token, at, count = np.unique(np.concatenate([r[1] for r in every]), return_inverse=True,
                                     return_counts=True)
        own = np.repeat(np.arange(len(every)), size)
        use = count[at] >= 2
        own, at = own[use], (np.cumsum(count >= 2) - 1)[at[use]]
        k, m = len(left), int((count >= 2).sum())
        rows = len(every) if right is None else k
        common = np.zeros((rows, len(every)), np.float32)
        order = np.argsort(at, kind="stable")
        own, at = own[order], at[order]
        for lo in range(0, m, 4096):
            a, b = np.searchsorted(at, (lo, lo + 4096))
            part = np.zeros((len(every), min(4096, m - lo)), np.float32)
            part[own[a:b], at[a:b] - lo] = 1
            common += part[:rows] @ part.T
        common = common.astype(np.int64)
        link = 100 * common >= percent * (size[:rows, None] + size[None, :] - common)
        if right is not None:
            link[:, :k] = False
        i, j = np.nonzero(link)
        label = doc.copy()
        while True:  # smallest id within reach, inside the cell
            new = label.copy()
            np.minimum.at(new, i, label[j])
            np.minimum.at(new, j, label[i])
            if (new == label).all():
                break
            label = new
        return [(int(d), int(c)) for d, c in zip(doc, label) if d != c]

    def run(table: pa.Table) -> pa.Table:
        groups: dict = {}
        for r in table.to_pylist():
            groups.setdefault(r["cell"], ([], []))[r["side"]].append(
                (r["doc_id"], np.frombuffer(r["tokens"], np.uint64)))
        out = []
        for left, right in groups.values():
            if left and len(left) + len(right) > 1:
                out += cell(left, right or None)
        give_back()
        return pa.table({"u": pa.array([x[0] for x in out], pa.int64()),
                         "v": pa.array([x[1] for x in out], pa.int64())})

    return run


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Forest of links between the classes' representatives."""
    sets = sets.filter(F.size("sigs") > 0)
    entry = sets.select("doc_id", F.explode("sigs").alias("sig"))
    least = write_table(entry.groupBy("sig").agg(F.min("doc_id").alias("home"), F.count("*").alias("c"))
                        .filter("c > 1"), "buckets")
    homes = write_table(join_counted(entry, least, "sig", "c", "doc_id", "inner")
                        .groupBy("doc_id").agg(F.min("home").alias("home")), "homes")
    # once more over the homes: groups that share buckets gather under one home
    held = write_table(homes.join(sets, "doc_id").select("home", F.explode("sigs").alias("sig")).distinct(), "held")
    least = write_table(held.groupBy("sig").agg(F.min("home").alias("top"), F.count("*").alias("c")), "tops")
    tops = write_table(join_counted(held, least, "sig", "c", "home", "inner").groupBy("home").agg(
        F.min("top").alias("top"), F.count("*").alias("c")), "top")
    held = write_table(join_counted(held, tops, "home", "c", "sig", "inner")
                       .select("sig", F.col("top").alias("home")).distinct(), "shared")
    sizes = write_table(homes.groupBy("home").agg(F.count("*").alias("n")).join(tops.drop("c"), "home"), "sizes")
    parts = write_table(sizes.groupBy("top").agg(F.sum("n").alias("c")).select(
        F.col("top").alias("home"), F.ceil(F.col("c") / F.lit(CELL)).alias("parts"), "c"), "parts")
    members = join_counted(homes, sizes.withColumnRenamed("n", "c"), "home", "c", "doc_id", "inner")
    members = members.select("doc_id", F.col("top").alias("home"))
    placed = write_table(
        join_counted(members, parts, "home", "c", "doc_id", "inner").join(sets, "doc_id")
        .select("home", F.pmod(F.xxhash64("doc_id"), F.col("parts")).alias("part"), "doc_id", "tokens"), "placed")
    pairs = held.alias("x").join(held.alias("y"), "sig").filter("x.home < y.home").select(
        F.col("x.home").alias("h1"), F.col("y.home").alias("h2")).distinct()
    pairs = pairs.union(parts.filter("c > 1").select(F.col("home").alias("h1"), F.col("home").alias("h2")))
    cells = (pairs.join(parts.select(F.col("home").alias("h1"), F.col("parts").alias("p1")), "h1")
             .join(parts.select(F.col("home").alias("h2"), F.col("parts").alias("p2")), "h2")
             .withColumn("b1", F.explode(F.sequence(F.lit(0).cast("long"), F.col("p1") - 1)))
             .withColumn("b2", F.explode(F.sequence(F.lit(0).cast("long"), F.col("p2") - 1)))
             .filter("h1 < h2 OR b1 <= b2"))
    cells = write_table(cells.select("h1", "b1", "h2", "b2"), "cells")
    ends = cells.select(
        F.xxhash64("h1", "b1", "h2", "b2").alias("cell"),
        F.inline(F.array(F.struct(F.lit(0).alias("side"), F.col("h1").alias("home"), F.col("b1").alias("part")),
                         F.struct(F.when((F.col("h1") < F.col("h2")) | (F.col("b1") < F.col("b2")), 1).alias("side"),
                                  F.col("h2").alias("home"), F.col("b2").alias("part"))))).filter("side IS NOT NULL")
    # of the small cells many, of the large ones of a big group few go to a task
    tasks = max(1, homes.count() // 256, cells.count() // 16)
    rows = ends.join(placed, ["home", "part"]).select(
        F.pmod(F.xxhash64("cell"), F.lit(tasks)).alias("task"), "cell", "side", "doc_id", "tokens")
    return rows.groupBy("task").applyInArrow(_verify(percent), "u long, v long")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4,
               percent: int = 85, rare: int = RARE, classes: int = CLASSES, mark: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, and
    ``mark``, where one is given to tell rows of one id apart."""
    blocks, bits = X.layout(docs, text_col)
    marked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                         (F.lit(None) if mark is None else mark).cast("string").alias("mark")).withColumn("block", X.block_of(blocks))
    dealt = pick(docs, id_col, text_col).withColumn("block", X.block_of(blocks))

    def digest(batches):
        for b in batches:
            w = W.words(*W.utf8(b.column(1)), lower=True)
            d = [xxhash.xxh3_128_digest(w.hash[x:y].tobytes()) if y > x else None
                 for x, y in zip(w.first[:-1], w.first[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(d, pa.binary()), b.column(2), b.column(3)],
                                             ["doc_id", "digest", "mark", "block"])
        give_back()

    marks = write_table(marked.mapInArrow(digest, "doc_id long, digest binary, mark string, block long"), "digests")
    heads = write_table(
        marks.filter("digest IS NOT NULL").groupBy("digest")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "block")).alias("least"), F.count("*").alias("c"))
        .select("digest", "c", "least.doc_id", "least.block"), "copies")

    def own(left: pa.Table, right: pa.Table) -> list[tuple[int, bytes, np.ndarray]]:
        """The block's representatives: id, digest and set, once each."""
        wanted = {(_NO_ID if r["doc_id"] is None else r["doc_id"], r["digest"])
                  for r in right.to_pylist() if r["digest"] is not None}
        sets, digests = _sets(left, n)
        found = {}
        for d, g, s in zip(ids(left["doc_id"], _NO_ID).tolist(), digests, sets):
            if (d, g) in wanted:
                found.setdefault((d, g), (d, g, s))
        return list(found.values())

    def count(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        sets = [s for _, _, s in own(left, right)] if left.num_rows else []
        h = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        return pa.Table.from_pylist(list(X.cells(key[0].as_py(), h, bits)), schema=_CELLS)

    def sign(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        out = own(left, right) if left.num_rows else []
        slot, total = X.lookup(right.to_pylist(), bits)
        rows = []
        for d, g, s in out:
            at, found = X.find(slot, X.slots(s, bits))
            c = np.where(found, total[at], 1) if len(slot) else np.ones(len(s), np.uint32)
            sigs = signatures(s, c, percent, rare, classes)[:None if d != _NO_ID else 0]
            rows.append({"doc_id": d if d != _NO_ID else None, "digest": g, "n_shingles": len(s), "sigs": sigs.view(np.int64).tolist(),
                         "tokens": s.tobytes() if len(sigs) else None})
        return pa.Table.from_pylist(rows, schema=_SET_ROWS)

    by_block = dealt.groupBy("block")
    cells = by_block.cogroup(heads.select("block", "doc_id", "digest").groupBy("block")).applyInArrow(count, X.CELL)
    back = X.shared(cells).select("block", "rng", "lows", "counts", F.lit(None).cast("long").alias("doc_id"),
                                  F.lit(None).cast("binary").alias("digest"))
    both = back.unionByName(heads.select("block", "doc_id", "digest"), allowMissingColumns=True)
    sets = write_table(dealt.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(sign, _SETS), "sets")
    comp = components(_links(sets.select("doc_id", "sigs", "tokens"), percent))
    result = (heads.join(sets.select("digest", "n_shingles"), "digest", "left")
              .join(comp, F.col("doc_id") == F.col("node"), "left")
              .select("digest", "c", F.col("n_shingles"),
                      F.coalesce("component", "doc_id").alias("component_id")))
    result = write_table(result, "classes")
    out = join_counted(marks, result, "digest", "c", "doc_id")
    return out.select(
        "doc_id", *([] if mark is None else ["mark"]), F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


_CELLS = pa.schema([("rng", pa.int32()), ("block", pa.int64()), ("lows", pa.binary()), ("counts", pa.binary())])
_SET_ROWS = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n_shingles", pa.int64()),
                       ("sigs", pa.list_(pa.int64())), ("tokens", pa.binary())])

"""Lexical retrieval packing.

1. Texts become token ids, plus an end id; a batch adds one row of document
   frequencies.  Both are written once.
2. Document frequencies of the whole corpus are summed; their number is
   bounded by the vocabulary.
3. Documents are routed by what they hold into shards of about
   ``shard_tokens``: their BM25 weights, projected to ``ROUTE_DIM`` random
   directions, go down a tree of median splits that is grown on a bounded,
   hash-chosen sample; a leaf that cannot be split (copies, too few sampled
   documents) is dealt by a hash of the id.  A shard builds a BM25 inverted
   index (k1, b; corpus-wide frequencies and mean length).  Neighbours are
   searched inside the shard only; README gives the recall.
4. A seed fills windows; while a window has room, the unused document with
   the best score for the seed follows, cut where the window ends.  The
   document that was cut is the next seed.  Where no neighbour shares a
   term, the next unused document in id order follows.
5. What remains at a shard's end is cut into sequences whose lengths are the
   powers of two of its binary form, which need no padding.

Nulls and ties: a null text is empty, its only id is the end id.  Equal
scores go to the document that comes first in (id, null last, text) order.
Repeated rows are packed once per row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import pick, write_table
from starmart.llm.tokens import loaded

WINDOW = 2048
END_ID = 1
SHARD_TOKENS = 1 << 20
TERM_BLOCK = 1024  # posting lists added at a time
ROUTE_DIM, ROUTE_ROWS, ROUTE_LEAF = 64, 1 << 17, 16  # directions, sampled documents, fewest on a split node
K1, B = 1.2, 0.75
_TOKENS = "doc_id long, n long, ids binary, terms binary"
_PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, "
           "offset long, ids binary")


def tokenise(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n, ids) per document; rows without n hold term counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(path)
        wide = len(coder.ends) > 1 << 16
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids = [np.append(x, END_ID) for x in coder.encode(
                    part.column(1).cast(pa.binary()).fill_null(b"").to_pylist())]
                df = np.zeros(len(coder.ends), np.int64)
                for x in ids:
                    df[np.unique(x)] += 1
                terms = np.flatnonzero(df)
                kind = "<u4" if wide else "<u2"
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([x.astype(kind).tobytes() for x in ids], pa.binary()),
                     pa.nulls(len(ids), pa.binary())], ["doc_id", "n", "ids", "terms"])
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                     pa.array([terms.astype("<i8").tobytes()], pa.binary()),
                     pa.array([df[terms].astype("<i8").tobytes()], pa.binary())],
                    ["doc_id", "n", "ids", "terms"])

    return write_table(docs.mapInArrow(run, _TOKENS), "tokens")


def frequencies(tokens: DataFrame) -> dict[int, int]:
    """Document frequency by id; as many entries as the vocabulary at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for b in batches:
            for r in b.to_pylist():
                for t, c in zip(np.frombuffer(r["ids"], "<i8").tolist(), np.frombuffer(r["terms"], "<i8").tolist()):
                    total[t] = total.get(t, 0) + c
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())],
                                         ["term", "df"])

    rows = tokens.filter("n IS NULL").select("ids", "terms").mapInArrow(run, "term long, df long")
    return {r.term: r.df for r in rows.groupBy("term").agg(F.sum("df").alias("df")).collect()}


def bm25(ids: np.ndarray, idf: np.ndarray, mean: float) -> tuple[np.ndarray, np.ndarray]:
    """A document's terms and their weights."""
    term, tf = np.unique(ids, return_counts=True)
    return term, idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ids) / mean))


def directions(docs: list[np.ndarray], idf: np.ndarray, mean: float, axes: np.ndarray) -> np.ndarray:
    """Unit vectors of the projected BM25 weights."""
    x = np.zeros((len(docs), axes.shape[1]), np.float32)
    for i, d in enumerate(docs):
        term, weight = bm25(d, idf, mean)
        x[i] = weight.astype(np.float32) @ axes[term]
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


class Router:
    """Tree over ``directions`` whose leaves hold shares of the shards in
    proportion to the tokens of the sampled documents."""

    def __init__(self, x: np.ndarray, n: np.ndarray, shards: int, leaf_rows: int = ROUTE_LEAF):
        self.axis, self.cut, self.child, self.first, self.shards = [], [], [], [], []
        todo, dealt = [(np.arange(len(x)), shards, -1, 0)], 0
        while todo:
            rows, k, parent, side = todo.pop()
            me = len(self.cut)
            if parent >= 0:
                self.child[parent][side] = me
            split = None
            if k > 1 and len(rows) >= 2 * leaf_rows:
                y = x[rows] - x[rows].mean(0)
                axis = np.linalg.eigh(y.T @ y)[1][:, -1]
                p = x[rows] @ axis
                by = np.argsort(p, kind="stable")
                p, tokens = p[by], np.cumsum(n[rows[by]])
                ends = np.flatnonzero(p[1:] - p[:-1] > 1e-5)  # copies stay together
                if len(ends):
                    at = ends[np.argmin(np.abs(tokens[ends] - tokens[-1] / 2))]
                    split = axis, (p[at] + p[at + 1]) / 2, by[:at + 1], by[at + 1:]
                    left = min(max(1, round(k * tokens[at] / tokens[-1])), k - 1)
            self.child.append([0, 0])
            self.first.append(dealt)
            self.shards.append(k)
            self.axis.append(split[0] if split else np.zeros(x.shape[1], np.float32))
            self.cut.append(split[1] if split else 0.0)
            if split:
                todo += [(rows[split[3]], k - left, me, 1), (rows[split[2]], left, me, 0)]
            else:
                dealt += k
        self.axis, self.cut = np.array(self.axis, np.float32), np.array(self.cut, np.float32)
        self.child, self.first, self.shards = np.array(self.child), np.array(self.first), np.array(self.shards)

    def route(self, x: np.ndarray, deal: np.ndarray) -> np.ndarray:
        """Shards of vectors; ``deal`` holds non-negative hashes."""
        node = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(self.child[node, 0] > 0)
            if not len(inner):
                return self.first[node] + deal % self.shards[node]
            at = node[inner]
            high = (x[inner] * self.axis[at]).sum(1) > self.cut[at]
            node[inner] = self.child[at, high.astype(np.int64)]


class Index:
    """BM25 inverted index of one shard."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float, term_block: int = TERM_BLOCK):
        parts = [bm25(d, idf, mean) for d in docs]
        n = np.array([len(p[0]) for p in parts])
        term = np.concatenate([p[0] for p in parts]).astype(np.int64)
        weight = np.concatenate([p[1] for p in parts])
        doc = np.repeat(np.arange(len(docs)), n)
        order = np.argsort(term, kind="stable")
        self.doc, self.weight, self.size, self.block = doc[order], weight[order], len(docs), term_block
        self.first = np.searchsorted(term[order], np.arange(len(idf) + 1))
        here = np.diff(self.first)
        finds = here[term] > 1  # terms of no other document find nothing
        ends = np.cumsum(n)
        self.query = [term[a:b][finds[a:b]] for a, b in zip(ends - n, ends)]

    def drop(self, unused: np.ndarray) -> None:
        """Forget the postings of used documents; they score 0 from here on."""
        keep = unused[self.doc]
        self.first = np.r_[0, np.cumsum(keep)][self.first]
        self.doc, self.weight = self.doc[keep], self.weight[keep]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 scores of the documents for all terms of the seed."""
        total, query = np.zeros(self.size), self.query[seed]
        query = query[self.first[query + 1] > self.first[query]]
        for at in range(0, len(query), self.block):
            start, end = self.first[query[at:at + self.block]], self.first[query[at:at + self.block] + 1]
            ends = np.cumsum(end - start)
            place = np.repeat(end - ends, end - start) + np.arange(ends[-1])  # in the lists, one after another
            total += np.bincount(self.doc[place], self.weight[place], self.size)
        return total


def arrange(docs: list[np.ndarray], index: Index, window: int) -> Iterator[int]:
    """The order in which the documents of a shard follow each other."""
    unused = np.ones(len(docs), bool)
    following, room, left = 0, 0, len(docs)
    held = left  # documents whose postings the index still holds
    scores = None
    for _ in range(len(docs)):
        if scores is None:
            best = -1
        else:
            best = int(np.argmax(scores))
            if scores[best] <= 0:
                best = -1
        if best < 0:
            while not unused[following]:
                following += 1
            best = following
            room = room or window
        unused[best] = False
        left -= 1
        if left < 0.8 * held:
            index.drop(unused)
            held = left
        yield best
        if len(docs[best]) >= room or scores is None:  # cut here: it seeds what follows
            room = (room - len(docs[best])) % window
            scores = np.where(unused, index.scores(best), 0) if room else None
        else:
            room -= len(docs[best])
            scores[best] = 0


def sequences(total: int, window: int) -> Iterator[int]:
    """Lengths of a shard's sequences: full ones, then powers of two."""
    for _ in range(total // window):
        yield window
    for bit in reversed(range(window.bit_length())):
        if (total % window) >> bit & 1:
            yield 1 << bit


def _axes(terms: int) -> np.ndarray:
    return np.random.default_rng(11).normal(size=(terms, ROUTE_DIM)).astype(np.float32)


def router(rows: DataFrame, count: int, shards: int, idf: np.ndarray, mean: float, kind: str) -> Router:
    """The tree, grown on about ``ROUTE_ROWS`` rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes = _axes(len(idf))
        for b in batches:
            ids = [np.frombuffer(x, kind) for x in b.column(2).to_pylist()]
            x = directions(ids, idf, mean, axes)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(d) for d in ids], pa.int64()),
                 pa.array([v.astype("<f4").tobytes() for v in x], pa.binary())], ["deal", "n", "x"])

    share = min(1.0, ROUTE_ROWS / max(count, 1))
    few = rows.filter(F.pmod(F.xxhash64("deal", F.lit(17)), F.lit(1 << 31)) < int(share * (1 << 31)))
    got = few.mapInArrow(run, "deal long, n long, x binary").toArrow()
    x = np.frombuffer(b"".join(got["x"].to_pylist()), "<f4").reshape(-1, ROUTE_DIM)
    deal, n = got["deal"].to_numpy(), got["n"].to_numpy()
    by = np.lexsort((n, deal))  # the same tree whatever order the rows come in
    return Router(x[by], n[by], shards)


def routed(rows: DataFrame, tree: Router, idf: np.ndarray, mean: float, kind: str) -> DataFrame:
    """(shard, doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes = _axes(len(idf))
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                x = directions([np.frombuffer(d, kind) for d in part.column(2).to_pylist()], idf, mean, axes)
                shard = tree.route(x, part.column(0).to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), part.column(1), part.column(2)],
                                                 ["shard", "doc_id", "ids"])

    return rows.mapInArrow(run, "shard long, doc_id long, ids binary")


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         shard_tokens: int = SHARD_TOKENS, term_block: int = TERM_BLOCK) -> DataFrame:
    """Pieces: doc_id, start, length, doc_tokens, sequence_id, offset and ids
    (little-endian unsigned 32-bit)."""
    tokens = tokenise(pick(docs, id_col, text_col), tokenizer)
    wide = len(loaded(tokenizer).ends) > 1 << 16
    size = tokens.filter("n IS NOT NULL").agg(F.sum("n"), F.count("*")).first()
    total, count = size[0] or 0, size[1]
    idf = np.zeros(len(loaded(tokenizer).ends))
    for t, df in frequencies(tokens).items():
        idf[t] = np.log1p((count - df + 0.5) / (df + 0.5))
    mean = total / max(count, 1)
    shards = max(1, -(-total // shard_tokens))
    kind = "<u4" if wide else "<u2"
    hashed = F.xxhash64(F.coalesce("doc_id", F.xxhash64("ids")))
    rows = tokens.filter("n IS NOT NULL").select(F.pmod(hashed, F.lit(1 << 62)).alias("deal"), "doc_id", "ids")
    if shards > 1:
        rows = routed(rows, router(rows, count, shards, idf, mean, kind), idf, mean, kind)
    else:
        rows = rows.withColumn("shard", F.lit(0).cast("long")).select("shard", "doc_id", "ids")

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["doc_id"].to_pylist(), table["ids"].to_pylist()),
                      key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        ids = [np.frombuffer(r[1], kind) for r in rows]
        out: list[tuple] = []
        lengths = sequences(sum(map(len, ids)), window)
        sequence, offset, room = key[0].as_py() << 32, 0, next(lengths)
        for d in arrange(ids, Index(ids, idf, mean, term_block), window):
            start = 0
            while start < len(ids[d]):
                n = min(room - offset, len(ids[d]) - start)
                out.append((rows[d][0], start, n, len(ids[d]), sequence, offset,
                            ids[d][start:start + n].astype("<u4").tobytes()))
                start, offset = start + n, offset + n
                if offset == room:
                    sequence, offset, room = sequence + 1, 0, next(lengths, 0)
        names = ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")
        return pa.table([pa.array(c, pa.int64()) for c in list(zip(*out))[:6]]
                        + [pa.array([r[6] for r in out], pa.binary())], [*names, "ids"])

    return rows.groupBy("shard").applyInArrow(run, _PIECES)

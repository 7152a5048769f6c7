"""Substring deduplication with difference-cover anchors.

A window is ``window`` consecutive words of one document.  A word goes when a
window that covers it also starts in a document with a smaller id.

1. Anchors.  Every position p of a document with p mod ``period`` in the
   difference cover hashes the ``window - period + 1`` words from there.  For
   any two offsets the cover has an aligned pair within one period, so two
   equal windows always share an anchor at the same place of both.  Only
   3/7 of all positions are hashed for (7; 0, 1, 3).
2. ``exchange.shared`` finds the anchors that the corpus holds twice.
3. Extension: each window around a shared anchor, and no other, is hashed in
   full; the reducer of its hash range finds the smallest id that holds it.
4. Documents drop the words covered by a window with a smaller id elsewhere.

Steps 1, 3 and 4 read the same shuffle of the texts by block, which Spark
reuses within the one plan.  No pairs, no collected links: a passage in a
third of all documents is one row per block in one hash range.

Nulls and ties: a null text has no words.  A null id counts as larger than
every id.  Rows with equal ids take nothing from each other.  Repeated rows
stay.  Texts under ``window`` words are kept as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm import exchange as X
from starmart.llm import words as W
from starmart.llm.common import give_back, ids, pick

WINDOW = 13
PERIOD, COVER = 7, (0, 1, 3)
_LAST = np.iinfo(np.int64).max  # stands for a null id
_WINDOWS = "rng int, block long, payload binary"


def covers(period: int, cover: tuple[int, ...]) -> bool:
    """Whether every difference modulo ``period`` occurs in ``cover``."""
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


def _anchors(w: W.Words, size: int, period: int, cover: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors that fit into their text, and their hashes."""
    fits = np.flatnonzero(W.inside(w, size))
    place = fits - np.repeat(w.first[:-1], np.diff(w.first))[fits]
    at = fits[np.isin(place % period, cover)]
    return at, W.windows(w.hash, size)[at]


def _payload(h: np.ndarray, doc: np.ndarray, many: np.ndarray) -> bytes:
    parts = h.astype("<u8").tobytes() + doc.astype("<i8").tobytes() + many.astype(np.uint8).tobytes()
    return len(h).to_bytes(4, "little") + pa.compress(parts, codec="zstd", asbytes=True)


def _payload_of(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:4], "little")
    raw = pa.decompress(blob[4:], n * 17, codec="zstd", asbytes=True)
    return (np.frombuffer(raw, "<u8", n), np.frombuffer(raw, "<i8", n, n * 8),
            np.frombuffer(raw, np.uint8, n, n * 16).astype(bool))


def _window_cells(block: int, h: np.ndarray, doc: np.ndarray, bits: int) -> list[dict]:
    """Per range: each hash, its smallest id, whether two ids hold it."""
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    new = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    last = np.r_[new[1:], len(h)] - 1 if len(new) else new
    h, low, many = h[new], doc[new], doc[new] != doc[last]
    rng = X.split(h, bits)[0]
    cut = np.flatnonzero(np.r_[True, rng[1:] != rng[:-1]]) if len(h) else []
    return [{"rng": int(rng[a]), "block": block, "payload": _payload(h[a:b], low[a:b], many[a:b])}
            for a, b in zip(cut, np.r_[cut[1:], len(h)] if len(cut) else [])]


def _smallest(table: pa.Table) -> pa.Table:
    """One range: back to each block, the smallest id of its hashes that
    occur in a second document."""
    rows = table.to_pylist()
    parts = [_payload_of(r["payload"]) for r in rows]
    h, doc, many = (np.concatenate(x) for x in zip(*parts))
    src = np.repeat(np.arange(len(rows)), [len(p[0]) for p in parts])
    order = np.lexsort((doc, h))
    h, doc, many, src = h[order], doc[order], many[order], src[order]
    new = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    runs = np.diff(np.r_[new, len(h)])
    low = np.repeat(doc[new], runs)
    twice = np.repeat(np.logical_or.reduceat(many, new) | (runs > 1), runs)
    out = []
    h, low, src = h[twice], low[twice], src[twice]
    back = np.argsort(src, kind="stable")
    h, low, src = h[back], low[back], src[back]
    cut = np.flatnonzero(np.r_[True, src[1:] != src[:-1]]) if len(src) else []
    for a, b in zip(cut, np.r_[cut[1:], len(src)] if len(cut) else []):
        r = rows[src[a]]
        out.append({"rng": r["rng"], "block": r["block"],
                    "payload": _payload(h[a:b], low[a:b], np.zeros(b - a, bool))})
    return pa.Table.from_pylist(out, schema=pa.schema(
        [("rng", pa.int32()), ("block", pa.int64()), ("payload", pa.binary())]))


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     window: int = WINDOW, period: int = PERIOD, cover: tuple[int, ...] = COVER,
                     as_words: bool = True) -> DataFrame:
    """The rows of ``docs``, with _n_words and _n_removed, and in the text the
    kept words joined by one space.  Without ``as_words`` a text that loses
    nothing stays as it is.  Other columns are carried along."""
    return dedup_rows(docs, id_col, text_col, window, period, cover, as_words).select(
        "row.*", F.col("n_words").alias("_n_words"), F.col("n_removed").alias("_n_removed"))


def dedup_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               window: int = WINDOW, period: int = PERIOD, cover: tuple[int, ...] = COVER,
               as_words: bool = True) -> DataFrame:
    """As ``dedup_substrings``, the rows in the struct ``row``, beside n_words
    and n_removed: the caller's columns may have any names."""
    if not covers(period, cover) or period > window:
        raise ValueError("cover must hold every difference modulo a period within the window")
    size = window - period + 1
    blocks, bits = X.layout(docs, text_col)
    dealt = pick(docs, id_col, text_col).withColumn("block", X.block_of(blocks))
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    if rest:  # under names that cannot clash
        dealt = docs.select(
            F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
            *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(rest)]).withColumn("block", X.block_of(blocks))
    kinds = [dealt.schema[f"_c{i}"].dataType.simpleString() for i in range(len(rest))]
    kept = ", ".join(["doc_id long, text string", *[f"_c{i} {k}" for i, k in enumerate(kinds)],
                      "_n_words long, _n_removed long"])

    def anchors(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        w = W.words(*W.utf8(table["text"]))
        at, h = _anchors(w, size, period, cover)
        owner = ids(table["doc_id"], _LAST)[w.doc()[at]]
        order = np.lexsort((owner, h))
        h, owner = h[order], owner[order]
        once = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])] if len(h) else np.zeros(0, bool)
        return pa.Table.from_pylist(list(X.cells(key[0].as_py(), h[once], bits)), schema=CELLS)

    def candidates(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.Table.from_pylist([], schema=WINDOWS)
        w = W.words(*W.utf8(left["text"]))
        at, h = _anchors(w, size, period, cover)
        seen = X.find(X.lookup(right.to_pylist(), bits)[0], X.slots(h, bits))[1]
        hit = np.zeros(len(w.hash) + period + 1, np.int32)
        hit[at[seen] + 1] = 1
        hit = np.cumsum(hit)
        s = np.flatnonzero(W.inside(w, window))
        s = s[hit[s + period] > hit[s]]  # an anchor begins at s .. s + period - 1
        owner = ids(left["doc_id"], _LAST)[w.doc()[s]]
        rows = _window_cells(key[0].as_py(), W.windows(w.hash, window)[s], owner, bits)
        return pa.Table.from_pylist(rows, schema=WINDOWS)

    def keep(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        w = W.words(*W.utf8(left["text"]))
        doc, owner = w.doc(), ids(left["doc_id"], _LAST)
        gone = np.zeros(len(w.hash) + 1, np.int64)
        parts = [_payload_of(r["payload"]) for r in right.to_pylist()]
        if parts and left.num_rows:
            h, low = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            order = np.argsort(h)
            h, low = h[order], low[order]
            s = np.flatnonzero(W.inside(w, window))
            at, found = X.find(h, W.windows(w.hash, window)[s])
            s = s[found][low[at[found]] < owner[doc[s[found]]]]
            np.add.at(gone, s, 1)
            np.add.at(gone, s + window, -1)
        gone = np.cumsum(gone[:-1]) > 0
        texts, removed = [], np.zeros(left.num_rows, np.int64)
        np.add.at(removed, doc[gone], 1)
        for i, t in enumerate(left["text"].to_pylist()):
            if not removed[i] and not as_words:
                texts.append(t)
                continue
            own = (t or "").encode().split()
            if removed[i]:
                a = w.first[i]
                own = [x for x, g in zip(own, gone[a:a + len(own)]) if not g]
            texts.append(b" ".join(own).decode())
        give_back()
        return pa.table({"doc_id": left["doc_id"], "text": pa.array(texts, pa.string()),
                         **{f"_c{i}": left[f"_c{i}"] for i in range(len(rest))},
                         "_n_words": pa.array(np.diff(w.first)), "_n_removed": pa.array(removed)})

    by_block = dealt.groupBy("block")
    shared = X.shared(by_block.applyInArrow(anchors, X.CELL))
    found = by_block.cogroup(shared.groupBy("block")).applyInArrow(candidates, _WINDOWS)
    smallest = found.groupBy("rng").applyInArrow(_smallest, _WINDOWS)
    out = dealt.groupBy("block").cogroup(smallest.groupBy("block")).applyInArrow(keep, kept)
    own = {id_col: "doc_id", text_col: "text", **{c: f"_c{i}" for i, c in enumerate(rest)}}
    return out.select(F.struct(*[F.col(own[c]).alias(c) for c in docs.columns]).alias("row"),
                      F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"))


CELLS = pa.schema([("rng", pa.int32()), ("block", pa.int64()), ("lows", pa.binary()), ("counts", pa.binary())])
WINDOWS = pa.schema([("rng", pa.int32()), ("block", pa.int64()), ("payload", pa.binary())])

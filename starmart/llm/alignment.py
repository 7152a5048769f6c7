"""Alignment of the tokens of two tokenizers over the same texts.

A is a byte-level BPE (``tokenizers`` file) of space + text, B a SentencePiece
BPE with byte fallback of text, which adds that space.  A token's bytes are
its vocabulary entry's.  The cumulative ends of both token lists go into
end-to-index dictionaries; the ends both hold, sorted, slice the two id lists
into groups, and each slice is expanded into links: the A-B occurrences whose
byte ranges overlap.

No token of either crosses a space that follows an ASCII character other than
white space, or a two-byte letter: a text's alignment is that of the parts
between such spaces in a row.  Each distinct part is encoded and aligned once
per worker while its table lasts (parts are known by a 64-bit hash).

On Spark: ``align`` deals each partition's texts into blocks of bounded bytes
and writes one row per text.  A block's first row also lists the block's
distinct id pairs with the number of its texts that hold each.
``link_counts`` adds these lists up by pair, finds each A id's highest count,
and brings a block only the counts of its own pairs.  A pair has at most one
row per block, so no key is hot, however often its tokens occur.

Nulls and ties: a null or empty text, and one whose joined token bytes of A
or B differ from space + text (U+2581 reads as a space in B), has no tokens:
all counts 0, ``groups`` ''.  Repeated rows and ids are texts of their own;
null ids stay null.  Pairs with equal counts are all highest.  Empty tables
give no rows.  Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm import words as W
from starmart.llm.common import give_back, pick, write_table
from starmart.llm.exchange import find
from starmart.session import scratch_path

BLOCK_BYTES = 4 << 20  # text per block; a longer text is a block of its own
TABLE_PARTS = 1 << 19  # distinct parts a worker keeps

_ALIGNED = pa.schema([
    ("key", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.binary()), ("block", pa.int64()),
    ("pairs", pa.binary()), ("times", pa.binary()),
    ("block_pairs", pa.list_(pa.int64())), ("block_docs", pa.list_(pa.int64()))])
_DDL = ("key long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups binary, block long, "
        "pairs binary, times binary, block_pairs array<long>, block_docs array<long>")


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable Latin-1 bytes stand for themselves, the others in order for the
    characters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(other)}}


def slices(ends_a: list[int], ends_b: list[int]) -> np.ndarray:
    """For each end that both lists hold, in order: how many tokens of A and
    of B end there or before."""
    at_a = dict(zip(ends_a, range(1, len(ends_a) + 1)))
    at_b = dict(zip(ends_b, range(1, len(ends_b) + 1)))
    common = sorted(at_a.keys() & at_b.keys())
    return np.array([[at_a[e] for e in common], [at_b[e] for e in common]], np.int64)


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slices' overlapping tokens, as indices, and the byte where each
    overlap ends: the bytes up to an end of either list, from the end before
    it, are of one token of A and one of B."""
    ends = np.unique(np.concatenate([ends_a, ends_b]))
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends), ends


def digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of the numbers below ``size``, with room for a mark
    after them, and their lengths."""
    text = [str(i).encode() for i in range(size)]
    width = max(map(len, text)) + 1
    table = np.frombuffer(b"".join(t.ljust(width) for t in text), np.uint8).reshape(-1, width)
    return table, np.array([len(t) for t in text])


def cut_parts(raw: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where the parts of texts begin: at each text's first byte (a space) and
    at spaces after printable ASCII or a two-byte character other than
    U+0080 to U+00BF, which holds white space."""
    start = np.zeros(len(raw), bool)
    if len(raw) > 1:
        before, now = raw[:-1], raw[1:] == 32
        start[1:] = now & (before > 32) & (before < 127)
        start[2:] |= now[1:] & (raw[1:-1] >= 128) & (raw[:-2] >= 0xC3) & (raw[:-2] <= 0xDF)
    start[firsts] = True
    return np.flatnonzero(start)


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; spans are in order and do not overlap."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):  # pieces of about 1 MB bound the temporaries
        j = max(i + 1, int(np.searchsorted(end, start[i] + (1 << 20), "right")))
        a, b = start[i], end[j - 1]
        up, down = W._powers(W._P, int(b - a))
        run = np.zeros(b - a + 1, np.uint64)
        np.cumsum(W._BYTE[raw[a:b]] * up[:b - a], out=run[1:])
        s, e = start[i:j] - a, end[i:j] - a
        out[i:j] = W.mix((run[e] - run[s]) * down[s] ^ (e - s).astype(np.uint64) * W.U(0x9E3779B97F4A7C15))
        i = j
    return out


class Aligner:
    """Both tokenizers and the table of aligned parts."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        if self.a.normalizer is not None:
            raise ValueError("A must not normalise")
        of = byte_characters()
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            self.bytes_a[i] = bytes(of[c] for c in piece)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("B must not join words")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.length_a, self.length_b = (np.array([len(x) for x in of]) for of in (self.bytes_a, self.bytes_b))
        self.digits = digits(max(len(self.bytes_a), len(self.bytes_b)))
        self.lead = len(self.b.encode("x"))  # tokens of the space and letter put before a part
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)  # hashes of parts, sorted
        self.place = np.zeros(0, np.int64)  # and where the parts stand in the lists below
        self.text: list[bytes] = []  # the part's groups as text
        self.counts = np.zeros((1 << 16, 4), np.int32)  # tokens of A and B, groups, links; 0 when its bytes differ
        self.first = np.zeros(1 << 16, np.int64)  # of its links
        self.linked = np.zeros(1 << 18, np.int32)  # pair numbers
        self.filled = 0
        self.pair_number: dict[int, int] = {}

    def _learn(self, parts: list[bytes]) -> None:
        """Encode and align new parts, all of them end to end."""
        texts = [p.decode() for p in parts]
        ids_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        ids_b = [x[self.lead:] for x in self.b.encode(["x" + t for t in texts], num_threads=1)]
        for i, part in enumerate(parts):
            if b"".join([self.bytes_a[t] for t in ids_a[i]]) != part or b"".join([self.bytes_b[t] for t in ids_b[i]]) != part:
                ids_a[i] = ids_b[i] = []
        counts = np.zeros((len(parts), 4), np.int32)
        counts[:, 0], counts[:, 1] = [len(x) for x in ids_a], [len(x) for x in ids_b]
        a = np.fromiter(chain.from_iterable(ids_a), np.int64)
        b = np.fromiter(chain.from_iterable(ids_b), np.int64)
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        to = np.cumsum([len(p) if x else 0 for p, x in zip(parts, ids_a)])  # where the parts end
        cut_a, cut_b = slices(ends_a.tolist(), ends_b.tolist())
        counts[:, 2] = np.diff(np.searchsorted(ends_a[cut_a - 1], to, "right"), prepend=0)
        i, j, ends = links(ends_a, ends_b)
        counts[:, 3] = np.diff(np.searchsorted(ends, to, "right"), prepend=0)
        pairs, pair = np.unique(a[i] << 32 | b[j], return_inverse=True)
        numbers = np.array([self.pair_number.setdefault(p, len(self.pair_number)) for p in pairs.tolist()], np.int32)
        # the groups as text: ids of A, then of B, each with the mark that follows it
        group_a, group_b = (np.searchsorted(c, np.arange(len(x)), "right") for c, x in ((cut_a, a), (cut_b, b)))
        place = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        rows = np.concatenate([self.digits[0][a], self.digits[0][b]])
        size = np.concatenate([self.digits[1][a], self.digits[1][b]])
        mark = np.full(len(rows), ord(","), np.uint8)
        mark[cut_a - 1], mark[len(a) + cut_b - 1] = ord("|"), ord(";")
        rows[np.arange(len(rows)), size] = mark
        rows, size = rows[place], size[place]
        blob = rows[np.arange(rows.shape[1]) <= size[:, None]].tobytes()
        at = np.r_[0, np.cumsum(size + 1)][np.r_[0, np.cumsum(counts[:, 0] + counts[:, 1])]].tolist()
        self.text += [blob[x:max(x, y - 1)] for x, y in zip(at, at[1:])]
        k, n, first = len(self.text) - len(parts), len(pair), self.filled
        while k + len(parts) > len(self.first):
            self.first = np.concatenate([self.first, self.first])
            self.counts = np.concatenate([self.counts, self.counts])
        while first + n > len(self.linked):
            self.linked = np.concatenate([self.linked, self.linked])
        self.counts[k:k + len(parts)] = counts
        self.first[k:k + len(parts)] = first + np.cumsum(counts[:, 3]) - counts[:, 3]
        self.linked[first:first + n] = numbers[pair] if n else pair
        self.filled += n

    def block(self, raws: list[bytes]) -> dict[str, list | np.ndarray]:
        """Columns for the texts (each with its space before it; b"" for none)
        of one block, and the block's pairs."""
        if len(self.text) > TABLE_PARTS:
            self._clear()
        raw = np.frombuffer(b"".join(raws), np.uint8)
        size = np.array([len(r) for r in raws], np.int64)
        to = np.cumsum(size)
        start = cut_parts(raw, (to - size)[size > 0]) if len(raw) else np.zeros(0, np.int64)
        end = np.r_[start[1:], len(raw)] if len(start) else start
        distinct, at, part = np.unique(span_hashes(raw, start, end), return_index=True, return_inverse=True)
        new = np.flatnonzero(~find(self.known, distinct)[1])
        if len(new):
            places = np.arange(len(self.text), len(self.text) + len(new))
            for k in range(0, len(new), 4096):
                some = at[new[k:k + 4096]]
                self._learn([raw[a:b].tobytes() for a, b in zip(start[some], end[some])])
            known = np.concatenate([self.known, distinct[new]])
            order = np.argsort(known, kind="stable")
            self.known, self.place = known[order], np.concatenate([self.place, places])[order]
        code = self.place[find(self.known, distinct)[0]][part]
        doc = np.searchsorted(to, start, "right")  # the text that a part belongs to
        good = np.ones(len(raws), bool)
        good[doc[self.counts[code, 0] == 0]] = False
        code, doc = code[good[doc]], doc[good[doc]]
        counts = np.zeros((len(raws), 4), np.int64)
        for c in range(4):
            counts[:, c] = np.bincount(doc, self.counts[code, c], len(raws))
        n = self.counts[code, 3].astype(np.int64)
        run = np.cumsum(n)
        pair = self.linked[np.repeat(self.first[code] - run + n, n) + np.arange(run[-1] if len(run) else 0)]
        used = np.zeros(len(self.pair_number), bool)
        used[pair] = True
        local = np.cumsum(used) - 1  # the pairs of this block, numbered
        width = max(1, int(used.sum()))
        held, times = np.unique(np.repeat(doc, n) * width + local[pair], return_counts=True)
        of_doc, held = held // width, held % width
        borders = np.searchsorted(of_doc, np.arange(len(raws) + 1))
        text = self.text
        cut = np.searchsorted(doc, np.arange(len(raws) + 1))
        codes = code.tolist()
        keys_of = np.fromiter(self.pair_number, np.int64, len(self.pair_number))
        return {"counts": counts,
                "groups": [b";".join([text[c] for c in codes[x:y]]) for x, y in zip(cut, cut[1:])],
                "pairs": [held[x:y].astype("<u4").tobytes() for x, y in zip(borders, borders[1:])],
                "times": [times[x:y].astype("<u4").tobytes() for x, y in zip(borders, borders[1:])],
                "block_pairs": keys_of[used], "block_docs": np.bincount(held, minlength=int(used.sum()))}


_LOADED: dict[tuple[str, str], Aligner] = {}


def loaded(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner, loaded once."""
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Aligner(path_a, path_b)
    return _LOADED[path_a, path_b]


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Written table with a row per text: a ``key`` of its own, doc_id, n_a,
    n_b, n_groups, n_links, ``groups`` (UTF-8 ``a1,a2|b1;a3|b2,b3``: ids of A
    and B per group), and what ``link_counts`` reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = loaded(path_a, path_b)
        part = TaskContext.get().partitionId()
        rows = blocks = 0

        def close(ids: list, raws: list[bytes]) -> pa.RecordBatch:
            nonlocal rows, blocks
            out = aligner.block(raws)
            n, counts = len(ids), out["counts"]
            once = [out["block_pairs"]], [out["block_docs"]]
            columns = [pa.array((part << 40) + rows + np.arange(n)), pa.array(ids, pa.int64()),
                       *[pa.array(counts[:, c]) for c in range(4)], pa.array(out["groups"], pa.binary()),
                       pa.array(np.full(n, (part << 32) + blocks)), pa.array(out["pairs"], pa.binary()),
                       pa.array(out["times"], pa.binary()),
                       *[pa.array(x + [None] * (n - 1), pa.list_(pa.int64())) for x in once]]
            rows, blocks = rows + n, blocks + 1
            return pa.RecordBatch.from_arrays(columns, schema=_ALIGNED)

        ids: list = []
        raws: list[bytes] = []
        size = 0
        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1)):
                raw = text.as_py()
                raw = b" " + raw if raw else b""
                if ids and size + len(raw) > block_bytes:
                    yield close(ids, raws)
                    ids, raws, size = [], [], 0
                ids.append(i.as_py())
                raws.append(raw)
                size += len(raw)
        if ids:
            yield close(ids, raws)
        give_back()

    texts = pick(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary"))
    path = scratch_path(docs.sparkSession, "aligned")
    texts.mapInArrow(run, _DDL).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def link_counts(aligned: DataFrame) -> DataFrame:
    """(key, n_best, count_sum) per text of ``align``.  A link's count is the
    number of texts that hold its id pair; ``n_best`` are the links whose
    count is the highest of their A id, ``count_sum`` adds up all counts."""
    listed = aligned.filter("block_pairs IS NOT NULL").select(
        "block", F.posexplode(F.arrays_zip("block_pairs", "block_docs")).alias("place", "entry"))
    entries = listed.select("block", "place", F.col("entry.block_pairs").alias("pair"),
                            F.col("entry.block_docs").alias("docs"))
    totals = write_table(entries.groupBy("pair").agg(F.sum("docs").alias("n"))
                         .withColumn("a", F.shiftright("pair", 32)), "pair_totals")
    top = totals.groupBy("a").agg(F.max("n").alias("top"))
    pairs = totals.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    found = entries.join(pairs, "pair").select(F.col("block").alias("of_block"), "place", "n", "best")

    def run(texts: pa.Table, counts: pa.Table) -> pa.Table:
        place = counts["place"].to_numpy()
        n, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        n[place], best[place] = counts["n"].to_numpy(), counts["best"].to_numpy()
        sums, bests = [], []
        for p, t in zip(texts["pairs"], texts["times"]):
            at, times = np.frombuffer(p.as_py(), "<u4"), np.frombuffer(t.as_py(), "<u4").astype(np.int64)
            sums.append(int(times @ n[at]))
            bests.append(int(times @ best[at]))
        return pa.table({"key": texts["key"], "n_best": pa.array(bests, pa.int64()),
                         "count_sum": pa.array(sums, pa.int64())})

    texts = aligned.select("key", "block", "pairs", "times")
    return texts.groupBy("block").cogroup(found.groupBy("of_block")).applyInArrow(
        run, "key long, n_best long, count_sum long")

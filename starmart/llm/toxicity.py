"""Character n-gram linear classifier scaled by naive Bayes log-count ratios.

1. A bounded, hash-chosen sample of labelled texts (``fit_rows``) is written.
2. Spark counts, per class, in how many texts each hashed n-gram (3 to 6
   characters, lower case, runs of white space as one blank) occurs; the log-count ratio r of
   an n-gram and its standard error give a z-score, and the n-grams with
   |z| >= ``min_z`` are the features, all of them unless ``max_features``
   is given.
3. Logistic regression on r times presence, in numpy by blocks of rows; the
   driver holds four bytes per feature present in a sampled text.
4. Every whole text is scored in batches.

Nulls and ties: null and empty texts score as texts without features.  Null
labels and ids teach nothing.  Without labels of both classes every score is
the share of label 1, or 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import pick
from starmart.llm.sample import labelled_texts
from starmart.llm.words import U

FIT_ROWS = 20_000
SIZES = (3, 4, 5, 6)
BITS = 20  # of hashed n-grams
CHUNK = 1 << 14  # n-grams per counting group
MIN_Z = 4.0
_STEP = U(0x9E3779B97F4A7C15)
_BLANK = re.compile(r"\s+")
_SLICE = 1 << 20  # characters handled at a time
_PART = 1 << 20  # present features handled at a time


def _runs(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about a slice each."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j] or "") <= _SLICE):
            size += len(texts[j] or "")
            j += 1
        yield i, j
        i = j


def grams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size, (text index, hashed n-gram) of every position."""
    text = [" " + _BLANK.sub(" ", (t or "").lower()) + " " for t in texts]
    code = np.frombuffer("".join(text).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = np.array([len(t) for t in text])
    end = np.repeat(np.cumsum(length), length)
    doc = np.repeat(np.arange(len(text)), length)
    place = np.arange(len(code))
    h = np.zeros(len(code), np.uint64)
    for n in range(1, max(SIZES) + 1):
        m = len(code) - n + 1
        if m <= 0:
            return
        h = (h[:m] + code[n - 1:]) * _STEP
        h ^= h >> U(29)
        if n in SIZES:
            fits = place[:m] + n <= end[:m]
            yield doc[:m][fits], (h[fits] * U(0xBF58476D1CE4E5B9) >> U(64 - BITS)).astype(np.int64)


def present(texts: list[str | None], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, n-gram) among the wanted n-grams."""
    docs, found = [], []
    for d, g in grams(texts):
        use = wanted[g]
        docs.append(d[use])
        found.append(g[use])
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.unique((np.concatenate(docs) << BITS) | np.concatenate(found))
    return key >> BITS, key & ((1 << BITS) - 1)


@dataclass
class Model:
    feature: np.ndarray  # hashed n-grams
    weight: np.ndarray  # ratio times coefficient
    bias: float

    def scorer(self):
        dense = np.zeros(1 << BITS)
        dense[self.feature] = self.weight
        wanted = dense != 0

        def score(texts: list[str | None]) -> np.ndarray:
            out = np.empty(len(texts))
            for i, j in _runs(texts):
                d, g = present(texts[i:j], wanted)
                out[i:j] = self.bias + np.bincount(d, dense[g], j - i)
            return 1 / (1 + np.exp(-np.clip(out, -500, 500)))

        return score


def _ratios(sample: DataFrame, ones: int, zeros: int, min_z: float, limit: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The features and their log-count ratios."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << BITS), np.uint32)
        everything = np.ones(1 << BITS, bool)
        for b in batches:
            texts, y = b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False)
            for i, j in _runs(texts):
                d, g = present(texts[i:j], everything)
                for k in (0, 1):
                    total[k] += np.bincount(g[y[i:j][d] == k], minlength=1 << BITS).astype(np.uint32)
        chunks = np.arange((1 << BITS) // CHUNK)
        yield pa.RecordBatch.from_arrays(
            [pa.array(chunks), pa.array([pa.compress(total[:, c * CHUNK:(c + 1) * CHUNK].tobytes(),
                                                     codec="zstd", asbytes=True) for c in chunks])],
            ["chunk", "counts"])

    def ratio(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        n = np.zeros((2, CHUNK))
        for blob in table["counts"].to_pylist():
            n += np.frombuffer(pa.decompress(blob, 8 * CHUNK, codec="zstd", asbytes=True),
                               np.uint32).reshape(2, CHUNK)
        n0, n1 = n + 1
        r = np.log(n1 / (ones + 2)) - np.log(n0 / (zeros + 2))
        z = np.abs(r) / np.sqrt(1 / n1 + 1 / n0)
        use = np.flatnonzero(z >= min_z)
        return pa.table({"gram": use + key[0].as_py() * CHUNK, "r": r[use], "z": z[use]})

    parts = sample.select("text", "y").mapInArrow(count, "chunk long, counts binary")
    rows = parts.groupBy("chunk").applyInArrow(ratio, "gram long, r double, z double")
    if limit is not None:
        rows = rows.orderBy(F.desc("z"), "gram").limit(limit)
    best = rows.select("gram", "r").toArrow().sort_by("gram")  # 2 ** BITS rows at most
    return best["gram"].to_numpy().astype(np.int64), best["r"].to_numpy()


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", fit_rows: int = FIT_ROWS,
        min_z: float = MIN_Z, max_features: int | None = None) -> Model:
    """Fit on (doc_id, text) and (doc_id, label)."""
    sample = labelled_texts(docs, labels, label, fit_rows)
    size = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    ones, zeros = size.get(1, 0), size.get(0, 0)
    if not ones or not zeros:
        share = ones / max(1, ones + zeros)
        return Model(np.zeros(0, np.int64), np.zeros(0), 500.0 if share else -500.0)
    feature, r = _ratios(sample, ones, zeros, min_z, max_features)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(1 << BITS, bool)
        wanted[feature] = True
        for b in batches:
            texts = b.column(0).to_pylist()
            for i, j in _runs(texts):
                d, g = present(texts[i:j], wanted)
                own = np.split(np.searchsorted(feature, g).astype("<i4"), np.searchsorted(d, np.arange(1, j - i)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(1).slice(i, j - i), pa.array([x.tobytes() for x in own], pa.binary())], ["y", "f"])

    rows = sample.select("text", "y").mapInArrow(features, "y int, f binary").toArrow()
    y = rows["y"].to_numpy().astype(float)
    held, size = [], []
    for c in rows["f"].chunks:  # views of Arrow's memory
        ends = np.frombuffer(c.buffers()[1], "<i4", len(c) + 1, 4 * c.offset)
        size.append(np.diff(ends) // 4)
        held.append(np.frombuffer(c.buffers()[2] or b"", "<i4", (ends[-1] - ends[0]) // 4, ends[0]))
    coef, bias = _logistic(held, size, r, y)
    return Model(feature, r * coef, bias)


def _parts(held: list[np.ndarray], size: list[np.ndarray]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``_PART`` present features: the first row, the
    features, and how many each row has."""
    out, row = [], 0
    for at, n in zip(held, size):
        ends = np.r_[0, np.cumsum(n, dtype=np.int64)]
        a = 0
        while a < len(n):
            b = max(a + 1, int(np.searchsorted(ends, ends[a] + _PART, "right")) - 1)
            out.append((row + a, at[ends[a]:ends[b]], n[a:b]))
            a = b
        row += len(n)
    return out


def _logistic(held: list[np.ndarray], size: list[np.ndarray], value: np.ndarray, y: np.ndarray, rounds: int = 300,
              rate: float = 0.05, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on presence times value, by Adam on all rows."""
    w = np.zeros(len(value) + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    parts = _parts(held, size)
    for t in range(1, rounds + 1):
        own, g = w[:-1] * value, np.zeros_like(w)
        for first, at, n in parts:
            doc = np.repeat(np.arange(len(n)), n)
            z = w[-1] + np.bincount(doc, own[at], len(n))
            err = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y[first:first + len(n)]) / len(y)
            g[:-1] += np.bincount(at, err[doc], len(value))
            g[-1] += err.sum()
        g[:-1] = g[:-1] * value + ridge * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and predicted of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                s = scorer(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                    ["doc_id", "score", "predicted"])

    return pick(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, predicted int")

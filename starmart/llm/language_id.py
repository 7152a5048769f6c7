"""Language identification by a byte convolutional network.

Texts are cut into windows of ``WINDOW`` bytes.  A window's bytes are
embedded, filters of widths 2, 3 and 4 slide over them, the largest
activation of each filter is kept, and a softmax layer gives the languages.
A text's probabilities are the means over all of its windows, weighted by
their bytes.  The network is trained in numpy on windows of a bounded,
hash-chosen sample of ``fit_rows`` texts per language.

Nulls and ties: a text that is null or has no letter is ``und`` with score 0.
Rows with a null language or id teach nothing.  Equal probabilities go to
the language first in the alphabet.  Without any labelled row all is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import pick, write_table

FIT_ROWS = 2_000  # texts per language
FIT_WINDOWS = 6  # windows per text, spread evenly
WINDOW = 256
EMBED, WIDTHS, FILTERS = 8, (2, 3, 4), 16
_LETTER = regex.compile(r"\p{L}")
_BATCH = 2048  # windows at a time


def cut(text: bytes) -> np.ndarray:
    """The text's windows; the last one is filled up with zeros."""
    n = max(1, -(-len(text) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[:len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, WINDOW)


@dataclass
class Network:
    labels: list[str]
    params: dict[str, np.ndarray]

    @staticmethod
    def new(labels: list[str], seed: int) -> Network:
        g = np.random.default_rng(seed)
        k = max(WIDTHS) * EMBED
        f = len(WIDTHS) * FILTERS
        conv = g.normal(0, 0.3, (k, f))
        return Network(labels, {
            "embed": g.normal(0, 0.5, (256, EMBED)).astype(np.float32),
            "conv": (conv * Network.mask()).astype(np.float32), "conv_b": np.zeros(f, np.float32),
            "out": g.normal(0, 0.1, (f, len(labels))).astype(np.float32),
            "out_b": np.zeros(len(labels), np.float32)})

    @staticmethod
    def mask() -> np.ndarray:
        """A filter of width w sees the first w bytes of each position."""
        seen = np.arange(max(WIDTHS))[:, None] < np.repeat(WIDTHS, FILTERS)[None, :]
        return np.repeat(seen, EMBED, axis=0)

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        p, k = self.params, max(WIDTHS)
        e = p["embed"][x]  # windows, bytes, EMBED
        e[x == 0] = 0
        pos = np.lib.stride_tricks.sliding_window_view(e, (k, EMBED), axis=(1, 2))
        pos = pos.reshape(len(x), WINDOW - k + 1, k * EMBED)
        act = pos.reshape(-1, k * EMBED) @ p["conv"]
        act = act.reshape(len(x), WINDOW - k + 1, -1)
        top = act.max(1)
        hidden = np.maximum(top + p["conv_b"], 0)
        z = hidden @ p["out"] + p["out_b"]
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True), hidden, act, pos

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int, seed: int, rate: float = 0.01) -> None:
        g = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.params.items()}
        v = {k: np.zeros_like(a) for k, a in self.params.items()}
        t, k, mask = 0, max(WIDTHS), self.mask()
        for _ in range(epochs):
            order = g.permutation(len(x))
            for i in range(0, len(x), 256):
                b = order[i:i + 256]
                prob, hidden, act, pos = self.forward(x[b])
                d = prob.copy()
                d[np.arange(len(b)), y[b]] -= 1
                d /= len(b)
                dh = (d @ self.params["out"].T) * (hidden > 0)
                at = act.argmax(1)  # the pooled position of each filter
                seen = np.take_along_axis(pos, at[:, :, None], 1)  # windows, filters, k * EMBED
                grad = {"out": hidden.T @ d, "out_b": d.sum(0), "conv_b": dh.sum(0),
                        "conv": np.einsum("nf,nfk->kf", dh, seen) * mask}
                de = (dh[:, :, None] * self.params["conv"].T[None]).reshape(len(b), -1, k, EMBED)
                byte = x[b][np.arange(len(b))[:, None, None], at[:, :, None] + np.arange(k)]
                emb = np.zeros_like(self.params["embed"])
                np.add.at(emb, byte.ravel(), de.reshape(-1, EMBED))
                emb[0] = 0
                grad["embed"] = emb
                t += 1
                for name, a in self.params.items():
                    q = grad[name].astype(np.float32)
                    m[name] = 0.9 * m[name] + 0.1 * q
                    v[name] = 0.999 * v[name] + 0.001 * q * q
                    a -= (rate * (m[name] / (1 - 0.9 ** t)) / (np.sqrt(v[name] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """Per text, the byte-weighted means over all of its windows."""
        out = np.zeros((len(texts), len(self.labels)))
        held: list[np.ndarray] = []
        owner: list[int] = []

        def flush() -> None:
            x = np.concatenate(held)
            p = self.forward(x)[0] * (x != 0).sum(1)[:, None]
            np.add.at(out, np.array(owner), p)
            held.clear()
            owner.clear()

        for i, t in enumerate(texts):
            w = cut(t)
            for a in range(0, len(w), _BATCH):
                part = w[a:a + _BATCH]
                held.append(part)
                owner += [i] * len(part)
                if len(owner) >= _BATCH:
                    flush()
        if held:
            flush()
        return out / np.maximum(out.sum(1, keepdims=True), 1e-12)


def fit(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
        fit_rows: int = FIT_ROWS, epochs: int = 4, seed: int = 7) -> Network | None:
    """Train on the rows of ``docs`` that have a language and an id."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(lang_col).alias("lang")).filter(
        "doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL AND length(text) > 0")
    size = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not size:
        return None
    share = F.lit(0.0)
    for lang, n in size.items():
        share = F.when(F.col("lang") == lang, F.lit(fit_rows / n)).otherwise(share)
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(1 << 20)) < share * (1 << 20))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = [cut(t) for t in b.column(0).cast(pa.binary()).to_pylist()]
            w = [x[np.unique(np.linspace(0, len(x) - 1, FIT_WINDOWS).astype(int))] for x in w]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in w], pa.binary()), b.column(1)],
                                             ["w", "lang"])

    got = write_table(chosen.select("doc_id", "text", "lang"), "texts").orderBy("doc_id", "text").select(
        "text", "lang").mapInArrow(windows, "w binary, lang string").collect()
    labels = sorted(size)
    x = [np.frombuffer(r.w, np.uint8).reshape(-1, WINDOW) for r in got]
    y = np.repeat([labels.index(r.lang) for r in got], [len(w) for w in x])
    net = Network.new(labels, seed)
    net.train(np.concatenate(x), y, epochs, seed)
    return net


def predict(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                texts = [t or "" for t in part.column(1).to_pylist()]
                known = [net is not None and _LETTER.search(t) is not None for t in texts]
                lang, score = ["und"] * len(texts), np.zeros(len(texts))
                use = [i for i, k in enumerate(known) if k]
                if use:
                    p = net.probabilities([texts[i].encode() for i in use])
                    best = p.argmax(1)
                    for i, k in zip(use, best):
                        lang[i] = net.labels[k]
                    score[use] = np.clip(p[np.arange(len(use)), best], 0, 1)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score)],
                                                 ["doc_id", "lang_pred", "score"])

    return pick(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")

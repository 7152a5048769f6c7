"""Quality by hierarchical empirical Bayes.

1. Evidence: a logistic classifier over 20 or so shape features of the whole text
   gives each document a log-odds; it is fitted in numpy on a bounded,
   hash-chosen sample of labelled texts.
2. Sites: Spark sums the probabilities per path and per host.  The spread
   between hosts (and between the paths of their hosts), by the method of
   moments, gives the strength of the Beta prior; a host's rate is shrunk to
   the global rate and a path's rate to its host's, the more the sparser it is.
3. Posterior: a document's log-likelihood ratio plus the log-odds of its path
   without the document itself.  Documents at ``threshold`` or more stay.

Nulls and ties: a text without words (null, empty, blank) has score 0, is
rejected and counts for no site.  A null host or path is a site of its own.
Without labels of both classes every text with words has evidence 0.
Repeated rows and ids are documents each.  The caller's columns travel in one
struct, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from starmart.llm import words as W
from starmart.llm.common import give_back, write_table
from starmart.llm.joins import join_counted
from starmart.llm.sample import labelled_texts

FIT_ROWS = 20_000
_GROUPS = (  # ASCII bytes whose shares are features
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"!", b"*$%&#@^~+=<>{}\\_`", b"|", b"0123456789", b".,;:?'\"()-/",
)
_SHARES = len(_GROUPS) + 4


def features(column: pa.Array) -> np.ndarray:
    """One row of features per text."""
    w = W.words(*W.utf8(column))
    out = np.zeros((len(column), 2 * _SHARES + 3))
    size = w.end - w.start
    again = np.r_[False, w.hash[1:] == w.hash[:-1]] if len(w.hash) else np.zeros(0, bool)
    for i, t in enumerate(column.cast(pa.binary()).fill_null(b"").to_pylist()):
        a, b = w.first[i], w.first[i + 1]
        if a == b:
            continue
        own = np.sort(w.hash[a:b])
        runs = np.diff(np.flatnonzero(np.r_[True, own[1:] != own[:-1], True]))
        lines = [x for x in t.split(b"\n") if x.strip()]
        share = [(len(t) - len(t.translate(None, g))) / len(t) for g in _GROUPS]
        share += [np.count_nonzero(again[a + 1:b]) / (b - a), runs.max() / (b - a), 1 - len(set(lines)) / len(lines),
                  1 - len(runs) / (b - a)]
        out[i, :_SHARES] = share
        out[i, _SHARES:2 * _SHARES] = np.log(np.array(share) + 1e-3)
        out[i, -3:] = np.log(b - a), size[a:b].mean(), len(lines) / (b - a)
    return out


@dataclass
class Classifier:
    mean: np.ndarray
    scale: np.ndarray
    coef: np.ndarray
    bias: float
    base: float  # share of label 1 in the sample

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log-likelihood ratio of label 1."""
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.coef + self.bias
        return np.clip(z - np.log(self.base / (1 - self.base)), -30, 30)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS,
        rounds: int = 600) -> Classifier | None:
    """Fit on (doc_id, text) and (doc_id, label); None without both classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                x = pa.array([x.tobytes() for x in features(part.column(1))], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), x], ["doc_id", "y", "x"])
        give_back()

    sample = labelled_texts(docs, labels, label, fit_rows)
    schema = StructType([sample.schema["doc_id"], sample.schema["y"], StructField("x", BinaryType())])
    # the features, not the texts, are put in order
    rows = sorted(sample.select("doc_id", "text", "y").mapInArrow(run, schema).collect())
    y = np.array([r.y for r in rows], float)
    if not len(y) or y.min() == y.max():
        return None
    x = np.array([np.frombuffer(r.x) for r in rows])
    mean, scale = x.mean(0), x.std(0) + 1e-9
    x = np.clip((x - mean) / scale, -8, 8)
    w = np.zeros(x.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        err = (1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -500, 500))) - y) / len(y)
        g = np.r_[err @ x + 1e-4 * w[:-1], err.sum()]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Classifier(mean, scale, w[:-1], float(w[-1]), float(y.mean()))


def _with_evidence(rows: DataFrame, model: Classifier | None, text_col: str) -> DataFrame:
    """``rows`` with the _llr of their texts, which stand in the struct
    ``row`` or, in whose place _llr comes then, in a last column _text; null
    where a text has no words."""
    last = rows.columns[-1] == "_text"
    kept = len(rows.columns) - last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                x = features(part.columns[-1] if last else pc.struct_field(part.column(0), text_col))
                blank = ~x.any(1)
                llr = np.zeros(len(x)) if model is None else model.evidence(x)
                yield pa.RecordBatch.from_arrays([*part.columns[:kept], pa.array(llr, mask=blank)],
                                                 [*part.schema.names[:kept], "_llr"])
        give_back()

    schema = StructType([*rows.schema.fields[:kept], StructField("_llr", DoubleType())])
    return rows.mapInArrow(run, schema)


def _strength(mean: float, spread: float, noise: float) -> float:
    """Beta prior strength for rates around ``mean`` with this variance."""
    between = max(spread - noise, 1e-6)
    return float(np.clip(mean * (1 - mean) / between - 1, 1, 1e6))


def site_rates(rows: DataFrame) -> DataFrame:
    """(_path, _n, _sum, _prior, _k): per path its documents, their summed
    probabilities, the shrunk host rate and the strength it counts with, read
    from a written table.  ``rows`` has _host, _path and _p."""
    paths = rows.groupBy("_host", "_path").agg(F.count("*").alias("_n"), F.sum("_p").alias("_sum"))
    hosts = paths.groupBy("_host").agg(F.sum("_n").alias("_hn"), F.sum("_sum").alias("_hs"))
    both = write_table(paths.join(hosts, "_host"), "sites")  # the only one: a file, and so a process, per shuffle partition
    hosts = both.groupBy("_host").agg(F.max("_hn").alias("_hn"), F.max("_hs").alias("_hs"))
    rate = F.col("_hs") / F.col("_hn")
    top = both.agg(F.sum("_sum"), F.sum("_n")).first()
    mean = min(max((top[0] or 0) / max(top[1] or 0, 1), 1e-6), 1 - 1e-6)
    v = hosts.agg(F.avg((rate - mean) ** 2), F.avg(1 / F.col("_hn"))).first()
    k = _strength(mean, v[0] or 0, mean * (1 - mean) * (v[1] or 0))
    both = both.withColumn("_prior", (F.lit(k * mean) + F.col("_hs")) / (F.lit(k) + F.col("_hn")))
    own = F.col("_sum") / F.col("_n")
    u = both.agg(F.avg((own - F.col("_prior")) ** 2), F.avg(1 / F.col("_n"))).first()
    k = _strength(mean, u[0] or 0, mean * (1 - mean) * (u[1] or 0))
    return both.select("_path", "_n", "_sum", "_prior", F.lit(k).alias("_k"))


def score(docs: DataFrame, model: Classifier | None, host: Column, path: Column, text_col: str = "text",
          threshold: float = 0.5, carry: bool = True) -> DataFrame:
    """The columns of ``docs`` and _score, _keep; with ``carry`` off, all
    columns but the text."""
    return score_rows(docs, model, host, path, text_col, threshold, carry).select(
        "row.*", F.col("score").alias("_score"), F.col("keep").alias("_keep"))


def score_rows(docs: DataFrame, model: Classifier | None, host: Column, path: Column, text_col: str = "text",
               threshold: float = 0.5, carry: bool = True) -> DataFrame:
    """As ``score``, the rows in the struct ``row``, beside score and keep.
    Every text is scored once; rows and evidence are a written table."""
    host = F.coalesce(host.cast("string"), F.lit("\u0000"))
    rows = _with_evidence(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if carry or c != text_col]).alias("row"),
        host.alias("_host"), F.concat_ws("\u0001", host, F.coalesce(path.cast("string"), F.lit("\u0000"))).alias("_path"),
        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("_spread"),
        *([] if carry else [F.col(f"`{text_col}`").alias("_text")])), model, text_col)
    base = 0.5 if model is None else model.base
    rows = write_table(rows.withColumn("_p", 1 / (1 + F.exp(-(F.col("_llr") + F.lit(float(np.log(base / (1 - base)))))))), "evidence")
    sites = site_rates(rows.select("_host", "_path", "_llr", "_p").filter("_llr IS NOT NULL"))
    rows = join_counted(rows, sites.withColumn("_c", F.col("_n")), "_path", "_c", "_spread")
    rate = (F.col("_k") * F.col("_prior") + F.col("_sum") - F.col("_p")) / (F.col("_k") + F.col("_n") - 1)
    rate = F.least(F.greatest(rate, F.lit(1e-6)), F.lit(1 - 1e-6))
    post = F.coalesce(1 / (1 + F.exp(-(F.col("_llr") + F.log(rate / (1 - rate))))), F.lit(0.0))
    return rows.select("row", post.alias("score"), (post >= threshold).alias("keep"))

"""Isolation Forest (ML-5; Liu, Ting & Zhou, 2008).

* Trees are independent and each needs only ``max_samples`` rows (256), so
  every row decides by hash which trees' subsamples it may join (JVM
  expression, one pass), the candidates are exploded to (tree, row) and each
  tree is grown by ``groupBy(tree).applyInPandas`` on its own small sample.
* The forest (trees x at most 2 * max_samples nodes) is a model-sized object
  shipped to the tasks; ``mapInPandas`` scores each Arrow batch with numpy.
* The contamination cut is an exact quantile of the scores (distributed).

``score`` follows scikit-learn's ``score_samples``: ``-2^(-E[h(x)] / c(psi))``,
lower is more abnormal; ``anomaly`` is -1 below the cut, else 1.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.selection import column_quantiles
from starmart.session import write_table

EULER = 0.5772156649015329


def avg_path(n):
    """c(n): average path length of an unsuccessful BST search."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    feat, thr, left, right, size = [], [], [], [], []

    def node(idx, depth):
        me = len(feat)
        feat.append(-1), thr.append(0.0), left.append(-1), right.append(-1), size.append(len(idx))
        if depth >= max_depth or len(idx) <= 1:
            return me
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if len(usable) == 0:
            return me
        f = int(rng.choice(usable))
        t = float(rng.uniform(lo[f], hi[f]))
        feat[me], thr[me] = f, t
        go_left = sub[:, f] < t
        left[me] = node(idx[go_left], depth + 1)
        right[me] = node(idx[~go_left], depth + 1)
        return me

    node(np.arange(len(x)), 0)
    return feat, thr, left, right, size


def fit_forest(df: DataFrame, id_col: str, cols: Sequence[str], n_trees: int = 100,
               max_samples: int = 256, seed: int = 42) -> tuple[list[dict], int]:
    n = df.count()
    psi = min(max_samples, n)
    # oversample 2x by hash, then keep the psi smallest hashes per tree
    frac = min(1.0, 2.0 * psi / max(n, 1))
    threshold = int(frac * 2**31)
    h = lambda t: F.pmod(F.xxhash64(F.col(id_col), t, F.lit(seed)), F.lit(2**31))
    trees = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: h(t) < threshold)
    cand = (df.select(F.explode(trees).alias("tree"), F.col(id_col).alias("id"),
                      *[F.col(c).cast("double").alias(c) for c in cols])
            .withColumn("u", F.pmod(F.xxhash64(F.col("id"), F.col("tree"), F.lit(seed)),
                                    F.lit(2**31))))
    max_depth = int(math.ceil(math.log2(max(psi, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values(["u", "id"], kind="stable").head(psi)
        rng = np.random.default_rng([seed, t])
        f, th, le, ri, sz = _grow(pdf[list(cols)].to_numpy(dtype=float), rng, max_depth)
        return pd.DataFrame({"tree": [t], "feat": [f], "thr": [th], "left": [le], "right": [ri],
                             "size": [sz]})

    schema = ("tree int, feat array<int>, thr array<double>, left array<int>, "
              "right array<int>, size array<int>")
    forest = [r.asDict() for r in cand.groupBy("tree").applyInPandas(grow, schema).collect()]
    return forest, psi


def score(df: DataFrame, cols: Sequence[str], forest: list[dict], psi: int,
          out: str = "score") -> DataFrame:
    trees = [(np.array(t["feat"]), np.array(t["thr"]), np.array(t["left"]), np.array(t["right"]),
              np.array(t["size"])) for t in forest]
    norm = float(avg_path([psi])[0]) or 1.0
    in_cols = df.columns

    def run(batches):
        for pdf in batches:
            x = pdf[list(cols)].to_numpy(dtype=float)
            depth_sum = np.zeros(len(x))
            for feat, thr, left, right, size in trees:
                node = np.zeros(len(x), dtype=int)
                depth = np.zeros(len(x))
                active = feat[node] >= 0
                while active.any():
                    i = np.flatnonzero(active)
                    nd = node[i]
                    go_left = x[i, feat[nd]] < thr[nd]
                    node[i] = np.where(go_left, left[nd], right[nd])
                    depth[i] += 1
                    active = feat[node] >= 0
                depth_sum += depth + avg_path(size[node])
            mean_depth = depth_sum / max(len(trees), 1)
            yield pdf.assign(**{out: -np.power(2.0, -mean_depth / norm)})

    schema = df.select(*in_cols, F.lit(0.0).alias(out)).schema
    return df.mapInPandas(run, schema)


def isolation_forest(df: DataFrame, id_col: str, cols: Sequence[str], contamination: float = 0.01,
                     n_trees: int = 100, max_samples: int = 256, seed: int = 42) -> DataFrame:
    """``df`` plus ``score`` and ``anomaly`` (-1 for the most isolated
    ``contamination`` share, else 1)."""
    forest, psi = fit_forest(df, id_col, cols, n_trees, max_samples, seed)
    # written once: the cut and the result read it, the trees run once per row
    scored = write_table(score(df, cols, forest, psi), "iforest")
    cut = column_quantiles(scored, ["score"], [contamination])[0][0]
    return scored.withColumn("anomaly", F.when(F.col("score") < F.lit(cut), -1).otherwise(1))

"""Descriptive statistics and tests over numeric columns (ST-1 ... ST-7).

Several columns are handled in one plan by unpivoting to a long
``(column_name, value)`` frame and grouping by the column name.  One-row
statistics reach other rows as scalar subqueries or through a join with the
per-column aggregate (one row per column), never via the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.special import chi2_sf
from starmart.operators.selection import column_quantiles


def long_form(df: DataFrame, cols: Sequence[str], id_cols: Sequence[str] = ()) -> DataFrame:
    """``(id..., column_name, value)`` with every value as DOUBLE."""
    typed = df.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in cols])
    return typed.unpivot(list(id_cols), list(cols), "column_name", "value")


def _round(c: Column, digits: int | None) -> Column:
    return F.round(c, digits) if digits is not None else c


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Exact quantiles (AG-15), one row per column."""
    rows = [(c, *q) for c, q in zip(cols, column_quantiles(df, cols, probs))]
    return df.sparkSession.createDataFrame(rows, ", ".join(["column_name string", *[f"{n} double" for n in names]]))


def describe(df: DataFrame, cols: Sequence[str], digits: int | None = None) -> DataFrame:
    """ST-1 (``DataFrame.describe`` of pandas): count, mean, sample std, min,
    exact quartiles, max; one row per column.  Not ``summary()``, whose
    quartiles are approximate."""
    long = long_form(df, cols)
    moments = long.groupBy("column_name").agg(
        F.count("value").alias("count"),
        _round(F.avg("value"), digits).alias("mean"),
        _round(F.stddev_samp("value"), digits).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    q = quantile_table(df, cols, [0.25, 0.5, 0.75], ["q25", "q50", "q75"])
    return moments.join(q, "column_name").select(
        "column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def population_moments(long: DataFrame) -> DataFrame:
    """Mean and population std (ddof 0, as scipy.stats.zscore and
    StandardScaler use) per column of a long frame."""
    return long.groupBy("column_name").agg(F.avg("value").alias("mean"),
                                           F.stddev_pop("value").alias("std_pop"))


def zscore_outliers(df: DataFrame, cols: Sequence[str], id_col: str, threshold: float = 3.0,
                    digits: int | None = None) -> DataFrame:
    """ST-2: rows with ``|z| > threshold`` per column, long form
    ``column_name, id, value, z``."""
    long = long_form(df, cols, [id_col])
    m = population_moments(long)
    z = F.when(F.col("std_pop") != 0, (F.col("value") - F.col("mean")) / F.col("std_pop"))
    return (long.join(m, "column_name").withColumn("z", z)
            .where(F.abs(F.col("z")) > threshold)
            .select("column_name", id_col, "value", _round(F.col("z"), digits).alias("z")))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 20) -> DataFrame:
    """ST-3: equal-width bins between min and max per column; the maximum
    falls into the last bin (numpy / seaborn convention).  Empty bins are
    not listed."""
    long = long_form(df, cols).where(F.col("value").isNotNull())
    rng = long.groupBy("column_name").agg(F.min("value").alias("lo"),
                                                             F.max("value").alias("hi"))
    span = F.col("hi") - F.col("lo")
    b = F.when(span == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / span * bins), F.lit(bins - 1)))
    counted = (long.join(rng, "column_name")
               .groupBy("column_name", b.cast("int").alias("bin"), "lo", "hi")
               .agg(F.count(F.lit(1)).alias("count")))
    edge = lambda k: F.col("lo") + (F.col("hi") - F.col("lo")) * k / bins
    return counted.select("column_name", "bin", edge(F.col("bin")).alias("bin_start"),
                          edge(F.col("bin") + 1).alias("bin_end"), "count")


def boxplot_stats(df: DataFrame, cols: Sequence[str], whisker: float = 1.5) -> DataFrame:
    """ST-5: quartiles, whiskers at the most extreme values within
    ``whisker * IQR`` of the box, and the number of points beyond them."""
    long = long_form(df, cols).where(F.col("value").isNotNull())
    q = quantile_table(df, cols, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo_fence = F.col("q1") - F.lit(whisker) * F.col("iqr")
    hi_fence = F.col("q3") + F.lit(whisker) * F.col("iqr")
    v = F.col("value")
    return (long.join(q, "column_name")
            .groupBy("column_name", "q1", "median", "q3", "iqr")
            .agg(F.min(F.when(v >= lo_fence, v)).alias("lower_whisker"),
                 F.max(F.when(v <= hi_fence, v)).alias("upper_whisker"),
                 F.count(F.when((v < lo_fence) | (v > hi_fence), 1)).alias("outliers")))


def kde_curve(df: DataFrame, col: str, grid_size: int = 200, cut: float = 3.0) -> DataFrame:
    """ST-4: Gaussian kernel density on an evenly spaced grid (Scott's rule,
    bandwidth = sample std * n^(-1/5); grid from min - cut*bw to max + cut*bw).

    Each partition adds its rows' kernels at every grid point with numpy
    (``mapInPandas``) and emits ``grid_size`` partial sums; a grouped sum
    finishes the job.  The grid is the only broadcast, its size a parameter.
    """
    x = df.select(F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull())
    st = x.agg(F.count("x").alias("n"), F.stddev_samp("x").alias("sd"),
               F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    n, sd = int(st["n"]), float(st["sd"] or 0.0)
    if n == 0:
        return df.sparkSession.createDataFrame([], "column_name string, point int, x double, "
                                                   "density double")
    bw = sd * n ** (-1.0 / 5.0) if sd > 0 else 1.0
    start, stop = st["lo"] - cut * bw, st["hi"] + cut * bw
    step = (stop - start) / (grid_size - 1)
    grid = start + np.arange(grid_size) * step  # point i is start + i * step
    norm = 1.0 / (n * bw * math.sqrt(2 * math.pi))

    def partial(batches):
        acc = np.zeros(grid_size)
        for pdf in batches:
            v = pdf["x"].to_numpy()
            for i in range(0, len(v), 4096):
                u = (grid[None, :] - v[i:i + 4096, None]) / bw
                acc += np.exp(-0.5 * u * u).sum(axis=0)
        yield pd.DataFrame({"point": np.arange(grid_size, dtype="int32"), "s": acc})

    sums = x.mapInPandas(partial, "point int, s double").groupBy("point").agg(F.sum("s").alias("s"))
    grid_col = F.lit(float(start)) + F.col("point") * F.lit(float(step))
    return sums.select(F.lit(col).alias("column_name"), "point", grid_col.alias("x"),
                       (F.col("s") * norm).alias("density"))


def correlation_long(df: DataFrame, cols: Sequence[str], digits: int | None = 9) -> DataFrame:
    """ST-6: Pearson correlation of every pair, long form
    ``col_a, col_b, corr`` (the full symmetric matrix, diagonal 1)."""
    aggs = []
    for a in cols:
        for b in cols:
            if a < b:
                aggs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double"))
                            .alias(f"{a}|{b}"))
    wide = df.agg(*aggs)
    pairs = wide.unpivot([], [f"{a}|{b}" for a in cols for b in cols if a < b], "pair", "corr")
    parts = F.split(F.col("pair"), r"\|")
    one = pairs.select(parts[0].alias("col_a"), parts[1].alias("col_b"), "corr")
    sym = one.unionByName(one.select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"),
                                     "corr"))
    diag = df.agg(*[F.lit(1.0).alias(c) for c in cols]).unpivot([], list(cols), "col_a", "corr") \
        .select("col_a", F.col("col_a").alias("col_b"), "corr")
    return sym.unionByName(diag).select("col_a", "col_b", _round(F.col("corr"), digits).alias("corr"))


def chi_square_stat(df: DataFrame, row_col: str, col_col: str,
                    digits: int | None = 9) -> DataFrame:
    """ST-7 statistic of the contingency table ``row_col x col_col``.

    ``chi2 = sum (O - E)^2 / E = sum_{O > 0} O^2 / E - N`` with
    ``E = R_i C_j / N``: only observed cells are needed, so the table is
    never expanded to all (row, column) pairs.  One row:
    ``statistic, dof, n, rows, cols``.
    """
    pairs = df.where(F.col(row_col).isNotNull() & F.col(col_col).isNotNull())
    cells = pairs.groupBy(row_col, col_col).agg(F.count(F.lit(1)).alias("o"))
    r = cells.groupBy(row_col).agg(F.sum("o").alias("r"))
    c = cells.groupBy(col_col).agg(F.sum("o").alias("c"))
    j = cells.join(r, row_col).join(c, col_col)
    agg = j.agg(F.sum(F.col("o").cast("double") * F.col("o") / (F.col("r") * F.col("c")))
                .alias("s"),
                F.sum("o").alias("n"),
                F.countDistinct(row_col).alias("rows"),
                F.countDistinct(col_col).alias("cols"))
    stat = F.col("s") * F.col("n") - F.col("n")
    return agg.select(_round(stat, digits).alias("statistic"),
                      ((F.col("rows") - 1) * (F.col("cols") - 1)).alias("dof"),
                      "n", "rows", "cols")


def chi_square_test(df: DataFrame, row_col: str, col_col: str, alpha: float = 0.05) -> DataFrame:
    """ST-7 with the p-value (chi-square survival function, a per-row helper
    on the one-row result) and the decision at ``alpha``."""
    st = chi_square_stat(df, row_col, col_col, digits=None)

    @F.pandas_udf("double")
    def sf(stat: pd.Series, dof: pd.Series) -> pd.Series:
        return pd.Series([chi2_sf(float(s), int(d)) for s, d in zip(stat, dof)])

    return st.withColumn("p_value", sf("statistic", "dof")).withColumn(
        "significant", F.col("p_value") < alpha)

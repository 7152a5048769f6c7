"""Connected components of a written edge table, by rounds of contraction.

In a round every node takes the first of itself and its neighbours as its
label, and edges move on to the labels; what became a loop is done.  Even
rounds order nodes by number, which folds a star in one round; odd rounds by
a hash, which shrinks chains by a constant share.  A round is a grouped
minimum and two lookup joins that no hub can overload.  Rounds end when at
most ``FEW`` edges are left, whose components are found on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.lookup import lookup_join
from starmart.session import write_table

FEW = 1 << 16


def _proper(u: Column, v: Column) -> tuple[Column, Column]:
    return F.greatest(u, v).alias("u"), F.least(u, v).alias("v")


def _labels(edges: DataFrame, turn: int) -> DataFrame:
    def order(c: str) -> Column:
        return F.struct(F.xxhash64(F.col(c), F.lit(turn)) if turn % 2 else F.lit(0).cast("long"), F.col(c).alias("node"))

    both = edges.select("u", "v").union(edges.select("v", "u"))
    return both.groupBy("u").agg(F.least(order("u"), F.min(order("v"))).getField("node").alias("label"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (u, v), LONG numbers: the
    smallest node of its component.  Repeats are allowed; loops and null ends
    are left out."""
    edges = write_table(links.select(*_proper(F.col("u"), F.col("v"))).where("u > v").distinct(), "edges")
    turns: list[DataFrame] = []
    while edges.count() > FEW:
        labels = write_table(_labels(edges, len(turns)), "labels")
        turns.append(labels)
        moved = lookup_join(edges, labels, "u", ["label"], "v", "inner").select(F.col("label").alias("a"), F.col("v").alias("u"))
        moved = lookup_join(moved, labels, "u", ["label"], "a", "inner")
        edges = write_table(moved.select(*_proper(F.col("a"), F.col("label"))).where("u > v").distinct(), "edges")
    roots = edges.sparkSession.createDataFrame(_small([(r.u, r.v) for r in edges.collect()]), "u long, label long")
    if not turns:
        return roots.select(F.col("u").alias("node"), F.col("label").alias("component"))
    for labels in reversed(turns):
        known = roots.select(F.col("u").alias("label"), F.col("label").alias("root"))
        roots = write_table(lookup_join(labels, known, "label", ["root"], "u").select(
            "u", F.coalesce("root", "label").alias("label")), "roots")
    least = roots.groupBy("label").agg(F.min("u").alias("component"))
    return lookup_join(roots, write_table(least, "least"), "label", ["component"], "u").select(
        F.col("u").alias("node"), "component")


def _small(edges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(node, smallest node of its component)."""
    up: dict[int, int] = {}

    def find(a: int) -> int:
        while up.setdefault(a, a) != a:
            up[a] = a = up[up[a]]
        return a

    for u, v in edges:
        x, y = find(u), find(v)
        up[max(x, y)] = min(x, y)
    return [(a, find(a)) for a in list(up)]

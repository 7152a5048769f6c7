"""Connected components by rounds of contraction.

In a round every node takes the first of itself and its neighbours as its
label and edges move to the labels; labels without edges are done.  Even
rounds order nodes by id, which folds a star in one round; odd rounds order
them by a hash, which shrinks chains by a constant share.  Every round is a
grouped minimum and two lookup joins over written tables; only a total and
whether edges are left reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import write_table
from starmart.llm.joins import join_counted


def _labels(edges: DataFrame, turn: int) -> DataFrame:
    """(u, label, c): each node's label and its number of edge ends."""
    both = edges.union(edges.select("v", "u"))

    def order(c: str):
        return F.struct(F.xxhash64(F.col(c), F.lit(turn)) if turn % 2 else F.lit(0).cast("long"), F.col(c).alias("id"))

    return both.groupBy("u").agg(F.least(order("u"), F.min(order("v"))).getField("id").alias("label"),
                                 F.count("*").alias("c"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (u, v): the component's
    smallest node.  Repeats are allowed; self-links and null ends are left out."""
    edges = write_table(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .filter("u > v").distinct(), "links")
    turns: list[DataFrame] = []
    while not turns or not edges.isEmpty():
        labels = write_table(_labels(edges, len(turns)), "labels")
        turns.append(labels.select("u", "label"))
        moved = join_counted(edges, labels, "u", "c", "v", "inner").select(F.col("label").alias("a"), F.col("v").alias("u"))
        moved = join_counted(moved, labels, "u", "c", "a", "inner").select("a", F.col("label").alias("b"))
        edges = write_table(moved.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                            .filter("u > v").distinct(), "edges")
    roots = turns[-1]
    for labels in reversed(turns[:-1]):
        last = roots.select(F.col("u").alias("label"), F.col("label").alias("root"))
        roots = labels.join(last, "label", "left").select("u", F.coalesce("root", "label").alias("label"))
    roots = write_table(roots, "roots")
    least = write_table(roots.groupBy("label").agg(F.min("u").alias("component"), F.count("*").alias("c")), "least")
    return join_counted(roots, least, "label", "c", "u", "inner").select(F.col("u").alias("node"), "component")

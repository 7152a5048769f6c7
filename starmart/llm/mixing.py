"""Mixing sources to target weights by hierarchical budgeting.

1. Leaves: Spark sums the tokens per domain, language and source.  A node's
   capacity is its leaves' tokens times ``max_epochs``.
2. Budgets go down the tree.  Siblings share their parent's budget by weight;
   what a sibling cannot use goes to its siblings by weight, and only what a
   whole family cannot use has already gone to the parent's siblings, because
   no node gets more than its capacity.  The share per weight is found from a
   histogram of capacity over weight, so no family is sorted in one task.
3. Selection: a leaf with budget q and t tokens takes q div t whole epochs and
   a token-prefix of one more: documents in the order of a seeded hash, up to
   the last that fits.  The cut is found from a histogram of the hash, and
   exactly within the one bin that holds it.

Nulls and ties: a null or empty text has no tokens and goes with its whole
epochs, or with a prefix that reaches its place.  Null domains, languages or
sources are nodes of their own.  Rows with equal ids and texts stand at one
place of the order and are taken together.  The caller's columns travel in
one struct, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm import words as W
from starmart.llm.common import give_back, write_table
from starmart.llm.joins import join_counted

_SEP, _NULL = "\u0001", "\u0002"


def _key(*parts: Column) -> Column:
    return F.concat_ws(_SEP, *[F.coalesce(p.cast("string"), F.lit(_NULL)) for p in parts])


def water_fill(items: DataFrame) -> DataFrame:
    """(node, share): ``items`` has parent, node, weight, cap and budget (the
    parent's).  share = min(cap, level * weight), the level one per parent."""
    fits = items.withColumn("ratio", F.col("cap") / F.col("weight"))
    fits = fits.withColumn("bin", F.floor(F.log2(F.greatest("ratio", F.lit(1e-9))) * 16))
    bins = fits.groupBy("parent", "bin").agg(
        F.sum("cap").alias("c"), F.sum("weight").alias("w"), F.min("ratio").alias("low"),
        F.max("budget").alias("budget"))
    before = Window.partitionBy("parent").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("parent").orderBy("bin").rowsBetween(0, Window.unboundedFollowing)
    bins = bins.withColumn("full", F.coalesce(F.sum("c").over(before), F.lit(0.0))).withColumn(
        "open", F.sum("w").over(after))
    # the last bin whose smallest item is still filled at the parent's budget
    bins = bins.filter(F.col("full") + F.col("low") * F.col("open") <= F.col("budget"))
    cut = write_table(bins.groupBy("parent").agg(F.max_by(F.struct("bin", "full", "open"), "bin").alias("at"))
                      .select("parent", F.col("at.bin").alias("cut"), F.col("at.full").alias("full"),
                              F.col("at.open").alias("open")), "cuts")
    inner = fits.join(cut, "parent").filter("bin = cut")
    order = Window.partitionBy("parent").orderBy("ratio", "node")
    inner = inner.withColumn("c", F.sum("cap").over(order)).withColumn("w", F.sum("weight").over(order))
    # filled with item i, what is open gets (budget - full) / open
    inner = inner.withColumn("fills", F.col("full") + F.col("c") - F.col("cap")
                             + F.col("ratio") * (F.col("open") - F.col("w") + F.col("weight")) <= F.col("budget"))
    level = inner.filter("fills").groupBy("parent").agg(
        F.max("budget").alias("b"), F.max(F.col("full") + F.col("c")).alias("f"), F.min(F.col("open") - F.col("w")).alias("o"))
    level = level.select("parent", F.when(F.col("o") > 1e-9 * F.col("b") / (F.col("b") + 1), F.greatest(F.col("b") - F.col("f"), F.lit(0.0)) / F.col("o"))
                         .otherwise(F.lit(float("inf"))).alias("filled"))
    whole = fits.groupBy("parent").agg(F.sum("weight").alias("all"), F.max("budget").alias("b"))
    level = whole.join(level, "parent", "left").select(
        "parent", F.coalesce("filled", F.col("b") / F.col("all")).alias("level"))
    return fits.join(level, "parent").select("node", F.least(F.col("cap"), F.col("level") * F.col("weight")).alias("share"))


def budgets(leaves: DataFrame, total: float, weights: Mapping[str, float], max_epochs: int) -> DataFrame:
    """(leaf, quota): ``leaves`` has domain, lang, source, leaf and tokens.
    ``weights`` gives a node's weight by the path of its names, joined by
    slashes; nodes without one weigh 1."""
    caps = leaves.withColumn("cap", F.col("tokens").cast("double") * max_epochs).filter("cap > 0")
    keys = [_key(*[F.col(c) for c in ("domain", "lang", "source")[:k]]) for k in range(4)]
    budget = None
    for k in (1, 2, 3):
        name = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("domain", "lang", "source")[:k]])
        weight = F.lit(1.0)
        for path, w in weights.items():
            weight = F.when(name == path, F.lit(float(w))).otherwise(weight)
        level = caps.groupBy((keys[k - 1] if k > 1 else F.lit("")).alias("parent"), keys[k].alias("node")).agg(
            F.sum("cap").alias("cap"), F.max(weight).alias("weight")).filter("weight > 0")
        level = (level.withColumn("budget", F.lit(float(total))) if budget is None
                 else level.join(budget.select(F.col("node").alias("parent"), F.col("share").alias("budget")), "parent"))
        budget = write_table(water_fill(write_table(level, "level")), "budget")
    return budget.select(F.col("node").alias("leaf"), F.col("share").alias("quota"))


def count_words(column: pa.Array) -> np.ndarray:
    """Words of each text: the begins of runs of bytes other than white space."""
    data, offsets = W.utf8(column)
    word = ~W._SPACE[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first] = word[first]  # a text's border also ends a word
    return np.diff(np.r_[0, np.cumsum(begins)][offsets])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column, a text, as its number of words."""
    for b in batches:
        for at in range(0, b.num_rows, 512):
            part = b.slice(at, 512)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(count_words(part.columns[-1]), pa.int64())],
                                             [*part.schema.names[:-1], "tokens"])
    give_back()


def mix(docs: DataFrame, domain: Column, lang: Column, source: Column, id_col: str = "doc_id",
        text_col: str = "text", total_share: float = 0.5, weights: Mapping[str, float] | None = None,
        max_epochs: int = 2, seed: int = 11) -> DataFrame:
    """The rows taken: the columns of ``docs`` and _epoch (from 0).  The total
    budget is ``total_share`` of the corpus tokens (words)."""
    return mix_rows(docs, domain, lang, source, id_col, text_col, total_share, weights, max_epochs, seed).select(
        "row.*", F.col("epoch").alias("_epoch"))


def mix_rows(docs: DataFrame, domain: Column, lang: Column, source: Column, id_col: str = "doc_id",
             text_col: str = "text", total_share: float = 0.5, weights: Mapping[str, float] | None = None,
             max_epochs: int = 2, seed: int = 11) -> DataFrame:
    """As ``mix``, the rows in the struct ``row``, beside ``epoch``."""
    place = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    leaf = _key(domain, lang, source)
    narrow = write_table(docs.select(
        domain.cast("string").alias("domain"), lang.cast("string").alias("lang"), source.cast("string").alias("source"),
        leaf.alias("leaf"), place.alias("place"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _counted, "domain string, lang string, source string, leaf string, place long, tokens long"), "tokens")
    leaves = write_table(narrow.groupBy("leaf", "domain", "lang", "source").agg(
        F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "leaves")
    total = (leaves.agg(F.sum("tokens")).first()[0] or 0) * total_share
    quota = budgets(leaves, total, weights or {}, max_epochs)
    quota = write_table(leaves.join(quota, "leaf", "left").select(
        "leaf", "rows", "tokens", F.coalesce(F.floor(F.col("quota") + 1e-6), F.lit(0)).alias("quota")).withColumns({
            "epochs": F.when(F.col("tokens") > 0, F.least(F.floor(F.col("quota") / F.col("tokens")), F.lit(max_epochs)))
            .otherwise(F.lit(0)).cast("int")}), "quota")
    quota = quota.withColumn("rest", F.when(F.col("epochs") < max_epochs, F.col("quota") - F.col("epochs") * F.col("tokens")).otherwise(F.lit(0)))
    bin_ = F.shiftrightunsigned("place", 52).alias("bin")  # 4096 bins, in the order of places
    order = (F.shiftrightunsigned("place", 52), F.col("place").bitwiseAND(F.lit((1 << 52) - 1)))
    bins = narrow.groupBy("leaf", bin_).agg(F.sum("tokens").alias("t"))
    upto = Window.partitionBy("leaf").orderBy("bin")
    bins = bins.withColumn("upto", F.sum("t").over(upto)).join(quota.select("leaf", "rest"), "leaf")
    cut = write_table(bins.groupBy("leaf").agg(
        F.min(F.when(F.col("upto") > F.col("rest"), F.struct("bin", (F.col("upto") - F.col("t")).alias("before")))).alias("at"),
        F.max("rest").alias("rest")).select("leaf", "rest", F.col("at.bin").alias("bin"), F.col("at.before").alias("before")), "bins")
    at = cut.filter("bin IS NOT NULL AND rest > 0").select("leaf", "bin", "before", "rest")
    near = narrow.select("leaf", order[0].alias("bin"), order[1].alias("low"), "tokens").join(at, ["leaf", "bin"])
    near = near.groupBy("leaf", "bin", "low").agg(F.sum("tokens").alias("t"), F.max("before").alias("before"), F.max("rest").alias("rest"))
    within = Window.partitionBy("leaf", "bin").orderBy("low")
    last = near.withColumn("sum", F.col("before") + F.sum("t").over(within)).filter("sum <= rest").groupBy("leaf").agg(
        F.max("low").alias("last"))
    plan = write_table(quota.select(F.col("leaf").alias("_leaf"), F.col("rows").alias("_c"), F.col("epochs").alias("_epochs"),
                                    F.col("rest").alias("_rest"))
                       .join(cut.select(F.col("leaf").alias("_leaf"), F.col("bin").alias("_bin")), "_leaf", "left")
                       .join(last.select(F.col("leaf").alias("_leaf"), F.col("last").alias("_last")), "_leaf", "left"), "plan")
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), leaf.alias("_leaf"), place.alias("_place"))
    rows = join_counted(held, plan, "_leaf", "_c", "_place")
    high, low = F.shiftrightunsigned("_place", 52), F.col("_place").bitwiseAND(F.lit((1 << 52) - 1))
    taken = (F.col("_rest") > 0) & (F.col("_bin").isNull() | (high < F.col("_bin"))
                                    | ((high == F.col("_bin")) & (low <= F.coalesce("_last", F.lit(-1)))))
    copies = F.col("_epochs") + F.when(taken, 1).otherwise(0)
    if max_epochs == 1:
        return rows.filter(copies > 0).select("row", F.lit(0).alias("epoch"))
    return rows.filter(copies > 0).select("row", F.explode(F.sequence(F.lit(0), copies - 1)).alias("epoch"))



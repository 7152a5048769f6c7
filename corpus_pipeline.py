"""The corpus pipeline: stages over ``documents``, each written and reread.

Every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import quality
from starmart.llm.common import rows_of, ship_package, table, write_table
from starmart.llm.mixing import mix_rows
from starmart.llm.ngram_join import ngram_join
from starmart.llm.packing import pack
from starmart.llm.queries import MIX_WEIGHTS, domain_of
from starmart.llm.substring_dedup import dedup_rows

#: Share of the words that the mix may take, once each.
MIX_SHARE = 0.9


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality is under one half go.

    Documents without words (null, empty and blank texts) go.  Repeated rows
    and ids are documents each; texts count whole, however long; null hosts
    and languages are sites of their own.  No rows give no rows."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_rows(docs, model, F.col("source"), F.col("lang"))
    return scored.filter("keep").select("row.*")


def ngram_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component stays; five-word
    shingles, similarity 0.8.

    Rows without an id or without words stay.  Of rows with one id and one
    text the first stays; rows with one id and different texts are documents
    each: only the one that copies a smaller id's goes.  Texts count whole,
    however long.  No rows give no rows."""
    rows = rows_of(docs).select("row", F.col("row.doc_id").cast("long").alias("id"), F.md5("row.text").alias("mark"))
    found = ngram_join(docs.select("doc_id", "text"), n=5, percent=80, mark=F.md5("text"))
    gone = found.filter("component_id < doc_id").select(F.col("doc_id").alias("id"), "mark").distinct()
    rest = rows.join(gone, ["id", "mark"], "left_anti")
    return rest.filter("id IS NOT NULL").dropDuplicates(["id", "mark"]).unionByName(
        rest.filter("id IS NULL")).select("row.*")


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go; documents of which nothing is left go as well.

    A text that loses nothing stays as it is, null and empty ones too; n_chars
    counts what is left.  Rows with one id do not take from each other, equal
    passages stay with the smallest id, and rows without an id come last.
    Texts count whole, however long.  No rows give no rows."""
    kept = dedup_rows(docs, as_words=False).filter("n_removed = 0 OR n_removed < n_words")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        kept = kept.withColumn("row", F.when(F.col("n_removed") > 0, F.col("row").withField(
            "n_chars", F.length("row.text").cast(kind))).otherwise(F.col("row")))
    return kept.select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources meet their budgets; no document is taken twice.

    Null and empty texts weigh nothing and go with their place in the order;
    null languages and sources are leaves of their own.  Rows with one id and
    one text are taken or left together; a text longer than a leaf's budget
    is left.  No rows give no rows."""
    taken = mix_rows(docs, domain_of(), F.col("lang"), F.col("source"), total_share=MIX_SHARE, weights=MIX_WEIGHTS, max_epochs=1)
    return taken.select("row.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens.

    A null or empty text is its end token alone; repeated rows and ids are
    documents each; a long text is cut into pieces.  No rows give no rows."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("ngram_join", ngram_stage),
    ("substring_dedup", substring_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: A trained classifier and tokenizers are not SQL; tests check against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the pieces of the last one."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return docs

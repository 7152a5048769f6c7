"""Registered queries of the operators, with production parameters, over
whole tables; ``SQL`` holds the DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import alignment, language_id, quality, toxicity, warc
from starmart.llm.common import ship_package, table
from starmart.llm.hard_negatives import mine
from starmart.llm.mixing import mix
from starmart.llm.near_vectors import near_dedup
from starmart.llm.ngram_join import ngram_join
from starmart.llm.packing import pack
from starmart.llm.sample import fold
from starmart.llm.sharding import shuffle_shards
from starmart.llm.sql import SQL
from starmart.llm.substring_dedup import dedup_substrings
from starmart.llm.vp_search import nearest

__all__ = ["QUERIES", "SQL"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)  # the Python workers import starmart
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


@query
def op8_substring_dedup(spark, sf_dir):
    """Words covered by a 13-word window of a smaller doc_id go."""
    kept = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"),
                       F.sha2("text", 256).alias("kept_sha256"))


@query
def op6_ngram_join(spark, sf_dir):
    """Components of documents whose 4-word shingles overlap by 85 %."""
    return ngram_join(table(spark, sf_dir, "documents"))


@query
def op4_retrieval_packing(spark, sf_dir):
    """All documents in sequences of at most 2048 tokens."""
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


@query
def op9_language_id(spark, sf_dir):
    """Language of every document; a quarter of the ids is held out."""
    docs = table(spark, sf_dir, "documents")
    held = fold("doc_id", 4) == 2
    net = language_id.fit(docs.filter(~held))
    return language_id.predict(docs, net).select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op10_toxicity(spark, sf_dir):
    """Toxicity of every document; a fifth of the ids is held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = fold("doc_id", 5) == 0
    model = toxicity.fit(docs, labels.filter(~held))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op2_quality(spark, sf_dir):
    """Posterior quality of every document and whether it stays."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels)
    out = quality.score(docs.select("doc_id", "source", "lang", "text"), model, F.col("source"), F.col("lang"), carry=False)
    return out.select("doc_id", "source", "lang", F.col("_score").alias("score"), F.col("_keep").alias("kept"))


def domain_of(source: str = "source"):
    """The domain of a source in the synthetic tables: one of four, by the
    number at the end of its name."""
    number = F.regexp_extract(source, r"(\d+)$", 1)
    return F.when(number != "", F.concat(F.lit("domain"), number.cast("long") % 4)).otherwise(F.lit("other"))


#: Weights of the mixing tree's nodes; all others weigh 1.
MIX_WEIGHTS = {"domain0": 2.0, "domain0/en": 3.0, "domain1/en": 3.0, "domain2/en": 3.0, "domain3/en": 3.0}


@query
def op7_mixing(spark, sf_dir):
    """Documents taken, with their epochs, for half of the corpus' words."""
    docs = table(spark, sf_dir, "documents")
    taken = mix(docs, domain_of(), F.col("lang"), F.col("source"), total_share=0.5, weights=MIX_WEIGHTS, max_epochs=2)
    return taken.select("doc_id", domain_of().alias("domain"), "lang", "source", F.col("_epoch").alias("epoch"))


@query
def op1_warc(spark, sf_dir):
    """Pages written as WARC records and read back from the bundles."""
    records = warc.read(warc.write(table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op3_vp_search(spark, sf_dir):
    """The 20 nearest rows of every twentieth vector by inner product."""
    return nearest(table(spark, sf_dir, "embeddings"), 20, "vec_id % 20 = 0")


@query
def op5_near_vectors(spark, sf_dir):
    """Links and components of vectors with a cosine of 0.95 or more."""
    return near_dedup(table(spark, sf_dir, "embeddings"))


@query
def op11_token_alignment(spark, sf_dir):
    """Groups and links of two tokenizers' tokens over every document."""
    aligned = alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                              public_tokenizers.path("piece_bpe_32k.model"))
    rows = aligned.select("key", "doc_id", "n_a", "n_b", "n_groups", "n_links",
                          F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"))
    return rows.join(alignment.link_counts(aligned), "key").drop("key")


@query
def op12_hard_negatives(spark, sf_dir):
    """Three hard negatives for each of the five positives of every fiftieth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", positives=5, negatives=3, low=50, high=95, label=label)


@query
def op13_shuffle_shards(spark, sf_dir):
    """All documents in eight shards of equal counts, in a random order."""
    placed = shuffle_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), 8)
    return placed.select("row.doc_id", "size", F.crc32(F.coalesce("row.text", F.lit(""))).alias("text_crc32"),
                         F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

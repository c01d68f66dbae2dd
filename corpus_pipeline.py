"""From raw documents to packed training sequences.

Each stage reads all that the one before it kept, and its decisions take effect: texts
without a language go, of equal texts and of near copies one stays, sources are mixed
to their target weights, and what is left is cut into sequences.  Stages are written to
the shared folder and read again; all but the last return the columns of documents.

Null and blank texts go with the first stage; texts of any length are read whole; repeated
rows are copies, of which one stays; a null doc_id, language or source is a value like any
other; columns of other names are carried on; an empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termspark.llm import exact_dedup, langid, mixing, ngram_join, packing
from termspark.llm.common import staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in which a language can be told: null texts and texts without a letter go."""
    return langid.accepted(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return exact_dedup.distinct(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that links join (0.75 or more on five-word shingles) the one with the smallest doc_id."""
    return ngram_join.representatives(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document that the mix takes twice is there twice."""
    return mixing.mix(docs).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens, with their ids."""
    import public_tokenizers
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [("language ID", language_id), ("exact dedup", exact_copies), ("n-gram Jaccard join", near_copies),
          ("mixing", mixed), ("packing", packed)]

#: SQL has no tokenizer, classifier or seeded draw; tests hold each stage against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)

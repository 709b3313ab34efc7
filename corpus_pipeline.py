"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatloom.llm import exact_dedup, packing, quality, simhash, substring_dedup
from flatloom.llm.queries import tokenizer
from flatloom.llm.shipping import ship
from flatloom.scratch import new_path, remove, stages


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    ship(spark)
    return quality.kept_documents(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space, one stays."""
    return exact_dedup.without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints, the document with the smallest id stays."""
    ship(spark)
    return simhash.one_of_each_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that a 20-word window repeats are cut out of the texts; every document stays."""
    ship(spark)
    left = substring_dedup.without_repeated_words(docs)
    return left.withColumn("n_chars", F.char_length("text").cast("long"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, in pieces with their places in sequences of 1024."""
    ship(spark)
    found = packing.packed(docs, tokenizer("byte_bpe_50k.json"), with_ids=True)
    return found.select("row.doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("simhash_dedup", near_copies),
    ("substring_dedup", repeated_passages),
    ("best_fit_packing", packed_sequences),
]

# Fingerprints and token ids are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next.

    What a stage needs on the way, and what the stage before it has written, is removed once it
    has been written itself.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        path = new_path(spark, name)
        with stages(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        remove(spark, *before)
        docs, before = spark.read.parquet(path), [path]
    return docs

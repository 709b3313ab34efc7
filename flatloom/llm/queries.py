"""The queries of this subpackage, by name, with SQL where SQL can say the same."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatloom.llm import sql
from flatloom.llm.centroids import clustered
from flatloom.llm.exact_dedup import with_digests
from flatloom.llm.language_model import scored
from flatloom.llm.line_dedup import without_aligned_lines
from flatloom.llm.packing import packed
from flatloom.llm.personal_data import KINDS, number_of, personal_data
from flatloom.llm.prefix_trie import prefix_nodes
from flatloom.llm.quality import judged
from flatloom.llm.sentence_pieces import encoded
from flatloom.llm.shipping import ship
from flatloom.llm.simhash import near_duplicates
from flatloom.llm.substring_dedup import repeated_words
from flatloom.llm.suffix_dedup import repeated_bytes
from flatloom.llm.url_filter import judged_urls

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its own name, with the SQL it is checked against, if any."""

    def register(run: Run) -> Run:
        @functools.wraps(run)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return run(spark, sf_dir)

        QUERIES[run.__name__] = shipped
        if oracle:
            SQL[run.__name__] = oracle.strip()
        return run

    return register


def tokenizer(name: str) -> str:
    """Where the file of a public tokenizer lies on the machines that run this."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


@query(sql.QUALITY)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures of the base rules and the verdict of the whole cascade."""
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = judged(_documents(spark, sf_dir), measures=measures)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.select("row.doc_id", *measures, failed.alias("base_failed"), "kept")


@query(sql.REPEATED_WORDS)
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words covered by a 20-word window that also starts earlier, removed."""
    found = repeated_words(_documents(spark, sf_dir))
    return found.select("row.doc_id", F.col("n_units").alias("n_words"), "n_removed", F.col("kept").alias("kept_sha256"))


@query(sql.REPEATED_BYTES)
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by a 100-byte string that also starts earlier, removed."""
    found = repeated_bytes(_documents(spark, sf_dir))
    return found.select(
        "row.doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", F.col("kept").alias("kept_sha256")
    )


@query()
def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 4-word shingles, linked at 4 or fewer differing bits."""
    found = near_duplicates(_documents(spark, sf_dir))
    fingerprint = F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint")
    return found.select("row.doc_id", fingerprint, "component_id")


@query(sql.EXACT)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document stays of those equal but for white space."""
    return with_digests(_documents(spark, sf_dir))


@query(sql.URLS)
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rules, or by what its aliases are judged."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return judged_urls(pages).select("row.page_id", "host", "path", "rule", "verdict")


@query()
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of lines that align with an earlier document, removed."""
    found = without_aligned_lines(_documents(spark, sf_dir))
    return found.select("row.doc_id", "n_lines", "n_removed", F.col("kept").alias("kept_sha256"))


@query()
def op8_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as pieces, and whether these give the text back."""
    docs = _documents(spark, sf_dir).withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit(""))))
    found = encoded(docs, tokenizer("piece_bpe_32k.model"), with_ids=False, decode=True)
    same = (F.col("decoded_crc32") == F.col("row.text_crc32")).alias("round_trip")
    return found.select("row.doc_id", "n_pieces", "ids_crc32", same)


@query()
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as token pieces, packed into sequences of 1024."""
    found = packed(_documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))
    return found.select("row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query()
def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text scored by the base and by the mixed model."""
    return scored(_documents(spark, sf_dir))


@query(sql.CENTROIDS)
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its cluster after five rounds."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    found = clustered(vectors)
    return found.select("row.vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@query(sql.PREFIXES)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct prefix of the rebuilt conversations, with its members, children, leaves and savings."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_nodes(conversations.select("conv_id", "turn", "role", "text"))


@query()
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's entities of the fixed patterns, and these with what contexts give away."""
    found = personal_data(_documents(spark, sf_dir))
    counts = [number_of(k).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    digest = F.sha2(F.col("base_text").cast("binary"), 256).alias("base_sha256")
    return found.select("row.doc_id", *counts, digest, F.col("spans_text").alias("spans"))

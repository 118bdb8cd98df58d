"""The registered queries of this folder, one per operator, and their DuckDB oracles.

Each query applies its operator to its whole table with production
parameters and derives the digest columns from the operator's output.
``ORACLE`` holds SQL only where SQL can express the result; the others are
held against brute force in ``tests/llm``.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality.llm import (adaptive_rules, adsampling, decontaminate, forced_bpe, html_density, jaccard, length_histogram,
                          licenses, prefix_free, quality, repair, spelling, turn_repair)
from tonality.llm.common import run_dir, via_table
from tonality.sources.tables import table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(fn: QueryFn) -> QueryFn:
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file (never copied into the repository)."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register
def op1_adaptive_dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 rows of largest inner product for every vector whose id is divisible by 20."""
    return adsampling.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@register
def op2_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, and lines of documents, that are a known license text."""
    return licenses.scan(table(spark, sf_dir, "documents"))


ORACLE["op2_license_digests"] = licenses.scan_sql()


@register
def op3_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    out = forced_bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))


@register
def op4_spaced_seed_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in documents."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op4_spaced_seed_leaks"] = decontaminate.leaks_sql()


@register
def op5_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the token file of all documents, reads it back and digests each document's ids."""
    path = repair.write(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                        posixpath.join(run_dir(spark, "tokens"), "shards"))

    return repair.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register
def op6_prefix_free_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 50-byte strings of earlier ones."""
    out = prefix_free.deduplicate(table(spark, sf_dir, "documents"), width=50)
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@register
def op7_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the resampling keeps, with their importance weight and rank."""
    out = quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.where("kept").select("doc_id", "log_weight", "key_weight", "rank")


@register
def op8_token_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every context limit keeps: one row per distinct encoded length of the documents."""
    lengths = length_histogram.token_lengths(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return length_histogram.suffix_sums(via_table(length_histogram.histogram(lengths), "lengths"))


@register
def op9_size_aware_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose sets of 4-word shingles reach a similarity of 0.85."""
    return jaccard.classes(table(spark, sf_dir, "documents"), width=4, percent=85)


@register
def op10_html_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_density.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


@register
def op11_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's rule figures and whether it stays under its language's and source's thresholds."""
    return adaptive_rules.judge(table(spark, sf_dir, "documents"))


ORACLE["op11_adaptive_rules"] = adaptive_rules.judge_sql()


@register
def op12_survivor_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations: their faults and the cheapest repair."""
    return turn_repair.audit(turn_repair.damage(table(spark, sf_dir, "conversations")), present="present")


@register
def op13_bit_sliced_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every longer word of the documents with its near words, form and root."""
    return spelling.variants(table(spark, sf_dir, "documents"))

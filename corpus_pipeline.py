"""A training-corpus pipeline over ``documents``: five stages of the operators in ``tonality.llm``.

Each stage takes all rows that its predecessor kept and returns the rows that
stay (the last one: their token ids).  Rows keep all columns of ``documents``;
rows with equal ``doc_id`` stay or go together.  Null and empty texts pass all
filters; an empty table gives an empty result.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tonality.llm import decontaminate, forced_bpe, jaccard, prefix_free, quality
from tonality.llm.common import run_dir
from tonality.llm.queries import vocabulary
from tonality.sources.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
ORACLE_SQL: str | None = None     # SQL expresses neither the classifier nor the encoder: tested by brute force


def quality_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the resampling rejects."""
    return quality.keep(docs, quality.resample(docs, table(spark, sf_dir, "labels")))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (5-word shingles, similarity 0.8): the one with the smallest id."""
    found = jaccard.classes(docs, width=5, percent=80)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_first")).distinct()
    return docs.join(first, F.col("doc_id").eqNullSafe(F.col("_first")), "left_semi")


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of earlier documents; documents of which nothing is left go."""
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    out = prefix_free.deduplicate(docs, width=50, whole_characters=True, carry=rest)
    out = out.where((F.col("n_bytes") == 0) | (F.octet_length("kept") > 0))
    return out.withColumn("text", F.decode("kept", "UTF-8")).select(
        *[F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def uncontaminated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark passage."""
    found = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))
    leaking = found.select(F.col("doc_id").alias("_leaking")).distinct()
    return docs.join(leaking, F.col("doc_id").eqNullSafe(F.col("_leaking")), "left_anti")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded_sha256)``: the ids of what is left, and the digest of their decoding."""
    out = forced_bpe.round_trip(docs, vocabulary("word_bpe_49k.json"))
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                      F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_documents),
    ("near_duplicates", distinct_documents),
    ("repeated_passages", without_repeated_passages),
    ("benchmark_leaks", uncontaminated_documents),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    base = run_dir(spark, "pipeline")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = posixpath.join(base, name)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs

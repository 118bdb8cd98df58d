"""Registered queries of the title search, with their oracles.

Titles are the first sentences of the documents (and the sources), requests are words inside them.
"""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality.operators.reviews import union_reviews
from tonality.operators.search import index_titles, search_titles
from tonality.operators.vocab import fit_vocabulary
from tonality.plans.features import tokenize
from tonality.plans.registry import (MAX_LEN, MAX_WORDS, RESOLVE_CTES, _resolve_ctes, pinned_scorer, register, title_requests,
                                     title_sentiment_sql)
from tonality.plans.serving import score_titles
from tonality.session import shared_dir
from tonality.sources.stages import read_stage, write_stage
from tonality.sources.tables import labelled_reviews, table, title_catalogue, title_reviews
from tonality.streaming.metrics import file_stream
from tonality.streaming.scoring import freeze_vocabulary
from tonality.streaming.verdicts import start_review_totals, start_verdict_stream

CONTAINS = "rk.k <> '' AND contains(ck.k, rk.k)"


def _first_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where(F.col("text").isNotNull())
    lines = docs.select(F.get(F.split("text", "[.\n]", 2), 0).alias("title"), "source")
    return read_stage(spark, write_stage(lines, shared_dir(spark, "first-sentences", uuid.uuid4().hex)))     # read five times


@register("title_search_contains", f"""
WITH line AS (SELECT string_split_regex(text, '[.\n]')[1] AS title, source FROM documents WHERE text IS NOT NULL),
{_resolve_ctes("SELECT DISTINCT title FROM line",
               "SELECT array_to_string(string_split(title, ' ')[2:3], ' ') AS request FROM line "
               "UNION ALL SELECT '(' || title || ')' FROM line UNION ALL SELECT title || ' no such ' || source FROM line "
               "UNION ALL SELECT substr(source, 4) FROM line", CONTAINS)}
SELECT request, title, status FROM res
""")
def q_title_search_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 K3 P3 by containment: two inner words, another spelling, a number and an unknown title of each sentence."""
    lines = _first_sentences(spark, sf_dir)
    words = F.slice(F.split("title", " "), 2, 2)
    requests = union_reviews(
        lines.select(F.array_join(words, " ").alias("request")), lines.select(F.concat(F.lit("("), "title", F.lit(")")).alias("request")),
        lines.select(F.concat("title", F.lit(" no such "), "source").alias("request")),
        lines.select(F.substr("source", F.lit(4)).alias("request")))
    return search_titles(requests, index_titles(lines.select("title")))


@register("title_sentiment_search", title_sentiment_sql(_resolve_ctes(
    "SELECT DISTINCT source AS title FROM documents",
    "SELECT substr(title, 3) AS request FROM cat UNION ALL SELECT title || '?' FROM cat UNION ALL SELECT 'no ' || title FROM cat",
    CONTAINS)))
def q_title_sentiment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 where requests are the ends of titles, found by the index."""
    catalogue = title_catalogue(spark, sf_dir)
    requests = union_reviews(catalogue.select(F.substr("title", F.lit(3)).alias("request")),
                             catalogue.select(F.concat("title", F.lit("?")).alias("request")),
                             catalogue.select(F.concat(F.lit("no "), "title").alias("request")))
    vocab = fit_vocabulary(tokenize(labelled_reviews(spark, sf_dir)), MAX_WORDS)
    out = score_titles(requests, catalogue, title_reviews(spark, sf_dir), pinned_scorer, vocab=vocab,
                       max_words=MAX_WORDS, max_len=MAX_LEN, index=index_titles(catalogue))
    return out.withColumn("score", F.round("score", 6))


def _quarters(spark: SparkSession, reviews: DataFrame) -> tuple[str, list[str]]:
    """Deals reviews out to four folders of as many files together as shuffles have partitions; copies of a row go to
    different ones.  Returns an empty folder and what to move there, one after the other."""
    held, arriving = (shared_dir(spark, kind, uuid.uuid4().hex) for kind in ("held", "arriving"))
    parts = 4 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    reviews.repartition(parts).withColumn("quarter", F.spark_partition_id() % 4).write.partitionBy("quarter").parquet(held)
    return arriving, [posixpath.join(held, f"quarter={i}") for i in range(4)]


def _arrive(spark: SparkSession, folder: str, arriving: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(place(folder)):                  # few reviews leave a quarter empty
        files.mkdirs(place(arriving))
        if not files.rename(place(folder), place(arriving, posixpath.basename(folder).replace("=", "-"))):
            raise OSError(f"{folder} could not be moved to {arriving}")


@register("title_request_stream_incremental", title_sentiment_sql(RESOLVE_CTES))
def q_title_request_stream_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews arrive in four micro-batches and are scored once each; requests are answered from the totals.

    A micro-batch is a folder of many files; as many as shuffles have partitions are written, not four."""
    asked = shared_dir(spark, "arriving", uuid.uuid4().hex)
    reviews = title_reviews(spark, sf_dir)
    arriving, quarters = _quarters(spark, reviews)
    title_requests(spark, sf_dir).write.parquet(asked)
    vocab = freeze_vocabulary(fit_vocabulary(tokenize(labelled_reviews(spark, sf_dir)), MAX_WORDS))
    stream = file_stream(spark, posixpath.join(arriving, "*"), reviews.schema)
    scoring, root = start_review_totals(spark, stream, vocab, pinned_scorer, max_words=MAX_WORDS, max_len=MAX_LEN, compact_every=3)
    try:
        for quarter in quarters:
            _arrive(spark, quarter, arriving)
            scoring.processAllAvailable()
        answering, out = start_verdict_stream(spark, file_stream(spark, asked, "request string"), title_catalogue(spark, sf_dir), root)
        try:
            answering.processAllAvailable()
        finally:
            answering.stop()
    finally:
        scoring.stop()
    return spark.read.parquet(out).drop("batch").withColumn("score", F.round("score", 6))

"""Parquet tables and the views the operators work on.

The review corpus is ``documents`` joined to ``labels``: ``value`` is the
text, ``label`` the ``quality`` flag and ``title`` the ``source``.  Column
selection happens before the join so the scans read only what is used.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(sf_dir, f"{name}.parquet"))


SPREAD_SETTING = "spark.tonality.spreadTo"


def text_table(spark: SparkSession, sf_dir: str, name: str = "documents", key: str = "doc_id",
               spread_to: int | None = None) -> DataFrame:
    """A table whose text is about to be tokenised, spread over ``spread_to`` partitions if asked to.

    Without the argument the session's ``spark.tonality.spreadTo`` counts; where
    neither is set the scan's own splits stay and nothing is shuffled.
    """
    if spread_to is None:
        setting = spark.conf.get(SPREAD_SETTING, None)
        spread_to = int(setting) if setting else None
    return spread(table(spark, sf_dir, name), key, spread_to)


def spread(df: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """Hash-spreads ``df`` over ``parts`` partitions; ``None`` leaves it as it is.

    A Parquet file is split by row groups, so a table stored as one row group
    is tokenised by a single task.  Whether its text is worth a shuffle is the
    caller's decision, never made from sizes or core counts here.
    """
    return df if parts is None else df.repartition(parts, key)


def labelled_reviews(spark: SparkSession, sf_dir: str, with_title: bool = False) -> DataFrame:
    """``(doc_id, value, label[, title])``: one row per labelled document.

    Catalyst picks the join: ``labels`` is broadcast while its scan is under
    the broadcast threshold, else both sides shuffle on ``doc_id``.
    """
    cols = [F.col("doc_id"), F.col("text").alias("value")]
    if with_title:
        cols.append(F.col("source").alias("title"))
    docs = text_table(spark, sf_dir).select(*cols)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return docs.join(labels, "doc_id")


def title_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(title, doc_id, review)``: every document is a review of its source."""
    return text_table(spark, sf_dir).select(
        F.col("source").alias("title"), "doc_id", F.col("text").alias("review"))


def title_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known titles: the distinct sources (a partial-aggregated distinct)."""
    return table(spark, sf_dir, "documents").select(F.col("source").alias("title")).distinct()

"""Title verdicts kept up to date (R1, M6): a review is scored once, when it arrives.

Two streams share a folder of versioned totals:

* ``start_review_totals`` scores the reviews of each micro-batch - only these - and writes their number and
  summed predictions per title as that batch's table; a marker written after it says that
  the table is whole.  A retried batch replaces its own table.  Every ``compact_every`` batches
  the sum of all so far is written as a new base, so readers open a bounded number of tables.
* ``start_verdict_stream`` answers title requests from the newest base and the batches after
  it: sums per title, no review is read.

``read_totals`` gives the totals to batch jobs as well.
"""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tonality.operators.score import join_verdicts, resolve_titles
from tonality.operators.search import TitleIndex, search_titles
from tonality.plans.features import preprocess
from tonality.session import shared_dir
from tonality.streaming.scoring import Scorer

TOTALS = "title string, n_reviews long, votes double, probabilities double"
AVERAGES = {"vote": "votes", "mean_prob": "probabilities"}


def _write(df: DataFrame, root: str, kind: str, version: int) -> None:
    """A table of a version, then the marker that it is whole."""
    df.write.mode("overwrite").parquet(posixpath.join(root, kind, f"version={version}"))
    mark = df.sparkSession.range(1).select(F.lit(kind).alias("kind"))
    mark.write.mode("overwrite").parquet(posixpath.join(root, "whole", f"version={version}", f"of={kind}"))


def _whole(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """``(version)`` of the tables of a kind that are whole."""
    marks = spark.read.schema("kind string, version long, of string").parquet(posixpath.join(root, "whole"))
    return marks.where(F.col("of") == kind).select("version")


def _tables(spark: SparkSession, root: str, kind: str) -> DataFrame:
    return spark.read.schema(f"{TOTALS}, version long").parquet(posixpath.join(root, kind))


def _sums(parts: DataFrame) -> DataFrame:
    return parts.groupBy("title").agg(*[F.sum(c).alias(c) for c in ("n_reviews", "votes", "probabilities")])


def read_totals(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """``(title, n_reviews, votes, probabilities)`` of every review scored so far (up to batch ``upto``)."""
    def known(kind: str) -> DataFrame:
        versions = _whole(spark, root, kind)
        return versions if upto is None else versions.where(F.col("version") <= upto)

    newest = known("base").agg(F.max("version")).first()[0]      # one number
    base = _tables(spark, root, "base").where(F.col("version") == newest)
    later = (_tables(spark, root, "batch").where(F.col("version") > newest)
             .join(known("batch"), "version", "left_semi"))
    return _sums(base.drop("version").unionByName(later.drop("version")))


def start_review_totals(spark: SparkSession, reviews: DataFrame, vocab: DataFrame, scorer: Scorer, root: str | None = None,
                        max_words: int = 10000, max_len: int = 100, compact_every: int = 50) -> tuple[StreamingQuery, str]:
    """``reviews (title, doc_id, review)`` as a stream -> totals below ``root``; returns ``(query, root)``."""
    root = root or shared_dir(spark, "streams", "totals", uuid.uuid4().hex)
    nothing = spark.createDataFrame([], TOTALS)
    for kind in ("base", "batch"):
        _write(nothing, root, kind, -1)        # readers always find a version

    def add(batch: DataFrame, epoch: int) -> None:
        feats, _ = preprocess(batch, text_col="review", key_col="doc_id", carry=["title"],
                              max_words=max_words, max_len=max_len, vocab=vocab)
        scored = scorer(feats).groupBy("title").agg(
            F.count(F.lit(1)).alias("n_reviews"), F.sum(F.col("prediction").cast("double")).alias("votes"),
            F.sum(F.col("probability").cast("double")).alias("probabilities"))
        _write(scored, root, "batch", epoch)
        if (epoch + 1) % compact_every == 0:
            _write(read_totals(batch.sparkSession, root, upto=epoch), root, "base", epoch)

    q = reviews.writeStream.foreachBatch(add).option("checkpointLocation", posixpath.join(root, "checkpoint")).start()
    return q, root


def verdicts(requests: DataFrame, catalogue: DataFrame, root: str, average: str = "vote", threshold: float = 0.5,
             index: TitleIndex | None = None) -> DataFrame:
    """``(request, title, n_reviews, score, sentiment, status)`` from the totals as they are now."""
    resolved = resolve_titles(requests, catalogue) if index is None else search_titles(requests, index)
    totals = read_totals(requests.sparkSession, root).where(F.col("n_reviews") > 0)
    per_title = totals.select("title", "n_reviews", (F.col(AVERAGES[average]) / F.col("n_reviews")).alias("score"))
    return join_verdicts(resolved, per_title, threshold)


def start_verdict_stream(spark: SparkSession, requests: DataFrame, catalogue: DataFrame, root: str,
                         out_dir: str | None = None, **options) -> tuple[StreamingQuery, str]:
    """Requests ``(request)`` as a stream -> verdicts in ``out/batch=<id>/``, replaced if a batch is retried."""
    place = out_dir or shared_dir(spark, "streams", "verdicts", uuid.uuid4().hex)
    out = posixpath.join(place, "out")

    def answer(batch: DataFrame, epoch: int) -> None:
        found = verdicts(batch, catalogue, root, **options)
        found.write.mode("overwrite").parquet(posixpath.join(out, f"batch={epoch}"))

    q = requests.writeStream.foreachBatch(answer).option("checkpointLocation", posixpath.join(place, "checkpoint")).start()
    return q, out

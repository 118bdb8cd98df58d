"""Scoring reviews, or requests for titles, as they arrive.

Each micro-batch runs the batch path - words, ids with a fixed vocabulary,
fixed length, scores - through ``foreachBatch``.  Encoding regroups a
document's words, which inside ``foreachBatch`` is an ordinary batch
aggregate and keeps no streaming state.  The vocabulary is written once as a
small Parquet table and read by every batch, so a batch never recomputes it
from the training corpus.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tonality.plans.features import preprocess
from tonality.plans.serving import score_titles
from tonality.session import shared_dir

Scorer = Callable[[DataFrame], DataFrame]


def freeze_vocabulary(vocab: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the vocabulary (at most ``num_words - 1`` rows) and reads it back."""
    spark = vocab.sparkSession
    path = path or shared_dir(spark, "vocab", uuid.uuid4().hex)
    vocab.select("word", "n", "id").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def start_scoring_stream(spark: SparkSession, reviews: DataFrame, vocab: DataFrame, scorer: Scorer,
                         out_dir: str | None = None, text_col: str = "value", key_col: str = "doc_id",
                         carry=("label",), max_words: int = 10000, max_len: int = 100,
                         columns=("doc_id", "label", "probability", "prediction")
                         ) -> tuple[StreamingQuery, str]:
    """``reviews`` is a streaming frame; scored rows land in ``out/batch=<id>/``."""
    root = out_dir or shared_dir(spark, "streams", "scoring", uuid.uuid4().hex)
    out, ckpt = posixpath.join(root, "out"), posixpath.join(root, "checkpoint")

    def score_batch(batch: DataFrame, epoch: int) -> None:
        # One folder per micro-batch, overwritten: a retried batch replaces
        # its own output instead of appending a second copy.
        feats, _ = preprocess(batch, text_col=text_col, key_col=key_col, carry=list(carry),
                              max_words=max_words, max_len=max_len, vocab=vocab)
        scorer(feats).select(*columns).write.mode("overwrite").parquet(posixpath.join(out, f"batch={epoch}"))

    q = reviews.writeStream.foreachBatch(score_batch).option("checkpointLocation", ckpt).start()
    return q, out


def start_title_stream(spark: SparkSession, requests: DataFrame, catalogue: DataFrame, reviews: DataFrame,
                       scorer: Scorer, out_dir: str | None = None, **options) -> tuple[StreamingQuery, str]:
    """Requests ``(request)`` as a stream -> verdicts ``(request, title, n_reviews, score, sentiment, status)``.

    Each micro-batch is one ``score_titles`` call (``options`` are its own) over
    the catalogue and reviews as they are then; verdicts land in
    ``out/batch=<id>/``, replaced if the batch is retried.
    """
    root = out_dir or shared_dir(spark, "streams", "titles", uuid.uuid4().hex)
    out, ckpt = posixpath.join(root, "out"), posixpath.join(root, "checkpoint")

    def answer(batch: DataFrame, epoch: int) -> None:
        verdicts = score_titles(batch, catalogue, reviews, scorer, **options)
        verdicts.write.mode("overwrite").parquet(posixpath.join(out, f"batch={epoch}"))

    q = requests.writeStream.foreachBatch(answer).option("checkpointLocation", ckpt).start()
    return q, out

"""Term weights (T9): document frequency and inverse document frequency.

``idf = ln((m + 1) / (df + 1))`` with ``m`` documents, the formula of Spark
ML's ``IDF``.  Exact words are counted here (``CountVectorizer`` style); for
the hashed variant use :func:`tonality.operators.train.tfidf_stages`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def idf_weights(df: DataFrame, words_col: str = "words", key_col: str = "doc_id",
                min_doc_freq: int = 0) -> DataFrame:
    """``(word, df, idf)``.  The document count is a scalar subquery (one row)."""
    per_doc = df.select(F.explode_outer(F.array_distinct(F.col(words_col))).alias("word")) \
        .where(F.col("word").isNotNull())
    dfreq = per_doc.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    if min_doc_freq > 0:
        dfreq = dfreq.where(F.col("df") >= min_doc_freq)
    m = df.agg(F.count(F.lit(1)).alias("m")).scalar()
    idf = F.log((m + F.lit(1.0)) / (F.col("df") + F.lit(1.0)))
    return dfreq.select("word", "df", idf.alias("idf"))


def tfidf_weights(df: DataFrame, words_col: str = "words", key_col: str = "doc_id") -> DataFrame:
    """``(key, word, tf, tfidf)``: each word's count in each document, weighted by its idf."""
    tf = df.select(key_col, F.explode_outer(words_col).alias("word")).where(F.col("word").isNotNull()) \
        .groupBy(key_col, "word").agg(F.count(F.lit(1)).alias("tf"))
    idf = idf_weights(df, words_col, key_col).select("word", "idf")
    return tf.join(idf, "word").select(key_col, "word", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))

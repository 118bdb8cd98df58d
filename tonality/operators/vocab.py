"""Word counts (A1) and the ranked vocabulary (K2, M7).

Rank rule: ids 1, 2, ... by descending corpus count; ties go to the word
that appears first, i.e. the smallest ``(doc key, position)``; only ids below
``num_words`` are kept.

Scale notes
-----------
* Counting is a hash aggregate with map-side partials, so a very frequent
  word costs one row per map task, not one per occurrence.
* The global top-k is ``orderBy(...).limit(k)``: Spark keeps a bounded
  k-row heap per task and merges the per-task heaps, so no task ever holds
  more than k rows per input partition.  Ids are then numbered over those
  k rows only.
* The per-group top-k (one vocabulary per title) is found by a threshold: the words'
  counts are folded to (count, words) per group, which gives the k-th count exactly; words
  below it are dropped before any sort, those above it are fewer than k, and only words that tie with
  it are ranked by first appearance, in ``salt_buckets`` parts.  So a title that holds a third
  of all words never sorts its vocabulary, in one task or many.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonality.session import shared_dir
from tonality.sources.stages import read_stage, write_stage


def _rank_order():
    return (F.desc("n"), F.asc("first"), F.asc("word"))   # the word tells rows with equal keys apart


def first_key(key_col: str, pos_col: str, whole: bool = True) -> "F.Column":
    """``(key, pos)`` packed into one orderable ``decimal(38,0)``: ``key * 2^31 + pos``.

    A single numeric ``min`` keeps the count a hash aggregate; a ``min`` over
    a struct would force a sort-based aggregate (a sort of every token).  Keys
    that are not whole numbers take the struct all the same.
    """
    if not whole:
        return F.struct(F.col(key_col).alias("key"), F.col(pos_col).alias("pos"))
    return (F.col(key_col).cast("decimal(38,0)") * F.lit(2 ** 31).cast("decimal(38,0)")
            + F.col(pos_col).cast("decimal(38,0)")).cast("decimal(38,0)")


def word_counts(df: DataFrame, words_col: str = "words", key_col: str = "doc_id",
                by: Sequence[str] = ()) -> DataFrame:
    """``(*by, word, n, first)``: occurrences of each word and where it first appears.

    ``posexplode_outer`` + a null filter rather than ``posexplode``: the
    latter makes Catalyst infer ``size(words) > 0`` and push that filter (and
    with it the whole tokenisation) below joins that would have dropped rows.
    """
    whole = isinstance(df.schema[key_col].dataType, T.IntegralType)
    exploded = df.select(*by, key_col, F.posexplode_outer(words_col).alias("pos", "word")) \
        .where(F.col("word").isNotNull())
    return exploded.groupBy(*by, "word").agg(
        F.count(F.lit(1)).alias("n"), F.min(first_key(key_col, "pos", whole)).alias("first"))


def _check_num_words(num_words: int) -> None:
    if not isinstance(num_words, int) or num_words < 2:
        raise ValueError("num_words must be an int >= 2 (ids run from 1 to num_words - 1)")


def fit_vocabulary(df: DataFrame, num_words: int = 10000, words_col: str = "words",
                   key_col: str = "doc_id") -> DataFrame:
    """K2: ``(word, n, id)`` for the ``num_words - 1`` highest-ranked words."""
    _check_num_words(num_words)
    counts = word_counts(df, words_col, key_col)
    top = counts.orderBy(*_rank_order()).limit(num_words - 1)
    ranked = top.withColumn("id", F.row_number().over(Window.orderBy(*_rank_order())))
    return ranked.select("word", "n", F.col("id").cast("int").alias("id"))


def kth_counts(counts: DataFrame, group_col: str, k: int) -> DataFrame:
    """``(group, cut, above)``: each group's k-th greatest count and the number of words with more.

    Words are folded to one row per distinct count first, of which a group has few (about the root
    of its words at most), so the running sum from the top holds no group's words.  A group of fewer than
    ``k`` words has no cut.
    """
    folded = counts.groupBy(group_col, "n").agg(F.count(F.lit(1)).alias("words"))
    top = Window.partitionBy(group_col).orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    upto = folded.withColumn("upto", F.sum("words").over(top))
    return upto.groupBy(group_col).agg(
        F.max(F.when(F.col("upto") >= k, F.col("n"))).alias("cut"),
        F.coalesce(F.max(F.when(F.col("upto") < k, F.col("upto"))), F.lit(0)).alias("above"))


def top_candidates(counts: DataFrame, group_col: str, k: int, salt_buckets: int) -> DataFrame:
    """The rows of ``counts`` that can be among a group's top ``k``, few more than ``k`` of them.

    Words below the group's k-th count go before anything is sorted.  Those above it stay.  Of those that
    tie with it, each of ``salt_buckets`` parts keeps as many as are still wanted, by first appearance.
    """
    cuts = kth_counts(counts, group_col, k).withColumnRenamed(group_col, "_g")
    marked = (counts.join(cuts, F.col(group_col).eqNullSafe(F.col("_g")), "left").drop("_g")
              .where(F.col("n") >= F.coalesce("cut", F.lit(0))))
    tied = F.coalesce(F.col("n") == F.col("cut"), F.lit(False))
    part = F.when(tied, F.pmod(F.xxhash64("word"), F.lit(salt_buckets))).otherwise(-1)
    w = Window.partitionBy(group_col, "_salt").orderBy(F.asc("first"), F.asc("word"))
    ties = marked.where(tied).withColumn("_salt", part).withColumn("_r", F.row_number().over(w)) \
        .where(F.col("_r") <= k - F.col("above"))
    cols = [group_col, "word", "n", "first"]
    return marked.where(~tied).select(*cols).unionByName(ties.select(*cols))


def fit_vocabulary_by(df: DataFrame, group_col: str, num_words: int = 10000,
                      words_col: str = "words", key_col: str = "doc_id",
                      salt_buckets: int | None = None) -> DataFrame:
    """M7: one vocabulary per group, ``(group, word, n, id)``.

    The counts are read twice (for the cuts, then for the candidates), so they are written once to
    the shared folder.  ``salt_buckets`` defaults to the session's number of shuffle partitions,
    which is set with the data's size."""
    _check_num_words(num_words)
    spark = df.sparkSession
    salt_buckets = salt_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    k = num_words - 1
    path = write_stage(word_counts(df, words_col, key_col, by=[group_col]), shared_dir(spark, "counts", uuid.uuid4().hex))
    candidates = top_candidates(read_stage(spark, path), group_col, k, salt_buckets)
    w = Window.partitionBy(group_col).orderBy(*_rank_order())
    ranked = candidates.withColumn("id", F.row_number().over(w)).where(F.col("id") <= k)
    return ranked.select(group_col, "word", "n", F.col("id").cast("int").alias("id"))

"""Quality selection by importance resampling.

Two generative models over hashed token n-grams are counted: one of the target
(documents labelled good) and one of the raw text (all documents); each gives
the probability that a document has the n-gram.  A
document's log weight is the sum, over its distinct n-grams, of the logarithm of the
ratio of the two models.  Documents are then sampled without replacement by
Gumbel top-k: each gets its log weight plus Gumbel noise from a hash of its
key and text, and the ``k`` largest stay.

Only n-grams that the target avoids count (their ratio is significantly below
one; all others weigh nothing), so that a weight does not grow with a
document's length.  Words are runs of letters and digits, lower case, and
runs of other visible characters; n-grams are words, their first 4 to 7 bytes
and word pairs; repetitions of the word before are n-grams
of their own kind, one for each power of two that a text's number of them
reaches.

``k`` is the number of documents whose weight reaches the cut that separates
good from bad labelled documents best.  Labels are used of at most
``MAX_LABELS`` rows (those with the smallest key hash), so they are broadcast;
the raw model counts all documents, and the ranks are exact over all of them.

Null and empty texts have no n-grams, log weight 0, and are ranked like any
other; equal keys with different texts are documents of their own, ties are
broken by key and text hash.  Without labels every document stays.  Columns
beside key and text are carried along unread.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonality.llm.common import (cast_like, clean_strings, mix64, pieces, range_hashes, shuffle_parts, sum_blocks,
                                 utf8, via_table, workers_import)

WORDS = 1 << 18          # cells for single words,
PREFIXES = 1 << 17       # for words' first bytes,
PAIRS = 1 << 15          # for word pairs,
LEVELS = 16              # and for how often a text repeats a word at once, in powers of two
BUCKETS = WORDS + PREFIXES + PAIRS + LEVELS
PREFIX_BYTES = (4, 5, 6, 7)
BLOCKS = 16
MAX_LABELS = 20_000
SMOOTHING = 0.5
SURE = 6.0               # standard deviations by which the target must avoid an n-gram ...
AVOIDED = 0.35           # ... and the ratio below which it is avoided
NOISE = 0.5              # scale of the Gumbel noise against a log weight

_SPACE, _MARK, _WORD = 0, 1, 2
_KIND = np.full(256, _MARK, np.uint8)
_KIND[[*range(0x00, 0x21), 0x7F]] = _SPACE
_KIND[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = _WORD
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(cells, texts)``: each text's distinct n-grams as hash cells, and the text that each is of.

    An n-gram counts once a text, so that one text's repetitions do not carry
    a model; how often a text repeats itself is told by the level cells.
    """
    none = np.empty(0, np.int64)
    if not len(data):
        return none, none
    low = _LOWER[data]
    kind = _KIND[low]
    edge = np.empty(len(kind), bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], len(data))
    seen = kind[starts] != _SPACE
    starts, ends = starts[seen], ends[seen]
    if not len(starts):
        return none, none
    text = np.searchsorted(offsets, starts, "right") - 1
    long = [np.flatnonzero(ends - starts >= n) for n in PREFIX_BYTES]
    hashes = range_hashes(low, np.concatenate([starts, *[starts[x] for x in long]]),
                          np.concatenate([ends, *[starts[x] + n for x, n in zip(long, PREFIX_BYTES)]]))
    word = hashes[:len(starts)]
    with np.errstate(over="ignore"):
        pair = mix64(word[:-1] * np.uint64(0x9E3779B97F4A7C15) + word[1:])
    follows = text[1:] == text[:-1]
    again = follows & (word[1:] == word[:-1])
    new = follows & ~again
    repeats = np.bincount(text[1:][again], minlength=len(offsets) - 1)
    cells = [
        text * BUCKETS + (word % np.uint64(WORDS)).astype(np.int64),
        text[np.concatenate(long)] * BUCKETS + WORDS + (hashes[len(starts):] % np.uint64(PREFIXES)).astype(np.int64),
        text[1:][new] * BUCKETS + WORDS + PREFIXES + (pair[new] % np.uint64(PAIRS)).astype(np.int64),
        *[np.flatnonzero(repeats >= 1 << k) * BUCKETS + BUCKETS - LEVELS + k for k in range(LEVELS)],
    ]
    both = np.unique(np.concatenate(cells))
    return both % BUCKETS, both // BUCKETS


def label_sample(labels: DataFrame, key: str = "doc_id", quality: str = "quality", toxic: str = "toxic",
                 limit: int = MAX_LABELS) -> DataFrame:
    """``(key, good)``: at most ``limit`` labelled keys, those with the smallest hash; good is quality and not toxic."""
    known = labels.select(F.col(f"`{key}`").alias("key"),
                          ((F.coalesce(F.col(f"`{quality}`"), F.lit(0)) == 1)
                           & (F.coalesce(F.col(f"`{toxic}`"), F.lit(0)) == 0)).cast("int").alias("good"))
    known = known.where("key IS NOT NULL").groupBy("key").agg(F.min("good").alias("good"))
    return known.orderBy(F.xxhash64("key"), "key").limit(limit)


def log_ratio(target: np.ndarray, raw: np.ndarray, n_target: int, n_raw: int) -> np.ndarray:
    """Per bucket the log of target over raw probability where the target surely avoids it, else 0.

    Probabilities are shares of the ``n`` documents that have the n-gram.
    """
    t, r = target.astype(np.float64), raw.astype(np.float64)
    expected = r * (n_target / max(1, n_raw))
    ratio = (t + SMOOTHING) / (expected + SMOOTHING)
    sure = (expected - t > SURE * np.sqrt(expected + 1.0)) & (ratio < AVOIDED)
    return np.where(sure, np.log(ratio), 0.0).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """Log ratios of all buckets (a fixed number, 1.7 MB) from ``docs`` and ``label_sample(...)``."""
    workers_import(docs.sparkSession)
    marked = (cast_like(docs, key, text).toDF("key", "text")
              .join(F.broadcast(labels), "key", "left").select("text", F.coalesce("good", F.lit(0)).alias("good")))

    def count(batches):
        from pyspark import TaskContext

        total = np.zeros((2, BUCKETS + BLOCKS), np.int32)       # raw, target; the last cells count documents
        for b in batches:
            data, off = utf8(b.column(0))
            good = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for i, j in pieces(off):
                grams, texts = ngrams(data[off[i]:off[j]], off[i:j + 1] - off[i])
                total[0, :BUCKETS] += np.bincount(grams, minlength=BUCKETS)
                total[1, :BUCKETS] += np.bincount(grams[good[i:j][texts]], minlength=BUCKETS)
            total[:, BUCKETS] += [len(good), good.sum()]
        part = TaskContext.get().partitionId()
        cut = total.reshape(2, BLOCKS, -1)
        for k in range(BLOCKS):
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([k], pa.int32()), pa.array([cut[:, k].tobytes()], pa.binary())],
                ["part", "block", "counts"])

    sums = sum_blocks(marked.mapInArrow(count, "part int, block int, counts binary"), BLOCKS)
    if any(s is None for s in sums):
        return np.zeros(BUCKETS, np.float32)
    raw, target = np.concatenate([s.reshape(2, -1) for s in sums], axis=1)
    return log_ratio(target[:BUCKETS], raw[:BUCKETS], int(target[BUCKETS]), int(raw[BUCKETS]))


def weigh(docs: DataFrame, ratios: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, text_hash, log_weight double)`` for every row."""
    spark = docs.sparkSession
    workers_import(spark)
    shipped = spark.sparkContext.broadcast(ratios)
    kind = dict(docs.dtypes)[key]

    def score(batches):
        ratio = shipped.value.astype(np.float64)
        for b in batches:
            data, off = utf8(clean_strings(b.column(2)))
            out = np.zeros(len(off) - 1)
            for i, j in pieces(off):
                grams, texts = ngrams(data[off[i]:off[j]], off[i:j + 1] - off[i])
                out[i:j] = np.bincount(texts, ratio[grams], j - i)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.round(out, 6))],
                                             ["key", "text_hash", "log_weight"])

    rows = cast_like(docs, key, text).toDF("key", "text").select("key", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(score, f"key {kind}, text_hash long, log_weight double").withColumnRenamed("key", key)


def best_cut(weights: DataFrame, labels: DataFrame, key: str = "doc_id") -> float | None:
    """The log weight from which labelled documents are good: the best balanced accuracy on the label sample."""
    pairs = weights.select(F.col(f"`{key}`").alias("key"), "log_weight").join(F.broadcast(labels), "key")
    by = pairs.groupBy(F.round("log_weight", 1).alias("w")).agg(
        F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")).orderBy("w").collect()  # at most the sample
    good, bad = sum(r.good for r in by), sum(r.bad for r in by)
    if not good or not bad:
        return None
    best, cut, below_good, below_bad = -1.0, None, 0, 0
    for r in by:                                # keep weights from r.w on
        score = (good - below_good) / good + below_bad / bad
        if score > best:
            best, cut = score, r.w - 0.05
        below_good += r.good
        below_bad += r.bad
    return cut


def select(weights: DataFrame, k: int, seed: int = 0, noise: float = NOISE, key: str = "doc_id") -> DataFrame:
    """``weights`` with ``rank`` (from 1) and ``kept``: Gumbel top-k over all rows.

    The rows are range-partitioned by their perturbed weight; a row's rank is
    its place in its partition after those of the partitions before, so no
    task sees them all.
    """
    spark = weights.sparkSession
    unit = (F.pmod(F.xxhash64(F.lit(seed), F.col(f"`{key}`"), "text_hash"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = weights.withColumn("key_weight", F.col("log_weight") - F.lit(noise) * F.log(-F.log(unit)))
    order = [F.col("key_weight").desc(), F.col(f"`{key}`").asc_nulls_first(), F.col("text_hash")]
    placed = via_table(keyed.repartitionByRange(shuffle_parts(spark), *order)
                       .withColumn("part", F.spark_partition_id()), "gumbel")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))   # a row per partition
    ranked = (placed.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy(*order)))
              .join(F.broadcast(bases), "part").withColumn("rank", F.col("base") + F.col("place")))
    return ranked.drop("part", "place", "base").withColumn("kept", F.col("rank") <= F.lit(int(k)))


def resample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", quality: str = "quality",
             toxic: str = "toxic", seed: int = 0) -> DataFrame:
    """``(key, text_hash, log_weight, key_weight, rank, kept)`` per document: the whole operator."""
    sample = via_table(label_sample(labels, key, quality, toxic), "labels")
    weights = via_table(weigh(docs, fit(docs, sample, key, text), key, text), "weights")
    cut = best_cut(weights, sample, key)
    k = weights.count() if cut is None else weights.where(F.col("log_weight") >= cut).count()
    return select(weights, k, seed, key=key)


def keep(docs: DataFrame, decisions: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose decision is ``kept``, all columns."""
    kept = decisions.where("kept").select(F.col(f"`{key}`").alias("_key"), F.col("text_hash").alias("_hash")).distinct()
    on = F.col(f"`{key}`").eqNullSafe(F.col("_key")) & (F.xxhash64(F.col(f"`{text}`")) == F.col("_hash"))
    return docs.join(kept, on, "left_semi")

"""Exact length histogram: token totals for every context limit from one aggregate.

Documents are aggregated by their encoded length, ``(n_tokens, docs)``; the
histogram has one row per distinct length, and suffix sums over it answer

* how many documents are longer than a limit,
* the tokens left when every document is cut at a limit,
* any quantile of the lengths,

exactly and for every limit at once, without reading the texts again.

Null and empty texts have length 0.  An empty table gives an empty
histogram.  Repeated rows count as often as they occur.  Other columns are
not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonality.llm import byte_bpe
from tonality.llm.common import cast_like, clean_strings, workers_import

SPAN = 4096   # lengths per bin of the two-step suffix sums


def token_lengths(docs: DataFrame, vocab_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_tokens long)`` for every row, whole texts encoded."""
    spark = docs.sparkSession
    workers_import(spark)
    config = byte_bpe.load(spark, vocab_path)
    kind = dict(docs.dtypes)[key]

    def lengths(batches):
        enc = byte_bpe.encoder(config)
        for b in batches:
            n = [len(x) // 4 for x in enc.encode(s.as_py() for s in clean_strings(b.column(1)))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["key", "n_tokens"])

    return cast_like(docs, key, text).mapInArrow(lengths, f"key {kind}, n_tokens long").withColumnRenamed("key", key)


def histogram(lengths: DataFrame, col: str = "n_tokens") -> DataFrame:
    """``(n_tokens, docs)``: partial counts per task, then one row per distinct length."""
    return lengths.groupBy(F.col(col).alias("n_tokens")).agg(F.count(F.lit(1)).alias("docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """Per distinct length ``L``: what a context limit of ``L`` tokens keeps.

    ``docs_longer`` documents exceed ``L`` and hold ``tokens_longer`` tokens;
    ``docs_upto`` fit; ``tokens_upto`` is their total; ``truncated_total`` is
    the corpus total when each document is cut at ``L``; ``quantile`` is the
    share of documents that fit.

    Two steps, so no task holds all lengths: totals per bin of 4,096 lengths
    are summed over the (few) bins, then within each bin.
    """
    h = hist.withColumn("bin", F.floor(F.col("n_tokens") / SPAN)).withColumn("tokens", F.col("n_tokens") * F.col("docs"))
    above = Window.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, -1)
    bins = (h.groupBy("bin").agg(F.sum("docs").alias("bd"), F.sum("tokens").alias("bt"))
            .withColumn("docs_above", F.coalesce(F.sum("bd").over(above), F.lit(0)))
            .withColumn("tokens_above", F.coalesce(F.sum("bt").over(above), F.lit(0)))
            .select("bin", "docs_above", "tokens_above"))
    total = h.agg(F.sum("docs").alias("all_docs"), F.sum("tokens").alias("all_tokens"))
    inside = Window.partitionBy("bin").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    longer = (h.join(bins, "bin")
              .withColumn("docs_longer", F.col("docs_above") + F.coalesce(F.sum("docs").over(inside), F.lit(0)))
              .withColumn("tokens_longer", F.col("tokens_above") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))))
    full = longer.join(F.broadcast(total))        # one row
    return full.select(
        "n_tokens", "docs", "docs_longer", "tokens_longer",
        (F.col("all_docs") - F.col("docs_longer")).alias("docs_upto"),
        (F.col("all_tokens") - F.col("tokens_longer")).alias("tokens_upto"),
        (F.col("all_tokens") - F.col("tokens_longer") + F.col("docs_longer") * F.col("n_tokens")).alias("truncated_total"),
        ((F.col("all_docs") - F.col("docs_longer")) / F.col("all_docs")).alias("quantile"))


def truncated_totals(hist: DataFrame, limits: list[int]) -> DataFrame:
    """``(context_limit, tokens)`` for the stated limits, lengths that occur or not."""
    each = hist.select(F.explode(F.array(*[F.lit(int(x)) for x in limits])).alias("context_limit"), "n_tokens", "docs")
    return each.groupBy("context_limit").agg(
        F.sum(F.least(F.col("n_tokens"), F.col("context_limit").cast("long")) * F.col("docs")).alias("tokens"))


def quantile(sums: DataFrame, q: float) -> DataFrame:
    """``(n_tokens)``: the smallest length that at least a share ``q`` of the documents do not exceed."""
    return sums.where(F.col("quantile") >= F.lit(float(q))).agg(F.min("n_tokens").alias("n_tokens"))

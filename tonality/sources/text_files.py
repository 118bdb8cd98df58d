"""Review text files (S1, S2) and request records.

``load_reviews`` reads ``*.txt`` under a class folder: one row per line (the
reference's behaviour) or one per file with ``wholetext=True``; the class
label is a literal.  ``load_labelled_dirs`` reads several class folders in a
single scan and takes each row's label from its file path.

Rows get a ``doc_id``: a 64-bit hash of the file's path and the line's number,
so it is the same on every read, in every load and however files are cut into blocks and packed
into partitions.  A large file is read by as many tasks as it has blocks: a line's number is its
number in the block plus the lines of the blocks before, which one small aggregate counts.  With
``wholetext=True`` a file is one row (and has to fit one).
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _read(spark: SparkSession, paths: str | list[str], wholetext: bool) -> DataFrame:
    """``(doc_id, value, file)``: a row per line or file; ``file`` is the decoded path."""
    # a path is URI-encoded, not form-encoded: a plus sign stands for itself
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    if wholetext:
        files = spark.read.text(paths, wholetext=True).select("value", path.alias("file"))
        return files.select(F.xxhash64("file", F.lit(0)).alias("doc_id"), "value", "file")
    return _numbered(spark.read.text(paths).select(
        "value", path.alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at")))


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines with the key of their number in the file, from their number in the block.

    A task reads a block from its start to its end, so ``at`` rises by one from line to line; the block's least
    ``at`` and its number of lines, one row per block, give the rest by a sum over the blocks before it.
    """
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    number = F.col("at") + F.col("shift")
    # numbers are hashed as the 32-bit ones they are in all but the largest files
    key = F.when(number < 2 ** 31, F.xxhash64("file", number.try_cast("int"))).otherwise(F.xxhash64("file", number))
    return lines.join(starts, ["file", "block"]).select(key.alias("doc_id"), "value", "file")


def load_reviews(spark: SparkSession, path: str, label: int, wholetext: bool = False,
                 with_key: bool = True) -> DataFrame:
    """S1 + S2: ``(doc_id, value, label)`` from ``path/*.txt``."""
    df = _read(spark, posixpath.join(path, "*.txt"), wholetext)
    return df.select(*(["doc_id"] if with_key else []), "value", F.lit(int(label)).alias("label"))


def load_labelled_dirs(spark: SparkSession, root: str, classes: Mapping[str, int] | None = None,
                       wholetext: bool = False) -> DataFrame:
    """S1 + S2 in one scan: ``(doc_id, value, label, file)`` for ``root/<class>/*.txt``."""
    classes = dict(classes or {"pos": 1, "neg": 0})
    df = _read(spark, [posixpath.join(root, c, "*.txt") for c in classes], wholetext)
    folder = F.element_at(F.split("file", "/"), -2)
    label = F.raise_error(F.concat(F.lit("no class for folder "), folder)).cast("int")
    for name, value in classes.items():
        label = F.when(folder == F.lit(name), F.lit(int(value))).otherwise(label)
    return df.select("doc_id", "value", label.alias("label"), "file")


REQUEST_SCHEMA = T.StructType([
    T.StructField("title", T.StringType(), False),
    T.StructField("reviews", T.ArrayType(T.StructType([
        T.StructField("content", T.StringType(), True),
    ])), True),
])


def flatten_reviews(nested: DataFrame, title_col: str = "title", reviews_col: str = "reviews",
                    content_field: str = "content", keep_empty: bool = False) -> DataFrame:
    """S3 + P4: ``(title, review_id, review)``; a review without content becomes ``''``.

    A title with no reviews yields no row, so that scoring reports it as
    ``no_reviews``; ``keep_empty`` keeps it as one row with a null
    ``review_id`` and an empty review.
    """
    explode = F.posexplode_outer if keep_empty else F.posexplode
    ex = nested.select(title_col, explode(reviews_col).alias("review_id", "_r"))
    return ex.select(F.col(title_col).alias("title"), "review_id",
                     F.coalesce(F.col(f"_r.{content_field}"), F.lit("")).alias("review"))


def records_frame(spark: SparkSession, records: Iterable, schema: T.StructType | str) -> DataFrame:
    """Small in-memory records (e.g. a batch of requests) with a declared schema."""
    return spark.createDataFrame(list(records), schema)

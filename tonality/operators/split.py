"""Hold-out split (M1) and the repeatable shuffle order (K1).

Both are pure functions of the row key and a seed, so they need no shuffle,
give the same answer on every re-run and after a lost executor, and can be
reproduced in SQL.  The hash split keeps about (not exactly) the requested
fraction; ``holdout_split_exact`` finds the hash at which exactly the requested number of
rows lies above, by counting.  NumPy's permutation is not reproduced.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


SPLIT_STEPS = 1_000_000


def key_hash_hex(key, seed: int) -> Column:
    """``md5(key || ':' || seed)`` as 32 hex digits."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def split_bucket(key, seed: int = 42) -> Column:
    """0..999,999 from the first 8 hex digits of the key hash."""
    head = F.conv(F.substring(key_hash_hex(key, seed), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(SPLIT_STEPS)).cast("int")


def _cut(test_size: float) -> int:
    """The first test bucket; a share too small or large for the steps is an error, not an empty side."""
    cut = round((1.0 - test_size) * SPLIT_STEPS)
    if not 0.0 <= test_size <= 1.0 or (0.0 < test_size < 1.0 and cut in (0, SPLIT_STEPS)):
        raise ValueError(f"test_size {test_size} is not a share in steps of {1 / SPLIT_STEPS}")
    return cut


def holdout_split(df: DataFrame, key_col: str = "doc_id", test_size: float = 0.2,
                  seed: int = 42, out: str = "split") -> DataFrame:
    """Adds ``out`` = ``'train'`` or ``'test'``; about ``test_size`` are test."""
    cut = _cut(test_size)
    return df.withColumn(
        out, F.when(split_bucket(key_col, seed) < F.lit(cut), F.lit("train")).otherwise(F.lit("test")))


def train_rows(df: DataFrame, key_col: str = "doc_id", test_size: float = 0.2, seed: int = 42) -> DataFrame:
    cut = _cut(test_size)
    return df.where(split_bucket(key_col, seed) < F.lit(cut))


def test_rows(df: DataFrame, key_col: str = "doc_id", test_size: float = 0.2, seed: int = 42) -> DataFrame:
    cut = _cut(test_size)
    return df.where(split_bucket(key_col, seed) >= F.lit(cut))


DIGITS = 4   # hex digits that a pass looks at: at most 65,536 counts


def _whole_hash(key_col: str, seed: int) -> Column:
    """The key's hash; a null key has the hash of an empty one."""
    return F.coalesce(key_hash_hex(key_col, seed), F.md5(F.lit(f":{seed}")))


def exact_cut(df: DataFrame, key_col: str = "doc_id", test_size: float = 0.2, seed: int = 42) -> str | None:
    """The least key hash (or a prefix of it) of the test side, which holds ``ceil(test_size * n)`` rows; None if that is 0.

    Selection by refinement: rows are counted by the first digits of their hash, the counts (a fixed number) summed
    from the top until the wanted row's digits are known, and the rows with these counted by the next ones.
    Two or three passes over the key column find the row among billions; nothing is sorted.
    """
    if not 0.0 <= test_size <= 1.0:
        raise ValueError(f"test_size {test_size} is not a share")
    hashes = df.select(_whole_hash(key_col, seed).alias("h"))
    prefix, wanted = "", None
    while True:
        digits = F.substring("h", len(prefix) + 1, DIGITS).alias("d")
        bins = hashes.where(F.col("h").startswith(prefix)).groupBy(digits).agg(F.count(F.lit(1)).alias("n"))
        if wanted is None:
            total = bins.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
            wanted = math.ceil(Fraction(str(test_size)) * total)
            if wanted == 0:
                return None
        from_top = Window.orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, 0)     # at most 65,536 rows
        at = bins.withColumn("upto", F.sum("n").over(from_top)).where(F.col("upto") >= wanted).orderBy("upto").limit(1).first()
        prefix += at.d
        wanted -= at.upto - at.n                          # of the rows that begin so
        if wanted == at.n or len(prefix) >= 32:
            return prefix


def holdout_split_exact(df: DataFrame, key_col: str = "doc_id", test_size: float = 0.2, seed: int = 42,
                        out: str = "split") -> DataFrame:
    """M1: ``'test'`` for exactly ``ceil(test_size * n)`` rows, those with the greatest key hashes; else ``'train'``.

    Rows that share a key are never parted: if the last test row's key occurs more often, its other rows
    are test rows too.
    """
    cut = exact_cut(df, key_col, test_size, seed)
    if cut is None:
        return df.withColumn(out, F.lit("train"))
    return df.withColumn(out, F.when(_whole_hash(key_col, seed) >= F.lit(cut), F.lit("test")).otherwise(F.lit("train")))


def shuffle_key(key, seed: int = 42) -> Column:
    """K1: a repeatable random sort key."""
    return key_hash_hex(key, seed)


def shuffled(df: DataFrame, key_col: str = "doc_id", seed: int | None = 42,
             out: str = "shuffle_key") -> DataFrame:
    """K1: rows in a random order.  ``seed=None`` uses ``rand()`` like the reference.

    This is a global sort (a range-partitioned shuffle); use it only where the
    order itself is wanted - the split does not need it.
    """
    if seed is None:
        return df.withColumn(out, F.rand().cast("string")).orderBy(out)
    return df.withColumn(out, shuffle_key(key_col, seed)).orderBy(out)

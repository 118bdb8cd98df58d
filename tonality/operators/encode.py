"""Sequence encoding (J1, T6) and padding (T7) as DataFrame operators.

``encode`` explodes each document's words with their positions, looks each
word up in the vocabulary with an equi-join, and folds the ids back into one
array per document in text order.  Out-of-vocabulary words vanish; a
document with no known word keeps its row with an empty sequence.

Plan: the lookup is an equi-join whose strategy Catalyst picks from the
vocabulary's size in bytes - the top-k plan carries its row limit and a frozen
vocabulary its file size, so a small one is broadcast and the text is not
shuffled; beyond the session's broadcast threshold both sides shuffle on the
word, with skew splitting.  The fold is one aggregate on the document key
whose partial step runs before the shuffle, so each document crosses the
network as a compact id list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonality.functions.text import pad_sequence


def encode(df: DataFrame, vocab: DataFrame, keys: Sequence[str] = ("doc_id",),
           words_col: str = "words", out: str = "seq", group_col: str | None = None,
           num_words: int | None = None) -> DataFrame:
    """``(*keys, out)``: the in-vocabulary ids of each row's words, in order.

    ``keys`` must identify a row.  Only ids below ``num_words`` count, whatever
    the vocabulary holds.  With ``group_col`` the vocabulary has one id space
    per group (``vocab`` then carries that column too).
    """
    keys = list(keys)
    lookup_keys = ["word"] + ([group_col] if group_col else [])
    carry = keys + ([group_col] if group_col and group_col not in keys else [])
    exploded = df.select(*carry, F.posexplode_outer(words_col).alias("pos", "word"))
    v = vocab.select(*lookup_keys, "id")
    if num_words is not None:
        v = v.where(F.col("id") < num_words)
    joined = exploded.join(v, lookup_keys, "left")
    # One placeholder row per document survives so empty documents stay.
    joined = joined.where(F.col("id").isNotNull() | F.col("pos").isNull() | (F.col("pos") == 0))
    # (pos, id) packed into one bigint, pos * 2^32 + id (both < 2^31, so exact):
    # the collected lists hold primitives and sort numerically into text order.
    packed = F.col("pos").cast("bigint") * F.lit(1 << 32) + F.col("id").cast("bigint")
    folded = joined.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(F.col("id").isNotNull(), packed))).alias("_p"))
    return folded.select(*keys, F.transform("_p", lambda x: (x % F.lit(1 << 32)).cast("int")).alias(out))


def pad(df: DataFrame, max_len: int = 100, seq_col: str = "seq", out: str = "features") -> DataFrame:
    """T7 on a column: fixed length ``max_len``, zeros on the left."""
    padded = df.withColumn(out, pad_sequence(seq_col, max_len))
    return padded.drop(seq_col) if out != seq_col else padded

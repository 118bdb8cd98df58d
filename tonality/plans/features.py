"""The composed preprocessing: text -> words -> vocabulary -> ids -> fixed length.

``preprocess`` is the Spark re-expression of the reference's
``preprocess_data``: the same two tokenisers and the same ranked
vocabulary, but the features stay in the same row as the key and label, and
nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonality.functions.text import review_words
from tonality.operators.encode import encode, pad
from tonality.operators.split import train_rows
from tonality.operators.vocab import fit_vocabulary, fit_vocabulary_by


def tokenize(df: DataFrame, text_col: str = "value", keep: Sequence[str] = ("doc_id", "label"),
             out: str = "words") -> DataFrame:
    """``(*keep, words)``."""
    return df.select(*keep, review_words(F.col(text_col)).alias(out))


def preprocess(df: DataFrame, text_col: str = "value", key_col: str = "doc_id",
               carry: Sequence[str] = ("label",), max_words: int = 10000,
               max_len: int = 100, vocab: DataFrame | None = None,
               fit_on: str = "all", seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Returns ``(features, vocab)``; features are ``(key, *carry, features array<int>)``.

    ``fit_on='all'`` fits the vocabulary on every row, as the reference does;
    ``'train'`` fits it on the hash-split train rows only, so hold-out words
    do not leak into the ids.  Of a given ``vocab`` the ids below ``max_words``
    are used.
    """
    words = tokenize(df, text_col, [key_col, *carry])
    if vocab is None:
        if fit_on == "all":
            fit_src = words
        elif fit_on == "train":
            fit_src = train_rows(words, key_col, seed=seed)
        else:
            raise ValueError("fit_on must be 'all' or 'train'")
        vocab = fit_vocabulary(fit_src, max_words, key_col=key_col)
    seqs = encode(words, vocab, keys=[key_col, *carry], num_words=max_words)
    return pad(seqs, max_len), vocab


def preprocess_by_group(df: DataFrame, group_col: str, text_col: str = "value",
                        key_col: str = "doc_id", max_words: int = 10000,
                        max_len: int = 100) -> tuple[DataFrame, DataFrame]:
    """M7: the vocabulary refitted inside each group (the serving variant)."""
    words = tokenize(df, text_col, [key_col, group_col])
    vocab = fit_vocabulary_by(words, group_col, max_words, key_col=key_col)
    seqs = encode(words, vocab, keys=[key_col, group_col], group_col=group_col,
                  num_words=max_words)
    return pad(seqs, max_len), vocab

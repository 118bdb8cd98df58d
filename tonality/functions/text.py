"""Column expressions for the text steps T1-T7, T10, T11.

Every function here takes and returns a ``Column`` and is built only from
``pyspark.sql.functions``, so it runs on the executors' JVM; nothing is a
Python UDF.  Lambdas over arrays (``filter``, ``transform``) are evaluated
outside whole-stage code, everything else inside it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonality.functions.stopwords import ENGLISH_STOP_WORDS

# --- fixed values: the second tokeniser's filter characters (T5) -----------
# Each of these becomes a separator; the apostrophe is not among them.
KERAS_FILTERS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'
KERAS_SPLIT = " "
# ---------------------------------------------------------------------------


def _java_char_class(chars: str) -> str:
    """A Java regex character class matching exactly ``chars``."""
    named = {"\t": "\\t", "\n": "\\n", "\x0b": "\\x0B", "\f": "\\f", "\r": "\\r", " ": " "}
    return "[" + "".join(named.get(c, c if c.isalnum() else "\\" + c) for c in chars) + "]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The six characters of Java's ``\\s``; T1 splits on each of them.
_WS_CHARS = " \t\n\x0b\f\r"
_WS_CLASS = _java_char_class(_WS_CHARS)
# T5 splits on the space and on every filter character.
_KERAS_CLASS = _java_char_class(KERAS_SPLIT + KERAS_FILTERS)


def ml_tokens(text) -> Column:
    """Lower-case, split on each single whitespace character.

    Same output as ``pyspark.ml.feature.Tokenizer``: inner and leading empty
    tokens are kept, trailing ones dropped, ``''`` gives ``['']`` and a string
    of only whitespace gives ``[]``.  A null text gives ``[]`` (the ML
    tokeniser throws).

    Trailing whitespace is trimmed (a character trim, no regex) and the text
    split on a one-character class (measured faster than mapping the
    whitespace to spaces with ``translate`` first).  The trim runs on the raw
    text (lower-casing neither makes nor removes ASCII whitespace), so the
    full-text ``lower`` appears once even where Spark evaluates this without
    code generation (inside the T2 lambda).
    """
    text = _col(text)
    trimmed = F.rtrim(text, F.lit(_WS_CHARS))
    empty = F.array().cast("array<string>")
    return (
        F.when(text.isNull(), empty)
        .when(text == F.lit(""), F.array(F.lit("")))
        .when(trimmed == F.lit(""), empty)
        .otherwise(F.split(F.lower(trimmed), _WS_CLASS))
    )


def remove_stop_words(tokens, stop_words=ENGLISH_STOP_WORDS, case_sensitive=False,
                      tokens_lower=True) -> Column:
    """Drop tokens that are exactly a stop word.

    Catalyst turns the ``IN`` list into a hash ``INSET`` inside the lambda, so
    the cost per token is one hash probe.  ``tokens_lower`` says the input is
    already lower-cased (true after :func:`ml_tokens`), which skips a second
    ``lower`` per token for the case-insensitive match.
    """
    words = list(stop_words) if case_sensitive else sorted({w.lower() for w in stop_words})

    def keep(w):
        key = w if (case_sensitive or tokens_lower) else F.lower(w)
        return ~key.isin(*words)

    return F.filter(_col(tokens), keep)


def join_tokens(tokens, sep: str = " ") -> Column:
    """T4: the tokens as one string."""
    return F.concat_ws(sep, _col(tokens))


def keras_words(text, lowered: bool = False) -> Column:
    """T5: the second tokeniser.

    Lower-case; each filter character becomes a space; split on the space;
    empty pieces dropped.  Other whitespace stays inside words.
    ``lowered=True`` skips the lower-casing for input that already is.
    """
    text = _col(text) if lowered else F.lower(_col(text))
    return F.array_remove(F.split(text, _KERAS_CLASS), "")


def review_words(text) -> Column:
    """T1 -> T2 -> T4 -> T5 as one expression: the words the vocabulary sees.

    T1 already lower-cases, so T5 does not lower-case the joined text again."""
    return keras_words(join_tokens(remove_stop_words(ml_tokens(text))), lowered=True)


def pad_sequence(seq, max_len: int, value: int = 0) -> Column:
    """Keep the last ``max_len`` ids and pad with ``value`` on the left."""
    seq = _col(seq)
    n = F.size(seq)
    kept = F.slice(seq, F.greatest(n - F.lit(max_len), F.lit(0)) + F.lit(1), max_len)
    return F.concat(F.array_repeat(F.lit(value), F.lit(max_len) - F.size(kept)), kept)


def ids_text(seq) -> Column:
    """An int array as space-separated text (for oracle comparison)."""
    return F.array_join(_col(seq).cast("array<string>"), " ")


def abs_diff(a, b) -> Column:
    """T10."""
    return F.abs(_col(a) - _col(b))


def bytes_to_kib(c) -> Column:
    """T11."""
    return _col(c) / F.lit(1024.0)

"""DuckDB SQL for every query that SQL can express.

These strings are the independent check of the Spark plans: the driver runs
them on the same Parquet tables (registered as views) and compares the
results.  The fragments below spell the same text rules in DuckDB's
dialect: ``\\s`` is written as the explicit class ``[ \\t\\n\\x0B\\f\\r]``,
lambdas use ``lambda x: ...``, and floats are rounded to 6 places.
"""

from __future__ import annotations

from tonality.functions.stopwords import sql_list

WS = r"[ \t\n\x0B\f\r]"
KERAS_CLASS = r'[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~\t\n]'
STOP_IN = sql_list()

REVIEWS = ("SELECT d.doc_id, d.text AS value, l.quality AS label, d.source AS title "
           "FROM documents d JOIN labels l ON d.doc_id = l.doc_id")


def ml_tokens(x: str) -> str:
    lx = f"lower({x})"
    trimmed = f"regexp_replace({lx}, '{WS}+$', '')"
    return (f"(CASE WHEN {x} IS NULL THEN []::VARCHAR[] WHEN {lx} = '' THEN [''] "
            f"WHEN {trimmed} = '' THEN []::VARCHAR[] "
            f"ELSE string_split_regex({trimmed}, '{WS}') END)")


def drop_stop_words(toks: str) -> str:
    return f"list_filter({toks}, lambda w: w NOT IN ({STOP_IN}))"


def keras_words(x: str) -> str:
    return (f"list_filter(string_split(regexp_replace(lower({x}), '{KERAS_CLASS}', ' ', 'g'), ' '), "
            f"lambda w: w <> '')")


def review_words(x: str) -> str:
    return keras_words(f"array_to_string({drop_stop_words(ml_tokens(x))}, ' ')")


def words_ctes(source_sql: str, keys: str = "doc_id, label", text: str = "value",
               p: str = "") -> str:
    """CTEs ``{p}src`` and ``{p}w(keys, words)``."""
    return (f"{p}src AS ({source_sql}),\n"
            f"{p}w AS (SELECT {keys}, {review_words(text)} AS words FROM {p}src)")


def tok_cte(p: str = "", by: str = "") -> str:
    """CTE ``{p}tok(doc_id, [by,] word, pos)`` from ``{p}w``."""
    by_sel = f"{by}, " if by else ""
    return (f"{p}tok AS (SELECT {by_sel}doc_id, unnest(words) AS word, "
            f"generate_subscripts(words, 1) - 1 AS pos FROM {p}w)")


def vocab_ctes(num_words: int, p: str = "", by: str = "") -> str:
    """CTEs ``{p}tok``, ``{p}counts`` and ``{p}vocab([by,] word, n, id)``."""
    by_sel = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return (tok_cte(p, by) + ",\n"
            f"{p}counts AS (SELECT {by_sel}word, count(*) AS n, min(doc_id * 1000000 + pos) AS first "
            f"FROM {p}tok GROUP BY {by_sel}word),\n"
            f"{p}vocab AS (SELECT {by_sel}word, n, "
            f"CAST(row_number() OVER ({part}ORDER BY n DESC, first) AS INTEGER) AS id "
            f"FROM {p}counts QUALIFY id < {num_words})")


def encode_ctes(keys: str = "doc_id, label", p: str = "", by: str = "", vocab: str | None = None) -> str:
    """CTEs ``{p}hits`` and ``{p}enc(keys, seq)`` (needs ``{p}tok`` and a vocabulary)."""
    vocab = vocab or f"{p}vocab"
    using = f"word, {by}" if by else "word"
    sel = ", ".join(f"{p}w." + k.strip() for k in keys.split(","))
    return (f"{p}hits AS (SELECT {p}tok.doc_id, list({vocab}.id ORDER BY {p}tok.pos) AS seq "
            f"FROM {p}tok JOIN {vocab} USING ({using}) GROUP BY {p}tok.doc_id),\n"
            f"{p}enc AS (SELECT {sel}, coalesce({p}hits.seq, []::INTEGER[]) AS seq "
            f"FROM {p}w LEFT JOIN {p}hits ON {p}w.doc_id = {p}hits.doc_id)")


def pad(seq: str, max_len: int) -> str:
    return (f"(CASE WHEN len({seq}) >= {max_len} THEN list_slice({seq}, len({seq}) - {max_len - 1}, len({seq})) "
            f"ELSE list_concat(list_transform(range({max_len} - len({seq})), lambda x: 0::INTEGER), {seq}) END)")


def ids_text(seq: str) -> str:
    return f"array_to_string({seq}, ' ')"


def split_bucket(key: str, seed: int = 42) -> str:
    return f"(CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8)) AS BIGINT) % 1000000)"


def padded_ctes(max_words: int = 10000, max_len: int = 100, source_sql: str = REVIEWS,
                keys: str = "doc_id, label") -> str:
    """CTEs ending in ``feat(keys, features)``."""
    return ("WITH " + words_ctes(source_sql, keys) + ",\n" + vocab_ctes(max_words) + ",\n"
            + encode_ctes(keys) + ",\n"
            + f"feat AS (SELECT {keys}, {pad('seq', max_len)} AS features FROM enc)")

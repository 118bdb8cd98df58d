"""Quality rules with adaptive thresholds: quantile sketches per language and source in place of fixed cutoffs.

Per document, in one pass of expressions (no Python worker): words, characters
in words, symbols, repeated lines and words in repeated 3-word windows.  Rules
that hold everywhere come first (``base_failed``: fewer than 50 words, or more
than half of the words in repeated windows).  The other cutoffs are not fixed;
they come from the documents that pass the base:

1. Each rate (a whole number per thousand words) falls into a bin that keeps its
   six leading bits, so that a bin's edge is within 1/32 of any value in it.
   A sketch is the count of each bin.  It merges by adding counts, in any
   order and grouping: partial aggregates build it, a hot source is one
   row per bin and task, and a task that runs again changes nothing.
2. Sketches of ``(lang, source)`` are merged to one per language and one of all;
   a group of fewer than ``least`` documents takes the thresholds of its
   language, and a language of fewer those of all documents.
3. Each sketch gives a lower and an upper quartile and from them the fences
   ``q25 - reach * s`` and ``q75 + reach * s``, where ``s`` is the distance of the
   quartiles, but at least the rate's own least spread.
4. Documents are joined with their group's fences; one that lies beyond a fence goes.

Null text has no words.  A null language or source is a group of its own.
Repeated rows are judged and counted as often as they occur; equal values share a
bin, so ties need no rule.  An empty table gives an empty table.  Only key, text,
language and source are read, whatever other columns are called.  A row's arrays
are as long as its text; windows are compared as 64-bit hashes of their words.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonality.llm.common import via_table

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED = 50        # percent of the words
WINDOW = 3                # words of a repeated window
LEAST_DOCS = 200          # documents that a sketch needs for thresholds of its own
BITS = 6                  # leading bits that a bin keeps


@dataclass(frozen=True)
class Rate:
    """A rate per thousand words: its column, least spread of the quartiles, reach, and whether low values fail too."""
    name: str
    over: str
    spread: int
    reach: int
    low: bool = False


RATES = (Rate("word_length", "word_chars", 250, 4, low=True), Rate("symbols", "n_symbols", 50, 4),
         Rate("dup_lines", "n_dup_lines", 50, 4), Rate("repeats", "n_repeat_words", 100, 4))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _windows(words: Column) -> Column:
    def at(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])

    some = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), at)
    return F.when(F.size(words) >= WINDOW, some).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: Column) -> Column:
    """Words under windows that occur twice or more: equal windows are neighbours once sorted."""
    def starts(s: Column) -> Column:
        again = F.filter(s, lambda x, j: (x["g"] == F.get(s, j - 1)["g"]) | (x["g"] == F.get(s, j + 1)["g"]))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    pairs = F.sort_array(F.transform(windows, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    return let(pairs, lambda s: F.aggregate(
        starts(s), zero,
        lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), x - acc["last"])).alias("n")),
        lambda acc: acc["n"]))


def repeated_words(words: Column) -> Column:
    """How many words lie in a window that the text holds twice or more, the first included."""
    return let(_windows(words), lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(_covered(g)))


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
             source: str = "source") -> DataFrame:
    """``(key, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)`` per row."""
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{lang}`").cast("string").alias("lang"),
                       F.col(f"`{source}`").cast("string").alias("source"), t.alias("text"))
    counted = rows.select("key", "lang", "source", "text", words_of(F.col("text")).alias("words")).select(
        "key", "lang", "source",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.concat_ws("", "words")).cast("long").alias("word_chars"),
        (F.octet_length("text") - F.octet_length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        repeated_lines(F.col("text")).cast("long").alias("n_dup_lines"),
        let(F.col("words"), repeated_words).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def _rate(rate: Rate) -> Column:
    return F.expr(f"{rate.over} * 1000 div greatest(n_words, 1L)")


def _bin(v: Column) -> Column:
    """The value without all but its ``BITS`` leading bits."""
    drop = F.greatest(F.length(F.bin(v)) - BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, drop), drop)


def sketches(measured: DataFrame) -> DataFrame:
    """``(lang, source, rate, bin, n)``: the sketch of every group's documents that pass the base."""
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rate"), _bin(_rate(r)).alias("bin")) for r in RATES]))
    rows = measured.where(~F.col("base_failed")).select("lang", "source", each.alias("x"))
    return rows.groupBy("lang", "source", "x.rate", "x.bin").agg(F.count(F.lit(1)).alias("n"))


def merge(parts: DataFrame, *by: str) -> DataFrame:
    """Sketches merged to fewer keys: counts of equal bins are added."""
    return parts.groupBy(*by, "rate", "bin").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, *by: str) -> DataFrame:
    """``(*by, docs, low_<rate>, high_<rate> ...)`` of each sketch; its window holds one row a bin."""
    group = Window.partitionBy(*by, "rate")
    upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketch.withColumn("upto", F.sum("n").over(upto)).withColumn("docs", F.sum("n").over(group))
    quarter = lambda k: F.min(F.when(F.col("upto") * 4 >= F.col("docs") * k, F.col("bin")))
    edges = ranked.groupBy(*by, "rate").agg(F.max("docs").alias("docs"), quarter(1).alias("q25"), quarter(3).alias("q75"))
    out = [F.max("docs").alias("docs")]
    for r in RATES:
        mine = F.col("rate") == r.name
        reach = r.reach * F.greatest(F.col("q75") - F.col("q25"), F.lit(r.spread))
        out += [F.max(F.when(mine, F.col("q25") - reach)).alias(f"low_{r.name}"),
                F.max(F.when(mine, F.col("q75") + reach)).alias(f"high_{r.name}")]
    return edges.groupBy(*by).agg(*out)


def thresholds(parts: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """``(lang, source, low_*, high_*)`` for every group: its own fences, its language's or those of all."""
    cuts = [c for r in RATES for c in (f"low_{r.name}", f"high_{r.name}")]
    own = fences(parts, "lang", "source")
    wide = fences(merge(parts, "lang"), "lang").select(F.col("lang").alias("l"), F.col("docs").alias("l_docs"),
                                                       *[F.col(c).alias(f"l_{c}") for c in cuts])
    every = fences(merge(parts)).select(*[F.col(c).alias(f"a_{c}") for c in cuts])      # one row
    joined = own.join(wide, own["lang"].eqNullSafe(wide["l"]), "left").join(F.broadcast(every))
    return joined.select("lang", "source", *[
        F.when(F.col("docs") >= least, F.col(c)).when(F.col("l_docs") >= least, F.col(f"l_{c}"))
        .otherwise(F.col(f"a_{c}")).alias(c) for c in cuts])


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
          least: int = LEAST_DOCS) -> DataFrame:
    """Every row's measures, ``base_failed`` and ``kept``; see the module's text."""
    rows = via_table(measures(docs, key, text, lang, source), "measures")
    cuts = thresholds(via_table(sketches(rows), "sketches"), least).withColumnsRenamed({"lang": "g_lang", "source": "g_source"})
    inside = F.lit(True)
    for r in RATES:
        inside &= _rate(r) <= F.col(f"high_{r.name}")
        if r.low:
            inside &= _rate(r) >= F.col(f"low_{r.name}")
    same = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return rows.join(cuts, same, "left").select(
        F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        kept.alias("kept"))


def judge_sql() -> str:
    """The same rules for DuckDB, windows compared as words."""
    def value(r: Rate) -> str:
        return f"({r.over} * 1000 // greatest(n_words, 1))"

    def cut(r: Rate, side: str, sign: str) -> str:
        q = "q25" if side == "low" else "q75"
        return (f"max(CASE WHEN rate = '{r.name}' THEN {q} {sign} {r.reach} * greatest(q75 - q25, {r.spread}) END) "
                f"AS {side}_{r.name}")

    cuts = [f"{side}_{r.name}" for r in RATES for side in ("low", "high")]
    made = ", ".join(cut(r, side, sign) for r in RATES for side, sign in (("low", "-"), ("high", "+")))
    rates = " UNION ALL ".join(f"SELECT lang, source, '{r.name}' AS rate, {value(r)} AS v FROM m WHERE NOT base_failed"
                               for r in RATES)

    def level(name: str, by: str) -> str:
        keys = f"{by}, " if by else ""
        return f"""
        {name}_b AS (SELECT {keys}rate, bin, sum(n) AS n FROM bins GROUP BY {keys}rate, bin),
        {name}_r AS (SELECT *, sum(n) OVER (PARTITION BY {keys}rate ORDER BY bin) AS upto,
                            sum(n) OVER (PARTITION BY {keys}rate) AS docs FROM {name}_b),
        {name}_q AS (SELECT {keys}rate, max(docs) AS docs, min(CASE WHEN upto * 4 >= docs THEN bin END) AS q25,
                            min(CASE WHEN upto * 4 >= docs * 3 THEN bin END) AS q75 FROM {name}_r GROUP BY {keys}rate),
        {name} AS (SELECT {keys}max(docs) AS docs, {made} FROM {name}_q {'GROUP BY ' + by if by else ''})"""

    chosen = ", ".join(f"CASE WHEN o.docs >= {LEAST_DOCS} THEN o.{c} WHEN l.docs >= {LEAST_DOCS} THEN l.{c} ELSE a.{c} END AS {c}"
                       for c in cuts)
    inside = " AND ".join([f"{value(r)} <= high_{r.name}" for r in RATES] + [f"{value(r)} >= low_{r.name}" for r in RATES if r.low])
    return rf"""
    WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
    w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
    g AS (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
          FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
    hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g) WHERE n > 1),
    rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM hit) GROUP BY doc_id),
    c AS (SELECT w.doc_id, lang, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
                 length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')) AS n_symbols,
                 len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
          FROM w LEFT JOIN rep USING (doc_id)),
    m AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM c),
    v AS ({rates}),
    bins AS (SELECT lang, source, rate, (v >> s) << s AS bin, count(*) AS n
             FROM (SELECT *, greatest(length(bin(v)) - {BITS}, 0) AS s FROM v) GROUP BY ALL),
    {level("own", "lang, source")}, {level("wide", "lang")}, {level("every", "")},
    cuts AS (SELECT o.lang, o.source, {chosen} FROM own o LEFT JOIN wide l ON o.lang IS NOT DISTINCT FROM l.lang CROSS JOIN every a)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND coalesce({inside}, false) AS kept
    FROM m LEFT JOIN cuts ON m.lang IS NOT DISTINCT FROM cuts.lang AND m.source IS NOT DISTINCT FROM cuts.source
    """

"""Benchmark decontamination by spaced seeds.

A mask keeps some positions of a short run of words and ignores the others,
so a seed still matches when a word at an ignored position was exchanged.
All masked runs of the documents are hash-joined with those of the benchmark.
Around every hit the two texts are laid word against word: the pair is a leak
if some window of ``window`` words that holds the seed (the whole item, if it
is shorter) agrees in at least ``agree`` of its words.

No such pair is missed: whichever words of a window differ, within what
``agree`` allows, one of the masks falls on equal words only (tests enumerate
the patterns).  Items for whose length the spaced masks do not reach that are
looked up by a run of words so short that some such run must be equal, down to
the whole item; documents are cut into these runs only if such items occur.

Native expressions only.  The benchmark is the stated query set: equal texts
are one, and they are taken in blocks of about ``block_words`` words, each
broadcast by itself (three seeds a word, 40 bytes each): where there are
several, a block's pairs are written before the next one is taken, so that
executors hold one.  The documents are not shuffled.  A hit leaves its
document with the words beside the item only, never with the whole text: a
long document full of hits costs the hits times an item.  Seeds of words are
64-bit hashes; the check compares hashes of words too.

Words are runs of letters and digits, lower case; punctuation is dropped.
Documents and items that are null or have no words match nothing.  Repeated rows and items count once a pair, null keys
pair like others, other columns are not read, empty tables give no pairs.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import via_table

#: kept positions of each mask
MASKS = ((0, 1, 3, 4, 6, 7), (0, 1, 2, 4, 7, 9), (0, 3, 4, 5, 7, 8))
SPAN = max(max(m) for m in MASKS) + 1
SQL_MASKS = MASKS[:2]       # of ``leaks_sql``, which lays both over ``SPAN`` words
MOST_ENUMERATED = 3         # differing words up to which the spaced masks are tried
WINDOW = 13
AGREE = 0.8
BLOCK_WORDS = 1_000_000


def words(text: Column) -> Column:
    """Words of a text as an array; empty for null."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain.isNull() | (plain == ""), F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def missed(masks: tuple[tuple[int, ...], ...], width: int, differing: int) -> list[tuple[int, ...]]:
    """Choices of ``differing`` places in ``width`` words that leave no mask on equal words only."""
    seeds = [{at + o for o in m} for m in masks for at in range(width - max(m))]
    return [c for c in combinations(range(width), differing) if not any(seed.isdisjoint(c) for seed in seeds)]


def masks_for(width: int, agree: float = AGREE) -> tuple[tuple[int, ...], ...]:
    """Masks of which one lies on equal words in any window of ``width`` words that agrees enough."""
    differing = max(0, min(width - 1, width - math.ceil(agree * width)))
    if differing <= MOST_ENUMERATED and width > max(MASKS[0]) and not missed(MASKS, width, differing):
        return tuple(m for m in MASKS if max(m) < width)
    # The equal words stand in at most differing + 1 runs: the longest has at least this many.
    return (tuple(range(-(-(width - differing) // (differing + 1)))),)


def _span(mask: tuple[int, ...]) -> int:
    return max(mask) + 1


def _seed(n: int, mask: tuple[int, ...], hashes: str, at: str) -> Column:
    """The seed of mask number ``n`` at position ``at``: the kept words' hash, null where the mask does not fit."""
    return F.when(F.col(at) + _span(mask) <= F.size(hashes),
                  F.xxhash64(F.lit(n), *[F.get(F.col(hashes), F.col(at) + o) for o in mask]))


def _positions(hashes: str, span: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.size(hashes) - span))


def _sizes(items: DataFrame, window: int, block_words: int) -> tuple[int, list[int]]:
    """The number of blocks and the widths of the items' windows."""
    size = F.size("item_hashes")
    total, widths = items.agg(F.sum(size), F.collect_set(F.least(size, F.lit(window)))).first()
    return max(1, -(-(total or 0) // block_words)), sorted(widths) or [window]


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
          item_text: str = "text", window: int = WINDOW, agree: float = AGREE,
          block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(key, item, item_words, matched_words, window_words, first_word)`` per document and leaked item.

    ``matched_words`` agree over the whole item as laid, ``window_words`` in
    the best window, and the item's place in the document starts at word
    ``first_word`` (its smallest; below 0 if the item's beginning is cut).
    """
    items = benchmark.select(F.col(f"`{item}`").alias("item"), word_hashes(F.col(f"`{item_text}`")).alias("item_hashes")) \
        .where(F.size("item_hashes") > 0).withColumn("text_no", F.xxhash64("item_hashes"))
    n_blocks, widths = _sizes(items, window, block_words)
    of_width = {w: masks_for(w, agree) for w in widths}
    masks = list(dict.fromkeys(m for w in widths for m in of_width[w]))
    least = min(map(_span, masks))
    rows = docs.select(F.col(f"`{key}`").alias("key"), word_hashes(F.col(f"`{text}`")).alias("hashes")) \
        .where(F.size("hashes") >= least)
    at = rows.select("key", "hashes", _positions("hashes", least).alias("at"))
    seeds = at.select("key", "hashes", "at", F.explode(
        F.array(*[_seed(n, m, "hashes", "at") for n, m in enumerate(masks)])).alias("seed"))
    width = F.least(F.size("item_hashes"), F.lit(window))
    of_item = F.array(*[F.struct(
        F.when(width.isin([w for w in widths if m in of_width[w]]), _seed(n, m, "item_hashes", "item_at")).alias("seed"),
        F.lit(_span(m)).alias("span")) for n, m in enumerate(masks)])
    found = None
    for b in range(n_blocks):
        block = items.where(F.pmod("text_no", F.lit(n_blocks)) == b)
        texts = block.select("text_no", "item_hashes").distinct()
        item_seeds = (texts.where(F.size("item_hashes") >= least)
                      .select("text_no", "item_hashes", _positions("item_hashes", least).alias("item_at"))
                      .select("text_no", F.size("item_hashes").alias("item_words"), "item_at", F.inline(of_item))
                      .where("seed IS NOT NULL"))
        first = F.col("at") - F.col("item_at")
        begin = F.greatest(first, F.lit(0))
        hits = (seeds.join(F.broadcast(item_seeds.distinct()), "seed")
                .select("key", "text_no", "item_at", "span", first.alias("first_word"),
                        F.slice("hashes", begin + 1, first + F.col("item_words") - begin).alias("beside"))
                .join(F.broadcast(texts), "text_no"))
        pairs = (_verified(hits, window, agree).groupBy("key", "text_no").agg(*_best())
                 .join(F.broadcast(block.select("text_no", "item").distinct()), "text_no").drop("text_no"))
        if n_blocks > 1:
            pairs = via_table(pairs, "leaks")
        found = pairs if found is None else found.unionByName(pairs)
    return found.groupBy("key", "item").agg(*_best()).withColumnRenamed("key", key).withColumnRenamed("item", item)


def _best() -> list[Column]:
    return [f(c).cast("long").alias(c) for f, c in ((F.max, "item_words"), (F.max, "matched_words"),
                                                    (F.max, "window_words"), (F.min, "first_word"))]


def _verified(hits: DataFrame, window: int, agree: float) -> DataFrame:
    before = F.least("first_word", F.lit(0))            # words of the item that stand before the document

    def same(j: Column) -> Column:
        place = before + j
        return (place >= 0) & (F.get(F.col("beside"), place) == F.get(F.col("item_hashes"), j))

    def agreeing(lo: Column, hi: Column) -> Column:
        return F.size(F.filter(F.sequence(lo, hi), same))

    length = F.size("item_hashes")
    width = F.least(F.lit(window), length)
    first = F.greatest(F.lit(0), F.col("item_at") + F.col("span") - width)
    last = F.greatest(first, F.least(F.col("item_at"), length - width))
    best = F.array_max(F.transform(F.sequence(first, last), lambda s: agreeing(s, s + width - 1)))
    out = hits.select("key", "text_no", "first_word", length.alias("item_words"), width.alias("width"),
                      agreeing(F.lit(0), length - 1).alias("matched_words"), best.alias("window_words"))
    return out.where(F.col("window_words") >= F.ceil(F.lit(agree) * F.col("width"))).drop("width")


def leaks_sql(window: int = WINDOW, agree: float = AGREE) -> str:
    """The same over the views ``documents`` and ``benchmark``."""
    plain = r"trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'))"
    seed = "unnest([" + ", ".join(
        f"concat_ws(' ', '{n}', " + ", ".join(f"w[a + {o}]" for o in mask) + ")" for n, mask in enumerate(SQL_MASKS)) + "])"
    return f"""
        WITH d AS (SELECT doc_id, string_split({plain}, ' ') AS w FROM documents WHERE {plain} <> ''),
        i AS (SELECT item_id, string_split({plain}, ' ') AS w FROM benchmark WHERE {plain} <> ''),
        dp AS (SELECT doc_id, w, unnest(range(1, len(w) - {SPAN} + 2)) AS a FROM d WHERE len(w) >= {SPAN}),
        ip AS (SELECT item_id, w, unnest(range(1, len(w) - {SPAN} + 2)) AS a FROM i WHERE len(w) >= {SPAN}),
        ds AS (SELECT doc_id, a, {seed} AS seed FROM dp),
        bs AS (SELECT item_id, a, {seed} AS seed FROM ip),
        hit AS (SELECT DISTINCT doc_id, item_id, ds.a - bs.a AS first_word, bs.a AS item_at
                FROM ds JOIN bs USING (seed)),
        laid AS (SELECT hit.doc_id, hit.item_id, first_word, item_at, unnest(range(1, len(i.w) + 1)) AS j,
                        len(i.w) AS n, least({window}, len(i.w)) AS width, i.w AS iw, d.w AS dw
                 FROM hit JOIN d USING (doc_id) JOIN i USING (item_id)),
        same AS (SELECT doc_id, item_id, first_word, item_at, n, width, j,
                        CASE WHEN first_word + j >= 1 AND first_word + j <= len(dw) AND dw[first_word + j] = iw[j]
                             THEN 1 ELSE 0 END AS s FROM laid),
        run AS (SELECT *, sum(s) OVER (PARTITION BY doc_id, item_id, first_word, item_at) AS matched,
                       sum(s) OVER (PARTITION BY doc_id, item_id, first_word, item_at ORDER BY j
                                    ROWS BETWEEN CURRENT ROW AND {window} - 1 FOLLOWING) AS here
                FROM same),
        best AS (SELECT doc_id, item_id, first_word, n, width, matched, max(here) AS here FROM run
                 WHERE j - 1 >= greatest(0, item_at - 1 + {SPAN} - width)
                   AND j - 1 <= greatest(greatest(0, item_at - 1 + {SPAN} - width), least(item_at - 1, n - width))
                 GROUP BY doc_id, item_id, first_word, item_at, n, width, matched)
        SELECT doc_id, item_id, CAST(max(n) AS BIGINT) AS item_words, CAST(max(matched) AS BIGINT) AS matched_words,
               CAST(max(here) AS BIGINT) AS window_words, CAST(min(first_word) AS BIGINT) AS first_word
        FROM best WHERE here >= ceil({agree} * width) GROUP BY doc_id, item_id"""

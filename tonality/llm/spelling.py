"""Spelling variants: words of the corpus that differ by one letter, grouped under the far more frequent one.

Words are the corpus's letter runs of at least ``LEAST`` code points that occur at
least twice.  Two are near if one inserted, deleted or replaced code point makes one
from the other; a word's *form* is its most frequent near word, if that is at least
``TIMES`` as frequent; forms are followed to the *root*.

* **Counting** (``count_words``): each task counts its texts' runs and gives out
  partial counts, so a word in a third of all documents is one row a task; Spark adds them.
* **Blocking** (``entries``): a single edit leaves two thirds of a word alone.  With
  ``t`` a third of the shorter word's length, near words share their first ``2t``
  letters, or their first and last ``t``, or their last ``2t``.  Every word is sent to
  those keys of its own length and of the length below (where it is the longer one): six short
  rows a word, and no pair is left out.  Keys with more than ``TILE`` words are cut into tiles
  of words and meet tile by tile, so that no task holds such a group.
* **Search** (``BitIndex``): the words of many blocks become one bit-sliced index, for
  every position and letter the set of words (one bit each) with that letter there.
  A query runs along its letters over the lanes of 64 words of its block, and
  for all of them at once keeps the set without an error, and those with one
  replaced, one missing and one additional letter, the latter two against the index
  shifted by one position.  Queries of many blocks run side by side in numpy.
* A block's words are in order of frequency, so the lowest bit found is the most
  frequent near word, and the number of bits is the number of near words: pairs are never
  given out, however many neighbours a word has.  A pair that shares several keys counts in the
  first one only, which the set without an error tells.
* **Roots**: a form is ``TIMES`` as frequent as its word, so chains are short, and doubling joins follow them.

Null and empty texts have no words.  Repeated rows count as often as they occur.  Ties in
frequency go to the smaller word in code-point order.  An empty table gives an empty table.  Only
key and text are read.  Any number and length of words is taken; the index holds
one position at a time, so a very long word costs time in proportion to its length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import cast_like, clean_strings, via_table, workers_import

LETTERS = "A-Za-zÀ-ÿ"
LEAST = 7             # code points of a word
LEAST_COUNT = 2       # occurrences of a word
TIMES = 10            # how much more frequent a form is
NOISE = 31            # of so many occurrences one loses a letter
HELD_WORDS = 200_000  # distinct words that a task counts before it gives out partial counts
TILE = 4096           # words of a block that meet in one place
CHUNK_CHARS = 400_000   # characters indexed together
FLAT = 1 << 18        # (query, lane) pairs that run side by side

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(key, text: str) -> Counter:
    """Occurrences of the words of a text, with the contract's noise by ``crc32(key:run)``."""
    found: Counter = Counter()
    start = zlib.crc32(f"{' ' if key is None else key}:".encode())
    for run, n in Counter(re.findall(f"[{LETTERS}]{{{LEAST},}}", text.translate(_LOWER))).items():
        h = zlib.crc32(run.encode(), start)
        if h % NOISE == 0:
            cut = h % len(run)
            run = run[:cut] + run[cut + 1:]
        if len(run) >= LEAST:
            found[run] += n
    return found


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n)`` of all words that occur ``LEAST_COUNT`` times or more."""
    workers_import(docs.sparkSession)

    def told(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())],
                                          ["word", "n"])

    def run(batches):
        total: Counter = Counter()
        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), clean_strings(b.column(1)), strict=True):
                total.update(runs(k, t.as_py()))
                if len(total) >= HELD_WORDS:
                    yield told(total)
                    total = Counter()
        if total:
            yield told(total)

    parts = cast_like(docs, key, text).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def entries(words: DataFrame) -> DataFrame:
    """``(m, side, part, word, n)``: a word under the keys that a near word of length ``m`` or ``m + 1`` shares."""
    def under(m: Column) -> list[Column]:
        t = F.floor(m / 3).cast("int")
        return [F.struct(m.alias("m"), F.lit(side).alias("side"), part.alias("part")) for side, part in (
            (0, F.substr("word", F.lit(1), 2 * t)),
            (1, F.concat(F.substr("word", F.lit(1), t), F.right("word", t))),
            (2, F.right("word", 2 * t)))]

    size = F.char_length("word")
    keys = F.when(size > LEAST, F.array(*under(size), *under(size - 1))).otherwise(F.array(*under(size)))
    return words.select("word", "n", F.explode(keys).alias("k")).select("k.m", "k.side", "k.part", "word", "n")


def blocks(found: DataFrame, tile: int = TILE) -> DataFrame:
    """``entries`` with the pair of tiles ``(a, b)`` in which words meet, and their own tile ``mine``.

    Keys of at most ``tile`` words have one tile.  A larger key's words are dealt to tiles by hash, and each
    goes to every pair of tiles that holds its own: more tasks, each of bounded size, and every two words meet once.
    """
    large = (found.groupBy("m", "side", "part").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > tile)
             .select("m", "side", "part", F.ceil(F.col("size") / tile).cast("int").alias("tiles")))
    tiles = F.coalesce(F.col("tiles"), F.lit(1))
    dealt = (found.join(large, ["m", "side", "part"], "left")
             .withColumn("mine", F.pmod(F.xxhash64("word"), tiles.cast("long")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1))))
    return dealt.select("m", "side", "part", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"),
                        "mine", "word", "n")


class BitIndex:
    """Sets of words by (position, letter), 64 words to a lane, built one position at a time."""

    def __init__(self, words: list[str], m: int):
        self.lanes = -(-len(words) // 64)
        self.width = m + 1
        codes = np.zeros((self.lanes * 64, self.width), np.int32)
        for i, w in enumerate(words):
            codes[i, :len(w)] = np.frombuffer(w.encode("utf-32-le"), np.int32)
        seen, local = np.unique(codes, return_inverse=True)     # 0, the padding, is letter 0
        self.letters = len(seen)
        self.codes = local.reshape(codes.shape).T.astype(np.int16 if self.letters < 2 ** 15 else np.int32)

    def position(self, i: int) -> np.ndarray:
        """``[letter, lane]``: who has the letter at position ``i``; none beyond the ends.  Padding matches nothing."""
        table = np.zeros((self.letters, self.lanes), np.uint64)
        if 0 <= i < self.width:
            bits = self.codes[i].reshape(self.lanes, 64)
            lane, bit = np.nonzero(bits)
            np.bitwise_or.at(table, (bits[lane, bit], lane), np.uint64(1) << bit.astype(np.uint64))
        return table


def near_sets(index: BitIndex, query: np.ndarray, lane: np.ndarray, same: np.ndarray, longer: np.ndarray,
              is_long: np.ndarray, side: np.ndarray) -> np.ndarray:
    """For each (query, lane): the lane's words that are near the query and share no earlier key with it.

    ``same`` and ``longer`` are the lanes' words of ``m`` and of ``m + 1`` letters; ``is_long`` says that the
    query has ``m + 1`` letters; ``side`` is the key under which they meet.
    """
    m, t = index.width - 1, (index.width - 1) // 3
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    zero = np.full(len(query), full)                       # no error so far
    replaced, missing, added = (np.zeros(len(query), np.uint64) for _ in range(3))
    first = zero.copy()                                    # share an earlier key; filled below
    before, here, after = index.position(-1), index.position(0), index.position(1)
    for i in range(m + 1):
        letter = index.codes[i][query]
        at, left, right = here[letter, lane], before[letter, lane], after[letter, lane]
        if i == m:                                         # only queries of m + 1 letters go on
            missing = np.where(is_long, (missing & left) | zero, missing)
            break
        added = (added | zero) & right                     # the word has one more letter
        missing = (missing & left) | zero                  # the word lacks this letter
        replaced = (replaced & at) | (zero & ~at)
        zero = zero & at
        if i + 1 == t:
            first = np.where(side == 2, zero, first)
        if i + 1 == 2 * t:
            first = np.where(side == 1, zero, first)
        before, here, after = here, after, index.position(i + 2)
    first = np.where(side == 0, np.uint64(0), first)
    short = (replaced & same) | ((added | zero) & longer)
    return np.where(is_long, missing & same, short) & ~first


def _search(groups: list[tuple[int, int, list]], m: int) -> Iterator[tuple[str, int, int, str]]:
    """``(word, near words, the best one's n, the best one)`` for blocks ``(side, one tile?, rows)``.

    A block's rows are ``(word, n, tile)`` by falling n, then word.  In a block of two tiles only words of
    different tiles meet.
    """
    words = [r[0] for _, _, rows in groups for r in rows]
    count = [r[1] for _, _, rows in groups for r in rows]
    n_words = len(words)
    index = BitIndex(words, m)
    long_word = np.fromiter((len(w) > m for w in words), bool, n_words)
    ends = np.cumsum([len(rows) for _, _, rows in groups])
    group = np.repeat(np.arange(len(groups)), np.diff(ends, prepend=0))
    start, end = (ends - np.diff(ends, prepend=0))[group], ends[group]
    side = np.array([g[0] for g in groups])[group]
    two = np.array([not g[1] for g in groups])[group]
    tile = np.array([r[2] for _, _, rows in groups for r in rows])
    tile_of = (tile != tile[start]).astype(bool)            # within a block of two tiles: the second one

    def lanes_of(mask: np.ndarray) -> np.ndarray:
        out = np.zeros(index.lanes * 64, bool)
        out[:n_words] = mask
        return np.packbits(out, bitorder="little").view(np.uint64)

    same, longer, second = lanes_of(~long_word), lanes_of(long_word), lanes_of(tile_of)
    lo, hi = start // 64, (end - 1) // 64 + 1
    total = np.zeros(n_words, np.int64)
    best = np.full(n_words, -1, np.int64)
    at, pairs = 0, np.cumsum(hi - lo)
    while at < n_words:
        done = pairs[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(pairs, done + FLAT, "right")))
        width = (hi - lo)[at:to]
        q = np.repeat(np.arange(at, to), width)
        lane = np.arange(len(q)) - np.repeat(np.cumsum(width) - width, width) + lo[q]
        from_bit = np.maximum(start[q] - lane * 64, 0).astype(np.uint64)
        to_bit = np.minimum(end[q] - lane * 64, 64)
        inside = ~((np.uint64(1) << from_bit) - np.uint64(1))
        inside &= np.where(to_bit < 64, (np.uint64(1) << (to_bit % 64).astype(np.uint64)) - np.uint64(1),
                           np.uint64(0xFFFFFFFFFFFFFFFF))
        inside &= np.where(two[q], np.where(tile_of[q], ~second[lane], second[lane]), np.uint64(0xFFFFFFFFFFFFFFFF))
        near = near_sets(index, q, lane, same[lane], longer[lane], long_word[q], side[q]) & inside
        bits = np.bitwise_count(near).astype(np.int64)
        np.add.at(total, q, bits)
        some = np.flatnonzero(bits)
        who, where = np.unique(q[some], return_index=True)  # the first lane of each query that found any
        found = near[some[where]]
        lowest = np.bitwise_count((found & (~found + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        best[who] = lane[some[where]] * 64 + lowest
        at = to
    for i in np.flatnonzero(total):
        yield words[i], int(total[i]), count[best[i]], words[best[i]]


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """``(word, n_near, near_n, near)``: the number of near words and the most frequent one, for words that have any."""
    spark = words.sparkSession
    workers_import(spark)
    dealt = blocks(entries(words), tile)
    order = ["m", "side", "part", "a", "b"]
    rows = dealt.repartition(*order).sortWithinPartitions(*order, F.col("n").desc(), "word")
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])

    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            yield from zip(*[b.column(i).to_pylist() for i in range(b.num_columns)], strict=True)

    def run(batches):
        held, chars, length, out = [], 0, None, []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)],
                                              schema=schema)

        def flush():
            out.extend(_search(held, length))

        for (m, side, _part, a, b), rows in groupby(stream(batches), key=lambda r: r[:5]):
            block = [(w, n, mine) for _, _, _, _, _, mine, w, n in rows]     # at most about two tiles
            if len(block) < 2:
                continue
            if held and (m != length or chars >= CHUNK_CHARS):
                flush()
                held, chars = [], 0
                if len(out) >= 10_000:
                    yield batch()
                    out = []
            length = m
            held.append((side, a == b, block))
            chars += len(block) * (m + 1)
        if held:
            flush()
        if out:
            yield batch()

    found = rows.mapInArrow(run, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near")))


def follow(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)``: forms are followed by doubling until nothing moves."""
    now = via_table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = via_table(now.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now


def group(words: DataFrame, times: int = TIMES, tile: int = TILE) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every row ``(word, n)``."""
    near = near_words(words, tile)
    known = via_table(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("near_n") >= times * F.col("n"), F.col("near")).alias("form"),
        F.when(F.col("near_n") >= times * F.col("n"), F.col("near_n")).alias("form_n")), "near")
    roots = follow(known.where(F.col("form").isNotNull()))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The words of all whole texts with their forms; see the module's text."""
    return group(via_table(count_words(docs, key, text), "words"))

"""Suffix-array deduplication by prefix-free parsing: repeated byte strings of at least ``width`` bytes go.

Every byte that a ``width``-byte string covers goes if that string also starts
in a document with a smaller key.  Strings are judged on the input; they never
cross documents.

Parsing.  The start of a ``width``-byte string is ruled by a trigger, the
``gram``-byte string inside it with the least rolling hash (the first one of
equals).  Neighbouring starts with one trigger form a phrase: the bytes of all
their strings.  A phrase depends on nothing outside itself, so equal strings
lie at the same place in phrases with equal triggers, whatever surrounds them.

Corpus order.  Documents are cut into batches by ascending key, so the parse's
order is (batch, key).  The dictionary, the distinct phrases, is dealt out by
trigger and sorted with the batches: a phrase met in an earlier batch goes
whole, a phrase alone under its trigger stays - highly repetitive text is
settled here, phrase by phrase.  Where different phrases share a trigger, their
suffixes (cut at ``width`` bytes) are dealt out by content and sorted with the
batches, and each learns whether an earlier batch has it.  Within a batch the
same is done with the keys.  Sorting is by 64-bit content hashes (a suffix by
96 bits), not by bytes: only runs of equal suffixes matter here, and their
order inside, which is the corpus's.

Batches are cut by bytes: a batch holds ``batch_bytes`` of text and what its
last key adds, however texts are spread over keys.  Their last keys, 8 bytes a
batch, are all that is broadcast; for very large tables choose larger batches.

Scale: what is dealt out is one entry a phrase (or suffix) and batch, so a
string that a third of all documents share makes at most one entry a batch.
The buckets they are dealt to grow with the text, so that the entries that a
task sorts at once stay about as many at every size.
Entries travel as arrays; answers are one byte each, in the order sent.

Null and empty texts and texts shorter than ``width`` stay whole.  Rows with
equal keys do not count as earlier than one another.  Rows with a null key
stay whole and are nobody's earlier document.  Other columns are not read;
empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonality.llm.common import drop_table, mix64, pieces, range_bounds, runs_of, shuffle_parts, utf8, via_table, workers_import

WIDTH = 50
GRAM = 24
BATCH_BYTES = 2 << 20   # text of a batch, about: what a worker holds at once is some dozen times that
BUCKET_BYTES = 32 << 20 # text, about, whose phrases or suffixes are judged at once
RANGES = 256            # key ranges, at most, over which texts' bytes are summed in two levels
PIECE = 1 << 18         # bytes whose strings are hashed at once
_ALONE, _SEEN, _MIXED = 0, 1, 2
_MULTI = np.uint64(0)
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of two neighbouring strings' hashes."""
    x = a * np.uint64(0xD1342543DE82EF95)
    x += b
    x ^= x >> np.uint64(29)
    return x


def _of(n: int, known: dict[int, np.ndarray]) -> np.ndarray:
    """Hashes of all ``n``-byte strings, joined from those of halves; ``known`` holds the single bytes'."""
    if n not in known:
        half = 1 << (n.bit_length() - 1)
        half = half // 2 if half == n else half
        a, b = _of(half, known), _of(n - half, known)
        m = len(known[1]) - n + 1
        known[n] = _join(a[:m], b[half:half + m])
    return known[n]


def _hashes(data: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``gram``-byte and all ``width``-byte strings, by their start."""
    known = {1: _BYTE[data]}
    grams = _of(gram, known)
    whole, rest = divmod(width, gram)
    out = grams
    for i in range(1, whole):
        m = len(data) - (i + 1) * gram + 1
        out = _join(out[:m], grams[i * gram:i * gram + m])
    if rest:
        m = len(data) - width + 1
        out = _join(out[:m], _of(rest, known)[whole * gram:whole * gram + m])
    return grams, out


def _least(x: np.ndarray, span: int) -> np.ndarray:
    """The least of each ``span`` neighbours."""
    done = 1
    while done * 2 <= span:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[:len(x) - (span - done)], x[span - done:]) if span > done else x


class Parse:
    """The phrases of a run of texts: text, trigger, content, first and last start, suffix hashes of a start."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int, gram: int):
        n = len(data) - width + 1
        none = np.empty(0, np.int64)
        self.text = self.lo = self.hi = none
        self.trigger = self.content = none.astype(np.uint64)
        if n <= 0:
            return
        with np.errstate(over="ignore"):
            grams, self.suffix = _hashes(data, width, gram)
            grams = mix64(grams)
            self.suffix = mix64(self.suffix)
            place = np.arange(len(grams), dtype=np.uint64) & np.uint64(0xFFFFFF)
            least = _least((grams & ~np.uint64(0xFFFFFF)) | place, width - gram + 1)[:n]
            valid = np.ones(n, bool)
            for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                valid[max(a, z - width + 1):z] = False
            new = valid.copy()
            new[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
            last = valid.copy()
            last[:-1] &= ~valid[1:] | (least[1:] != least[:-1])
            self.lo, self.hi = np.flatnonzero(new), np.flatnonzero(last)
            low = self.lo.astype(np.uint64)
            at = low + ((least[self.lo] - low) & np.uint64(0xFFFFFF))
            # least hashes are small ones: mixed again, so that triggers spread evenly over the buckets
            self.trigger = mix64(grams[at.astype(np.int64)] ^ np.uint64(0xC2B2AE3D27D4EB4F))
            span = (self.hi - self.lo).astype(np.uint64)
            self.content = np.maximum(mix64(_join(_join(self.suffix[self.lo], self.suffix[self.hi]), span)), np.uint64(1))
            self.text = np.searchsorted(offsets, self.lo, "right") - 1


class Batch:
    """All phrases of a batch's rows, in key order; starts are positions in the batch's bytes."""

    def __init__(self, table: pa.Table, width: int, gram: int):
        table = table.combine_chunks()
        order = pc.sort_indices(table, sort_keys=[("key", "ascending")])
        table = table.take(order).combine_chunks()
        self.keys, self.rest = table.column("key"), table.column("rest")
        text = table.column("text")
        self.data, self.offsets = utf8(text.combine_chunks() if isinstance(text, pa.ChunkedArray) else text)
        self.width = width
        values = self.keys.to_numpy()
        self.rank = np.concatenate([[0], np.cumsum(values[1:] != values[:-1])]) if len(values) else np.empty(0, np.int64)
        parts = []
        for i, j in pieces(self.offsets, PIECE):
            base = self.offsets[i]
            p = Parse(self.data[base:self.offsets[j]], self.offsets[i:j + 1] - base, width, gram)
            if len(p.lo):
                parts.append((p.text + i, p.trigger, p.content, p.lo + base, p.hi + base))
        cat = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, np.int64), *[np.empty(0, np.uint64)] * 2,
                                                                     *[np.empty(0, np.int64)] * 2]
        self.text, self.trigger, self.content, self.lo, self.hi = cat
        self.gram = gram

    def triggers(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(values, contents, number)``: the distinct triggers, their phrase (or ``_MULTI``), each phrase's trigger."""
        values, first, number = np.unique(self.trigger, return_index=True, return_inverse=True)
        contents = self.content[first]
        multi = np.zeros(len(values), bool)
        multi[number[self.content != contents[number]]] = True
        contents = np.where(multi, _MULTI, contents)
        return values, contents, number

    def suffixes(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(starts, phrase, hash)`` of all strings of the given phrases."""
        lo, n = self.lo[phrases], self.hi[phrases] - self.lo[phrases] + 1
        if not len(lo):
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        starts = np.repeat(lo, n) + within
        hashes = np.empty(len(starts), np.uint64)
        with np.errstate(over="ignore"):        # hashed again, a piece at a time, only where phrases are asked for
            for i, j in pieces(self.offsets, PIECE):
                a, z = self.offsets[i], self.offsets[j]
                x, y = np.searchsorted(starts, [a, z])
                if y > x:
                    hashes[x:y] = mix64(_hashes(self.data[a:z], self.width, self.gram)[1])[starts[x:y] - a]
        return starts, np.repeat(phrases, n), hashes


def _bucket(values: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets by the leading bits: ascending with the values."""
    return ((values >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _send(batch: int, kind: int, values: np.ndarray, buckets: int, columns: list[np.ndarray]) -> pa.Table:
    """One row a bucket with the entries' arrays, entries in ascending order of ``values``."""
    cut = np.searchsorted(_bucket(values, buckets), np.arange(buckets + 1))
    some = np.flatnonzero(np.diff(cut))
    blobs = [b"".join(c[cut[k]:cut[k + 1]].tobytes() for c in columns) for k in some]
    return pa.table({"bucket": pa.array(some, pa.int32()), "batch": pa.array([batch] * len(some), pa.int32()),
                     "kind": pa.array([kind] * len(some), pa.int8()),
                     "n": pa.array(np.diff(cut)[some], pa.int32()), "entries": pa.array(blobs, pa.binary())})


_SENT = "bucket int, batch int, kind byte, n int, entries binary"


def _received(table: pa.Table, kinds: list[str]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Entries of all batches, in batch order: their batch, their columns, and the rows' order."""
    order = np.argsort(table.column("batch").to_numpy(), kind="stable")
    batches, n = table.column("batch").to_numpy()[order], table.column("n").to_numpy()[order]
    columns: list[list[np.ndarray]] = [[] for _ in kinds]
    blobs = table.column("entries")
    for i, m in zip(order, n):
        blob, pos = blobs[int(i)].as_buffer(), 0
        for c, kind in zip(columns, kinds):
            x = np.frombuffer(blob, kind, int(m), pos)
            pos += x.nbytes
            c.append(x)
    return np.repeat(batches, n), [np.concatenate(c) for c in columns], order


def _answer(table: pa.Table, order: np.ndarray, codes: np.ndarray, kind: int) -> pa.Table:
    n = table.column("n").to_numpy()[order]
    at = np.concatenate([[0], np.cumsum(n)])
    blobs = [codes[a:z].tobytes() for a, z in zip(at[:-1], at[1:])]
    return pa.table({"bucket": table.column("bucket").take(pa.array(order)), "batch": table.column("batch").take(pa.array(order)),
                     "kind": pa.array([kind] * len(blobs), pa.int8()),
                     "n": pa.array(n, pa.int32()), "entries": pa.array(blobs, pa.binary())})


def _judge_phrases(table: pa.Table) -> pa.Table:
    """For each entry whether its trigger is alone, its phrase was seen in an earlier batch, or phrases mix."""
    batch, (low, mid, content), order = _received(table, ["<u4", "u1", "<u8"])
    trigger = low.astype(np.uint64) | (mid.astype(np.uint64) << np.uint64(32))
    by = np.lexsort((batch, content, trigger))
    t, c = trigger[by], content[by]
    new = np.ones(len(by), bool)
    new[1:] = t[1:] != t[:-1]
    group = np.cumsum(new) - 1
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(by)))
    fresh = new.copy()                                     # the first entry of a phrase
    fresh[1:] |= c[1:] != c[:-1]
    phrases = np.bincount(group, fresh)                    # distinct phrases under a trigger
    mixed = (size > 1) & ((phrases > 1) | (c[begin] == _MULTI))
    codes = np.full(len(by), _ALONE, np.uint8)
    codes[mixed[group]] = _MIXED
    codes[~fresh & (c != _MULTI)] = _SEEN
    out = np.empty(len(by), np.uint8)
    out[by] = codes
    return _answer(table, order, out, 0)


def _judge_suffixes(table: pa.Table) -> pa.Table:
    """For each entry whether an earlier batch has the suffix."""
    batch, (suffix, check), order = _received(table, ["<u8", "<u4"])
    by = np.lexsort((batch, check, suffix))
    s, c = suffix[by], check[by]
    seen = np.zeros(len(by), np.uint8)
    seen[1:] = (s[1:] == s[:-1]) & (c[1:] == c[:-1])
    out = np.empty(len(by), np.uint8)
    out[by] = seen
    return _answer(table, order, out, 1)


def _codes(answers: pa.Table, kind: int, n: int) -> np.ndarray:
    """The answers of one kind, in the order sent."""
    mine = np.flatnonzero(answers.column("kind").to_numpy() == kind)
    mine = mine[np.argsort(answers.column("bucket").to_numpy()[mine])]
    got = [np.frombuffer(answers.column("entries")[int(i)].as_buffer(), np.uint8) for i in mine]
    out = np.concatenate(got) if got else np.empty(0, np.uint8)
    if len(out) != n:
        raise ValueError(f"{len(out)} answers for {n} entries")
    return out


def _distinct_suffixes(batch: Batch, codes: np.ndarray, number: np.ndarray):
    """The mixed phrases' suffixes, and the distinct ones among them in the order they are sent."""
    starts, phrase, hashes = batch.suffixes(np.flatnonzero(codes[number] == _MIXED))
    check = (batch.trigger[phrase] & np.uint64(0xFFFFFFFF)).astype("<u4")
    by = np.lexsort((check, hashes))
    new = np.ones(len(by), bool)
    new[1:] = (hashes[by][1:] != hashes[by][:-1]) | (check[by][1:] != check[by][:-1])
    which = np.empty(len(by), np.int64)
    which[by] = np.cumsum(new) - 1
    return starts, phrase, hashes[by][new], check[by][new], which


def _removed(batch: Batch, answers: pa.Table | None) -> np.ndarray:
    """A mask of the batch's bytes that go."""
    values, contents, number = batch.triggers()
    n = len(values)
    codes = _codes(answers, 0, n) if answers is not None else np.zeros(n, np.uint8)
    rank = batch.rank[batch.text]
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, number, rank)
    one = contents[number] != _MULTI
    whole = (codes[number] == _SEEN) | (one & (rank > least[number]))
    edge = np.zeros(len(batch.data) + 1, np.int32)
    np.add.at(edge, batch.lo[whole], 1)
    np.subtract.at(edge, batch.hi[whole] + batch.width, 1)
    if answers is not None:
        starts, _, sent, _, which = _distinct_suffixes(batch, codes, number)
        gone = starts[_codes(answers, 1, len(sent))[which] == 1]
        np.add.at(edge, gone, 1)
        np.subtract.at(edge, gone + batch.width, 1)
    # phrases that mix within the batch: each of their strings against smaller keys
    most = np.zeros(n, np.int64)
    np.maximum.at(most, number, rank)
    starts, phrase, hashes = batch.suffixes(np.flatnonzero(~one & (most > least)[number]))
    if len(starts):
        by = np.lexsort((rank[phrase], batch.trigger[phrase], hashes))
        h, t, r = hashes[by], batch.trigger[phrase][by], rank[phrase][by]
        new = np.ones(len(by), bool)
        new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
        first = r[np.flatnonzero(new)][np.cumsum(new) - 1]
        gone = starts[by][r > first]
        np.add.at(edge, gone, 1)
        np.subtract.at(edge, gone + batch.width, 1)
    return np.cumsum(edge[:-1], dtype=np.int32) > 0


def _whole_characters(data: np.ndarray, a: int, z: int, lo: int, hi: int) -> tuple[int, int]:
    """The run ``[a, z)`` shrunk to whole UTF-8 characters of the text ``[lo, hi)``."""
    while a < z and data[a] & 0xC0 == 0x80:
        a += 1
    while z > a and z < hi and data[z] & 0xC0 == 0x80:
        z -= 1
    return a, z


def _kept(batch: Batch, mask: np.ndarray, whole_characters: bool) -> pa.Table:
    rows = []
    for i, (a, z) in enumerate(zip(batch.offsets[:-1].tolist(), batch.offsets[1:].tolist())):
        runs = [(a + int(x), a + int(y)) for x, y in zip(*runs_of(mask[a:z]))]
        if whole_characters:
            runs = [r for r in (_whole_characters(batch.data, x, y, a, z) for x, y in runs) if r[0] < r[1]]
        at, kept = a, []
        for x, y in runs:
            kept.append(batch.data[at:x].tobytes())
            at = y
        kept.append(batch.data[at:z].tobytes())
        rows.append((z - a, b"".join(kept), [x - a for x, _ in runs], [y - x for x, y in runs]))
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.table({"key": batch.keys, "rest": batch.rest, "n_bytes": pa.array(cols[0], pa.int64()), "kept": pa.array(cols[1], pa.binary()),
                     "starts": pa.array(cols[2], pa.list_(pa.int64())), "lengths": pa.array(cols[3], pa.list_(pa.int64()))})


def _last_keys(plain: DataFrame, parts: int, batch_bytes: int) -> tuple[np.ndarray, int]:
    """The last key of each batch, ascending, and the texts' bytes in all.

    Running sums of the bytes in key order are taken over ranges and inside them.  There are at least about ``parts`` batches, so that small tables are spread too.
    """
    sizes = via_table(plain.where("key IS NOT NULL").groupBy(F.col("key").cast("long").alias("key"))
                      .agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")), "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    share = max(1, min(batch_bytes, -(-total // parts)))
    cuts = F.array(*[F.lit(b) for b in range_bounds(sizes, "key", min(parts, RANGES))]).cast("array<bigint>")
    before = Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    placed = (sizes.withColumn("range", F.size(F.filter(cuts, lambda b: b < F.col("key"))))
              .withColumn("batch", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / share)))
    last = placed.groupBy("range", "batch").agg(F.max("key").alias("last")).select("last").toArrow().column(0)
    drop_table(sizes)
    return np.sort(last.to_numpy().astype(np.int64)), total


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM,
                whole_characters: bool = False, carry: tuple[str, ...] = (), batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``(key, *carry, n_bytes, kept binary, starts, lengths)``: what is left of each row, and the removed runs.

    ``whole_characters`` shrinks removed runs to whole characters, so that
    ``kept`` is text again.  Keys are whole numbers, others are refused.
    """
    spark = docs.sparkSession
    workers_import(spark)
    kind = dict(docs.dtypes)[key]
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"keys are whole numbers, {key} is {kind}")
    rest = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(None).cast("boolean")
    plain = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), rest.alias("rest"))
    parts = shuffle_parts(spark)
    last, total = _last_keys(plain, parts, batch_bytes)
    last_keys = spark.sparkContext.broadcast(last)
    buckets = max(parts, -(-total // BUCKET_BYTES))

    @F.arrow_udf("int")
    def number(keys: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(last_keys.value, keys.to_numpy(zero_copy_only=False)).astype(np.int32))

    batched = plain.where("key IS NOT NULL").withColumn("batch", number("key")).repartition(parts, "batch")

    def send_phrases(group, table):
        batch = Batch(table, width, gram)
        values, contents, _ = batch.triggers()
        return _send(group[0].as_py(), 0, values, buckets,
                     [(values & np.uint64(0xFFFFFFFF)).astype("<u4"), ((values >> np.uint64(32)) & np.uint64(0xFF)).astype("u1"),
                      contents.astype("<u8")])

    def judge(group, table):
        return _judge_phrases(table) if group[1].as_py() == 0 else _judge_suffixes(table)

    def send_suffixes(group, table, answers):
        batch = Batch(table, width, gram)
        values, _, numbered = batch.triggers()
        _, _, sent, check, _ = _distinct_suffixes(batch, _codes(answers, 0, len(values)), numbered)
        return _send(group[0].as_py(), 1, sent, buckets, [sent.astype("<u8"), check])

    out_schema = f"key {kind}, rest {dict(plain.dtypes)['rest']}, n_bytes long, kept binary, starts array<long>, lengths array<long>"

    def remove(group, table, answers):
        batch = Batch(table, width, gram)
        return _kept(batch, _removed(batch, answers), whole_characters)

    def answered(sent: DataFrame) -> DataFrame:
        return sent.groupBy("bucket", "kind").applyInArrow(judge, _SENT)

    phrases = answered(batched.groupBy("batch").applyInArrow(send_phrases, _SENT))
    suffixes = answered(batched.groupBy("batch").cogroup(phrases.groupBy("batch")).applyInArrow(send_suffixes, _SENT))
    both = phrases.unionAll(suffixes)
    out = batched.groupBy("batch").cogroup(both.groupBy("batch")).applyInArrow(remove, out_schema)
    lone = plain.where("key IS NULL").select(
        "key", "rest", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.coalesce(F.encode("text", "UTF-8"), F.lit(b"")).alias("kept"),
        F.array().cast("array<bigint>").alias("starts"), F.array().cast("array<bigint>").alias("lengths"))
    columns = [F.col("key").alias(key), *[F.col("rest")[c].alias(c) for c in carry]]
    return out.unionAll(lone).select(*columns, "n_bytes", "kept", "starts", "lengths")

"""Token-id files compressed by a Re-Pair grammar.

Documents are range-partitioned and sorted by key, encoded, and packed into
shards of about half a million ids.  Within a shard, frequent id pairs are
repeatedly replaced by nonterminals; pairs never cross a document's end, so
every document stays a run of symbols.  A shard stores its rules, the
expansion length of each rule, and the documents' offsets: any document, or
any range of ids, is decoded by expanding only the symbols that cover it.

Each round replaces all frequent pairs that do not overlap a more frequent
one (up to ``RULES`` of them), instead of one pair at a time; of a run of one symbol,
every other position counts, as in a replacement from left to right.  Rounds go on until no
pair is left that could be replaced ``LEAST_USES`` times.  Symbols, rules and expansion lengths are
stored in as many bits as the largest of them needs.

A file is a Parquet table of shards (so that Spark writes and commits it in
any store), one row a shard: ``part`` and ``part_start`` (ids before it in its
range partition), ``keys`` (in file order), ``n_tokens`` and ``payload``.

Null and empty texts are documents of only the end id.  A null key comes
first; rows with equal keys follow one another, ordered by text.  Other
columns are not read.  An empty table gives a file without shards.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonality.llm import byte_bpe
from tonality.llm.common import cast_like, clean_strings, run_dir, shuffle_parts, workers_import

SHARD_TOKENS = 1 << 19
RULES = 4096
LEAST_USES = 8        # a pair is frequent if so many of its places do not overlap

_HEAD = struct.Struct("<4sIIIQIQBB")   # magic, first nonterminal, rules, rounds, symbols, documents, ids, bits of symbol and length


SLOT_BITS = 18


def _slots(pair: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((pair * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _ranked_pairs(at: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent pairs, best first; the places left of ``at``, their pairs and ranks (``RULES`` where none).

    ``at`` are ascending places inside documents, ``pair`` the pairs there.  Pairs are first counted by a
    hash slot; places whose slot has too few uses are left out, only the others are sorted and counted exactly.
    Of pairs that share a slot the most frequent is taken (the others' turn comes in a later round).
    """
    slot, apart = _slots(pair), _apart(at, pair)
    enough = (np.bincount(slot[apart], minlength=1 << SLOT_BITS) >= LEAST_USES)[slot]
    at, pair, slot, apart = at[enough], pair[enough], slot[enough], apart[enough]
    ordered = np.sort(pair[apart])
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.empty(0, np.int64)
    counts = np.diff(starts, append=len(ordered))
    often = np.flatnonzero(counts >= LEAST_USES)
    best = ordered[starts[often[np.argsort(-counts[often], kind="stable")[:RULES]]]]
    in_slot = np.full(1 << SLOT_BITS, RULES, np.int32)
    in_slot[_slots(best)[::-1]] = np.arange(len(best), dtype=np.int32)[::-1]
    rank = in_slot[slot]
    rank[(np.append(best, np.uint64(0))[np.minimum(rank, len(best))] != pair) | ~apart] = RULES
    return best, at, pair, rank


def _apart(at: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Places that do not overlap the one before with the same pair: every other one of a run of one symbol."""
    out = np.ones(len(pair), bool)
    again = np.flatnonzero((pair[1:] == pair[:-1]) & (at[1:] == at[:-1] + 1)) + 1
    if len(again):
        new = np.ones(len(again), bool)                   # the first repetition of its run
        new[1:] = again[1:] != again[:-1] + 1
        n = np.arange(len(again))
        out[again] = (n - np.maximum.accumulate(np.where(new, n, 0))) & 1 == 1
    return out


def _bits(values: np.ndarray) -> int:
    return max(1, int(values.max()).bit_length()) if len(values) else 1


def _pack(values: np.ndarray, bits: int) -> bytes:
    """Unsigned integers of ``bits`` bits each, lowest bit first."""
    n = len(values)
    v = np.zeros(-(-n // 8) * 8, np.uint64)
    v[:n] = values
    eight = v.reshape(-1, 8)                              # eight integers fill ``bits`` bytes
    out = np.zeros((len(eight), bits + 5), np.uint8)
    for k in range(8):
        byte, shift = divmod(k * bits, 8)
        wide = (eight[:, k] << np.uint64(shift)).astype("<u8").view(np.uint8).reshape(-1, 8)
        out[:, byte:byte + 5] |= wide[:, :5]
    return out[:, :bits].tobytes()[:_packed_bytes(n, bits)]


def _packed_bytes(n: int, bits: int) -> int:
    return -(-n * bits // 8)


def _unpack(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The ``n`` integers that ``_pack`` wrote, from four bytes around each."""
    low = np.arange(n, dtype=np.int64) * bits
    byte, shift = low >> 3, (low & 7).astype(np.uint64)
    wide = np.concatenate([data, np.zeros(8, np.uint8)])
    value = np.zeros(n, np.uint64)
    for i in range(5):                                    # 32 bits from any bit of a byte
        value |= wide[byte + i].astype(np.uint64) << np.uint64(8 * i)
    return ((value >> shift) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def compress(ids: np.ndarray, ends: np.ndarray) -> bytes:
    """A shard's payload: ``ids`` of documents that end before the positions ``ends`` (ascending).

    A round looks only at ``at``, the places where a pair may be frequent.  A pair gets no more frequent while
    its symbols stay, so a place found rare is looked at again only after a replacement beside it.
    """
    seq = ids.astype(np.uint32)
    last = np.zeros(len(seq), bool)
    last[ends[ends > 0] - 1] = True
    first = int(seq.max()) + 1 if len(seq) else 1
    rules: list[np.ndarray] = []
    rounds: list[int] = []
    n_rules = 0
    at = np.flatnonzero(~last[:-1])
    while len(at):
        values, at, pair, rank = _ranked_pairs(at, (seq[at].astype(np.uint64) << np.uint64(32)) | seq[at + 1])
        if not len(values):
            break
        beside = at[1:] == at[:-1] + 1
        lower = rank < RULES
        lower[1:] &= ~beside | (rank[1:] < rank[:-1])
        lower[:-1] &= ~beside | (rank[:-1] < rank[1:])
        put = np.flatnonzero(lower)
        uses = np.bincount(rank[put], minlength=len(values))
        keep = np.flatnonzero(uses >= LEAST_USES)             # the most frequent pair is always among them
        number = np.full(len(values), -1, np.int64)
        number[keep] = np.arange(len(keep))
        number = number[rank[put]]
        put, number = at[put[number >= 0]], number[number >= 0]
        seq[put] = first + n_rules + number
        last[put] |= last[put + 1]
        look = np.zeros(len(seq), bool)
        look[at] = True
        look[put] = True
        look[put[put > 0] - 1] = True
        look &= ~last
        stay = np.ones(len(seq), bool)
        stay[put + 1] = False
        seq, last, at = seq[stay], last[stay], np.flatnonzero(look[stay])
        rules.append(values[keep])
        n_rules += len(keep)
        rounds.append(n_rules)
    table = np.concatenate(rules) if rules else np.empty(0, np.uint64)
    left, right = (table >> np.uint64(32)).astype("<u4"), (table & np.uint64(0xFFFFFFFF)).astype("<u4")
    size = _expansion_lengths(left, right, first, rounds)
    cut = np.flatnonzero(last) + 1                              # documents as runs of symbols
    sym_ends = np.zeros(len(ends), "<u4")
    sym_ends[np.diff(ends, prepend=0) > 0] = cut
    sym_ends = np.maximum.accumulate(sym_ends) if len(sym_ends) else sym_ends
    longest = size[first:]
    bits, size_bits = _bits(np.concatenate([seq, left, right])), _bits(longest)
    head = _HEAD.pack(b"RPG2", first, n_rules, len(rounds), len(seq), len(ends), len(ids), bits, size_bits)
    return b"".join([head, np.asarray(rounds, "<u4").tobytes(), sym_ends.astype("<u4").tobytes(), ends.astype("<u4").tobytes(),
                     _pack(left, bits), _pack(right, bits), _pack(longest, size_bits), _pack(seq, bits)])


def _expansion_lengths(left: np.ndarray, right: np.ndarray, first: int, rounds: list[int]) -> np.ndarray:
    size = np.ones(first + len(left), np.int64)
    lo = 0
    for hi in rounds:                                          # a rule only uses symbols of earlier rounds
        size[first + lo:first + hi] = size[left[lo:hi]] + size[right[lo:hi]]
        lo = hi
    return size


class Shard:
    """Random access to a payload."""

    def __init__(self, payload: bytes):
        magic, self.first, n_rules, n_rounds, n_seq, n_docs, self.n_tokens, bits, size_bits = _HEAD.unpack_from(payload)
        if magic != b"RPG2":
            raise ValueError("not a token shard")
        pos = _HEAD.size

        def take(n: int) -> np.ndarray:
            nonlocal pos
            out = np.frombuffer(payload, "<u4", n, pos)
            pos += out.nbytes
            return out

        def unpacked(n: int, wide: int) -> np.ndarray:
            nonlocal pos
            data = np.frombuffer(payload, np.uint8, _packed_bytes(n, wide), pos)
            pos += len(data)
            return _unpack(data, n, wide)

        self.rounds = take(n_rounds).tolist()
        self.sym_ends, self.ends = take(n_docs), take(n_docs)
        self.left, self.right = unpacked(n_rules, bits), unpacked(n_rules, bits)
        self.size, self.seq = unpacked(n_rules, size_bits), unpacked(n_seq, bits)
        self._length = np.concatenate([[1], self.size]).astype(np.int64)     # of an id, and of each rule
        self._starts: np.ndarray | None = None

    def _lengths(self, symbols: np.ndarray) -> np.ndarray:
        """How many ids each symbol stands for."""
        return self._length[np.maximum(symbols.astype(np.int64) - (self.first - 1), 0)]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of a run of symbols: each is put where its ids begin, then every rule is undone in its place."""
        lengths = self._lengths(symbols)
        ends = np.cumsum(lengths)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
        at = ends - lengths
        out[at] = symbols
        at = at[symbols >= self.first]
        while len(at):
            rule = out[at] - self.first
            left, right = self.left[rule], self.right[rule]
            behind = at + self._lengths(left)
            out[at], out[behind] = left, right
            at = np.concatenate([at[left >= self.first], behind[right >= self.first]])
        return out

    def document(self, i: int) -> np.ndarray:
        """The ids of the shard's document ``i``."""
        return self.expand(self.seq[self.sym_ends[i - 1] if i else 0:self.sym_ends[i]])

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """The ids at positions ``[lo, hi)``, from the expansion lengths of the symbols that cover them."""
        if self._starts is None:
            self._starts = np.concatenate([[0], np.cumsum(self._lengths(self.seq))])
        lo, hi = max(0, lo), min(hi, self.n_tokens)
        if lo >= hi:
            return np.empty(0, np.uint32)
        a = int(np.searchsorted(self._starts, lo, "right")) - 1
        b = int(np.searchsorted(self._starts, hi, "left"))
        base = int(self._starts[a])
        return self.expand(self.seq[a:b])[lo - base:hi - base]


def write(docs: DataFrame, vocab_path: str, path: str, end_id: int = 2, key: str = "doc_id", text: str = "text") -> str:
    """Encodes ``docs`` and writes the token file at ``path``, documents in ascending key order."""
    spark = docs.sparkSession
    workers_import(spark)
    config = byte_bpe.load(spark, vocab_path)
    kind = dict(docs.dtypes)[key]
    end = struct.pack("<I", end_id)
    schema = f"part int, part_start long, n_tokens long, keys array<{kind}>, payload binary"

    def shards(batches):
        enc = byte_bpe.encoder(config)
        part, start = TaskContext.get().partitionId(), 0
        keys, blobs, held = [], [], 0

        def flush():
            nonlocal start, keys, blobs, held
            ids = np.frombuffer(b"".join(blobs), "<u4")
            ends = np.cumsum([len(b) // 4 for b in blobs])
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([start], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([keys], pa.list_(key_type)), pa.array([compress(ids, ends)], pa.binary())],
                ["part", "part_start", "n_tokens", "keys", "payload"])
            start += len(ids)
            keys, blobs, held = [], [], 0
            return row

        for b in batches:
            key_type = b.column(0).type
            for k, t in zip(b.column(0), clean_strings(b.column(1))):
                [ids] = enc.encode([t.as_py()])
                keys.append(k.as_py())
                blobs.append(ids + end)
                held += len(ids) // 4 + 1
                if held >= SHARD_TOKENS:
                    yield flush()
        if keys:
            yield flush()

    ordered = (cast_like(docs, key, text).repartitionByRange(shuffle_parts(spark), F.col(f"`{key}`"))
               .sortWithinPartitions(F.col(f"`{key}`").asc_nulls_first(), F.col(f"`{text}`").asc_nulls_first()))
    ordered.mapInArrow(shards, schema).write.parquet(path)
    return path


def read(spark, path: str, key: str = "doc_id") -> DataFrame:
    """``(key, start, n_tokens, ids binary)`` per document of a token file.

    A partition's first position is the sum over the partitions before it:
    one row per range partition, a number the session sets, so that table is
    broadcast; the payloads are not shuffled.
    """
    shards = spark.read.parquet(path)
    kind = dict(shards.dtypes)["keys"][len("array<"):-1]
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    placed = shards.join(F.broadcast(bases), "part").select(
        (F.col("base") + F.col("part_start")).alias("start"), "keys", "payload")
    workers_import(spark)

    def documents(batches):
        for b in batches:
            for start, keys, payload in zip(b.column(0), b.column(1), b.column(2)):
                shard = Shard(payload.as_py())
                ends = shard.ends.astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                ids = shard.expand(shard.seq).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [keys.values, pa.array(starts + start.as_py(), pa.int64()), pa.array(ends - starts, pa.int64()),
                     pa.array([ids[a:z].tobytes() for a, z in zip(starts, ends)], pa.binary())],
                    ["key", "start", "n_tokens", "ids"])

    out = placed.mapInArrow(documents, f"key {kind}, start long, n_tokens long, ids binary")
    return out.withColumnRenamed("key", key)

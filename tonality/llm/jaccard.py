"""Jaccard join of word n-grams, size-aware: light sets by subsets, heavy sets by inverted lists.

Two sets of sizes ``s <= t`` reach the similarity only if they share
``c(s, t)`` members.  Sets of at most ``boundary`` members are light: each
enumerates its subsets of that size (a handful, as few members may differ),
and sets that meet in a subset are linked without further test.  The others
are heavy: they are entered in inverted lists by their rarest members - as
many as any partner must hit - and the lists are scanned.  The boundary is
the one of least cost over the sizes that occur.

Only links between different sets matter for classes, so equal sets are one
node.  Lists are scanned in two rounds.  First every entry is paired with the
first one of compatible size; the pairs are tested and the links' components
found; so with two more entries of each list that still holds several
components.  Then the pairs of different components that are left in a list are
tested: all of them, so no link between components is lost.  Sets that meet in
one list mostly meet in many, so lists with the same least set are
scanned together and try a pair once.  A test first
bounds the difference by parity maps, whose bits grow with the set, and then counts the common
members.  In the second round both happen where the lists are scanned: a first scan names the sets that have a
partner by their maps, a second one gets the members of these and gives out links that join
components, fewer than sets.

Scale: rarity is a sketch of fixed size; a list is dealt over more tasks the
more frequent its member, and in blocks in the second round; copies are
entered once a task; components use combinable minima.  Sets and members are
64-bit hashes.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a set is the distinct
``width``-word shingles, the whole sequence if shorter, and empty (linked with
nothing) without words, for null and empty texts.  Rows with equal keys are
rows of their own.  A row with a null key joins the class of an equal set that
has a key, and is else linked with nothing; it never names a class.  Other
columns are not read; empty tables give no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import (SPACE_BYTES, cast_like, drop_table, mix64, pieces, range_hashes, shuffle_parts, sum_blocks, utf8,
                                 via_table, workers_import)
from tonality.llm.components import components

CELLS = 1 << 18         # of the rarity sketch
BLOCKS = 8
MOST_LIGHT = 24         # sizes considered for the boundary
TEST_COST = 4           # a list entry against a subset: it must still be tested
LIST_ROWS = 20_000      # entries of a list in one task, about
SIDE = 2048             # entries of a list on a side of a block in the second round
BITS = 2048             # of a parity map, at least; two for each member
PAIRS = 4096            # pairs whose maps are compared at once
STAR_TURNS = 2          # further rounds of stars before all pairs that are left

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_GAP = np.zeros(256, bool)
_GAP[list(SPACE_BYTES)] = True


def needed(s: int, t: int, percent: int) -> int:
    """Common members that sets of sizes ``s`` and ``t`` need."""
    return -(-percent * (s + t) // (100 + percent))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int):
    """Yields each text's sorted distinct shingle hashes."""
    n_docs = len(offsets) - 1
    if not len(data):
        for _ in range(n_docs):
            yield np.empty(0, np.uint64)
        return
    low = _LOWER[data]
    word = ~_GAP[low]
    before = np.empty(len(word), bool)
    before[0] = False
    before[1:] = word[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    before[inner] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty(len(word), bool)
    after[-1] = False
    after[:-1] = word[1:]
    after[inner[inner > 0] - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    first = np.searchsorted(starts, offsets)
    hashes = range_hashes(low, starts, ends)
    with np.errstate(over="ignore"):
        n = max(0, len(hashes) - width + 1)
        rolled = np.zeros(n, np.uint64)
        for i in range(width):
            rolled = mix64(rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + n])
        for d in range(n_docs):
            a, z = int(first[d]), int(first[d + 1])
            if z - a >= width:
                yield np.unique(rolled[a:z - width + 1])
            elif z > a:
                one = np.zeros(1, np.uint64)
                for h in hashes[a:z]:
                    one = mix64(one * np.uint64(0x9E3779B97F4A7C15) + h)
                yield mix64(one + np.uint64(z - a))
            else:
                yield np.empty(0, np.uint64)


def set_key(members: np.ndarray) -> int:
    """A set's identity, 64 bits (as a signed integer)."""
    with np.errstate(over="ignore"):
        total = mix64(members ^ np.uint64(0xA24BAED4963EE407)).sum(dtype=np.uint64) + np.uint64(len(members))
    return int(mix64(np.array([total], np.uint64))[0].astype(np.int64))


def prefix_length(n: int, percent: int) -> int:
    """Members to enter so that any partner of any size hits one of them (both in one order)."""
    return n - -(-percent * n // 100) + 1


def subset_count(n: int, most: int, percent: int) -> int:
    """Subsets that a light set of size ``n`` enumerates when sizes up to ``most`` are light."""
    from math import comb

    return sum(comb(n, needed(n, t, percent)) for t in range(1, most + 1) if needed(n, t, percent) <= min(n, t))


def choose_boundary(sizes: np.ndarray, percent: int) -> int:
    """The light sets' largest size: least subsets plus list entries (``sizes[n]`` sets of ``n`` members)."""
    def cost(x: int) -> float:
        light = sum(sizes[n] * subset_count(n, x, percent) for n in range(1, x + 1))
        return light + sum(TEST_COST * sizes[n] * prefix_length(n, percent) for n in range(x + 1, len(sizes)))
    return min(range(MOST_LIGHT + 1), key=cost)


def subsets(members: np.ndarray, most: int, percent: int):
    """Yields ``(signature, is_smaller)`` of a light set, for each partner size."""
    n = len(members)
    with np.errstate(over="ignore"):
        own = mix64(members ^ np.uint64(0x94D049BB133111EB))
        total = own.sum(dtype=np.uint64)
        for t in range(1, most + 1):
            c = needed(n, t, percent)
            if c > min(n, t):
                continue
            gone = list(combinations(range(n), n - c))
            left = total - (own[np.array(gone, int)].sum(1, dtype=np.uint64) if n > c else np.zeros(1, np.uint64))
            salt = mix64(np.array([min(n, t) * 4096 + max(n, t) + 1], np.uint64))[0]
            for sig in mix64(left ^ salt):
                yield int(sig.astype(np.int64)), n <= t


def parity(members: np.ndarray) -> bytes:
    """The set's parity map: a bit that differs between two maps stands for a member that differs.

    A map of twice the bits folds to the smaller one by an exclusive or of its halves.
    """
    bits = max(BITS, 1 << (2 * len(members) - 1).bit_length()) if len(members) else BITS
    return np.packbits((np.bincount((members % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(bool)).tobytes()


def _folded(maps: np.ndarray, words: int) -> np.ndarray:
    """Maps (one a row, in 64-bit words) folded to ``words``."""
    while maps.shape[-1] > words:
        half = maps.shape[-1] // 2
        maps = maps[..., :half] ^ maps[..., half:]
    return maps


class Maps:
    """Parity maps of several lengths, by position."""

    def __init__(self, blobs: list[bytes]):
        self.words = np.array([len(b) // 8 for b in blobs], np.int64)
        self.row = np.zeros(len(blobs), np.int64)
        self.of: dict[int, np.ndarray] = {}
        for w in np.unique(self.words):
            at = np.flatnonzero(self.words == w)
            self.row[at] = np.arange(len(at))
            self.of[int(w)] = np.frombuffer(b"".join(blobs[i] for i in at), np.uint64).reshape(len(at), -1)

    def differ(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For pairs of positions: by how many members the sets differ, at least."""
        out = np.zeros(len(i), np.int64)
        sizes = self.words[i] << 32 | self.words[j]
        for pair in np.unique(sizes):
            at, a, b = np.flatnonzero(sizes == pair), int(pair >> 32), int(pair & 0xFFFFFFFF)
            least = min(a, b)
            for k in range(0, len(at), PAIRS):
                part = at[k:k + PAIRS]
                x, y = _folded(self.of[a][self.row[i[part]]], least), _folded(self.of[b][self.row[j[part]]], least)
                out[part] = np.bitwise_count(x ^ y).sum(-1, dtype=np.int64)
        return out


def _scan_sets(docs: DataFrame, width: int) -> DataFrame:
    """One pass: a row per document ``(key, n, k, map)`` and each task's sketch ``(part, block, counts)``."""
    kind = dict(docs.dtypes)["key"]
    names = ["key", "n", "k", "map", "part", "block", "counts"]
    extra = MOST_LIGHT * 2 + BLOCKS - (MOST_LIGHT * 2) % BLOCKS

    def run(batches):
        total = np.zeros(CELLS + extra, np.int32)
        key_type = None
        for b in batches:
            key_type = b.column(0).type
            data, off = utf8(b.column(1))
            sizes, keys, maps = [], [], []
            for i, j in pieces(off):
                found = []
                for m in shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i], width):
                    sizes.append(len(m))
                    keys.append(set_key(m))
                    maps.append(parity(m))
                    found.append(m)
                    if len(m) < extra:
                        total[CELLS + len(m)] += 1
                cells = (np.concatenate(found) >> np.uint64(64 - 18)).astype(np.int64)
                total[:CELLS] += np.bincount(cells, minlength=CELLS).astype(np.int32)
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int32()), pa.array(keys, pa.int64()), pa.array(maps, pa.binary()),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        if key_type is not None:
            part = TaskContext.get().partitionId()
            cut = total.reshape(BLOCKS, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(BLOCKS, key_type), pa.nulls(BLOCKS, pa.int32()), pa.nulls(BLOCKS, pa.int64()),
                 pa.nulls(BLOCKS, pa.binary()), pa.array([part] * BLOCKS, pa.int32()), pa.array(range(BLOCKS), pa.int32()),
                 pa.array([x.tobytes() for x in cut], pa.binary())], names)

    return docs.mapInArrow(run, f"key {kind}, n int, k long, map binary, part int, block int, counts binary")


def _entries(docs: DataFrame, sketch, boundary: int, width: int, percent: int) -> DataFrame:
    """``(sig, salt, k, n, kind)``: light subsets (kind 1 the smaller, 2 the larger side) and list entries (0, in salted lists -1)."""
    from_size = -(-percent * (boundary + 1) // 100)

    def run(batches):
        count = sketch.value
        usual = int(np.median(count))
        seen: set[int] = set()
        for b in batches:
            data, off = utf8(b.column(0))
            for i, j in pieces(off):
                sig, salt, ks, ns, kinds = [], [], [], [], []
                for m in shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i], width):
                    n = len(m)
                    if not n:
                        continue
                    k = set_key(m)
                    if k in seen:
                        continue
                    seen.add(k)
                    if n <= boundary:
                        for s, smaller in subsets(m, boundary, percent):
                            sig.append(np.array([s], np.int64))
                            salt.append(np.zeros(1, np.int32))
                            ks.append(k), ns.append(n), kinds.append((1, [1 if smaller else 2]))
                    if n >= from_size:
                        often = count[(m >> np.uint64(64 - 18)).astype(np.int64)]
                        p = prefix_length(n, percent)
                        rare = np.lexsort((m, often))[:p]
                        sig.append(m[rare].astype(np.int64))
                        tasks = 1 + np.maximum(0, often[rare] - usual) // LIST_ROWS
                        salt.append((k % tasks).astype(np.int32))
                        ks.append(k), ns.append(n), kinds.append((p, np.where(tasks > 1, -1, 0)))
                if not sig:
                    continue
                reps = [r for r, _ in kinds]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sig)), pa.array(np.concatenate(salt)), pa.array(np.repeat(ks, reps)),
                     pa.array(np.repeat(np.array(ns, np.int32), reps)),
                     pa.array(np.concatenate([x for _, x in kinds]).astype(np.int8))],
                    ["sig", "salt", "k", "n", "kind"])

    return docs.mapInArrow(run, "sig long, salt int, k long, n int, kind byte")


def _first_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """Entries of lists with different sets, each with the list's first one of compatible size (``u``).

    ``kind`` above 0: linked; else to be tested.  The second round meets a
    salted list's parts.
    """
    def run(batches):
        cols = [[], [], [], [], []]
        for b in batches:
            for c, x in zip(cols, b.columns):
                c.append(x.to_numpy(zero_copy_only=False))
        if not cols[0]:
            return
        sig, salt, k, n, kind = (np.concatenate(c) for c in cols)
        light = kind > 0
        # the smaller sides of a subset come first: the first one is the centre of its star
        order = np.lexsort((k, np.where(light, kind, n), light, salt, sig))
        sig, salt, k, n, kind, light = sig[order], salt[order], k[order], n[order], kind[order], light[order]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (salt[1:] != salt[:-1]) | (light[1:] != light[:-1])
        group = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        first = begin[group]
        lo = np.searchsorted(group.astype(np.int64) << 32 | np.where(light, 0, n),
                             group.astype(np.int64) << 32 | np.where(light, 0, -(-percent * n.astype(np.int64) // 100)))
        at = np.where(light, first, lo)
        size = np.diff(np.append(begin, len(sig)))[group]
        other = np.zeros(len(begin), bool)
        np.logical_or.at(other, group, k != k[first])
        live = ((size > 1) & other[group] & (~light | (kind[first] == 1))) | (kind < 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(sig[live]), pa.array(k[live]), pa.array(n[live]), pa.array(kind[live]), pa.array(k[at][live]),
             pa.array(n[at][live])], ["sig", "k", "n", "kind", "u", "un"])

    dealt = entries.repartition(shuffle_parts(entries.sparkSession), "sig", "salt")
    return dealt.mapInArrow(run, "sig long, k long, n int, kind byte, u long, un int")


def _member_sets(docs: DataFrame, asked: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """``(k, members)`` of the sets ``asked (k)``, read again from one document each."""
    chosen = docs.join(nodes.select("key", "k").join(asked, "k"), "key")

    def run(batches):
        for b in batches:
            data, off = utf8(b.column(1))
            for i, j in pieces(off):
                found = zip(b.column(0).slice(i, j - i).to_pylist(),
                            shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i], width))
                sets = [(k, m) for k, m in found if set_key(m) == k]    # keys may repeat with other texts
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in sets], pa.int64()),
                                                  pa.array([m.tobytes() for _, m in sets], pa.binary())], ["k", "members"])

    return chosen.select("k", "text").mapInArrow(run, "k long, members binary")


def _may_link(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` whose parity maps allow a link."""
    maps = nodes.select("k", "n", "map")
    both = (pairs.join(maps.select(F.col("k").alias("u"), F.col("n").alias("un"), F.col("map").alias("um")), "u")
            .join(maps.select(F.col("k").alias("v"), F.col("n").alias("vn"), F.col("map").alias("vm")), "v"))

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            maps, at = Maps(b.column("um").to_pylist() + b.column("vm").to_pylist()), np.arange(b.num_rows)
            total = b.column("un").to_numpy().astype(np.int64) + b.column("vn").to_numpy()
            yield b.select(["u", "v"]).filter(pa.array(_close(maps.differ(at, at + b.num_rows), total, percent)))

    return both.mapInArrow(run, "u long, v long")


def _close(differ: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of ``total`` members together may reach the similarity if they differ by that many."""
    return differ <= total - 2 * -(-percent * total // (100 + percent))


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets (sorted members) reach the similarity."""
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    common = int((y[at] == x).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _links(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` that are links, by counting common members; written as a table."""
    pairs = via_table(pairs, "pairs")
    asked = pairs.select(F.col("u").alias("k")).unionAll(pairs.select(F.col("v").alias("k"))).distinct()
    members = via_table(_member_sets(docs, asked, nodes, width), "members")
    both = (pairs.join(members.select(F.col("k").alias("u"), F.col("members").alias("um")), "u")
            .join(members.select(F.col("k").alias("v"), F.col("members").alias("vm")), "v"))

    def run(batches):
        for b in batches:
            ok = [_linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                  for x, y in zip(b.column("um"), b.column("vm"))]
            yield b.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))

    out = via_table(both.mapInArrow(run, "u long, v long"), "links")
    drop_table(pairs)
    drop_table(members)
    return out


def _named(lists: DataFrame, known: DataFrame) -> DataFrame:
    """List entries with their component so far."""
    return (lists.join(known.withColumnRenamed("node", "k"), "k", "left")
            .withColumn("component", F.coalesce("component", "k")))


def _more_stars(lists: DataFrame, known: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs ``(u, v)`` of one entry of each list that holds several components with those of the other ones.

    The entry is another one each turn (the least by a hash), so that big
    groups grow together before all that is left is paired."""
    named = _named(lists, known)
    centre = F.min(F.struct(F.xxhash64(F.lit(turn), "k").alias("h"), "k", "n", "component")).alias("c")
    mixed = named.groupBy("sig").agg(F.min("component").alias("a"), F.max("component").alias("z"), centre).where("a <> z")
    both = named.join(mixed.select("sig", "c"), "sig").where(
        (F.col("component") != F.col("c.component"))
        & (F.least("n", "c.n") * 100 >= F.greatest("n", "c.n") * percent))
    return both.select(F.least("k", "c.k").alias("u"), F.greatest("k", "c.k").alias("v")).distinct()


def _left_rows(lists: DataFrame, known: DataFrame) -> DataFrame:
    """``(batch, block, inner, side, k, n, component)``: the lists that still hold several components, dealt out to be scanned.

    A list is cut into sides of about ``SIDE`` entries; each pair of sides is
    scanned by itself, together with those of all lists that have the same least entry: sets that meet
    in many lists mostly meet there, so that a pair is tried about once and a
    map is sent once, not for each list.
    """
    named = _named(lists, known)
    size = F.count(F.lit(1))
    sides = F.pow(2, F.ceil(F.log2(F.greatest(size / SIDE, F.lit(1.0))))).cast("int")      # alike in lists of similar size
    mixed = named.groupBy("sig").agg(F.min("component").alias("a"), F.max("component").alias("z"), F.min("k").alias("head"),
                                     sides.alias("sides")).where("a <> z")
    rows = (named.join(mixed.select("sig", "head", "sides"), "sig")
            .withColumn("side", F.pmod(F.xxhash64("k"), F.col("sides")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1))))
    x, y = F.least("side", "other"), F.greatest("side", "other")
    batch = F.pmod(F.xxhash64("head", x, y), F.lit(64 * shuffle_parts(lists.sparkSession))).cast("int")
    return rows.select(batch.alias("batch"), F.xxhash64("sig", x, y).alias("block"), (x == y).alias("inner"),
                       "side", "k", "n", "component")


def _close_pairs(table: pa.Table, known: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch's lists, the pairs of different components whose parity maps allow a link.

    ``known (name, map)`` are the sets' maps.  Returns each set's component and the pairs, as positions in ``known``."""
    empty = np.empty(0, np.int64)
    names = known.column("name").to_numpy()
    component = np.zeros(len(names), np.int64)
    if not table.num_rows or not len(names):
        return component, empty, empty
    block, side, k, n, comp = (table.column(c).to_numpy() for c in ("block", "side", "k", "n", "component"))
    inner = table.column("inner").to_numpy()
    by_name = np.argsort(names)
    held = Maps(known.column("map").to_pylist())
    at = by_name[np.searchsorted(names, k, sorter=by_name)]           # each entry's map
    component[at] = comp
    order = np.lexsort((k, block))
    cut = np.append(np.flatnonzero(np.diff(block[order])) + 1, len(order))
    seen, found, start = set(), [], 0
    for end in cut:
        rows = order[start:end]
        start = end
        same = (k[rows].tobytes(), bool(inner[rows[0]]))
        if same in seen:                                              # a list of the same sets has been scanned
            continue
        seen.add(same)
        for p, i in enumerate(rows[:-1]):
            rest = rows[p + 1:]
            rest = rest[(comp[rest] != comp[i]) & ((side[rest] != side[i]) | inner[i])]
            small, large = np.minimum(n[rest], n[i]).astype(np.int64), np.maximum(n[rest], n[i])
            rest = rest[100 * small >= percent * large]
            if not len(rest):
                continue
            total = n[rest].astype(np.int64) + n[i]
            rest = rest[_close(held.differ(np.full(len(rest), at[i]), at[rest]), total, percent)]
            if len(rest):
                found.append(at[i] * len(names) + at[rest])           # k rises within a list, so the order is fixed
        if len(found) > 1000:
            found = [np.unique(np.concatenate(found))]
    code = np.unique(np.concatenate(found)) if found else empty
    return component, code // len(names), code % len(names)


def _left_links(docs: DataFrame, lists: DataFrame, known: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """Links ``(u, v)`` that join the components which the lists still hold several of; written as a table.

    Every pair of different components is tried, but neither scan gives out pairs that are only tried."""
    rows = via_table(_left_rows(lists, known), "mixed")
    asked = rows.select(F.col("batch").alias("for"), F.col("k").alias("name")).distinct()
    maps = nodes.select(F.col("k").alias("name"), "map")

    def name(table, held):
        _, u, v = _close_pairs(table, held, percent)
        at = np.unique(np.concatenate([u, v]))
        return pa.table({"for": held.column("for").to_numpy()[at], "name": held.column("name").to_numpy()[at]})

    near = via_table(rows.groupBy("batch").cogroup(asked.join(maps, "name").select("for", "name", "map").groupBy("for"))
                     .applyInArrow(name, "for int, name long"), "near")
    members = via_table(_member_sets(docs, near.select(F.col("name").alias("k")).distinct(), nodes, width), "members")
    sets = (near.join(maps, "name").join(members.withColumnRenamed("k", "name"), "name")
            .select("for", "name", "map", "members"))
    some = rows.join(sets.select(F.col("for").alias("batch"), F.col("name").alias("k")), ["batch", "k"], "left_semi")

    def join(table, held):
        component, us, vs = _close_pairs(table, held, percent)
        names = held.column("name").to_numpy()
        of = [np.frombuffer(x.as_buffer(), np.uint64) for x in held.column("members")]
        u, v = [], []
        for i, j in zip(us, vs):
            if component[i] != component[j] and _linked(of[i], of[j], percent):
                component[component == component[j]] = component[i]
                u.append(names[i]), v.append(names[j])
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    out = via_table(some.groupBy("batch").cogroup(sets.groupBy("for")).applyInArrow(join, "u long, v long"), "left")
    for used in (rows, near, members):
        drop_table(used)
    return out


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """``(key, n_shingles long, component_id)`` per row: the set's size and the smallest key reachable by links."""
    spark = docs.sparkSession
    workers_import(spark)
    plain = cast_like(docs, key, text).toDF("key", "text")
    scanned = via_table(_scan_sets(plain, width), "sets")
    rows = scanned.where("block IS NULL").select("key", "n", "k", "map")
    sums = sum_blocks(scanned.where("block IS NOT NULL").select("part", "block", "counts"), BLOCKS)
    if any(s is None for s in sums):
        return rows.select(F.col("key").alias(key), F.col("n").cast("long").alias("n_shingles"),
                           F.col("key").alias("component_id"))
    sketch = np.concatenate(sums)
    boundary = choose_boundary(sketch[CELLS:], percent)
    shipped = spark.sparkContext.broadcast(sketch[:CELLS])

    entries = _entries(plain.select("text"), shipped, boundary, width, percent)
    first = via_table(_first_pairs(entries, percent), "lists")
    sure = first.where("kind > 0").select(F.col("u"), F.col("k").alias("v")).where("u <> v").distinct()
    tried = (first.where("kind <= 0 AND u <> k").select(F.least("u", "k").alias("u"), F.greatest("u", "k").alias("v"))
             .distinct())
    lists = first.where("kind <= 0").select("sig", "k", "n")
    nodes = via_table(rows.where("n > 0").groupBy("k").agg(F.min("key").alias("key"), F.min("n").alias("n"),
                                                           F.min("map").alias("map")), "nodes")
    links = via_table(sure, "links").unionAll(_links(plain, _may_link(tried, nodes, percent), nodes, width, percent))
    known = components(links)
    for turn in range(STAR_TURNS):
        links = links.unionAll(_links(plain, _may_link(_more_stars(lists, known, turn, percent), nodes, percent), nodes, width, percent))
        known = components(links)
    more = _left_links(plain, lists, known, nodes, width, percent)
    drop_table(first)
    final = components(links.unionAll(more)) if more.limit(1).count() else known

    named = (nodes.select("k", "key").join(final.withColumnRenamed("node", "k"), "k", "left")
             .withColumn("c", F.coalesce("component", "k")))
    smallest = named.groupBy("c").agg(F.min("key").alias("component_id"))
    by_set = named.join(smallest, "c").select("k", "component_id")
    out = rows.where("n > 0").join(by_set, "k").select("key", "n", "component_id") \
        .unionAll(rows.where("n = 0").select("key", "n", F.col("key").alias("component_id")))
    return out.select(F.col("key").alias(key), F.col("n").cast("long").alias("n_shingles"), "component_id")

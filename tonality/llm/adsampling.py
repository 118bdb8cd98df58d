"""Approximate nearest neighbours by adaptive dimension scan.

Largest inner product, found as a nearest-neighbour search: a vector is
extended by one component that brings all candidates to one length, so the
nearest extended vector has the largest product.  Extended vectors are turned
by a random rotation and assigned to the nearest of a set of centroids (an
inverted list each).  A query scans its ``probes`` nearest lists: as many as
hold the share ``RECALL`` of true neighbours among vectors of a sample that the
centroids were not fitted on, so their number follows from the data's
structure, not from the table's size.  Candidates are compared column block by
column block: after each block a hypothesis test on the partial distance
abandons those that are, at the set confidence, beyond the query's k-th best so
far; only survivors are finished and tighten it.  A task scans a query's lists
nearest first and hands its bound on from one to the next.

Candidates found are scored exactly, in double precision, on the original
vectors.

Scale: copies of a vector are one candidate - it carries the ``k + 1``
smallest ids, all that any query can want - and copies among queries search
once.  Lists are dealt out in blocks of at most ``BLOCK`` vectors, so a list
of any size is scanned by many tasks; each returns at most ``k + 1`` rows a
query.  Centroids are fitted on at most ``SAMPLE`` vectors (those with the
smallest hash); their number grows as the square root of the table, up to
``MAX_LISTS``.

Vectors that are null or empty, of another length than the most frequent one,
zero, or hold a null or non-finite component take no part.  Rows with equal
ids are candidates of their own, as one id: the best product counts.  Null ids take no part.  Empty
tables give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonality.llm.common import via_table, workers_import

SAMPLE = 20_000
MAX_LISTS = 4096
BLOCK = 4096            # vectors that a task compares at once
GROUP = 8               # lists dealt out together
QUERY_PART = 4096       # queries that a task compares at once, about
STRIP = 512             # candidates after which a query's bound is tightened
COLUMNS = 16            # dimensions compared between two tests
EPSILON = 2.1           # the test's confidence: larger abandons later
RECALL = 0.96           # share of the held-out sample's neighbours that the scanned lists hold
PROBES = None           # a share of the lists to scan instead of what RECALL needs
HELD_OUT = 5            # one in so many vectors of the sample is kept from the centroids
HELD_OUT_QUERIES = 1000
ROWS = 4096             # rows compared with all centroids at once
SEED = 7


def usable(vec: Column) -> Column:
    """Whether a vector has components, all finite, not all zero."""
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vec.isNotNull() & (F.size(vec) > 0) & good & F.exists(vec, lambda x: x != 0), F.lit(False))


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _closest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Each row's nearest centroid, some rows at a time."""
    size = (centers ** 2).sum(1)
    return np.concatenate([np.empty(0, np.int64)] + [np.argmin(size - 2 * x[i:i + ROWS] @ centers.T, axis=1)
                                                     for i in range(0, len(x), ROWS)])


def _kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    centers = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _closest(x, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=k)
        centers[n > 0] = sums[n > 0] / n[n > 0, None]
        if (n == 0).any():
            centers[n == 0] = x[rng.choice(len(x), int((n == 0).sum()))]
    return centers


class Index:
    """What tasks need: the rotation, the length all candidates are brought to, the centroids and how many lists to scan."""

    def __init__(self, sample: np.ndarray, max_norm2: float, n_rows: int, k: int = 20):
        self.dim = sample.shape[1] + 1
        self.turn = rotation(self.dim)
        self.max_norm2 = max_norm2
        held = np.arange(len(sample)) % HELD_OUT == HELD_OUT - 1
        x = self.candidates(sample[~held])
        lists = int(min(MAX_LISTS, max(1, round(np.sqrt(n_rows))), max(1, len(x) // 8)))
        self.centers = _kmeans(x, lists)
        self.probes = self._needed(sample[held], n_rows, k) if PROBES is None else max(1, round(PROBES * lists))

    def _needed(self, held: np.ndarray, n_rows: int, k: int) -> int:
        """The least number of lists that holds ``RECALL`` of the held-out vectors' nearest held-out vectors.

        Of ``k`` neighbours in the table, the held-out vectors are that share (one at least, which errs to more lists).
        """
        n = min(len(held) - 1, max(1, -(-k * len(held) // n_rows)))
        if n < 1:
            return len(self.centers)
        of, places = _closest(self.candidates(held), self.centers), []
        for low in range(0, min(len(held), HELD_OUT_QUERIES), 100):
            q = held[low:min(low + 100, HELD_OUT_QUERIES)]
            product = q @ held.T
            product[np.arange(len(q)), low + np.arange(len(q))] = -np.inf
            near = np.argpartition(-product, n - 1, axis=1)[:, :n]
            apart = self.distances(self.queries(q))
            reached = np.take_along_axis(apart, of[near], axis=1)
            places.append((apart[:, None, :] < reached[:, :, None]).sum(2).ravel())
        place = np.sort(np.concatenate(places))
        return int(place[max(0, int(np.ceil(RECALL * len(place))) - 1)]) + 1

    def candidates(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.max_norm2 - (x ** 2).sum(1)))
        return np.hstack([x, rest[:, None]]) @ self.turn

    def queries(self, q: np.ndarray) -> np.ndarray:
        """Queries of unit length (their scale does not change the order), with a zero component."""
        q = q / np.sqrt((q ** 2).sum(1, keepdims=True)) * np.sqrt(self.max_norm2)
        return np.hstack([q, np.zeros((len(q), 1))]) @ self.turn

    def distances(self, x: np.ndarray) -> np.ndarray:
        return (self.centers ** 2).sum(1) - 2 * x @ self.centers.T


def scan(q: np.ndarray, x: np.ndarray, k: int, epsilon: float = EPSILON, columns: int = COLUMNS,
         bound: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``(query, candidate)`` of positions: each rotated query's ``k`` nearest by the adaptive scan.

    ``bound`` holds the distance beyond which a query wants no candidate
    (infinite: not known yet) and is tightened in place.  While one is
    infinite, the first candidates are compared in full.  Then come strips of
    candidates: a strip's pairs go through the column blocks together, those
    that fail the test are dropped after each block, and the survivors tighten
    the bounds before the next strip.
    """
    (n, dim), n_q = x.shape, len(q)
    bound = np.full(n_q, np.inf) if bound is None else bound
    head = 0 if np.isfinite(bound).all() else min(n, max(4 * k, 64))
    who, at = np.repeat(np.arange(n_q), head), np.tile(np.arange(head), n_q)
    who, at, dist = _nearest(who, at, _apart(q, x[:head]).ravel(), bound, k)
    for low in range(head, n, STRIP):
        strip = x[low:low + STRIP]
        new, place = np.divmod(np.arange(n_q * len(strip)), len(strip))
        part = _apart(q[:, :columns], strip[:, :columns]).ravel()
        for seen in range(columns, dim, columns):   # estimate from the columns seen, against a widened bound
            stay = np.flatnonzero(part * (dim / seen) <= bound[new] * (1 + epsilon / np.sqrt(seen)) ** 2)
            new, place = new[stay], place[stay]
            cols = slice(seen, seen + columns)
            part = part[stay] + ((q[new, cols] - strip[place, cols]) ** 2).sum(1)
        who, at, dist = _nearest(np.concatenate([who, new]), np.concatenate([at, place + low]),
                                 np.concatenate([dist, part]), bound, k)
    return who, at


def _nearest(who: np.ndarray, at: np.ndarray, dist: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Each query's ``k`` nearest pairs within its bound, with all ties at the k-th distance, to which the bound falls."""
    order = np.lexsort((dist, who))
    who, at, dist = who[order], at[order], dist[order]
    edges = np.searchsorted(who, np.arange(len(bound) + 1))
    enough = np.flatnonzero(np.diff(edges) >= k)
    bound[enough] = np.minimum(bound[enough], dist[edges[enough] + k - 1])
    take = dist <= bound[who] * (1 + 1e-12)
    return who[take], at[take], dist[take]


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` from all rows of ``b``."""
    return np.maximum(0.0, (a ** 2).sum(1)[:, None] + (b ** 2).sum(1) - 2 * a @ b.T)


def _matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else np.empty((0, 1))


def search(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """``(query_id, rank, key, score double)``: each query's ``k`` rows of largest product, itself left out."""
    spark = vectors.sparkSession
    workers_import(spark)
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), is_query.alias("is_query"),
                          F.col(f"`{vec}`").cast("array<double>").alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))
    shape = rows.groupBy(F.size("v").alias("dim")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("norm2")) \
        .orderBy(F.desc("n"), "dim").first()
    empty = f"query_id long, rank int, {key} long, score double"
    if shape is None:
        return spark.createDataFrame([], empty)
    rows = rows.where(F.size("v") == shape.dim)
    # one candidate a distinct vector; the ids of its copies come back by its hash
    smallest = F.array_sort(F.collect_set("id"))
    hashed = rows.withColumn("h", F.xxhash64("v")).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    ranked = hashed.withColumn("n", F.row_number().over(Window.partitionBy("h", "v", "salt").orderBy("id")))
    some = ranked.where(F.col("n") <= k + 1).groupBy("h", "v", "salt").agg(smallest.alias("ids"))
    distinct = some.groupBy("h", "v").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"))
    distinct = via_table(distinct.withColumn("c", F.xxhash64("h", "v")), "vectors")
    n_rows = distinct.count()
    sample = distinct.select("v").orderBy(F.xxhash64(F.lit(SEED), "v")).limit(SAMPLE).toPandas()
    index = spark.sparkContext.broadcast(Index(np.stack(sample["v"].to_numpy()), float(shape.norm2), n_rows, k))

    def to_list(batches):
        ix = index.value
        for b in batches:
            x = ix.candidates(_matrix(b.column(1)))
            near = _closest(x, ix.centers)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(near.astype(np.int32)), b.column(1)], ["c", "list", "v"])

    n_groups = max(1, -(-len(index.value.centers) // GROUP))

    def to_probes(batches):
        ix = index.value
        for b in batches:
            q = ix.queries(_matrix(b.column(1)))
            n = ix.probes
            near = np.argpartition(ix.distances(q), n - 1, axis=1)[:, :n] if len(q) else np.empty((0, n), np.int64)
            who, lists = np.repeat(np.arange(b.num_rows), n), near.ravel()
            order = np.lexsort((lists % n_groups, who))
            who, lists = who[order], lists[order].astype(np.int32)
            new = np.flatnonzero(np.diff(who * n_groups + lists % n_groups, prepend=-1))
            cuts = pa.array(np.append(new, len(who)).astype(np.int32))
            rows = pa.array(who[new])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(rows), pa.array(lists[new] % np.int32(n_groups)),
                 pa.ListArray.from_arrays(cuts, pa.array(lists)), b.column(1).take(rows)], ["q", "grp", "lists", "v"])

    listed = via_table(distinct.select("c", "v").mapInArrow(to_list, "c long, list int, v array<double>")
                       .withColumn("grp", F.pmod(F.col("list"), F.lit(n_groups))), "lists")
    sizes = listed.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))   # a row per group
    queries = rows.where("is_query").select("v").distinct().select(F.xxhash64(F.xxhash64("v"), "v").alias("q"), "v")
    parts = max(1, -(-rows.where("is_query").count() // QUERY_PART))
    probed = (queries.mapInArrow(to_probes, "q long, grp int, lists array<int>, v array<double>")
              .join(F.broadcast(sizes), "grp")
              .withColumn("part", F.pmod(F.xxhash64("q"), F.lit(parts)).cast("int"))
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    cands = (listed.join(F.broadcast(sizes), "grp").withColumn("block", F.pmod(F.col("c"), F.col("blocks")).cast("int"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))))

    def compare(left, right):
        ix = index.value
        qs, cs, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        if left.num_rows and right.num_rows:
            qv, xv = _matrix(left.column("v").combine_chunks()), _matrix(right.column("v").combine_chunks())
            q_turned, x_turned = ix.queries(qv), ix.candidates(xv)
            probes = left.column("lists").combine_chunks()
            q_of = np.repeat(np.arange(len(qv)), np.diff(probes.offsets.to_numpy()))
            list_of, x_list = probes.flatten().to_numpy(), right.column("list").to_numpy()
            centers = ix.centers[left.column("grp")[0].as_py()::n_groups]
            apart = ((centers ** 2).sum(1) - 2 * q_turned @ centers.T)[q_of, list_of // n_groups]
            order = np.lexsort((apart, q_of))               # a query's lists, the nearest first
            q_of, list_of = q_of[order], list_of[order]
            turn = np.arange(len(q_of)) - np.searchsorted(q_of, q_of)
            bound = np.full(len(qv), np.inf)
            whos, ats = [], []
            for now in range(int(turn.max()) + 1):
                for one in np.unique(list_of[turn == now]):
                    asking, here = q_of[(turn == now) & (list_of == one)], np.flatnonzero(x_list == one)
                    if len(here):
                        wanted = bound[asking]
                        who, at = scan(q_turned[asking], x_turned[here], k + 1, bound=wanted)
                        bound[asking] = wanted
                        whos.append(asking[who])
                        ats.append(here[at])
            if whos:
                who, at = np.concatenate(whos), np.concatenate(ats)
                score = (qv[who] * xv[at]).sum(1)
                order = np.lexsort((-score, who))
                who, at, score = who[order], at[order], score[order]
                begin = np.searchsorted(who, np.arange(len(qv)))
                size = np.diff(np.append(begin, len(who)))
                least = np.where(size > 0, score[np.minimum(begin + np.minimum(size, k + 1), len(who)) - 1], 0.0)
                best = score >= least[who]
                qs.append(left.column("q").to_numpy()[who[best]])
                cs.append(right.column("c").to_numpy()[at[best]])
                scores.append(score[best])
        return pa.table({"q": np.concatenate(qs), "c": np.concatenate(cs), "score": np.concatenate(scores)})

    pairs = (probed.select("grp", "block", "part", "q", "lists", "v").groupBy("grp", "block", "part")
             .cogroup(cands.select("grp", "block", "part", "c", "list", "v").groupBy("grp", "block", "part"))
             .applyInArrow(compare, "q long, c long, score double"))
    best = pairs.withColumn("n", F.rank().over(Window.partitionBy("q").orderBy(F.desc("score"))))
    best = best.where(F.col("n") <= k + 1).drop("n")
    named = best.join(distinct.select("c", "ids"), "c").select("q", "score", F.explode("ids").alias(key))
    ids = named.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), key))) \
        .where(F.col("n") <= k + 1).drop("n")
    who = rows.where("is_query").select(F.xxhash64(F.xxhash64("v"), "v").alias("q"), F.col("id").alias("query_id")).distinct()
    own = who.join(ids, "q").where(F.col("query_id") != F.col(key))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    once = own.groupBy("query_id", key).agg(F.max("score").alias("score"))
    return (once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), key, "score"))

"""Small helpers shared by the operators: worker imports, Arrow text, byte runs, block sums."""

from __future__ import annotations

import os
import posixpath
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality.session import shared_dir

PIECE_BYTES = 1 << 20

#: white space of the word definition ``[^\x20\x09-\x0D]+``
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def workers_import(spark: SparkSession) -> None:
    """Lets Python workers on this driver's path import the package too.

    On a cluster the package is shipped with ``--py-files`` (or installed);
    for sessions that only extended ``sys.path`` the root is added to the
    workers' ``PYTHONPATH``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([p for p in [*have, root] if p])


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint location."""
    return posixpath.join(shared_dir(spark, "llm"), f"{name}-{uuid.uuid4().hex}")


def via_table(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: the lineage is cut there."""
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Removes the folder of a ``via_table`` frame, once all that was read from it is itself written."""
    spark = df.sparkSession
    for path in {posixpath.dirname(f) for f in df.inputFiles()}:
        if posixpath.basename(posixpath.dirname(path)) != "llm":
            raise ValueError(f"{path} is not a table of this run")
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def clean_strings(col: pa.Array) -> pa.Array:
    """The column as plain strings, null as empty."""
    if not pa.types.is_string(col.type):
        col = col.cast(pa.string())
    return pc.fill_null(col, "") if col.null_count else col


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column without a copy; null counts as empty."""
    col = clean_strings(col)
    n = len(col)
    if n == 0 or col.buffers()[2] is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8)[off[0]:off[-1]]
    return data, off - off[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs ``[i, j)`` of whole texts of about ``limit`` bytes, so that scratch arrays stay small."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply), vectorised; ``x`` is uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15


def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    filled = 1
    step = np.uint64(base)
    with np.errstate(over="ignore"):
        while filled < n:                     # doubling: out[k:2k] = out[:k] * base**k
            take = min(filled, n - filled)
            out[filled:filled + take] = out[:take] * step
            filled += take
            step = step * step
    return out


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """64-bit hash of each byte range ``[start, end)``: a polynomial over 2**64, mixed with the length.

    One running sum serves all ranges; multiplying by a power of the inverse
    of the (odd) base makes the value independent of the position.
    """
    with np.errstate(over="ignore"):
        n = len(data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(n, base), out=sums[1:])
        back = _powers(n + 1, pow(base, -1, 1 << 64))
        value = (sums[ends] - sums[starts]) * back[starts]
        return mix64(value ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    if not len(mask):
        e = np.empty(0, np.int64)
        return e, e
    edge = np.diff(mask.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def cast_like(df: DataFrame, *cols: str) -> DataFrame:
    """Only the named columns: extra columns of an input never reach a worker."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def range_bounds(df: DataFrame, col: str, parts: int) -> list[int]:
    """At most ``parts - 1`` ascending cut values of a numeric column, from Spark's quantile sketch."""
    if parts < 2:
        return []
    qs = [i / parts for i in range(1, parts)]
    got = df.select(F.percentile_approx(F.col(col).cast("long"), F.lit(qs), 20 * parts).alias("q")).first()
    return sorted(set(got.q)) if got and got.q else []


def sum_blocks(df: DataFrame, n_blocks: int) -> list[np.ndarray | None]:
    """Element-wise sums of count blocks ``(part int, block int, counts binary of int32)``, one int64 array a block.

    The counts have a fixed number of cells whatever the input, so that the
    sums that reach the driver have a proven size.  Salted in two steps: the
    tasks' blocks are first summed in groups of about 16 tasks.
    """
    def adder(kind: str):
        def add(key, table):
            total = np.zeros(0, np.int64)
            for blob in table.column("counts"):
                x = np.frombuffer(blob.as_buffer(), kind).astype(np.int64)
                total = total + x if len(total) else x
            return pa.table({"block": pa.array([key[0].as_py()], pa.int32()),
                             "counts": pa.array([total.tobytes()], pa.binary())})
        return add

    groups = max(1, df.sparkSession.sparkContext.defaultParallelism // 16, shuffle_parts(df.sparkSession) // 16)
    salted = df.withColumn("salt", F.col("part") % F.lit(groups))
    first = salted.groupBy("block", "salt").applyInArrow(adder("i4"), "block int, counts binary")
    rows = first.groupBy("block").applyInArrow(adder("i8"), "block int, counts binary").collect()
    out: list[np.ndarray | None] = [None] * n_blocks
    for r in rows:
        out[r.block] = np.frombuffer(r.counts, np.int64)
    return out


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

"""Growth of cumulative counters as a stream (R4): keyed state with timers.

The batch form (``operators/metrics.counter_deltas``) looks back with ``lag``.  In a stream the
previous call of an instance may lie in an earlier micro-batch, and calls may come out of
order, so each instance has state:

* ``waiting``: calls that the watermark has not passed yet, any order;
* ``last``: time, id and counters of the last call that it has passed.

A timer at the earliest waiting call wakes the instance once the watermark gets there; the
calls up to the watermark are then taken in order, compared with ``last`` and given out, each once.
Calls before the watermark are late and dropped (Spark itself drops those before the last batch's).  When the watermark
is ``expire`` past the last call, the state is cleared; a call after that is a first one, by
its own time and not by when the timer ran, so batch and stream give the same rows.

State per instance is one row and the calls of the watermark's delay, as blocks: the calls that an
instance has in a batch are one entry, so that state is read and written by the batch, not by the call.
Calls of one instance are taken in order, thus by one task; instances are spread over all.
Calls without a time never pass; ones without an id come last of those of their time.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tonality.session import shared_dir

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"   # what keyed state with timers needs


def growth(value: int | None, before: int | None) -> int | None:
    """By how much a counter grew; one that fell was reset and counts from zero."""
    if value is None or before is None:
        return None
    return value if value < before else value - before


def _block(frame: pd.DataFrame, columns: Sequence[str]) -> np.ndarray:
    """A row of whole numbers per call: the columns, null as 0, and a bit for each that is null."""
    out = np.zeros((len(frame), len(columns) + 1), np.int64)
    for i, c in enumerate(columns):
        null = frame[c].isna().to_numpy(bool)
        out[~null, i] = frame[c][~null].to_numpy().astype(np.int64)
        out[:, -1] |= null.astype(np.int64) << i
    return out


class CounterState(StatefulProcessor):
    def __init__(self, values: Sequence[str], expire_us: int):
        self.values, self.expire_us = list(values), expire_us
        self.width = 2 + len(self.values) + 1

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "call binary")
        self.waiting = handle.getListState("waiting", "calls binary")

    def _calls(self, blob: bytes) -> np.ndarray:
        return np.frombuffer(bytes(blob), np.int64).reshape(-1, self.width)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        new = [_block(batch, ["start_us", "event_id", *self.values]) for batch in rows]
        new = [b[(b[:, 0] >= passed) & (b[:, -1] & 1 == 0)] for b in new]      # those before the watermark have been given out
        new = [b for b in new if len(b)]
        if new:
            self.waiting.appendList([(b.tobytes(),) for b in new])
            self._wake(min(int(b[:, 0].min()) for b in new))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        blocks = [self._calls(r[0]) for r in self.waiting.get()]
        calls = np.concatenate(blocks) if blocks else np.empty((0, self.width), np.int64)
        calls = calls[np.lexsort((calls[:, 1], calls[:, -1] >> 1 & 1, calls[:, 0]))]
        n = int(np.searchsorted(calls[:, 0], passed))
        ready, rest = calls[:n], calls[n:]
        kept = self.last.get()
        last = self._calls(kept[0]) if kept is not None else None
        out = self._grown(key[0], ready, last) if n else None
        if n:
            last = ready[-1:]
            self.waiting.clear()
            if len(rest):
                self.waiting.appendList([(rest.tobytes(),)])
        if len(rest):
            self._wake(int(rest[0, 0]))
        if last is not None and not len(rest) and passed > last[0, 0] + self.expire_us:
            if kept is not None:
                self.last.clear()
        elif n:
            self.last.update((last.tobytes(),))
            self._wake(int(last[0, 0]) + self.expire_us)
        if out is not None:
            yield out

    def _grown(self, instance, ready: np.ndarray, last: np.ndarray | None) -> pd.DataFrame:
        """The calls, each with what :func:`growth` makes of it and the one before."""
        before = np.concatenate([ready[:1] if last is None else last, ready[:-1]])
        known = ready[:, 0] - before[:, 0] <= self.expire_us
        if last is None:
            known[0] = False
        out = pd.DataFrame({"instance": pd.Series([instance] * len(ready), dtype=object), "start_us": ready[:, 0],
                            "event_id": pd.arrays.IntegerArray(ready[:, 1].copy(), (ready[:, -1] >> 1 & 1).astype(bool))})
        for i, v in enumerate(self.values, 2):
            null = ~known | ((ready[:, -1] | before[:, -1]) >> i & 1).astype(bool)
            grown = np.where(ready[:, i] < before[:, i], ready[:, i], ready[:, i] - before[:, i])
            out[f"{v}_delta"] = pd.arrays.IntegerArray(grown, null)
        return out

    def _wake(self, us: int) -> None:
        self.handle.registerTimer(us // 1000 + 1)

    def close(self) -> None:
        pass


def counter_delta_stream(log: DataFrame, values: Sequence[str] = ("net_bytes_sent", "net_bytes_recv"),
                         instance_col: str = "instance", watermark: str = "10 minutes",
                         expire_us: int = 24 * 3_600_000_000) -> DataFrame:
    """``(instance, start_us, event_id, *_delta)`` of a streaming request log, each call once, as the watermark passes it."""
    rows = log.select(F.col(instance_col).alias("instance"), "start_us", "event_id",
                      *[F.col(v).cast("long").alias(v) for v in values], "event_time").withWatermark("event_time", watermark)
    kind = dict(log.dtypes)[instance_col]
    schema = f"instance {kind}, start_us long, event_id long, " + ", ".join(f"{v}_delta long" for v in values)
    return rows.groupBy("instance").transformWithStateInPandas(
        CounterState(values, expire_us), schema, outputMode="Append", timeMode="EventTime")


def start_counter_stream(spark: SparkSession, log: DataFrame, out_dir: str | None = None, **options) -> tuple[StreamingQuery, str]:
    """Starts the stream into a Parquet folder; returns ``(query, folder)``.  ``options`` are those of the stream."""
    root = out_dir or shared_dir(spark, "streams", "counters", uuid.uuid4().hex)
    out = posixpath.join(root, "out")
    was = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)          # read when a query starts
    try:
        q = (counter_delta_stream(log, **options).writeStream.outputMode("append").format("parquet")
             .option("path", out).option("checkpointLocation", posixpath.join(root, "checkpoint")).start())
    finally:
        spark.conf.set(PROVIDER, was)
    return q, out

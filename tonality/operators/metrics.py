"""Request metrics: counter (A7), last-value gauges (A8), HTTP totals and
latency buckets (A9), run time (R2), memory used (R3), counter deltas (R4),
resampling to a scrape interval (R5) and the long metric form (R6).

The reference sets one counter and five gauges per request.  Here a request
log - one row per call - is aggregated instead, so every figure can be
produced for any time window, in batch or in a stream.

Scale notes
-----------
* Counters, sums and buckets are plain aggregates with map-side partials.
* A gauge is the value of the latest call: ``max_by(value, (time, id))``,
  again a partial aggregate, so a hot handler or instance costs one row per
  task.
* Counter deltas need the previous call of the same instance (``lag``).  A
  window partitioned by instance alone would put a hot instance into one
  task, so the window is partitioned by ``(instance, hour)`` and the
  first call of each bucket takes the last call of the instance's previous
  bucket, found over one row per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonality.functions.text import abs_diff, bytes_to_kib

# --- fixed values: the HTTP instrumentation's latency buckets (seconds) -------
LATENCY_BUCKETS = (0.1, 0.5, 1.0)
# ---------------------------------------------------------------------------

GAUGES = ("run_time_s", "memory_kib", "cpu_percent", "net_bytes_sent", "net_bytes_recv")
MiB = 1024 * 1024


def epoch_micros(ts, instant: bool = False) -> Column:
    """Microseconds since 1970, zone-free: of a ``TIMESTAMP`` if ``instant``, else of a ``TIMESTAMP_NTZ``."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    if instant:
        return F.unix_micros(ts)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, ts.cast("timestamp_ntz"))


def request_log(events: DataFrame) -> DataFrame:
    """The ``events`` table read as a request log.

    Fixed mapping (the table has no host probes): handler = ``event_type``,
    instance = ``user_id``, start = ``ts``, duration = ``value`` seconds,
    CPU percent = ``props.k``, memory before / after the call = ``k`` /
    ``value`` MiB, and the host network counters (cumulative bytes sent /
    received) = ``event_id * 1500`` / ``event_id * 900 + k``.
    """
    k = F.get_json_object("props", "$.k").cast("double")
    start_us = epoch_micros("ts", isinstance(events.schema["ts"].dataType, T.TimestampType))
    end_us = start_us + F.round(F.col("value") * F.lit(1e6)).cast("bigint")
    log = events.select(
        "event_id", "ts",
        F.col("user_id").alias("instance"), F.col("event_type").alias("handler"),
        start_us.alias("start_us"), end_us.alias("end_us"),
        (k * F.lit(MiB)).alias("mem_before_bytes"), (F.col("value") * F.lit(MiB)).alias("mem_after_bytes"),
        k.alias("cpu_percent"),
        (F.col("event_id") * F.lit(1500)).alias("net_bytes_sent"),
        (F.col("event_id") * F.lit(900) + k.cast("bigint")).alias("net_bytes_recv"))
    return with_derived(log)


def with_derived(log: DataFrame) -> DataFrame:
    """R2 + R3: run time from start/end, memory used in KiB, and the event instant."""
    return (log
            .withColumn("run_time_s", (F.col("end_us") - F.col("start_us")) / F.lit(1e6))
            .withColumn("memory_kib", bytes_to_kib(abs_diff("mem_after_bytes", "mem_before_bytes")))
            .withColumn("event_time", F.timestamp_micros("start_us")))


def order_key(time_col: str = "start_us", id_col: str = "event_id") -> Column:
    """``(time, id)`` packed into one orderable ``decimal(38,0)``: ``time * 2^64 + id + 2^63``.

    ``max_by`` over a single numeric key stays a hash aggregate; over a struct
    it would sort every row first.
    """
    d = "decimal(38,0)"
    return (F.col(time_col).cast(d) * F.lit(str(2 ** 64)).cast(d)
            + F.col(id_col).cast(d) + F.lit(str(2 ** 63)).cast(d)).cast(d)


def _latest(value: str) -> Column:
    return F.max_by(F.col(value), order_key())


def request_totals(log: DataFrame, by: Sequence[str] = ("handler",),
                   buckets: Sequence[float] = LATENCY_BUCKETS) -> DataFrame:
    """A7 + A9: calls, total seconds and cumulative latency buckets per group."""
    cols = [F.count(F.lit(1)).alias("requests_total"), F.sum("run_time_s").alias("duration_sum_s")]
    for b in buckets:
        name = "le_" + (f"{b:g}".replace(".", "_"))
        cols.append(F.sum(F.when(F.col("run_time_s") <= F.lit(b), 1).otherwise(0)).cast("bigint").alias(name))
    cols.append(F.count(F.lit(1)).alias("le_inf"))
    return log.groupBy(*by).agg(*cols)


def gauges(log: DataFrame, by: Sequence[str] = ("instance",),
           values: Sequence[str] = GAUGES) -> DataFrame:
    """Calls and the latest value of every gauge per group."""
    return log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("requests"),
        *[_latest(v).alias(v) for v in values],
        F.max("start_us").alias("last_start_us"))


def counter_deltas(log: DataFrame, values: Sequence[str] = ("net_bytes_sent", "net_bytes_recv"),
                   instance_col: str = "instance", bucket_us: int = 3_600_000_000, expire_us: int | None = None) -> DataFrame:
    """By how much each counter grew since the instance's previous call, in call order.

    A counter that fell was reset (its host started anew), so it counts from zero: its growth is its value.  The
    first call has none (null), and so has, with ``expire_us``, a call that comes longer than that after
    the previous one.  ``bucket_us`` is the time slice that bounds each window partition (default one hour:
    a window partition holds one instance-hour of calls, and the carry table has at most one row per non-empty
    instance-hour).
    """
    order = ["start_us", "event_id"]
    b = F.floor(F.col("start_us") / F.lit(bucket_us)).cast("bigint")
    keyed = log.select(instance_col, *order, *values, b.alias("_b"))
    kept = [*values, "start_us"]

    # Level 1: previous call inside the same (instance, bucket).
    w = Window.partitionBy(instance_col, "_b").orderBy(*order)
    inner = keyed.withColumn("_rn", F.row_number().over(w))
    for v in kept:
        inner = inner.withColumn(f"_prev_{v}", F.lag(v).over(w))

    # Level 2: last call of each bucket, then the previous non-empty bucket's last call.
    last = keyed.groupBy(instance_col, "_b").agg(
        *[F.max_by(F.col(v), order_key(*order)).alias(f"_last_{v}") for v in kept])
    wb = Window.partitionBy(instance_col).orderBy("_b")
    carry = last.select(instance_col, "_b", *[F.lag(f"_last_{v}").over(wb).alias(f"_carry_{v}") for v in kept])

    j = inner.join(carry, [instance_col, "_b"], "left")
    before = {v: F.when(F.col("_rn") == 1, F.col(f"_carry_{v}")).otherwise(F.col(f"_prev_{v}")) for v in kept}
    out = [instance_col, *order]
    for v in values:
        grown = F.when(F.col(v) < before[v], F.col(v)).otherwise(F.col(v) - before[v])
        if expire_us is not None:
            grown = F.when(F.col("start_us") - before["start_us"] <= F.lit(expire_us), grown)
        out.append(grown.alias(f"{v}_delta"))
    return j.select(*out)


def resample(log: DataFrame, interval: str = "10 seconds", by: Sequence[str] = ("handler",),
             time_col: str = "event_time", values: Sequence[str] = ("run_time_s", "cpu_percent", "memory_kib")) -> DataFrame:
    """Tumbling windows of ``interval``: calls and the latest gauges per window.

    The window start is given as epoch seconds (``window_start_s``).
    """
    agg = log.groupBy(F.window(time_col, interval).alias("w"), *by).agg(
        F.count(F.lit(1)).alias("requests"), *[_latest(v).alias(v) for v in values])
    return agg.select(F.unix_seconds(F.col("w.start")).alias("window_start_s"), *by, "requests", *values)


def metrics_long(wide: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One ``(ids..., metric, value)`` row per metric (``unpivot``, no shuffle)."""
    cast = wide.select(*ids, *[F.col(v).cast("double").alias(v) for v in values])
    return cast.unpivot(list(ids), list(values), "metric", "value")


def request_metrics(log: DataFrame, interval: str = "10 seconds", by: Sequence[str] = ("handler",),
                    watermark: str | None = None) -> DataFrame:
    """The metric snapshot per scrape interval in long form: R5 then R6.

    Works on a batch or a streaming request log (give ``watermark`` for a stream).
    """
    if watermark:
        log = log.withWatermark("event_time", watermark)
    wide = resample(log, interval, by=by)
    return metrics_long(wide, ["window_start_s", *by], ["requests", "run_time_s", "cpu_percent", "memory_kib"])

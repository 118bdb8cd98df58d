"""What a scraper sees (R5 with A7, A8): gauges and counters at fixed times.

A gauge keeps its value until it is set again, and a counter only grows; a scrape
every ``interval`` sees both as they are then, whether or not a request came
since the last one.  ``resample`` (``operators/metrics``) gives the windows that hold a
request; here every scrape has a row, from the first one after a group's first
request to the last one of the whole log.  A value is set when its request ends
(``end_us``); of requests that end together, the greater ``event_id`` counts.

Two levels keep every window small, however long or hot a group is:

1. Requests are folded to one row per (group, scrape) - latest gauges, counts and sums,
   as partial aggregates - and these to one row per (group, range) of ``range_us``.
2. Over the ranges (one row per group and range, also empty ones) the last value and the running totals
   *before* each range are carried.
3. Inside a (group, range) the scrapes are laid out, joined with their rows, and filled: last value so far,
   running total so far, else what the range was handed.

No window holds a group's requests, or its scrapes: one has a row per range, the other the
scrapes of one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonality.operators.metrics import LATENCY_BUCKETS, order_key

HOUR_US = 3_600_000_000


def _tick(time_col: str, interval_us: int) -> Column:
    """Number of the first scrape at or after a time."""
    return F.ceil(F.col(time_col) / F.lit(interval_us)).cast("bigint")


def _outer(grid: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``grid`` with the columns of ``rows`` that it lacks, matched on ``keys`` (nulls match)."""
    renamed = rows.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return grid.join(renamed, on, "left").drop(*[f"_r_{k}" for k in keys])


def _bounds(cells: DataFrame, by: Sequence[str], per: int) -> DataFrame:
    """``(*by, range, from, to)``: every range of every group with the scrapes it holds."""
    end = cells.agg(F.max("tick").alias("_end"))
    spans = cells.groupBy(*by).agg(F.min("tick").alias("_start")).join(F.broadcast(end))     # one row
    first = F.floor(F.col("_start") / per).cast("bigint")
    ranges = spans.select(*by, "_start", "_end", F.explode(F.sequence(first, F.floor(F.col("_end") / per).cast("bigint"))).alias("range"))
    return ranges.select(*by, "range", F.greatest(F.col("range") * per, "_start").alias("from"),
                         F.least(F.col("range") * per + (per - 1), "_end").alias("to"))


def _fill(cells: DataFrame, by: Sequence[str], per: int, last: Sequence[str], total: Sequence[str]) -> DataFrame:
    """``(*by, tick, ...)`` for every scrape: ``last`` columns carried, ``total`` columns summed up to it."""
    cells = cells.withColumn("range", F.floor(F.col("tick") / per).cast("bigint"))
    ends = cells.groupBy(*by, "range").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("tick"))).alias(c) for c in last],
        *[F.sum(c).alias(c) for c in total])
    ranges = _outer(_bounds(cells, by, per), ends, [*by, "range"])
    so_far = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    handed = ranges.select(
        *by, "range", "from", "to",
        *[F.last(c, ignorenulls=True).over(so_far).alias(f"_{c}") for c in last],
        *[F.coalesce(F.sum(c).over(so_far), F.lit(0)).alias(f"_{c}") for c in total])
    grid = handed.withColumn("tick", F.explode(F.sequence("from", "to"))).drop("from", "to")
    rows = _outer(grid, cells, [*by, "range", "tick"])
    inside = Window.partitionBy(*by, "range").orderBy("tick").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select(
        *by, "tick",
        *[F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col(f"_{c}")).alias(c) for c in last],
        *[(F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_{c}")).alias(c) for c in total])


def _per_range(interval_s: int, range_us: int) -> int:
    if interval_s < 1:
        raise ValueError("interval_s must be at least one second")
    return max(1, range_us // (interval_s * 1_000_000))


def scraped_gauges(log: DataFrame, interval_s: int = 10, by: Sequence[str] = ("handler",),
                   values: Sequence[str] = ("run_time_s", "memory_kib", "cpu_percent"),
                   time_col: str = "end_us", id_col: str = "event_id", range_us: int = HOUR_US) -> DataFrame:
    """A8 at every scrape: ``(scrape_s, *by, *values)``, each gauge as it was last set.

    A request whose value is null sets nothing.  Requests without a time are never seen.
    """
    seen = log.where(F.col(time_col).isNotNull()).withColumn("tick", _tick(time_col, interval_s * 1_000_000))
    at = order_key(time_col, id_col)
    # max_by would take a null value of the latest request: a null sets nothing, so it has no order
    latest = [F.max_by(F.col(v), F.when(F.col(v).isNotNull(), at)).alias(v) for v in values]
    cells = seen.groupBy(*by, "tick").agg(*latest)
    filled = _fill(cells, by, _per_range(interval_s, range_us), values, ())
    return filled.select((F.col("tick") * interval_s).alias("scrape_s"), *by, *values)


def scraped_counters(log: DataFrame, interval_s: int = 10, by: Sequence[str] = ("handler",),
                     buckets: Sequence[float] = LATENCY_BUCKETS, time_col: str = "end_us",
                     range_us: int = HOUR_US) -> DataFrame:
    """A7 + A9 at every scrape: ``(scrape_s, *by, requests_total, duration_sum_s, le_* ...)``, totals since the start.

    Latency buckets are cumulative both in time and over their bounds; ``le_inf`` equals ``requests_total``.  The sum
    of seconds is kept in whole microseconds, so it is exact in any order of the rows.
    """
    seen = log.where(F.col(time_col).isNotNull()).withColumn("tick", _tick(time_col, interval_s * 1_000_000))
    names = ["le_" + f"{b:g}".replace(".", "_") for b in buckets]
    counted = [F.sum(F.when(F.col("run_time_s") <= F.lit(float(b)), 1).otherwise(0)).cast("bigint").alias(n)
               for b, n in zip(buckets, names, strict=True)]
    cells = seen.groupBy(*by, "tick").agg(
        F.count(F.lit(1)).alias("requests_total"), *counted,
        F.coalesce(F.sum(F.round(F.col("run_time_s") * F.lit(1e6)).cast("bigint")), F.lit(0)).alias("duration_us"))
    filled = _fill(cells, by, _per_range(interval_s, range_us), (), ["requests_total", "duration_us", *names])
    return filled.select((F.col("tick") * interval_s).alias("scrape_s"), *by, "requests_total",
                         (F.col("duration_us") / F.lit(1e6)).alias("duration_sum_s"), *names,
                         F.col("requests_total").alias("le_inf"))

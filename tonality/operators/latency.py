"""Latency quantiles of requests (A9): from cumulative buckets, and from mergeable sketches.

* ``bucket_quantiles`` reads a quantile off the buckets that ``request_totals`` or ``scraped_counters``
  give, by linear interpolation inside the bucket that holds it.  It costs nothing more and is as exact as the buckets are narrow.
* ``latency_sketches`` keeps one KLL sketch per group and window (Spark's native aggregate; partial sketches
  merge on the way).  Sketches are columns: they can be stored, and ``merge_sketches`` joins them to any longer
  interval or fewer groups without the requests.  The rank of an answer is off by at most about
  ``RANK_ERROR`` of the requests, minimum, maximum and number are exact, and a sketch of a few hundred
  values holds them all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_K = 400        # size parameter of a sketch (some kB)
RANK_ERROR = 0.01     # of the requests, at this size, with 99 % confidence


def bucket_columns(bounds: Sequence[float]) -> list[str]:
    return ["le_" + f"{b:g}".replace(".", "_") for b in bounds]


def bucket_quantile(q: float, bounds: Sequence[float]) -> Column:
    """The ``q``-quantile by the columns ``le_<bound>`` and ``le_inf`` of a row.

    The first bucket starts at zero.  A quantile beyond the last bound is that bound, as nothing is known above it.
    Null if there is no request.
    """
    if not 0.0 <= q <= 1.0:
        raise ValueError("a quantile lies between 0 and 1")
    if list(bounds) != sorted(set(map(float, bounds))) or not bounds or bounds[0] <= 0:
        raise ValueError("bounds must be positive and rise")
    rank = F.lit(float(q)) * F.col("le_inf")
    out = F.lit(float(bounds[-1]))
    low, below = 0.0, F.lit(0)
    steps = []
    for b, name in zip(bounds, bucket_columns(bounds), strict=True):
        inside = F.col(name) - below
        share = F.when(inside > 0, (rank - below) / inside).otherwise(F.lit(1.0))
        steps.append((F.col(name) >= rank, F.lit(low) + F.lit(float(b) - low) * share))
        low, below = float(b), F.col(name)
    for held, value in reversed(steps):
        out = F.when(held, value).otherwise(out)
    return F.when(F.col("le_inf") > 0, out)


def bucket_quantiles(totals: DataFrame, qs: Sequence[float], bounds: Sequence[float], prefix: str = "p") -> DataFrame:
    """``totals`` with a column ``p<percent>`` per quantile."""
    return totals.withColumns({f"{prefix}{q * 100:g}".replace(".", "_"): bucket_quantile(q, bounds) for q in qs})


def latency_sketches(log: DataFrame, interval: str = "10 seconds", by: Sequence[str] = ("handler",),
                     value: str = "run_time_s", time_col: str = "event_time", k: int = SKETCH_K) -> DataFrame:
    """``(window_start_s, *by, sketch)``: a sketch of the run times per window and group; nulls are not in it."""
    held = log.where(F.col(value).isNotNull()).groupBy(F.window(time_col, interval).alias("w"), *by).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))
    return held.select(F.unix_seconds(F.col("w.start")).alias("window_start_s"), *by, "sketch")


def merge_sketches(sketches: DataFrame, seconds: int | None = None, by: Sequence[str] = ("handler",), k: int = SKETCH_K) -> DataFrame:
    """Sketches merged to windows of ``seconds`` (None: all time) and to the groups ``by``."""
    start = [] if seconds is None else [(F.floor(F.col("window_start_s") / seconds) * seconds).cast("bigint").alias("window_start_s")]
    return sketches.groupBy(*start, *by).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, qs: Sequence[float], prefix: str = "p") -> DataFrame:
    """``sketches`` without the sketch, with its number of requests ``n`` and a column ``p<percent>`` per quantile."""
    told = {f"{prefix}{q * 100:g}".replace(".", "_"): F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))) for q in qs}
    return sketches.withColumns({"n": F.kll_sketch_get_n_double("sketch"), **told}).drop("sketch")

"""Registered queries of the request log as a scraper sees it and as keyed streams, with their oracles."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tonality.operators.latency import (RANK_ERROR, bucket_columns, bucket_quantiles, latency_sketches, merge_sketches,
                                        sketch_quantiles)
from tonality.operators.metrics import counter_deltas, epoch_micros, request_log, request_totals
from tonality.operators.scrape import scraped_counters, scraped_gauges
from tonality.plans.registry import LOG_SQL, RESAMPLED_SQL, WINDOW_COLUMNS, _log, _round_gauges, register
from tonality.session import shared_dir
from tonality.sources.stages import read_stage, write_stage
from tonality.sources.tables import table
from tonality.streaming.admission import admitted_stream, late_rows, start_admission, start_distinct_metrics
from tonality.streaming.counters import start_counter_stream
from tonality.streaming.metrics import file_stream, single_file_glob

SCRAPE_S = 60   # the service's 10 s give 1.3 million rows here, hardly any of them with a request

#: the log with the end of each request, and the scrapes that each handler has a value at
SCRAPE_CTES = f"""log AS (SELECT *, start_us + CAST(round(run_time_s * 1e6) AS BIGINT) AS end_us FROM ({LOG_SQL})),
t AS (SELECT *, (end_us + {SCRAPE_S * 1_000_000 - 1}) // {SCRAPE_S * 1_000_000} AS tick FROM log),
grid AS (SELECT handler, unnest(generate_series(min(tick), (SELECT max(tick) FROM t))) AS tick FROM t GROUP BY handler)"""


@register("metrics_scraped", f"""
WITH {SCRAPE_CTES},
seen AS (SELECT handler, end_us, arg_max(run_time_s, event_id) AS run_time_s, arg_max(memory_kib, event_id) AS memory_kib,
                arg_max(cpu_percent, event_id) AS cpu_percent FROM log GROUP BY handler, end_us),
scrape AS (SELECT handler, tick * {SCRAPE_S} AS scrape_s, tick * {SCRAPE_S * 1_000_000} AS at_us FROM grid)
SELECT scrape.scrape_s, scrape.handler, round(run_time_s, 6) AS run_time_s, round(memory_kib, 6) AS memory_kib,
       round(cpu_percent, 6) AS cpu_percent
FROM scrape ASOF JOIN seen ON scrape.handler = seen.handler AND scrape.at_us >= seen.end_us
""")
def q_metrics_scraped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every handler's gauges at every scrape, kept while no request sets them."""
    seen = scraped_gauges(_log(spark, sf_dir), SCRAPE_S)
    return seen.select("scrape_s", "handler", *[F.round(c, 6).alias(c) for c in ("run_time_s", "memory_kib", "cpu_percent")])


@register("counter_scraped", f"""
WITH {SCRAPE_CTES},
cell AS (SELECT handler, tick, count(*) AS n, sum(CAST(round(run_time_s * 1e6) AS BIGINT)) AS us,
                sum(CASE WHEN run_time_s <= 0.1 THEN 1 ELSE 0 END) AS a, sum(CASE WHEN run_time_s <= 0.5 THEN 1 ELSE 0 END) AS b,
                sum(CASE WHEN run_time_s <= 1.0 THEN 1 ELSE 0 END) AS c FROM t GROUP BY handler, tick)
SELECT tick * {SCRAPE_S} AS scrape_s, handler, CAST(sum(coalesce(n, 0)) OVER w AS BIGINT) AS requests_total,
       CAST(sum(coalesce(us, 0)) OVER w AS BIGINT) / 1e6 AS duration_sum_s, CAST(sum(coalesce(a, 0)) OVER w AS BIGINT) AS le_0_1,
       CAST(sum(coalesce(b, 0)) OVER w AS BIGINT) AS le_0_5, CAST(sum(coalesce(c, 0)) OVER w AS BIGINT) AS le_1,
       CAST(sum(coalesce(n, 0)) OVER w AS BIGINT) AS le_inf
FROM grid LEFT JOIN cell USING (handler, tick) WINDOW w AS (PARTITION BY handler ORDER BY tick)
""")
def q_counter_scraped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every handler's counters at every scrape, since the start of the log."""
    return scraped_counters(_log(spark, sf_dir), SCRAPE_S)


# --- R4 with resets --------------------------------------------------------------------
WRAP = {"net_bytes_sent": 4_000_000, "net_bytes_recv": 3_000_000}   # the counters start anew there, as after a restart
EXPIRE_US = 12 * 3_600_000_000


def _wrapped(log: DataFrame) -> DataFrame:
    return log.withColumns({c: F.col(c) % F.lit(n) for c, n in WRAP.items()})


def _grown(c: str) -> str:
    return (f"CASE WHEN start_us - lag(start_us) OVER w <= {EXPIRE_US} THEN "
            f"CASE WHEN {c} < lag({c}) OVER w THEN {c} ELSE {c} - lag({c}) OVER w END END AS {c}_delta")


RESETS_SQL = f"""
SELECT instance, start_us, event_id, {_grown("net_bytes_sent")}, {_grown("net_bytes_recv")}
FROM (SELECT instance, start_us, event_id, {", ".join(f"{c} % {n} AS {c}" for c, n in WRAP.items())} FROM ({LOG_SQL}))
WINDOW w AS (PARTITION BY instance ORDER BY start_us, event_id)
"""


@register("counter_deltas_resets", RESETS_SQL)
def q_counter_deltas_resets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 for counters that fall back to zero and instances that are silent for long."""
    return counter_deltas(_wrapped(_log(spark, sf_dir)), expire_us=EXPIRE_US)


def _finish(q: StreamingQuery) -> None:
    try:
        q.processAllAvailable()
    finally:
        q.stop()


@register("counter_deltas_stream", f"""
SELECT * FROM ({RESETS_SQL}) WHERE start_us < ((SELECT max(epoch_us(ts)) FROM events) // 1000 - 600000) * 1000
""")
def q_counter_deltas_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 R7 as a stream: every call that the watermark (10 minutes) has passed."""
    source = file_stream(spark, single_file_glob(posixpath.join(sf_dir, "events.parquet")), table(spark, sf_dir, "events").schema)
    q, out = start_counter_stream(spark, _wrapped(request_log(source)), watermark="10 minutes", expire_us=EXPIRE_US)
    _finish(q)
    return spark.read.parquet(out)


# --- R7 with repeated and late deliveries --------------------------------------------------
PERIOD_US = 5 * 86_400_000_000       # a delivery holds the events of five days,
DELAY_US = 2 * PERIOD_US             # those of the five days before once more, and some that are too late


def _deliveries(spark: SparkSession, sf_dir: str) -> str:
    """Files in order: a period's events twice, the period before again, and the period three before."""
    events = table(spark, sf_dir, "events")
    at = epoch_micros("ts")
    first, last = events.agg(F.min(at), F.max(at)).first()
    period = F.floor((at - F.lit(first)) / F.lit(PERIOD_US))
    source = shared_dir(spark, "deliveries", uuid.uuid4().hex)
    for i in range((last - first) // PERIOD_US + 1):
        again = events.where(period.isin(i, i - 1, i - 3)).unionAll(events.where(period == i))
        again.coalesce(1).write.parquet(posixpath.join(source, f"delivery={i:05d}"))
    return source


def _admitted(spark: SparkSession, sf_dir: str) -> str:
    schema = table(spark, sf_dir, "events").schema
    arriving = file_stream(spark, posixpath.join(_deliveries(spark, sf_dir), "*", "*.parquet"), schema, max_files_per_trigger=1)
    q, root = start_admission(spark, arriving, DELAY_US)
    _finish(q)
    return root


@register("requests_late", f"""
WITH e AS (SELECT event_id, epoch_us(ts) AS us FROM events),
p AS (SELECT *, (us - (SELECT min(us) FROM e)) // {PERIOD_US} AS period FROM e),
m AS (SELECT period, max(max(us)) OVER (ORDER BY period) - {DELAY_US} AS watermark_us FROM p GROUP BY period)
SELECT event_id, CAST(p.period + 3 AS BIGINT) AS delivery, watermark_us FROM p JOIN m ON m.period = p.period + 2
WHERE us < watermark_us AND p.period + 3 <= (SELECT max(period) FROM p)
""")
def q_requests_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that came behind the watermark, with the delivery they came in and the watermark they missed."""
    late = late_rows(spark, _admitted(spark, sf_dir))
    return late.select("event_id", F.col("batch").cast("long").alias("delivery"), "watermark_us")


@register("metrics_stream_distinct", f"""
SELECT * FROM ({RESAMPLED_SQL})
WHERE (window_start_s + 3600) * 1000000 <= ((SELECT max(epoch_us(ts)) FROM events) // 1000) * 1000 - {DELAY_US}
""")
def q_metrics_stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 R7 where every event is delivered two to four times: the closed windows of the distinct events."""
    root = _admitted(spark, sf_dir)
    q, out = start_distinct_metrics(spark, admitted_stream(spark, root, table(spark, sf_dir, "events").schema),
                                    interval="1 hour", delay="10 days")
    _finish(q)
    return _round_gauges(spark.read.parquet(out).select(*WINDOW_COLUMNS))


# --- A9 by method and status, with quantiles ---------------------------------------------------
BOUNDS = (1.0, 2.5, 5.0, 10.0, 25.0, 50.0)
QUANTILES = (0.5, 0.9, 0.99)
HTTP_SQL = f"""SELECT *, CASE WHEN handler IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
  CASE WHEN handler <> 'error' THEN 200 WHEN event_id % 3 = 0 THEN 404 ELSE 500 END AS status FROM ({LOG_SQL})"""


def _http(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with a method and a status, which the events' type and id stand for."""
    status = F.when(F.col("handler") != "error", 200).when(F.col("event_id") % 3 == 0, 404).otherwise(500)
    method = F.when(F.col("handler").isin("purchase", "signup"), "POST").otherwise("GET")
    return _log(spark, sf_dir).withColumns({"method": method, "status": status})


def _bucket_sql(q: float) -> str:
    cases, low, below = [], 0.0, "0"
    for b, c in zip(BOUNDS, bucket_columns(BOUNDS), strict=True):
        share = f"CASE WHEN {c} > {below} THEN ({q} * le_inf - {below}) / ({c} - {below}) ELSE 1.0 END"
        cases.append(f"WHEN {c} >= {q} * le_inf THEN {low} + {b - low} * {share}")
        low, below = b, c
    return f"round(CASE {' '.join(cases)} ELSE {BOUNDS[-1]} END, 6) AS p{q * 100:g}"


_LE = ", ".join(f"CAST(sum(CASE WHEN run_time_s <= {b} THEN 1 ELSE 0 END) AS BIGINT) AS {c}"
                for b, c in zip(BOUNDS, bucket_columns(BOUNDS), strict=True))


@register("http_metrics", f"""
WITH t AS (SELECT handler, method, status, count(*) AS requests_total, round(sum(run_time_s), 6) AS duration_sum_s, {_LE},
                  count(*) AS le_inf FROM ({HTTP_SQL}) GROUP BY handler, method, status)
SELECT *, {", ".join(_bucket_sql(q) for q in QUANTILES)} FROM t
""")
def q_http_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests, seconds, latency buckets and their quantiles by handler, method and status."""
    t = request_totals(_http(spark, sf_dir), by=("handler", "method", "status"), buckets=BOUNDS)
    t = bucket_quantiles(t, QUANTILES, BOUNDS)
    return t.withColumns({c: F.round(c, 6) for c in ("duration_sum_s", *[f"p{q * 100:g}" for q in QUANTILES])})


@register("latency_sketches", f"""
WITH t AS (SELECT (start_us // 86400000000) * 86400 AS window_start_s, method, run_time_s FROM ({HTTP_SQL}))
SELECT window_start_s, method, count(*) AS n, round(min(run_time_s), 6) AS p0, round(max(run_time_s), 6) AS p100,
       true AS p50_in_rank, true AS p99_in_rank
FROM t GROUP BY window_start_s, method
""")
def q_latency_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly sketches by handler and method, stored, then merged to days by method; the rank of each answer is
    counted among the requests themselves."""
    log = _http(spark, sf_dir)
    path = write_stage(latency_sketches(log, "1 hour", by=("handler", "method")), shared_dir(spark, "sketches", uuid.uuid4().hex))
    days = sketch_quantiles(merge_sketches(read_stage(spark, path), 86_400, by=("method",)), (0, 0.5, 0.99, 1))
    day = (F.floor(F.col("start_us") / 86_400_000_000) * 86_400).cast("bigint").alias("window_start_s")
    at = days.select("window_start_s", "method", "p50", "p99")
    ranks = log.select(day, "method", "run_time_s").join(at, ["window_start_s", "method"]).groupBy("window_start_s", "method").agg(
        *[F.avg(F.when(F.col("run_time_s") < F.col(c), 1.0).otherwise(0.0)).alias(f"{c}_below") for c in ("p50", "p99")],
        *[F.avg(F.when(F.col("run_time_s") <= F.col(c), 1.0).otherwise(0.0)).alias(f"{c}_upto") for c in ("p50", "p99")])

    def in_rank(c: str, q: float) -> Column:
        return ((F.col(f"{c}_below") <= q + RANK_ERROR) & (F.col(f"{c}_upto") >= q - RANK_ERROR)).alias(f"{c}_in_rank")

    return days.join(ranks, ["window_start_s", "method"]).select(
        "window_start_s", "method", "n", F.round("p0", 6).alias("p0"), F.round("p100", 6).alias("p100"),
        in_rank("p50", 0.5), in_rank("p99", 0.99))

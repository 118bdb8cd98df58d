"""Fixture 9 and the skew-safe lag."""

import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from tonality.operators.metrics import counter_deltas, gauges, metrics_long, request_totals, resample, with_derived


def _log(spark, rows):
    df = spark.createDataFrame(rows, "event_id long, instance long, handler string, start_us long, end_us long, "
                                     "mem_before_bytes double, mem_after_bytes double, cpu_percent double, "
                                     "net_bytes_sent long, net_bytes_recv long")
    return with_derived(df)


def test_fixture9_counter_and_gauges(spark):
    t0 = 1_700_000_000_000_000
    log = _log(spark, [(1, 1, "/predict", t0, t0 + 1_500_000, 0.0, 2048 * 1024.0, 10.0, 100, 50),
                       (2, 1, "/predict", t0 + 3_000_000, t0 + 5_000_000, 0.0, 1024 * 1024.0, 20.0, 300, 80)])
    g = gauges(log).first()
    assert g.requests == 2 and g.run_time_s == 2.0 and g.memory_kib == 1024.0 and g.cpu_percent == 20.0
    t = request_totals(log).first()
    assert (t.requests_total, t.duration_sum_s, t.le_0_1, t.le_1, t.le_inf) == (2, 3.5, 0, 0, 2)
    w = resample(log, "10 seconds").first()
    assert w.requests == 2 and w.run_time_s == 2.0
    long = {r.metric: r.value for r in metrics_long(resample(log, "10 seconds"), ["window_start_s", "handler"],
                                                    ["requests", "run_time_s"]).collect()}
    assert long == {"requests": 2.0, "run_time_s": 2.0}


def test_counter_deltas_equal_plain_lag_across_buckets(spark):
    rows = []
    for i in range(300):
        inst = 7 if i % 3 else i % 5        # instance 7 holds two thirds of the calls
        rows.append((i, inst, "h", i * 3_600_000_000 // 7, 0, 0.0, 0.0, 0.0, i * 11 + inst, i * 5))
    log = _log(spark, rows)
    got = {(r.instance, r.event_id): (r.net_bytes_sent_delta, r.net_bytes_recv_delta)
           for r in counter_deltas(log, bucket_us=3_600_000_000).collect()}
    w = Window.partitionBy("instance").orderBy("start_us", "event_id")
    ref = log.select("instance", "event_id", (F.col("net_bytes_sent") - F.lag("net_bytes_sent").over(w)).alias("a"),
                     (F.col("net_bytes_recv") - F.lag("net_bytes_recv").over(w)).alias("b"))
    assert got == {(r.instance, r.event_id): (r.a, r.b) for r in ref.collect()}


def test_request_metrics_long_form(spark):
    import tonality
    t0 = 1_700_000_000_000_000
    log = _log(spark, [(1, 1, "/predict", t0, t0 + 1_000_000, 0.0, 0.0, 5.0, 0, 0)])
    rows = {r.metric: r.value for r in tonality.request_metrics(log, "10 seconds").collect()}
    assert rows == {"requests": 1.0, "run_time_s": 1.0, "cpu_percent": 5.0, "memory_kib": 0.0}

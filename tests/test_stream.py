"""R5, R7 (fixture 10) and R1."""

import posixpath

from tests.conftest import SF_MID
from tonality.operators.metrics import request_log, resample
from tonality.sources.tables import table
from tonality.streaming.metrics import latest_windows, single_file_glob, start_metrics_stream


def _run(spark, mode):
    q, out = start_metrics_stream(spark, single_file_glob(posixpath.join(SF_MID, "events.parquet")),
                                  interval="1 hour", watermark="10 minutes", mode=mode,
                                  schema=table(spark, SF_MID, "events").schema)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return latest_windows(spark, out) if mode == "update" else spark.read.parquet(out)


def test_fixture10_append_withholds_open_windows(spark):
    out = _run(spark, "append")
    assert out.count() == 3380
    assert out.agg({"requests": "sum"}).first()[0] == 9986


def test_fixture10_update_equals_batch(spark):
    out = _run(spark, "update")
    batch = resample(request_log(table(spark, SF_MID, "events")), "1 hour")
    cols = ["window_start_s", "handler", "requests", "run_time_s", "cpu_percent", "memory_kib"]
    assert out.count() == 3385
    assert out.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    assert batch.select(*cols).exceptAll(out.select(*cols)).count() == 0


def test_late_rows_are_dropped_in_append_mode(spark):
    """Three micro-batches: the late 09:30 row arrives after the watermark has
    passed 10:00 (Spark drops rows older than the previous batch's watermark)."""
    import tempfile
    from tonality.session import shared_dir
    from tonality.streaming.metrics import file_stream, metrics_stream
    src = tempfile.mkdtemp(prefix="tonality-late-")
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"

    def rows(spec):
        import datetime
        return [(i, datetime.datetime(2024, 1, 1, h, m), 1, "view", 1.0, '{"k": 5}') for i, h, m in spec]

    for name, spec in (("f1", [(1, 9, 5), (2, 11, 0)]), ("f2", [(3, 12, 30)]), ("f3", [(4, 9, 30)])):
        spark.createDataFrame(rows(spec), schema).coalesce(1).write.parquet(f"{src}/{name}")
    events = file_stream(spark, src + "/f*/*.parquet", schema, max_files_per_trigger=1)
    out = shared_dir(spark, "late-test")
    q = (metrics_stream(events, "1 hour", "10 minutes").writeStream.outputMode("append").format("parquet")
         .option("path", out + "/o").option("checkpointLocation", out + "/c").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted((r.window_start_s, r.requests) for r in spark.read.parquet(out + "/o").collect())
    # 09:00 keeps one call (the late one is dropped), 11:00 closed, 12:00 still open
    assert got == [(int(datetime_utc(9)), 1), (int(datetime_utc(11)), 1)]


def datetime_utc(hour):
    import datetime
    return datetime.datetime(2024, 1, 1, hour, tzinfo=datetime.timezone.utc).timestamp()

"""R4, R1/M6 and R7 as streams with state: counters with resets, verdicts kept up to date, repeated and late requests."""

import datetime

import pytest
from pyspark.sql import functions as F

from tonality.operators.metrics import counter_deltas, request_log, resample
from tonality.operators.score import linear_scores
from tonality.plans.serving import score_titles
from tonality.streaming.admission import admitted_stream, late_rows, start_admission, start_distinct_metrics
from tonality.streaming.counters import growth, start_counter_stream
from tonality.streaming.metrics import file_stream
from tonality.streaming.verdicts import read_totals, start_review_totals, start_verdict_stream, verdicts

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
MINUTE = 60_000_000


def finish(q):
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return q


def test_growth():
    assert [growth(5, 3), growth(3, 5), growth(5, None), growth(None, 1), growth(0, 0)] == [2, 3, None, None, 0]


def calls(spark, root, files):
    """Files of ``(event_id, minute, user, sent)``; the counter sits in ``value``."""
    for i, rows in enumerate(files):
        full = [(e, datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=m), u, "view", float(sent), '{"k": 1}') for e, m, u, sent in rows]
        spark.createDataFrame(full, EVENTS).coalesce(1).write.parquet(f"{root}/f{i}")
    return f"{root}/f*/*.parquet"


FILES = [[(1, 0, 1, 100), (2, 5, 1, 150), (3, 3, 2, 10), (4, 4, 1, 130)],           # 4 comes out of order; instance 1 fell at 4 -> reset
         [(5, 30, 1, 20), (6, 9, 2, 30), (7, 31, 3, 7)],                              # a reset across micro-batches
         [(8, 60, 1, 25), (9, 2, 2, 999)],                                            # 9 is late (before 21)
         [(10, 400, 2, 50), (11, 401, 1, 26), (12, 402, 3, 9)],                       # long after: expired
         [(13, 500, 4, 1)]]


def test_counter_stream_is_the_batch(spark, tmp_path):
    glob = calls(spark, str(tmp_path / "in"), FILES)
    log = request_log(file_stream(spark, glob, EVENTS, max_files_per_trigger=1)).withColumn("sent", F.col("mem_after_bytes") / (1 << 20))
    expire = 120 * MINUTE
    q, out = start_counter_stream(spark, log, str(tmp_path / "s"), values=("sent",), expire_us=expire)
    finish(q)
    got = {r.event_id: (r.instance, r.sent_delta) for r in spark.read.parquet(out).collect()}
    batch = request_log(spark.read.parquet(f"{tmp_path}/in/f*")).where("event_id not in (9, 13)")     # late; still waiting
    batch = batch.withColumn("sent", (F.col("mem_after_bytes") / (1 << 20)).cast("long"))
    want = {r.event_id: (r.instance, r.sent_delta) for r in counter_deltas(batch, ("sent",), expire_us=expire).collect()}
    assert got == want
    assert want[2] == (1, 20) and want[4] == (1, 30) and want[5] == (1, 20) and want[6] == (2, 20) and want[10] == (2, None)
    state = [p.stateOperators[0] for p in q.recentProgress if p.stateOperators]
    assert state[-1].numRowsTotal < max(s.numRowsTotal for s in state) + 1


def test_state_of_silent_instances_goes(spark, tmp_path):
    rows = [[(i, i % 7, i, i) for i in range(20)], [(100, 300, 99, 5)], [(101, 600, 99, 9)]]
    glob = calls(spark, str(tmp_path / "in"), rows)
    log = request_log(file_stream(spark, glob, EVENTS, max_files_per_trigger=1)).withColumn("sent", F.col("event_id"))
    q, out = start_counter_stream(spark, log, str(tmp_path / "s"), values=("sent",), expire_us=30 * MINUTE)
    finish(q)
    held = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    assert max(held) >= 20 and held[-1] <= 8           # of instance 99 only: its waiting call, last call and timers
    assert spark.read.parquet(out).count() == 21


def test_batch_counts_a_reset_from_zero_across_buckets(spark):
    rows = [(1, 0, 1, 10), (2, 30, 1, 50), (3, 90, 1, 5), (4, 200, 1, 9), (5, 210, 2, 4)]
    full = [(e, datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=m), u, "view", float(v), '{"k": 1}') for e, m, u, v in rows]
    log = request_log(spark.createDataFrame(full, EVENTS)).withColumn("sent", (F.col("mem_after_bytes") / (1 << 20)).cast("long"))
    delta = lambda **o: {r.event_id: r.sent_delta for r in counter_deltas(log, ("sent",), **o).collect()}
    assert delta() == {1: None, 2: 40, 3: 5, 4: 4, 5: None}
    assert delta(expire_us=100 * MINUTE) == {1: None, 2: 40, 3: 5, 4: None, 5: None}


# --- verdicts ---------------------------------------------------------------------------------
REVIEWS = "title string, doc_id long, review string"


def scorer(feats):
    return linear_scores(feats, [0.5, -0.25, 1.0], -0.6)


def arrivals(spark, root, first, n):
    rows = [(f"t{(first + i) % 5}" if (first + i) % 3 else "hot", first + i, ["good film", "bad", "", "good good bad", None][(first + i) % 5])
            for i in range(n)]
    spark.createDataFrame(rows, REVIEWS).coalesce(1).write.parquet(f"{root}/f{first:04d}")


@pytest.mark.parametrize("average", ["vote", "mean_prob"])
def test_only_new_reviews_are_scored_and_verdicts_equal_the_batch(spark, tmp_path, average):
    src, root = str(tmp_path / "in"), str(tmp_path / "totals")
    vocab = spark.createDataFrame([("good", 9, 1), ("bad", 5, 2)], "word string, n long, id int")
    catalogue = spark.createDataFrame([(t,) for t in ("hot", "t0", "t1", "t2", "t3", "t4", "quiet")], "title string")
    requests = spark.createDataFrame([("HOT",), ("t1",), ("t2!",), ("quiet",), ("none",)], "request string")

    def run():
        stream = file_stream(spark, src + "/f*/*.parquet", REVIEWS, max_files_per_trigger=1)
        q, _ = start_review_totals(spark, stream, vocab, scorer, root, max_words=10, max_len=3, compact_every=2)
        return finish(q)

    def batch():
        everything = spark.read.schema(REVIEWS).parquet(src + "/f*")
        return score_titles(requests, catalogue, everything, scorer, vocab=vocab, max_words=10, max_len=3, average=average)

    rounded = lambda df: sorted(map(str, df.withColumn("score", F.round("score", 9)).collect()))
    for first in (0, 40, 70):
        arrivals(spark, src, first, 30)
    progress = [p for p in run().recentProgress if p.numInputRows]
    assert [p.numInputRows for p in progress] == [30, 30, 30]         # each review is read, and scored, once
    scored = spark.read.schema("n_reviews long, version long").parquet(f"{root}/batch").groupBy("version").sum("n_reviews")
    assert dict(map(tuple, scored.where("version >= 0").collect())) == {0: 30, 1: 30, 2: 30}
    assert rounded(verdicts(requests, catalogue, root, average)) == rounded(batch())

    arrivals(spark, src, 100, 25)                                     # a restart takes up where it was
    progress = [p for p in run().recentProgress if p.numInputRows]
    assert [p.numInputRows for p in progress] == [25]
    assert rounded(verdicts(requests, catalogue, root, average)) == rounded(batch())
    assert read_totals(spark, root).agg(F.sum("n_reviews")).first()[0] == 115

    asked = str(tmp_path / "asked")
    requests.coalesce(1).write.parquet(asked)
    q, out = start_verdict_stream(spark, file_stream(spark, asked, "request string"), catalogue, root, average=average)
    progress = finish(q).recentProgress
    assert sum(p.numInputRows for p in progress) == 5
    assert rounded(spark.read.parquet(out).drop("batch")) == rounded(batch())


def test_a_batch_that_is_not_whole_is_not_read(spark, tmp_path):
    root = str(tmp_path / "totals")
    src = str(tmp_path / "in")
    arrivals(spark, src, 0, 10)
    vocab = spark.createDataFrame([("good", 9, 1)], "word string, n long, id int")
    q, _ = start_review_totals(spark, file_stream(spark, src + "/f*/*.parquet", REVIEWS), vocab, scorer, root, max_words=10, max_len=3)
    finish(q)
    spark.createDataFrame([("hot", 1000, 1.0, 1.0)], "title string, n_reviews long, votes double, probabilities double") \
        .write.parquet(f"{root}/batch/version=7")
    assert read_totals(spark, root).agg(F.sum("n_reviews")).first()[0] == 10


# --- repeated and late requests -----------------------------------------------------------------
def test_repeated_requests_count_once_and_late_ones_are_kept_aside(spark, tmp_path):
    rows = {i: (i, i * 7, i % 3, 1.0) for i in range(60)}              # seven minutes apart
    files = [[rows[i] for i in range(20)], [rows[i] for i in range(12, 40)] + [rows[i] for i in range(30, 40)],
             [rows[i] for i in range(40, 60)] + [rows[0], rows[35]], [rows[59], rows[58]]]
    glob = calls(spark, str(tmp_path / "in"), files)
    delay = 60 * MINUTE
    q, root = start_admission(spark, file_stream(spark, glob, EVENTS, max_files_per_trigger=1), delay, str(tmp_path / "a"))
    finish(q)
    late = {(r.batch, r.event_id, r.watermark_us) for r in late_rows(spark, root).collect()}
    t0 = 1_704_067_200_000_000
    seen, want = None, set()
    for b, f in enumerate(files):
        want |= {(b, e, seen - delay) for e, m, _, _ in f if seen is not None and t0 + m * MINUTE < seen - delay}
        seen = max([seen or 0, *[t0 + m * MINUTE for _, m, _, _ in f]])
    assert late == want and (2, 0, t0 + 39 * 7 * MINUTE - delay) in late
    q, out = start_distinct_metrics(spark, admitted_stream(spark, root, EVENTS), str(tmp_path / "d"), interval="1 hour", delay="60 minutes")
    finish(q)
    cols = ["window_start_s", "handler", "requests", "run_time_s"]
    batch = resample(request_log(spark.read.parquet(f"{tmp_path}/in/f*").distinct()), "1 hour").select(*cols)
    closed = batch.where((F.col("window_start_s") + 3600) * 1_000_000 <= t0 + 59 * 7 * MINUTE - delay)
    got = spark.read.parquet(out).select(*cols)
    assert sorted(map(str, got.collect())) == sorted(map(str, closed.collect())) and got.count() > 3


def test_calls_of_a_batch_are_one_entry_of_state(spark, tmp_path):
    """Without a time they go, without an id they come last, and what waits is kept by the batch."""
    rows = [(i if i % 10 else None, m, 1, 10 * i) for i, m in enumerate([*range(30), 29])]
    glob = calls(spark, str(tmp_path / "in"), [rows])
    none = [(99, None, 1, "view", 1.0, '{"k": 1}')]
    spark.createDataFrame(none, EVENTS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/f0")
    log = request_log(file_stream(spark, glob, EVENTS)).withColumn("sent", F.col("mem_after_bytes") / (1 << 20))
    q, out = start_counter_stream(spark, log, str(tmp_path / "s"), values=("sent",), watermark="10 minutes")
    finish(q)
    got = sorted((r.start_us, r.sent_delta) for r in spark.read.parquet(out).collect())
    assert len(got) == 19 and got[0][1] is None and {d for _, d in got[1:]} == {10}
    state = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    assert max(state) < 15


def test_reviews_are_dealt_to_four_folders_of_several_files(spark):
    from tonality.plans.title_queries import _quarters
    reviews = spark.createDataFrame([("t", i // 2, "good") for i in range(400)], REVIEWS)
    _, folders = _quarters(spark, reviews)
    parts = [spark.read.schema(REVIEWS).parquet(f) for f in folders]
    assert all(len(p.inputFiles()) > 1 and 80 < p.count() < 120 for p in parts)
    assert sorted(r.doc_id for p in parts for r in p.collect()) == sorted(i // 2 for i in range(400))

"""M7 by threshold, M1 with an exact share, A9 quantiles, S1 over blocks."""

import math
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tonality.operators.latency import (RANK_ERROR, bucket_quantiles, latency_sketches, merge_sketches, sketch_quantiles)
from tonality.operators.split import exact_cut, holdout_split_exact
from tonality.operators.vocab import fit_vocabulary_by, kth_counts, top_candidates, word_counts
from tonality.plans.features import tokenize
from tonality.sources.tables import title_reviews
from tonality.sources.text_files import load_labelled_dirs, load_reviews


# --- M7 ------------------------------------------------------------------------------------------
def by_hand(docs, k):
    """docs: (doc_id, title, words)"""
    n, first = Counter(), {}
    for d, t, words in docs:
        for i, w in enumerate(words):
            n[t, w] += 1
            first[t, w] = min(first.get((t, w), (d, i)), (d, i))
    out = {}
    for t in {t for _, t, _ in docs}:
        ranked = sorted((w for t2, w in n if t2 == t), key=lambda w: (-n[t, w], first[t, w]))
        out |= {(t, w): (n[t, w], i + 1) for i, w in enumerate(ranked[:k])}
    return out


@pytest.mark.parametrize("k", [1, 3, 20, 1000])
def test_threshold_top_words(spark, k):
    rng = random.Random(k)
    docs = [(i, rng.choice(["hot", "hot", "a", None, "one"]), [f"w{min(rng.randrange(60), rng.randrange(60))}" for _ in range(rng.randrange(9))])
            for i in range(200)]
    docs += [(900, "ties", [f"x{i}" for i in range(50)]), (901, "empty", [])]
    df = spark.createDataFrame(docs, "doc_id long, title string, words array<string>")
    got = {(r.title, r.word): (r.n, r.id) for r in fit_vocabulary_by(df, "title", k + 1, salt_buckets=4).collect()}
    assert got == by_hand(docs, k)


def test_fewer_rows_reach_the_last_window(spark):
    words = tokenize(title_reviews(spark, SF_SMALL), text_col="review", keep=["doc_id", "title"])
    counts = word_counts(words, by=["title"]).cache()
    k, salts = 50, 8
    titles = counts.select("title").distinct().count()
    new = top_candidates(counts, "title", k, salts).count()
    salted = counts.groupBy("title", F.pmod(F.xxhash64("word"), F.lit(salts)).alias("s")).count()
    before = salted.select(F.least("count", F.lit(k)).alias("n")).agg(F.sum("n")).first()[0]    # the top k of each salt
    ties = counts.join(kth_counts(counts, "title", k), "title").where("n = cut").count()
    assert new <= titles * k + min(ties, titles * salts * k) and new < 0.5 * before
    counts.unpersist()


# --- M1 ------------------------------------------------------------------------------------------
@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 1001])
@pytest.mark.parametrize("share", [0.0, 0.2, 1 / 3, 1.0])
def test_exact_share(spark, n, share):
    import hashlib
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("x").alias("h"))
    rows = {r.doc_id: r.split for r in holdout_split_exact(df, "doc_id", share, 7).collect()}
    test = {k for k, v in rows.items() if v == "test"}
    from fractions import Fraction
    assert len(rows) == n and len(test) == math.ceil(Fraction(str(share)) * n)
    ranked = sorted(range(n), key=lambda i: hashlib.md5(f"{i}:7".encode()).hexdigest(), reverse=True)
    assert test == set(ranked[:len(test)])


def test_exact_share_with_equal_and_null_keys(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 5 + [(None,)] * 2 + [(f"k{i}",) for i in range(8)], "doc_id string")
    got = holdout_split_exact(df, "doc_id", 0.5, 1).collect()
    sides = {}
    for r in got:
        sides.setdefault(r.doc_id, set()).add(r.split)
    assert all(len(s) == 1 for s in sides.values())
    assert 10 <= sum(r.split == "test" for r in got) <= 14
    with pytest.raises(ValueError):
        exact_cut(df, "doc_id", 1.5)


def test_exact_share_sorts_nothing(spark):
    df = spark.range(1000).withColumnRenamed("id", "doc_id")
    plan = holdout_split_exact(df)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan


# --- A9 ------------------------------------------------------------------------------------------
def interpolated(values, q, bounds):
    n = len(values)
    if not n:
        return None
    rank, low, below = q * n, 0.0, 0
    for b in bounds:
        upto = sum(v <= b for v in values)
        if upto >= rank:
            return low + (b - low) * ((rank - below) / (upto - below) if upto > below else 1.0)
        low, below = b, upto
    return bounds[-1]


def test_bucket_quantiles(spark):
    rng = random.Random(1)
    bounds = (0.5, 1.0, 4.0)
    samples = [[], [0.2], [9.0] * 3, [0.1, 0.6, 0.9, 3.0], [rng.random() * 5 for _ in range(50)], [0.5, 1.0, 4.0]]
    rows = [(i, *[sum(v <= b for v in s) for b in bounds], len(s)) for i, s in enumerate(samples)]
    df = spark.createDataFrame(rows, "i int, le_0_5 long, le_1 long, le_4 long, le_inf long")
    qs = (0.0, 0.25, 0.5, 0.95, 1.0)
    for r in bucket_quantiles(df, qs, bounds).collect():
        for q in qs:
            want = interpolated(samples[r.i], q, bounds)
            assert r[f"p{q * 100:g}"] == (None if want is None else pytest.approx(want)), (r.i, q)
    with pytest.raises(ValueError):
        bucket_quantiles(df, (0.5,), (1.0, 0.5))


def test_sketches_merge_to_any_interval_within_their_rank_error(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(40) * 900, rng.choice(["hot", "hot", "hot", "b", None]), None if i % 50 == 0 else rng.expovariate(1))
            for i in range(30_000)]
    log = spark.createDataFrame(rows, "s long, handler string, run_time_s double").select(
        "*", F.timestamp_seconds("s").alias("event_time"))
    qs = (0.0, 0.1, 0.5, 0.9, 0.99, 1.0)
    small = latency_sketches(log, "15 minutes")
    for seconds, by in ((3600, ("handler",)), (None, ("handler",)), (None, ())):
        for r in sketch_quantiles(merge_sketches(small, seconds, by), qs).collect():
            mine = sorted(v for s, h, v in rows if v is not None and (not by or h == r.handler)
                          and (seconds is None or s // seconds * seconds == r.window_start_s))
            assert r.n == len(mine) and (r.p0, r.p100) == (mine[0], mine[-1])
            for q in qs[1:-1]:
                got = r[f"p{q * 100:g}"]
                below, upto = sum(v < got for v in mine) / len(mine), sum(v <= got for v in mine) / len(mine)
                assert below - 2 * RANK_ERROR <= q <= upto + 2 * RANK_ERROR


# --- S1 ------------------------------------------------------------------------------------------
BODIES = {"a.txt": "l1\nl2\n", "b.txt": "x", "e.txt": "", "crlf.txt": "one\r\ntwo\r\n\r\nfour", "cr.txt": "a\rb\rc",
          "blank.txt": "\n\n\nend\n", "big.txt": "".join(f"line {i} " + "é" * (i % 37) + "\n" for i in range(2000)), "ünï+code.txt": "q\nr"}


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700b", "spark.sql.files.openCostInBytes": "10b"}
    was = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


def lines_of(body):
    body = body.replace("\r\n", "\n").replace("\r", "\n")
    return (body[:-1] if body.endswith("\n") else body).split("\n") if body else []


def test_a_large_file_is_read_by_many_tasks_with_the_same_keys(spark, tmp_path, small_blocks):
    folder = tmp_path / "pos"
    os.makedirs(folder)
    for name, body in BODIES.items():
        (folder / name).write_text(body, newline="")
    df = load_reviews(spark, str(folder), 1)
    got = sorted((r.doc_id, r.value) for r in df.collect())
    whole = [(f"file:{folder}/{name}", i, v) for name, body in BODIES.items() for i, v in enumerate(lines_of(body))]
    want = spark.createDataFrame(whole, "file string, line int, value string").select(F.xxhash64("file", "line").alias("k"), "value")
    files = {r.file for r in load_labelled_dirs(spark, str(tmp_path), {"pos": 1}).select("file").distinct().collect()}
    if files and not next(iter(files)).startswith(f"file:{folder}"):          # file:/// and file:/ name the same file
        head = next(iter(files)).split(str(folder))[0]
        want = spark.createDataFrame([(f"{head}{f.removeprefix('file:')}", i, v) for f, i, v in whole], "file string, line int, value string") \
            .select(F.xxhash64("file", "line").alias("k"), "value")
    assert got == sorted((r.k, r.value) for r in want.collect())
    tasks = spark.read.text(str(folder / "big.txt")).rdd.getNumPartitions()
    assert tasks > 20

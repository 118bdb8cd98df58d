"""S1-S10 round trips: text files (fixture 1), records, stages, run log."""

import os
import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tonality.sources.runs import log_runs, search_experiments, search_runs
from tonality.sources.stages import (FEATURE_SCHEMA, new_stage_root, read_features, read_raw, write_features,
                                     write_raw)
from tonality.sources.tables import labelled_reviews
from tonality.sources.text_files import load_labelled_dirs, load_reviews
from tonality.plans.features import preprocess
from tonality.session import shared_dir


def _text_dirs():
    root = tempfile.mkdtemp(prefix="tonality-text-")
    for cls, files in {"pos": {"a.txt": "l1\nl2\n", "b.txt": "x", "e.txt": ""}, "neg": {"c.txt": "bad\n"}}.items():
        os.makedirs(os.path.join(root, cls))
        for name, body in files.items():
            with open(os.path.join(root, cls, name), "w") as f:
                f.write(body)
    return root


def test_fixture1_text_source(spark):
    root = _text_dirs()
    lines = load_reviews(spark, os.path.join(root, "pos"), 1)
    assert lines.count() == 3 and {r.label for r in lines.collect()} == {1}
    assert lines.select("doc_id").distinct().count() == 3
    assert load_reviews(spark, os.path.join(root, "pos"), 1, wholetext=True).count() == 2
    both = load_labelled_dirs(spark, root)
    assert sorted((r.value, r.label) for r in both.collect()) == [("bad", 0), ("l1", 1), ("l2", 1), ("x", 1)]


def test_stage_roundtrip_keeps_schema_and_rows(spark):
    root = new_stage_root(spark)
    reviews = labelled_reviews(spark, SF_SMALL)
    write_raw(reviews, root)
    assert read_raw(spark, root).count() == reviews.count()
    feats, _ = preprocess(read_raw(spark, root), max_words=100, max_len=5)
    write_features(feats, root)
    back = read_features(spark, root)
    assert back.schema.simpleString() == FEATURE_SCHEMA.simpleString()
    assert back.exceptAll(feats.select("doc_id", "label", "features")).count() == 0


def test_run_log_partition_pruning_and_experiments(spark):
    root = shared_dir(spark, "test-tracking")
    runs = spark.createDataFrame([("r1", 1.0, .5, "exp_a"), ("r2", 2.0, .7, "exp_b")],
                                 "run_id string, start_ts double, accuracy double, experiment string")
    log_runs(runs, root=root)
    log_runs(runs.where(F.col("experiment") == "exp_a").withColumn("run_id", F.lit("r3")), root=root)
    a = search_runs(spark, "exp_a", root)
    assert sorted(r.run_id for r in a.collect()) == ["r1", "r3"]
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "exp_a" in plan
    ids = {r.name: r.experiment_id for r in search_experiments(spark, root).collect()}
    by_id = search_runs(spark, root=root, experiment_id=ids["exp_b"])
    assert [r.run_id for r in by_id.collect()] == ["r2"]
    plan = by_id._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "exp_b" in plan
    assert search_runs(spark, "exp_a", root, ids["exp_b"]).count() == search_runs(spark, root=root, experiment_id="0").count() == 0
    exps = search_experiments(spark, root).collect()
    assert sorted(e.name for e in exps) == ["exp_a", "exp_b"]
    assert all(e.lifecycle_stage == "active" for e in exps)


def test_spread_is_the_callers_decision(spark):
    from tonality.sources.tables import SPREAD_SETTING, spread, text_table
    few = spark.range(0, 1000, numPartitions=1).withColumnRenamed("id", "doc_id")
    assert spread(few, "doc_id") is few
    assert spread(few, "doc_id", 5).rdd.getNumPartitions() == 5
    was = spark.conf.get(SPREAD_SETTING)
    try:
        spark.conf.unset(SPREAD_SETTING)
        assert "Exchange" not in text_table(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert text_table(spark, SF_SMALL, spread_to=3).rdd.getNumPartitions() == 3
    finally:
        spark.conf.set(SPREAD_SETTING, was)


def test_text_keys_are_unique_across_loads_and_stable(spark):
    root = _text_dirs()
    pos, neg = (load_reviews(spark, os.path.join(root, c), i) for c, i in (("pos", 1), ("neg", 0)))
    both = pos.unionByName(neg)
    keys = {r.value: r.doc_id for r in both.collect()}
    assert len(set(keys.values())) == both.count() == 4
    was = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1g")
        assert {r.value: r.doc_id for r in load_labelled_dirs(spark, root).collect()} == keys
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", was)


def test_odd_folder_names_and_line_ends(spark):
    root = tempfile.mkdtemp(prefix="tonality-text-")
    for name, body in (("very good", "a\r\nb\rc\n\nd"), ("100%+", "x\n")):
        os.makedirs(os.path.join(root, name))
        with open(os.path.join(root, name, "f 1.txt"), "w", newline="") as f:
            f.write(body)
    got = load_labelled_dirs(spark, root, {"very good": 1, "100%+": 0}).collect()
    assert sorted((r.value, r.label) for r in got) == [("", 1), ("a", 1), ("b", 1), ("c", 1), ("d", 1), ("x", 0)]


def test_a_repeated_log_call_adds_nothing_and_errors_are_raised(spark):
    import pytest

    root = shared_dir(spark, "test-repeat")
    runs = spark.createDataFrame([("r1", 1.0, .5), ("r2", 2.0, .7)], "run_id string, start_ts double, accuracy double")
    assert search_experiments(spark, root).count() == 0 and search_runs(spark, "e", root).count() == 0
    for _ in range(2):
        log_runs(runs, "e", root)
    assert search_runs(spark, "e", root).count() == 2 and search_experiments(spark, root).count() == 1
    own = search_experiments(spark, root).first().experiment_id
    assert search_runs(spark, root=root, experiment_id=own).count() == 2
    assert search_runs(spark, root=root, experiment_id="1").count() == 0
    with pytest.raises(Exception):
        search_experiments(spark, "nosuchscheme://x/y").count()

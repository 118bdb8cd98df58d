"""Fixture 6."""

from tonality.operators.select import best_run


def test_fixture6_best_run(spark):
    runs = spark.createDataFrame([("e", "r1", 1.0, .8), ("e", "r2", 2.0, float("nan")), ("e", "r3", 3.0, .8)],
                                 "experiment string, run_id string, start_ts double, accuracy double")
    r = best_run(runs).collect()
    assert [(x.run_id, x.accuracy) for x in r] == [("r3", 0.8)]


def test_no_valid_run_gives_no_row(spark):
    runs = spark.createDataFrame([("e", "r2", 2.0, float("nan")), ("e", "r4", 4.0, None)],
                                 "experiment string, run_id string, start_ts double, accuracy double")
    assert best_run(runs).count() == 0


def test_tie_on_time_goes_to_smallest_id(spark):
    runs = spark.createDataFrame([("e", "b", 1.0, .5), ("e", "a", 1.0, .5), ("f", "c", 0.0, .1)],
                                 "experiment string, run_id string, start_ts double, accuracy double")
    assert {r.experiment: r.run_id for r in best_run(runs).collect()} == {"e": "a", "f": "c"}

"""Gauges and counters at fixed times against a walk over the log."""

import random

import pytest

from tonality.operators.metrics import with_derived
from tonality.operators.scrape import scraped_counters, scraped_gauges

T0 = 1_700_000_000_000_000
S = 1_000_000
COLUMNS = ("event_id long, instance long, handler string, start_us long, end_us long, mem_before_bytes double, mem_after_bytes double, "
           "cpu_percent double, net_bytes_sent long, net_bytes_recv long")


def log(spark, rows):
    """``rows``: (event_id, handler, start, seconds, cpu)."""
    full = [(i, 1, h, T0 + int(at * S), T0 + int(at * S) + int(sec * S) if sec is not None else None, 0.0, 1024.0 * i, cpu, 0, 0)
            for i, h, at, sec, cpu in rows]
    return with_derived(spark.createDataFrame(full, COLUMNS))


def walk(rows, interval):
    done = sorted((T0 + int(at * S) + int(sec * S), i, h, cpu, int(sec * S)) for i, h, at, sec, cpu in rows if sec is not None)
    tick = lambda us: -(-us // (interval * S))
    gauges, counters = {}, {}
    end = max((tick(d[0]) for d in done), default=0)
    for h in {d[2] for d in done}:
        mine = [d for d in done if d[2] == h]
        for k in range(tick(mine[0][0]), end + 1):
            before = [d for d in mine if d[0] <= k * interval * S]
            cpu = [d[3] for d in before if d[3] is not None]
            gauges[k * interval, h] = (before[-1][4] / 1e6, cpu[-1] if cpu else None)
            counters[k * interval, h] = (len(before), sum(d[4] for d in before) / 1e6, sum(d[4] <= .5 * S for d in before), len(before))
    return gauges, counters


def some(seed, n, span):
    rng = random.Random(seed)
    return [(i, rng.choice(["hot", "hot", "hot", "b", None]), round(rng.random() * span, 3), rng.choice([0, .1, .5, 1.25, 40.0, None]),
             rng.choice([None, 1.0, float(i)])) for i in range(n)]


CASES = {"dense": some(1, 300, 100), "with long gaps": some(2, 25, 9000), "one request": [(1, "h", 0, .2, 5.0)],
         "ties at one end": [(i, "h", 3, .5, float(i)) for i in range(5)] + [(9, "h", 3.5, 0, 7.0)],
         "on a scrape": [(1, "h", 0, 10, 1.0), (2, "h", 20, 0, 2.0), (3, "g", 70, 0, 3.0)]}


@pytest.mark.parametrize("case", sorted(CASES))
@pytest.mark.parametrize("range_s", [20, 3600])
def test_as_a_walk_over_the_log(spark, case, range_s):
    rows = CASES[case]
    gauges, counters = walk(rows, 10)
    df = log(spark, rows)
    got = scraped_gauges(df, 10, values=("run_time_s", "cpu_percent"), range_us=range_s * S).collect()
    assert len(got) == len(gauges)
    assert {(r.scrape_s, r.handler): (r.run_time_s, r.cpu_percent) for r in got} == gauges
    got = scraped_counters(df, 10, range_us=range_s * S).collect()
    assert {(r.scrape_s, r.handler): (r.requests_total, r.duration_sum_s, r.le_0_5, r.le_inf) for r in got} == counters


def test_whole_service_and_empty_log(spark):
    rows = some(3, 60, 200)
    one = [(i, "all", at, sec, cpu) for i, _, at, sec, cpu in rows]
    got = scraped_gauges(log(spark, rows), 5, by=(), values=("cpu_percent",)).collect()
    assert {r.scrape_s: r.cpu_percent for r in got} == {k[0]: v[1] for k, v in walk(one, 5)[0].items()}
    assert scraped_gauges(log(spark, []), 10).collect() == [] and scraped_counters(log(spark, []), 10).collect() == []


def test_no_window_holds_a_whole_group(spark):
    for out in (scraped_gauges(log(spark, CASES["dense"]), 10), scraped_counters(log(spark, CASES["dense"]), 10)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if "windowspecdefinition" in line]
        assert windows and all("range#" in line for line in windows)
        assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()

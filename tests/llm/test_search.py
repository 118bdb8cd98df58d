import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from tonality.llm import adsampling as A  # noqa: E402


def table(spark, some):
    return spark.createDataFrame([(i, v, 1, 2, "q") for i, v in some],
                                 "vec_id long, embedding array<float>, c long, list int, q string")


def brute(some, is_query, k):
    good = [(i, np.array(v, np.float64)) for i, v in some
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 8]
    out = {}
    for qi, q in good:
        if is_query(qi):
            near = sorted({i: -float((np.float32(q).astype(float) * np.float32(x).astype(float)).sum()) for i, x in good if i != qi}.items(),
                          key=lambda t: (t[1], t[0]))
            out[qi] = [i for i, _ in near[:k]]
    return out


def vectors(n=400, seed=0):
    rng = np.random.default_rng(seed)
    some = [(i, [float(x) for x in rng.standard_normal(8)]) for i in range(n)]
    some += [(5000 + i, some[20][1]) for i in range(60)]                       # copies of a query's vector
    some += [(2000, None), (2001, []), (2002, [0.0] * 8), (2003, [1.0, None] + [0.0] * 6), (2004, [float("nan")] * 8),
             (2005, [float("inf")] + [0.0] * 7), (2006, [1.0]), (None, [1.0] * 8), (2020, [3.0] * 8)]
    return some


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append(r.vec_id)
        assert r.rank == len(out[r.query_id])
    return out


def test_all_lists_probed_is_exact(spark, monkeypatch):
    monkeypatch.setattr(A, "EPSILON", 1e9)
    monkeypatch.setattr(A, "PROBES", 1.0)
    monkeypatch.setattr(A, "BLOCK", 64)
    monkeypatch.setattr(A, "QUERY_PART", 5)
    got = found(A.search(table(spark, vectors()), F.col("vec_id") % 20 == 0, k=20))
    assert got == brute(vectors(), lambda i: i % 20 == 0, 20)


def test_recall_and_scores(spark):
    some = vectors(1500, 3)
    df = A.search(table(spark, some), F.col("vec_id") % 20 == 0, k=20)
    got, want = found(df), brute(some, lambda i: i % 20 == 0, 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) >= 0.9
    by = {i: np.array(v, np.float32).astype(float) for i, v in some if i is not None and v and len(v) == 8 and None not in v}
    for r in df.limit(200).collect():
        assert abs(r.score - float((by[r.query_id] * by[r.vec_id]).sum())) < 1e-12


def test_few_and_no_rows(spark):
    assert found(A.search(table(spark, [(0, [1.0, 2.0]), (3, [1.0, 0.5]), (5, [2.0, 2.0])]), F.col("vec_id") % 20 == 0)) == {0: [5, 3]}
    assert A.search(table(spark, [(0, [1.0, 2.0])]), F.col("vec_id") % 20 == 0).count() == 0
    assert A.search(table(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert A.search(table(spark, [(0, None), (1, [0.0])]), F.col("vec_id") % 20 == 0).count() == 0


def test_scan_abandons_and_keeps_the_nearest():
    rng = np.random.default_rng(0)
    turn = A.rotation(64)
    x, q = rng.standard_normal((3000, 64)) @ turn, rng.standard_normal((30, 64)) @ turn
    who, at = A.scan(q, x, 10)
    hits = sum(len(set(at[who == i]) & set(np.argsort(((x - v) ** 2).sum(1))[:10])) for i, v in enumerate(q))
    assert hits / 300 >= 0.98
    assert np.allclose(turn @ turn.T, np.eye(64))


@pytest.mark.parametrize("n", [3, 84, 85, 600, 3000])
def test_scan_over_strips_hands_on_all_ties(n):
    rng = np.random.default_rng(n)
    x, q = rng.normal(size=(n, 48)), rng.normal(size=(30, 48))
    x[n // 2:n // 2 + 3] = x[0]                     # copies in several strips
    who, at = A.scan(q, x, 10)
    found = set(zip(who.tolist(), at.tolist()))
    wanted = 0
    for i, v in enumerate(q):
        dist = ((x - v) ** 2).sum(1)
        near = np.flatnonzero(dist <= np.sort(dist)[min(n, 10) - 1])
        wanted += sum((i, j) in found for j in near.tolist()) / len(near)
    assert wanted / len(q) >= 0.98 and len(found) == len(who)


@pytest.mark.parametrize("spread, most", [(0.7, 0.2), (None, 0.9)])
def test_recall_with_lists_left_out(spread, most):
    """The lists to scan follow from the data's structure; those that are left out cost at most a tenth of the neighbours."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((20_000, 32))
    if spread:
        x = rng.standard_normal((100, 32))[rng.integers(0, 100, len(x))] * 2 + spread * x
    ix = A.Index(x, float((x ** 2).sum(1).max()), len(x), 20)
    assert ix.probes <= most * len(ix.centers)
    turned, of = ix.candidates(x), A._closest(ix.candidates(x), ix.centers)
    asked = ix.queries(x[:40])
    hits = 0
    for i, lists in enumerate(np.argsort(ix.distances(asked), axis=1)[:, :ix.probes]):
        product = x @ x[i]
        bound, found = np.full(1, np.inf), []
        for one in lists:
            here = np.flatnonzero(of == one)
            found += here[A.scan(asked[i:i + 1], turned[here], 21, bound=bound)[1]].tolist()
        found = sorted(set(found) - {i}, key=lambda j: -product[j])[:20]
        product[i] = -np.inf
        hits += len(set(found) & set(np.argsort(-product)[:20].tolist()))
    assert hits / 800 >= 0.9


def test_search_of_clustered_vectors_leaves_lists_out(spark):
    rng = np.random.default_rng(2)
    x = (rng.standard_normal((40, 16))[rng.integers(0, 40, 6000)] * 2 + 0.6 * rng.standard_normal((6000, 16))).astype(np.float32).astype(float)
    got = found(A.search(table(spark, enumerate(x.tolist())), F.col("vec_id") % 20 == 0, k=20))
    assert A.Index(x, float((x ** 2).sum(1).max()), len(x), 20).probes < 40
    hits = 0
    for i, near in got.items():
        product = x @ x[i]
        product[i] = -np.inf
        hits += len(set(near) & set(np.argsort(-product)[:20].tolist()))
    assert len(got) == 300 and hits / 6000 >= 0.9

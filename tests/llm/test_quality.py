import os
import random
import sys

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from fixtures import documents, prose, rows  # noqa: E402

from tonality.llm import quality as Q  # noqa: E402


def corpus():
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(900):
        w = prose(1000 + i, rng.randrange(20, 200)).split()
        bad = i % 6 == 0
        if bad:
            for _ in range(max(3, len(w) // 15)):
                w.insert(rng.randrange(len(w)), rng.choice(["nasty", "vile", "|"]))
        docs.append((i, " ".join(w)))
        if i % 2 == 0:
            labels.append((i, 1, int(bad)))
    return docs, labels


def label_table(spark, labels):
    return spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, text string")


def test_bad_documents_go_and_good_ones_stay(spark):
    docs, labels = corpus()
    table = documents(spark, docs)
    out = Q.resample(table, label_table(spark, labels))
    got = {r.doc_id: r for r in out.collect()}
    held_out = [i for i, _ in docs if i % 2]
    bad = [i for i in held_out if i % 6 == 0] + [i for i, _ in docs if i % 6 == 0]
    good = [i for i, _ in docs if i % 6]
    assert len(got) == len(docs)
    assert np.mean([not got[i].kept for i in bad]) > 0.95
    assert np.mean([got[i].kept for i in good]) > 0.95
    ranks = sorted(got.values(), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranks] == list(range(1, len(docs) + 1))
    assert all(a.key_weight >= b.key_weight for a, b in zip(ranks, ranks[1:]))
    kept = Q.keep(table, out)
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_counts_and_weights_by_brute_force(spark):
    docs, labels = corpus()
    good = {i for i, q, t in labels if q == 1 and t == 0}
    raw, target = np.zeros(Q.BUCKETS), np.zeros(Q.BUCKETS)
    cells = {}
    for i, t in docs:
        b = t.encode()
        cells[i], _ = Q.ngrams(np.frombuffer(b, np.uint8), np.array([0, len(b)]))
        raw[cells[i]] += 1
        if i in good:
            target[cells[i]] += 1
    want = Q.log_ratio(target, raw, len(good), len(docs))
    table = documents(spark, docs)
    got = Q.fit(table, Q.label_sample(label_table(spark, labels)))
    assert np.allclose(got, want)
    for r in Q.weigh(table, got).collect():
        assert abs(r.log_weight - float(want[cells[r.doc_id]].astype(float).sum())) < 1e-5


def test_text_position_does_not_matter():
    texts = [(t or "").encode() for _, t in rows()]
    off = np.cumsum([0, *map(len, texts)])
    cells, which = Q.ngrams(np.frombuffer(b"".join(texts), np.uint8), off)
    for i, b in enumerate(texts):
        alone, _ = Q.ngrams(np.frombuffer(b, np.uint8), np.array([0, len(b)]))
        assert (np.sort(cells[which == i]) == alone).all()


def test_repetitions_raise_levels():
    def level(t):
        b = t.encode()
        return (Q.ngrams(np.frombuffer(b, np.uint8), np.array([0, len(b)]))[0] >= Q.BUCKETS - Q.LEVELS).sum()
    assert [level(x) for x in ("a b c", "a a", "a a a", "a " * 17)] == [0, 1, 2, 5]


def test_awkward_rows(spark):
    out = Q.resample(documents(spark), label_table(spark, [(1, 1, 0), (4, 0, 0), (5, None, None), (None, 1, 0), (1, 1, 0)]))
    assert out.count() == len(rows())
    assert out.where(F.col("log_weight") == 0).count() >= 4
    none = Q.resample(documents(spark), label_table(spark, []))
    assert none.where("kept").count() == len(rows())
    assert Q.keep(documents(spark), none).count() == len(rows())
    assert Q.resample(documents(spark, []), label_table(spark, [(1, 1, 0)])).count() == 0

import os
import re
import sys
from itertools import combinations

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from fixtures import documents, prose, rows  # noqa: E402

from tonality.llm import jaccard, prefix_free  # noqa: E402
from tonality.llm.components import components  # noqa: E402


def brute_kept(some, width):
    first = {}
    texts = [(i, (t or "").encode()) for i, t in some]
    for i, b in texts:
        if i is not None:
            for p in range(len(b) - width + 1):
                s = b[p:p + width]
                first[s] = min(first.get(s, i), i)
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        if i is not None:
            for p in range(len(b) - width + 1):
                if first[b[p:p + width]] < i:
                    gone[p:p + width] = True
        edge = np.diff(gone.astype(int), prepend=0)
        out.append((i, len(b), np.frombuffer(b, np.uint8)[~gone].tobytes(), int((edge == 1).sum())))
    return sorted(out, key=str)


def found_kept(df):
    return sorted(((r.doc_id, r.n_bytes, bytes(r.kept), len(r.starts)) for r in df.collect()), key=str)


def small_rows():
    return [(i, t if t is None or len(t) < 40_000 else t[:40_000]) for i, t in rows()]


def test_removal_is_exact(spark):
    assert found_kept(prefix_free.deduplicate(documents(spark, small_rows()))) == brute_kept(small_rows(), 50)


def test_removal_with_few_letters(spark):
    rng = np.random.default_rng(3)
    some = [(int(i), "".join(rng.choice(list("ab"), int(rng.integers(0, 90))))) for i in rng.permutation(120)]
    some += [(i + 200, some[i][1] + some[i + 1][1]) for i in range(40)]
    out = prefix_free.deduplicate(documents(spark, some), width=10, gram=6)
    assert found_kept(out) == brute_kept(some, 10)


def test_no_rows(spark):
    assert prefix_free.deduplicate(documents(spark, [])).count() == 0


def test_many_batches_and_buckets_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(prefix_free, "BUCKET_BYTES", 500)
    got = found_kept(prefix_free.deduplicate(documents(spark, small_rows()), batch_bytes=700))
    assert got == brute_kept(small_rows(), 50)


def test_batches_are_cut_by_bytes(spark):
    sizes = [(i, 3000 if 100 <= i < 140 else 10) for i in range(400)] + [(7, 10), (10 ** 12, 10), (-5, 0), (None, 500)]
    table = documents(spark, [(i, "x" * n) for i, n in sizes]).selectExpr("doc_id AS key", "text")
    last, total = prefix_free._last_keys(table, 4, 6000)
    assert total == sum(n for i, n in sizes if i is not None)
    assert (np.diff(last) > 0).all() and last[-1] == 10 ** 12
    batch = {}
    for i, n in sizes:
        if i is not None:
            batch.setdefault(int(np.searchsorted(last, i)), []).append(n)
    assert max(batch) == len(last) - 1
    assert all(sum(b) <= 6000 + 3000 for b in batch.values())
    assert 120_000 / 9000 <= len(batch) <= 40
    none, total = prefix_free._last_keys(table.where("false"), 4, 6000)
    assert len(none) == total == 0


def test_other_keys_are_refused(spark):
    with pytest.raises(TypeError, match="whole numbers"):
        prefix_free.deduplicate(documents(spark, []).selectExpr("CAST(doc_id AS string) doc_id", "text"))


def test_whole_characters_and_carried_columns(spark):
    some = [(1, "é" * 60), (2, "x" + "é" * 40 + "ü tail"), (3, "a" * 10)]
    out = prefix_free.deduplicate(documents(spark, some), whole_characters=True, carry=("key", "n"))
    got = {r.doc_id: (bytes(r.kept).decode(), r.key, r.n) for r in out.collect()}
    assert got[1][0] == "é" * 60 and got[3] == ("a" * 10, "x", 1)
    assert got[2][0] in ("xü tail", "xéü tail")


def test_triggers_agree_wherever_a_string_stands():
    rng = np.random.default_rng(0)
    s = rng.integers(97, 101, 50).astype(np.uint8)
    seen = set()
    for before in (0, 1, 13, 400):
        data = np.concatenate([rng.integers(97, 101, before).astype(np.uint8), s, rng.integers(97, 101, 33).astype(np.uint8)])
        p = prefix_free.Parse(data, np.array([0, len(data)]), 50, 24)
        which = np.flatnonzero((p.lo <= before) & (before <= p.hi))
        assert len(which) == 1
        seen.add(int(p.trigger[which[0]]))
    assert len(seen) == 1


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def brute_sets(some, width):
    out = []
    for _, t in some:
        w = words_of(t)
        out.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    return out


def brute_classes(some, width=4, percent=85):
    sets = brute_sets(some, width)
    up = list(range(len(some)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in combinations(range(len(some)), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            up[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for i, (key, _) in enumerate(some):
        least[top(i)] = min(least.get(top(i), key), key)
    return sorted((key, len(sets[i]), least[top(i)]) for i, (key, _) in enumerate(some))


def found_classes(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def many_rows():
    out = [(i, t) for i, t in rows() if i is not None]
    for f in range(6):
        base = prose(100 + f, 90).split()
        for v in range(12):
            w = list(base)
            for e in range(v % 4):
                w[(17 * e + v) % len(w)] = f"edit{v}{e}"
            out.append((100 + 20 * f + v, " ".join(w)))
    short = prose(50, 14).split()
    for v in range(10):
        out.append((300 + v, " ".join(short[:14 - v % 5] + ([f"s{v}"] if v % 3 == 0 else []))))
    return out


def test_classes_are_exact(spark):
    assert found_classes(jaccard.classes(documents(spark, many_rows()))) == brute_classes(many_rows())


@pytest.mark.parametrize("most", [0, 12])
def test_boundary_changes_no_class(spark, monkeypatch, most):
    monkeypatch.setattr(jaccard, "choose_boundary", lambda sizes, percent: most)
    monkeypatch.setattr(jaccard, "LIST_ROWS", 1)
    monkeypatch.setattr(jaccard, "SIDE", 3)
    some = many_rows()
    assert found_classes(jaccard.classes(documents(spark, some), width=2)) == brute_classes(some, 2)


def test_null_keys_and_no_rows(spark):
    some = [(None, "a b c d e"), (3, "a b c d e"), (None, "q r s t u"), (5, None)]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.classes(documents(spark, some)).collect()}
    assert got == {(None, 2, 3), (3, 2, 3), (None, 2, None), (5, 0, 5)}
    assert jaccard.classes(documents(spark, [])).count() == 0


def test_subsets_meet_exactly_at_the_needed_overlap():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 16).astype(np.uint64)
    for _ in range(60):
        a, b = (np.sort(rng.choice(pool, int(rng.integers(3, 12)), replace=False)) for _ in range(2))
        sa, sb = ({s for s, _ in jaccard.subsets(x, 12, 70)} for x in (a, b))
        common = len(np.intersect1d(a, b))
        linked = 100 * common >= 70 * (len(a) + len(b) - common)
        assert not linked or sa & sb


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(500 + i, 501 + i) for i in range(60)] + [(7, 7)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: top(x) for x in up}


def test_pairs_that_are_only_tried_are_not_given_out(spark, monkeypatch):
    """24 texts, each pair just below the similarity: their maps let many pairs pass, their members none."""
    base = [f"w{i}" for i in range(298)]
    some = []
    for v in range(24):
        w = list(base)
        for e in range(3):
            w[4 * (v + 24 * e) + 3] = f"edit{v}x{e}"
        some.append((v, " ".join(w)))
    some += [(100, some[0][1]), (101, some[0][1] + " end")]
    written = {}
    plain = jaccard.via_table

    def counting(df, name):
        out = plain(df, name)
        written.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard, "via_table", counting)
    assert found_classes(jaccard.classes(documents(spark, some))) == brute_classes(some)
    assert written["left"][0] < 24
    assert max(max(n) for name, n in written.items() if name in ("pairs", "links", "left")) <= 5 * 24

"""J2 by containment: the index against a plain search of every title."""

import random
import re

import pytest

from tonality.operators.search import index_titles, open_index, search_titles
from tonality.plans.serving import score_titles


def key(s):
    return re.sub(r"[\W_]", "", s.lower())


def brute(requests, titles):
    out = {}
    for r in set(requests):
        k = key(r) if r else ""
        hits = [t for t in set(titles) if t and k and key(t) and k in key(t)]
        best = min(hits, key=lambda t: (t != r, len(t), t.encode()), default=None)
        out[r] = (best, "ok" if best is not None else "invalid_title")
    return out


def found(spark, requests, titles, **options):
    cat = spark.createDataFrame([(t, 1) for t in titles], "title string, key int")
    got = search_titles(spark.createDataFrame([(r, "x") for r in requests], "request string, key string"),
                        index_titles(cat, **options)).collect()
    assert len(got) == len({r.request for r in got})
    return {r.request: (r.title, r.status) for r in got}


TITLES = ["The Matrix", "The Matrix Reloaded", "Matrix", "matrix!", "Ma", "M", "Spider-Man", "Spiderman 2", "Amélie", "Ünder 𝒜𝒷", "东京物语",
          "  ", "", None, "!!!", "The Matrix", "aaaa", "aaaaa", "x" * 3000 + "needle" + "y" * 3000]
REQUESTS = ["Matrix", "MATRIX", "the matrix", "Reloaded", "matrix reloaded", "trix rel", "ma", "m", "spider man", "Spider-Man", "2", "AMÉLIE",
            "é", "京物", "𝒷", "𝒜𝒷", "aaa", "aaaaaa", "needle", "xyz", "", None, " ", "?!", "Matrix Revolutions", "matrix", "Matrix"]


def test_titles_that_contain_a_request(spark):
    got = found(spark, REQUESTS, TITLES)
    assert got == brute(REQUESTS, TITLES)
    assert got["Reloaded"] == ("The Matrix Reloaded", "ok") and got["matrix"] == ("Matrix", "ok")


@pytest.mark.parametrize("part", [3, 100_000])
def test_many_titles_and_frequent_grams(spark, part):
    """Two thirds of the titles hold one word; with small parts its postings are dealt to many salts."""
    rng = random.Random(2)
    words = ["the", "theme", "other", "ab", "b", "zebra", "ab-c"]
    titles = [" ".join(rng.choices(words, [9, 1, 1, 2, 2, 1, 1], k=rng.randrange(1, 6))) + f" {i % 70}" for i in range(400)]
    requests = [t[i:i + n] for t in titles[::3] for i, n in ((0, 3), (2, 5), (1, 2), (4, 9))] + ["the", "zebra zebra zebra q"]
    assert found(spark, requests, titles, part=part) == brute(requests, titles)


def test_empty_sides(spark):
    assert found(spark, ["a"], []) == {"a": (None, "invalid_title")} and found(spark, [], ["a"]) == {}


def test_index_is_kept_and_plan_has_no_nested_loop(spark, tmp_path):
    cat = spark.createDataFrame([(t,) for t in TITLES], "title string")
    path = str(tmp_path / "index")
    index_titles(cat, path)
    requests = spark.createDataFrame([(r,) for r in REQUESTS], "request string")
    out = search_titles(requests, open_index(spark, path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert {r.request: r.title for r in out.collect()} == {k: v[0] for k, v in brute(REQUESTS, TITLES).items()}
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = search_titles(requests, open_index(spark, path))._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_verdicts_of_searched_titles(spark):
    from pyspark.sql import functions as F
    cat = spark.createDataFrame([("The Matrix",), ("Heat",)], "title string")
    reviews = spark.createDataFrame([("The Matrix", 1, "good one"), ("The Matrix", 2, "bad"), ("Heat", 3, "fine")],
                                    "title string, doc_id long, review string")
    requests = spark.createDataFrame([("matrix",), ("hea",), ("alien",)], "request string")
    vocab = spark.createDataFrame([("good", 1, 1)], "word string, n long, id int")

    def scorer(feats):
        return feats.withColumn("prediction", F.when(F.element_at("features", -1) > 0, 1).otherwise(0)).withColumn("probability", F.lit(.5))

    got = {r.request: (r.title, r.n_reviews, r.sentiment, r.status)
           for r in score_titles(requests, cat, reviews, scorer, vocab=vocab, max_words=10, max_len=2, index=index_titles(cat)).collect()}
    assert got == {"matrix": ("The Matrix", 2, "Positive", "ok"), "hea": ("Heat", 1, "Negative", "ok"), "alien": (None, 0, None, "invalid_title")}


def test_postings_of_titles_that_cannot_contain_the_request_go_at_once(spark, monkeypatch):
    from tonality.operators import search
    titles = [f"the {a}{b} of {c}" for a in ("red", "blue", "green") for b in "abcdefgh" for c in ("north", "south", "west")]
    requests = [t[4:] for t in titles[::5]]
    seen, plain = [], search.held_titles

    def counting(look, index):
        seen.append((look.join(index.postings, ["gram", "salt"]).count(), plain(look, index).count()))
        return plain(look, index)

    monkeypatch.setattr(search, "held_titles", counting)
    assert found(spark, requests, titles) == brute(requests, titles)
    assert seen[0][1] <= 2 * 2 * len(requests) < seen[0][0]


def test_tiers_of_title_lengths(spark, monkeypatch):
    """Whatever tiers the titles fall into: equal lengths stay together, marks make a title longer than its key."""
    from tonality.operators import search
    monkeypatch.setattr(search, "FIRST", 40, raising=False)
    rng = random.Random(3)
    titles = ["".join(rng.choices("abc -!", [5, 4, 1, 2, 1, 1], k=rng.choice([1, 2, 3, 5, 8, 13, 40, 120]))) for _ in range(300)] + TITLES
    requests = [t[i:i + n] for t in titles if t for i, n in ((0, 2), (1, 4), (3, 7), (0, 200))] + ["bcbcbcbc", "ccc c", "a" * 130, "Ab!"] + REQUESTS
    cat = spark.createDataFrame([(t,) for t in titles], "title string")
    index = index_titles(cat, part=50)
    assert index.tiers.count() > 3
    got = search_titles(spark.createDataFrame([(r,) for r in requests], "request string"), index).collect()
    assert {r.request: (r.title, r.status) for r in got} == brute(requests, titles) and len(got) == len(set(requests))


def test_a_request_that_many_titles_contain_meets_only_the_shortest(spark, monkeypatch):
    from tonality.operators import search
    titles = [f"{a}{b}matrix" + "x" * n for n in range(0, 120, 4) for a in "abcdefgh" for b in "stuv"]
    requests = ["matrix", "atri", "trix", "hvmatrix" + "x" * 116]
    seen, plain = [], search.held_titles

    def counting(look, index):
        seen.append(plain(look, index).count())
        return plain(look, index)

    monkeypatch.setattr(search, "FIRST", 500, raising=False)
    monkeypatch.setattr(search, "held_titles", counting)
    assert found(spark, requests, titles) == brute(requests, titles)
    assert sum(seen) < len(titles)

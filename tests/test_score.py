"""Fixture 7."""

from tonality.operators.score import linear_scores, resolve_titles, title_verdicts
from tonality.plans.serving import score_titles
from tonality.plans.features import preprocess
from tonality.sources.text_files import flatten_reviews, records_frame, REQUEST_SCHEMA


def test_fixture7_verdicts(spark):
    catalogue = spark.createDataFrame([("A",), ("B",), ("C",)], "title string")
    requests = spark.createDataFrame([("a",), ("B",), ("c",), ("zz",)], "request string")
    preds = spark.createDataFrame([("A", 1), ("A", 0), ("B", 1), ("B", 0), ("B", 0)], "title string, prediction int")
    out = {r.request: (r.title, r.n_reviews, r.sentiment, r.status)
           for r in title_verdicts(resolve_titles(requests, catalogue), preds).collect()}
    assert out == {"a": ("A", 2, "Positive", "ok"), "B": ("B", 3, "Negative", "ok"),
                   "c": ("C", 0, None, "no_reviews"), "zz": (None, 0, None, "invalid_title")}


def test_resolution_prefers_shortest_then_smallest(spark):
    catalogue = spark.createDataFrame([("The-Film",), ("the film",), ("THE FILM!",)], "title string")
    requests = spark.createDataFrame([("thefilm",)], "request string")
    assert resolve_titles(requests, catalogue).first().title == "The-Film"


def test_score_titles_end_to_end(spark):
    nested = records_frame(spark, [("Up", [("good good",), (None,)]), ("Down", [])], REQUEST_SCHEMA)
    reviews = flatten_reviews(nested).withColumnRenamed("review_id", "doc_id")
    assert sorted(r.review for r in reviews.collect()) == ["", "good good"]
    catalogue = spark.createDataFrame([("Up",), ("Down",)], "title string")
    requests = spark.createDataFrame([("up",), ("down",), ("sideways",)], "request string")
    train = spark.createDataFrame([(1, "good good bad", 1)], "doc_id long, value string, label int")
    _, vocab = preprocess(train, max_words=10, max_len=3)

    def scorer(df):
        return linear_scores(df, [0.0, 0.0, 1.0], -0.5)

    out = {r.request: (r.n_reviews, r.score, r.sentiment, r.status)
           for r in score_titles(requests, catalogue, reviews, scorer, vocab, 10, 3).collect()}
    # 'good' is id 1: review "good good" -> last id 1 -> margin .5 -> 1; "" -> 0 -> mean .5
    assert out == {"up": (2, 0.5, "Positive", "ok"), "down": (0, None, None, "no_reviews"),
                   "sideways": (0, None, None, "invalid_title")}
    per_title = {r.request: r.status for r in score_titles(
        requests, catalogue, reviews, scorer, vocab_scope="per_title", max_words=10, max_len=3).collect()}
    assert per_title["up"] == "ok"


def test_mean_probability_average(spark):
    catalogue = spark.createDataFrame([("Up",)], "title string")
    requests = spark.createDataFrame([("up",)], "request string")
    reviews = spark.createDataFrame([("Up", 1, "good"), ("Up", 2, "bad")], "title string, doc_id long, review string")
    train = spark.createDataFrame([(1, "good good bad", 1)], "doc_id long, value string, label int")
    _, vocab = preprocess(train, max_words=10, max_len=1)

    def scorer(df):   # margin = id - 1.5: good (1) -> -0.5, bad (2) -> +0.5
        return linear_scores(df, [1.0], -1.5)

    r = score_titles(requests, catalogue, reviews, scorer, vocab, 10, 1, average="mean_prob").first()
    assert abs(r.score - 0.5) < 1e-12 and r.sentiment == "Positive" and r.n_reviews == 2


def test_punctuation_only_titles_never_match(spark):
    catalogue = spark.createDataFrame([("!!!",), ("...",), ("Up",)], "title string")
    requests = spark.createDataFrame([("???",), ("UP",)], "request string")
    out = {r.request: (r.title, r.status) for r in resolve_titles(requests, catalogue).collect()}
    assert out == {"???": (None, "invalid_title"), "UP": ("Up", "ok")}


def test_the_exact_spelling_wins(spark):
    catalogue = spark.createDataFrame([("AB",), ("a b!",), ("a-b",)], "title string")
    requests = spark.createDataFrame([("a b!",), ("a-b",), ("ab",)], "request string")
    out = {r.request: r.title for r in resolve_titles(requests, catalogue).collect()}
    assert out == {"a b!": "a b!", "a-b": "a-b", "ab": "AB"}


def test_features_of_a_wrong_length_fail(spark):
    import pytest

    df = spark.createDataFrame([(1, [1, 2])], "doc_id long, features array<int>")
    with pytest.raises(Exception, match="3 features expected"):
        linear_scores(df, [0.1, 0.2, 0.3], 0.0).collect()


def test_a_given_vocabulary_is_limited(spark):
    train = spark.createDataFrame([(1, "xa xa xa xb xb xc", 1)], "doc_id long, value string, label int")
    _, vocab = preprocess(train, max_words=10, max_len=3)
    assert vocab.count() == 3
    feats, _ = preprocess(train, max_words=2, max_len=6, vocab=vocab)
    assert feats.first().features == [0, 0, 0, 1, 1, 1]


def test_title_requests_as_a_stream(spark):
    from tonality.session import shared_dir
    from tonality.streaming.metrics import file_stream
    from tonality.streaming.scoring import start_title_stream

    source = shared_dir(spark, "test-title-requests")
    spark.createDataFrame([("up",), ("zz",)], "request string").write.mode("overwrite").parquet(source)
    catalogue = spark.createDataFrame([("Up",)], "title string")
    reviews = spark.createDataFrame([("Up", 1, "good"), ("Up", 2, "bad")], "title string, doc_id long, review string")
    train = spark.createDataFrame([(1, "good good bad", 1)], "doc_id long, value string, label int")
    _, vocab = preprocess(train, max_words=10, max_len=1)
    q, out = start_title_stream(spark, file_stream(spark, source, "request string"), catalogue, reviews,
                                lambda df: linear_scores(df, [1.0], -1.5), vocab=vocab, max_words=10, max_len=1)
    q.processAllAvailable()
    q.stop()
    got = {r.request: (r.n_reviews, r.score, r.status) for r in spark.read.parquet(out).collect()}
    assert got == {"up": (2, 0.5, "ok"), "zz": (0, None, "invalid_title")}

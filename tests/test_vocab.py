"""Fixture 4 and properties."""

from pyspark.sql import functions as F

from tonality.operators.encode import encode, pad
from tonality.operators.vocab import fit_vocabulary, fit_vocabulary_by
from tonality.plans.features import preprocess, tokenize


def _docs(spark):
    return spark.createDataFrame([(1, "plot film plot", 1), (2, "film cast", 0)],
                                 "doc_id long, value string, label int")


def test_fixture4_vocabulary_encode_pad(spark):
    words = tokenize(_docs(spark))
    vocab = fit_vocabulary(words, 3)
    assert sorted((r.word, r.id) for r in vocab.collect()) == [("film", 2), ("plot", 1)]
    seqs = {r.doc_id: r.seq for r in encode(words, vocab, ["doc_id", "label"], num_words=3).collect()}
    assert seqs == {1: [1, 2, 1], 2: [2]}
    padded = {r.doc_id: r.features for r in pad(encode(words, vocab, ["doc_id"]), 2).collect()}
    assert padded == {1: [2, 1], 2: [0, 2]}
    doc3 = tokenize(spark.createDataFrame([(3, "cast", 1)], "doc_id long, value string, label int"))
    assert pad(encode(doc3, vocab, ["doc_id"]), 2).first().features == [0, 0]


def test_full_vocabulary_tie_break_by_first_appearance(spark):
    vocab = fit_vocabulary(tokenize(_docs(spark)), 10)
    assert sorted((r.id, r.word, r.n) for r in vocab.collect()) == [(1, "plot", 2), (2, "film", 2), (3, "cast", 1)]


def test_empty_document_keeps_row(spark):
    df = spark.createDataFrame([(1, "plot", 1), (2, "", 0), (3, "the and", 1)], "doc_id long, value string, label int")
    feats, _ = preprocess(df, max_words=5, max_len=3)
    got = {r.doc_id: r.features for r in feats.collect()}
    assert got == {1: [0, 0, 1], 2: [0, 0, 0], 3: [0, 0, 0]}


def test_per_group_vocabulary_matches_single_group(spark):
    rows = [(i, f"t{i % 2}", " ".join(f"w{(i * j) % 7}" for j in range(1, 9))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, title string, value string")
    words = tokenize(df, keep=["doc_id", "title"])
    by = fit_vocabulary_by(words, "title", 5, salt_buckets=3)
    for t in ("t0", "t1"):
        one = fit_vocabulary(words.where(F.col("title") == t), 5)
        assert sorted((r.word, r.id) for r in by.where(F.col("title") == t).collect()) == \
            sorted((r.word, r.id) for r in one.collect())


def test_padded_length_and_id_range(spark):
    from tests.conftest import SF_SMALL
    from tonality.sources.tables import labelled_reviews
    feats, _ = preprocess(labelled_reviews(spark, SF_SMALL), max_words=50, max_len=7)
    bad = feats.where((F.size("features") != 7) | F.exists("features", lambda x: (x < 0) | (x >= 50)))
    assert bad.count() == 0


def test_fit_on_train_uses_only_train_rows(spark):
    from tonality.operators.split import train_rows
    rows = [(i, f"w{i} common", i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, value string, label int")
    _, vocab = preprocess(df, max_words=1000, max_len=4, fit_on="train")
    train_ids = {r.doc_id for r in train_rows(df).collect()}
    words = {r.word for r in vocab.collect()}
    assert words == {"common"} | {f"w{i}" for i in train_ids}


def test_string_keys(spark):
    df = spark.createDataFrame([("b", ["y", "x"]), ("a", ["x", "y", "z"])], "doc_id string, words array<string>")
    assert [(r.word, r.id) for r in fit_vocabulary(df, 10).orderBy("id").collect()] == [("x", 1), ("y", 2), ("z", 3)]

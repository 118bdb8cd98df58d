"""T1, T2, T4, T5, T7 against Spark ML and the hand-worked fixtures."""

import string

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from tonality.functions.stopwords import ENGLISH_STOP_WORDS
from tonality.functions.text import keras_words, ml_tokens, pad_sequence, remove_stop_words, review_words


def _one(spark, expr, value, schema="value string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("value")).alias("r")).first().r


def test_stop_word_list_is_spark_default(spark):
    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")
    assert len(ENGLISH_STOP_WORDS) == 181


def test_fixture2_tokenise_and_stop_words(spark):
    text = "The, movie  wasn't\tGREAT!! and don't "
    assert _one(spark, ml_tokens, text) == ["the,", "movie", "", "wasn't", "great!!", "and", "don't"]
    assert _one(spark, lambda c: remove_stop_words(ml_tokens(c)), text) == ["the,", "movie", "", "great!!"]
    assert _one(spark, ml_tokens, "") == [""]
    assert _one(spark, ml_tokens, None) == []
    assert _one(spark, ml_tokens, "  lead the") == ["", "", "lead", "the"]
    assert _one(spark, lambda c: remove_stop_words(ml_tokens(c)), "  lead the") == ["", "", "lead"]
    assert _one(spark, ml_tokens, "   ") == []


def test_fixture3_second_tokeniser(spark):
    assert _one(spark, review_words, "The, movie  GREAT!!") == ["the", "movie", "great"]
    assert _one(spark, keras_words, "it's a-b\tc\x0bd") == ["it's", "a", "b", "c\x0bd"]


_alphabet = st.sampled_from(list("aAbZ '\t\n\x0b\x0c\r.,!-éÉ") + ["don't", "THE", "Wasn't"])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(_alphabet, max_size=12).map("".join), min_size=1, max_size=8))
def test_tokeniser_matches_spark_ml(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, value string")
    ref = StopWordsRemover(inputCol="w", outputCol="f").transform(
        Tokenizer(inputCol="value", outputCol="w").transform(df))
    ours = df.select("id", ml_tokens("value").alias("w2"), remove_stop_words(ml_tokens("value")).alias("f2"))
    got = {r.id: (r.w2, r.f2) for r in ours.collect()}
    for r in ref.collect():
        assert got[r.id] == (r.w, r.f), repr(texts[r.id])


def _keras_python(text):
    # The second tokeniser's rule, written out in plain Python for the test.
    filters = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'
    text = text.lower().translate(str.maketrans({c: " " for c in filters}))
    return [w for w in text.split(" ") if w]


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet=string.ascii_letters + string.punctuation + " \t\n\x0b'é", max_size=40))
def test_second_tokeniser_matches_rule(spark, text):
    assert _one(spark, keras_words, text) == _keras_python(text)


def test_pad_keeps_last_and_pads_left(spark):
    df = spark.createDataFrame([([1, 2, 1],), ([2],), ([],)], "s array<int>")
    out = [r.p for r in df.select(pad_sequence("s", 2).alias("p")).collect()]
    assert out == [[2, 1], [0, 2], [0, 0]]

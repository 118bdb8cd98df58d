"""The whole preprocessing against a plain sequential implementation of the same rules."""

import re
from collections import OrderedDict

from hypothesis import given, settings
from hypothesis import strategies as st

from tonality.functions.stopwords import ENGLISH_STOP_WORDS
from tonality.plans.features import preprocess

_STOP = set(ENGLISH_STOP_WORDS)
_FILTERS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'


def _java_split_ws(text):
    parts = re.split(r"[ \t\n\x0b\f\r]", text.lower())
    if text == "":
        return [""]
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def _words(text):
    kept = [w for w in _java_split_ws(text) if w not in _STOP]
    joined = " ".join(kept).lower().translate(str.maketrans({c: " " for c in _FILTERS}))
    return [w for w in joined.split(" ") if w]


def _reference(texts, num_words, max_len):
    counts = OrderedDict()
    seqs = [_words(t) for t in texts]
    for seq in seqs:
        for w in seq:
            counts[w] = counts.get(w, 0) + 1
    ranked = sorted(counts.items(), key=lambda kv: kv[1], reverse=True)   # stable
    index = {w: i + 1 for i, (w, _) in enumerate(ranked)}
    out = []
    for seq in seqs:
        ids = [index[w] for w in seq if index[w] < num_words]
        ids = ids[-max_len:]
        out.append([0] * (max_len - len(ids)) + ids)
    return out


_token = st.sampled_from(["film", "plot", "The", "and", "good!", "bad", "don't", "a-b", "x.y", "", "é", "cast"])
_sep = st.sampled_from([" ", "  ", "\t", "\n", ", "])
_doc = st.lists(st.tuples(_token, _sep), max_size=12).map(lambda xs: "".join(a + b for a, b in xs))


@settings(max_examples=25, deadline=None)
@given(st.lists(_doc, min_size=1, max_size=8), st.integers(2, 8), st.integers(1, 6))
def test_preprocess_matches_sequential_reference(spark, texts, num_words, max_len):
    df = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(texts)], "doc_id long, value string, label int")
    feats, _ = preprocess(df, max_words=num_words, max_len=max_len)
    got = {r.doc_id: r.features for r in feats.collect()}
    assert [got[i] for i in range(len(texts))] == _reference(texts, num_words, max_len)

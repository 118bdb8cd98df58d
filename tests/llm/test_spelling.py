"""Spelling variants against a plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

import pytest

from fixtures import documents, rows
from tonality.llm import spelling
from tonality.llm.queries import QUERIES

LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute_words(docs):
    n = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{' ' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                cut = h % len(run)
                run = run[:cut] + run[cut + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def brute_near(words):
    """Words that meet at a word with one letter left out, or replaced by any."""
    holes = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1:]), set()).add(w)
    near = {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            near[w] |= holes[w[:i], w[i + 1:]]
            short = w[:i] + w[i + 1:]
            if short in words:
                near[w].add(short)
                near[short].add(w)
    return {w: s - {w} for w, s in near.items()}


def brute(words):
    near, out, form = brute_near(words), {}, {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] is not None else None)
    return out


def result(df):
    got = [(r.word, (r.form, r.root, r.n, r.n_near, r.form_n)) for r in df.collect()]
    assert len(got) == len(dict(got))
    return dict(got)


def noisy_words(seed, n):
    rng = random.Random(seed)
    words = Counter()
    for _ in range(n):
        w = "".join(rng.choice(["ab", "cé", "d", "ÿe", "aa", "b"]) for _ in range(rng.randrange(4, 9)))
        words[w] += rng.choice([1, 1, 2, 30, 500])
        for _ in range(3):
            i = rng.randrange(len(w))
            words[rng.choice([w[:i] + w[i + 1:], w[:i] + "b" + w[i:], w[:i] + "a" + w[i + 1:]])] += rng.randrange(1, 4)
    return {w: c for w, c in words.items() if len(w) >= 7 and c >= 2}


@pytest.mark.parametrize("tile", [4096, 16])
def test_all_words_compared(spark, tile):
    words = noisy_words(1, 2500)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert result(spelling.group(df, tile=tile)) == brute(words)


def test_one_block_with_many_words(spark):
    """Words that share first and last letters: a hot key, cut into tiles; a hub near hundreds of words."""
    rng = random.Random(4)
    words = {"abc" + "".join(rng.choice("xyzü") for _ in range(4)) + "abc": rng.randrange(2, 6) for _ in range(600)}
    words["abcxxxxabc"] = 900
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    want = brute(words)
    assert result(spelling.group(df, tile=50)) == want and max(v[3] for v in want.values()) >= 12


def test_chains_of_forms(spark):
    chain = ["aaaaaaaaaa"]
    for i in range(9):
        chain.append(chain[-1][:i] + "b" + chain[-1][i + 1:])
    words = {w: 2 * 10 ** i for i, w in enumerate(chain)}
    got = result(spelling.group(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == brute(words) and got[chain[0]][1] == chain[-1]


def test_long_and_equal_words(spark):
    long = "abcdefghij" * 2000
    words = {long: 50, long + "x": 3, long[:9000] + long[9001:]: 4, "z" * 30: 2, "z" * 31: 2, "z" * 32: 20, "aabaaba": 5, "aabaabaa": 5}
    assert result(spelling.group(spark.createDataFrame(list(words.items()), "word string, n long"))) == brute(words)


def test_query_on_the_given_table(spark):
    path = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    got = result(QUERIES["op13_bit_sliced_spelling"](spark, path))
    assert got == brute(brute_words(docs)) and any(v[0] for v in got.values())


def test_awkward_documents(spark):
    docs = [*rows(), (40, "Réunion RÉUNION rÉunion Éclairs éclairs É×clairs ÷ naïveté" * 3), (41, "abcdefg" * 3 + " " + "abcdefgh " * 40),
            (None, "abcdefgh abcdefgi")]
    assert result(spelling.variants(documents(spark, docs))) == brute(brute_words(docs))
    assert spelling.variants(documents(spark).limit(0)).collect() == []

"""Adaptive quality rules against a plain reading of the rules."""

import random
import re
from collections import Counter, defaultdict

import pytest
from fixtures import prose, rows

from tonality.llm import adaptive_rules as rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n long, bin long, rate string, words string, docs long, key long, g_lang string"
EXTRA = (1, 2, "x", "w", 3, 4, "l")


def measure(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def rates(m):
    return {"word_length": m[1] * 1000 // max(m[0], 1), "symbols": m[2] * 1000 // max(m[0], 1),
            "dup_lines": m[3] * 1000 // max(m[0], 1), "repeats": m[4] * 1000 // max(m[0], 1)}


def quartile(values, k):
    """The least value, of its six leading bits, that at least k quarters do not exceed."""
    cut = sorted(v >> max(v.bit_length() - 6, 0) << max(v.bit_length() - 6, 0) for v in values)
    return next(v for i, v in enumerate(cut) if (i + 1) * 4 >= len(cut) * k)


def brute(docs, least):
    """``docs``: (doc_id, text, lang, source)."""
    found = [(d, la, so, measure(t)) for d, t, la, so in docs]
    pools = defaultdict(list)
    for _, la, so, m in found:
        if not m[-1]:
            for pool in ((la, so), (la,), ()):
                pools[pool].append(rates(m))
    out = []
    for d, la, so, m in found:
        pool = next((p for p in ((la, so), (la,)) if len(pools[p]) >= least), ())
        kept = not m[-1]
        if kept:
            for name, spread, low in (("word_length", 250, True), ("symbols", 50, False), ("dup_lines", 50, False), ("repeats", 100, False)):
                values = [r[name] for r in pools[pool]]
                q25, q75 = quartile(values, 1), quartile(values, 3)
                reach = 4 * max(q75 - q25, spread)
                kept &= rates(m)[name] <= q75 + reach and not (low and rates(m)[name] < q25 - reach)
        out.append((d, *m, kept))
    return sorted(out, key=str)


def judged(spark, docs, least):
    df = spark.createDataFrame([(*d, *EXTRA) for d in docs], SCHEMA)
    return sorted([tuple(r) for r in rules.judge(df, least=least).collect()], key=str)


def corpus():
    rng = random.Random(8)
    docs = []
    for i in range(400):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["hot", "hot", "hot", "a", "b", None])
        text = prose(i, rng.randrange(40, 120))
        if i % 9 == 0:
            text = text.replace(" ", " ### ", 30)
        elif i % 11 == 0:
            text = "".join(text.split(" ")[:70]) + " " + text
        elif i % 7 == 0:
            text += ("\n" + prose(i, 4)) * rng.randrange(2, 30)
        elif i % 13 == 0:
            text = " ".join(w[:2] for w in text.split())
        docs.append((i, text, lang, source))
    return docs


@pytest.mark.parametrize("least", [1, 20, 60, 10_000])
def test_as_by_hand(spark, least):
    docs = corpus()
    got = judged(spark, docs, least)
    assert got == brute(docs, least)
    assert 0 < sum(r[-1] for r in got) < sum(not r[-2] for r in got)


def test_awkward_rows(spark):
    docs = [(d, t, None if i % 3 else "en", None if i % 2 else "s") for i, (d, t) in enumerate(rows())]
    docs += [(50, "a b c " * 30, "en", "s"), (51, "x y\nx y\n\n\r\nx y\n \t\n", "en", "s"), (52, "a a a a a", "en", "s"),
             (53, "\n".join(f"w{i} v{i} u{i}" for i in range(30)) + "\nw3 v3 u3\nw3 v3 u3", "fr", "t"), (50, "a b c " * 30, "en", "s")]
    assert judged(spark, docs, 3) == brute(docs, 3)
    empty = rules.judge(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert empty.collect() == []


def test_sketches_merge_in_any_grouping(spark):
    df = spark.createDataFrame([(*d, *EXTRA) for d in corpus()], SCHEMA)
    whole = rules.sketches(rules.measures(df))
    halves = [rules.sketches(rules.measures(df.where(f"doc_id % 2 = {k}"))) for k in (0, 1)]
    merged = rules.merge(halves[0].unionAll(halves[1]), "lang", "source")
    key = lambda d: sorted(map(str, d.select("lang", "source", "rate", "bin", "n").collect()))
    assert key(whole) == key(merged)


def test_no_python_worker_and_one_shuffle_of_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = rules.measures(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    plan = rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan

"""The pipeline against a brute-force version of each stage, judged on the stage's own input."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from fixtures import PASSAGE, prose  # noqa: E402
from test_dedup import brute_classes, brute_kept  # noqa: E402
from test_quality import corpus  # noqa: E402
from test_scans import plain  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("tables"))
    docs, labels = corpus()
    item = prose(900, 40)
    docs += [(1000, docs[7][1]), (1001, docs[8][1] + " end"), (1002, prose(61, 80) + " " + PASSAGE + " " + prose(62, 70)),
             (1003, prose(63, 90) + " " + PASSAGE), (1004, prose(64, 60) + " " + item + " " + prose(65, 30)), (1005, None),
             (1006, ""), (1007, PASSAGE), (1008, "größe " * 3), (1009, docs[11][1]), (1009, docs[11][1])]
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, item), (2, prose(901, 20))], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages(spark, folder, tmp_path):
    import public_tokenizers

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    before = pairs(docs)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name == "token_ids":
            lib = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            want = sorted((i, lib.encode(t or "", add_special_tokens=False).ids) for i, t in before)
            assert sorted((r.doc_id, list(memoryview(bytes(r.ids)).cast("I"))) for r in out.collect()) == want
            break
        assert out.columns == columns
        after = pairs(out)
        if name == "quality":
            bad = re.compile(r"\b(nasty|vile)\b|\|")
            gone = [x for x in before if x not in after]
            assert gone and all(bad.search(t) for _, t in gone)
            assert not any(len(bad.findall(t or "")) > 2 for _, t in after)
        elif name == "near_duplicates":
            first = {c for _, _, c in brute_classes(before)}
            assert after == [x for x in before if x[0] in first]
            assert (1000, before[0][1]) not in after and len(after) < len(before)
        elif name == "repeated_passages":
            want = [(i, k.decode()) for i, n, k, _ in brute_kept(before, 50) if k or not n]
            assert [(i, t or "") for i, t in after] == sorted(want, key=str)
            assert sum(PASSAGE in (t or "") for _, t in after) == 1
            assert all(r.n_chars == len(r.text) for r in out.collect())
        elif name == "benchmark_leaks":
            bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            leaking = {i for i, t in before if any(" ".join(plain(b)) in " ".join(plain(t)) for _, b in bench)}
            assert 1004 in leaking and after == [x for x in before if x[0] not in leaking]
        docs, before = out, after


def test_run_is_the_stages_in_order(spark, folder):
    out = entry.queries()["pipeline"](spark, folder)
    ids = {r.doc_id for r in out.collect()}
    assert 1004 not in ids and 1000 not in ids and {1005, 1006, 1008} & ids
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()


def test_no_documents(spark, folder, tmp_path):
    base = str(tmp_path)
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{base}/{name}.parquet")
    assert corpus_pipeline.run(spark, base).count() == 0


def test_near_duplicates_are_those_of_five_words_and_four_fifths(spark, folder):
    words = [f"w{i}" for i in range(100)]
    some = [(1, " ".join(words)), (2, " ".join(words + [f"x{i}" for i in range(20)])),            # 96 of 116 at five words
            (3, " ".join([f"v{i}" for i in range(100)])), (4, " ".join([f"v{i}" for i in range(100)] + [f"y{i}" for i in range(25)])),
            (5, "a b c d e"), (6, "a b c d f"), (7, "a b c d"), (8, "A b c d"), (9, None), (10, "")]
    for i in range(30):
        base = prose(500 + i % 6, 90 + i % 6).split()
        for e in range(i // 6):
            base[(23 * e + i) % len(base)] = f"edit{i}{e}"
        some.append((20 + i, " ".join(base)))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in some],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = pairs(corpus_pipeline.distinct_documents(spark, docs, folder))
    first = {c for _, _, c in brute_classes(some, 5, 80)}
    assert kept == sorted((x for x in some if x[0] in first), key=str)
    ids = {i for i, _ in kept}
    assert 1 in ids and 2 not in ids and {3, 4} <= ids and first != {c for _, _, c in brute_classes(some)}

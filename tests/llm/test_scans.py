import math
import os
import re
import sys
from itertools import combinations

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from fixtures import documents, prose, rows  # noqa: E402

from tonality.llm import decontaminate, licenses  # noqa: E402

MIT = dict(licenses.TEXTS[:1])["MIT"]


def duck(spark_rows, bench=None):
    import duckdb

    c = duckdb.connect()
    c.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    c.executemany("INSERT INTO documents VALUES (?, ?)", spark_rows)
    if bench is not None:
        c.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
        c.executemany("INSERT INTO benchmark VALUES (?, ?)", bench)
    return c


def license_rows():
    return rows() + [
        (100, MIT), (101, "Copyright (c) 2019 A. Person\nAll rights reserved.\n\n" + MIT.upper().replace(", ", " ,\n")),
        (102, MIT.replace("sublicense", "sub-licence")), (103, MIT + " but not quite"),
        (104, "text\nReleased under the MIT License.\nmore\n  * licensed under the Apache LICENCE -- version 2.0\n"),
        (105, "SPDX-License-Identifier: GPL-3.0"), (105, "SPDX-License-Identifier: GPL-3.0"),
        (None, "Licensed under CC BY-NC 4.0."), (106, "© 2020 nobody"), (107, "x " * 30_000 + "\nReleased under the MIT License."),
    ]


def test_license_scan(spark):
    got = sorted((str(r.doc_id), r.unit, r.line_no, r.license_id) for r in licenses.scan(documents(spark, license_rows())).collect())
    want = [("100", "line", 1, "MIT"), ("100", "text", 0, "MIT"), ("101", "text", 0, "MIT"), ("102", "line", 1, "MIT"),
            ("102", "text", 0, "MIT"), ("104", "line", 2, "MIT"), ("104", "line", 4, "Apache-2.0"),
            ("105", "line", 1, "GPL-3.0"), ("105", "line", 1, "GPL-3.0"), ("105", "text", 0, "GPL-3.0"),
            ("105", "text", 0, "GPL-3.0"), ("107", "line", 2, "MIT"), ("None", "line", 1, "CC-BY-NC-4.0"),
            ("None", "text", 0, "CC-BY-NC-4.0")]
    assert got == sorted(want)
    assert licenses.scan(documents(spark, [])).count() == 0


def test_license_sql_agrees(spark):
    some = [r for r in license_rows() if r[1] is None or "\x00" not in r[1]]
    got = sorted(map(str, licenses.scan(documents(spark, some)).select("doc_id", "unit", "line_no", "license_id", "digest").collect()))
    cur = duck(some).execute(licenses.scan_sql())
    names = [d[0] for d in cur.description]
    from pyspark.sql import Row

    assert got == sorted(str(Row(**dict(zip(names, r)))) for r in cur.fetchall())


def bench_rows():
    return [(1, prose(900, 40)), (2, prose(901, 15)), (3, "too short"), (4, None), (5, ""), (6, prose(902, 60)), (6, prose(902, 60))]


def leaky_rows():
    one, two, six = prose(900, 40), prose(901, 15), prose(902, 60)
    changed = one.split()
    changed[5] = changed[16] = changed[30] = "exchanged"
    return rows() + [
        (200, prose(70, 300) + " " + one + " " + prose(71, 50)), (201, prose(72, 20) + "\n" + " ".join(changed)),
        (202, two.upper() + "!"), (203, prose(73, 40) + " " + " ".join(six.split()[20:45])), (204, " ".join(one.split()[:9])),
        (205, one + " " + two), (205, one + " " + two), (None, two), (206, one + " x " + one),
    ]


def plain(text):
    return re.sub(r"[^\w]+|_", " ", (text or "").lower()).split()


def brute_leaks(docs, bench, window=13, agree=0.8):
    """All pairs whose texts agree in enough words of some window, laid in any way."""
    out = set()
    for i, t in docs:
        d = plain(t)
        for item, b in bench:
            w = plain(b)
            if len(w) < decontaminate.SPAN or len(d) < decontaminate.SPAN:
                continue
            n = min(window, len(w))
            for shift in range(-len(w), len(d)):
                same = [0 <= shift + j < len(d) and d[shift + j] == w[j] for j in range(len(w))]
                if any(sum(same[s:s + n]) >= agree * n for s in range(len(w) - n + 1)):
                    out.add((i, item))
                    break
    return out


def items(spark, some):
    return spark.createDataFrame([(*r, 1, "k") for r in some], "item_id long, text string, doc_id long, key string")


def test_leaks_are_found_and_clean_texts_left(spark):
    docs = [r for r in leaky_rows() if r[1] is None or len(r[1]) < 20_000]
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(documents(spark, docs), items(spark, bench_rows())).collect()}
    assert got == brute_leaks(docs, bench_rows())
    assert {(200, 1), (201, 1), (202, 2), (203, 6), (205, 1), (205, 2), (None, 2)} <= got


def test_leaks_in_blocks_are_the_same(spark):
    docs, bench = documents(spark, leaky_rows()), items(spark, bench_rows())
    whole = sorted(map(str, decontaminate.leaks(docs, bench).collect()))
    assert sorted(map(str, decontaminate.leaks(docs, bench, block_words=30).collect())) == whole


def test_leaks_of_nothing(spark):
    assert decontaminate.leaks(documents(spark, []), items(spark, bench_rows())).count() == 0
    assert decontaminate.leaks(documents(spark), items(spark, [])).count() == 0


def test_leaks_sql_agrees(spark):
    docs = [r for r in leaky_rows() if r[0] is not None and r[1] is not None and "\x00" not in r[1] and len(r[1]) < 20_000]
    docs = list(dict(docs).items())
    bench = list(dict(bench_rows()).items())
    cols = ["doc_id", "item_id", "item_words", "matched_words", "window_words", "first_word"]
    got = sorted(tuple(r) for r in decontaminate.leaks(documents(spark, docs), items(spark, bench)).select(*cols).collect())
    cur = duck(docs, bench).execute(decontaminate.leaks_sql())
    names = [d[0] for d in cur.description]
    assert got == sorted(tuple(r[names.index(c)] for c in cols) for r in cur.fetchall())


@pytest.mark.parametrize("name", ["scan", "leaks"])
def test_native_plans(spark, name):
    df = licenses.scan(documents(spark)) if name == "scan" else decontaminate.leaks(documents(spark), items(spark, bench_rows()))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_every_pattern_within_the_threshold_holds_a_seed():
    for agree in (0.8, 0.9, 1.0):
        for width in range(1, 14):
            differing = width - math.ceil(agree * width)
            assert not decontaminate.missed(decontaminate.masks_for(width, agree), width, differing), (width, agree)
    assert decontaminate.masks_for(13) == decontaminate.MASKS and len(decontaminate.masks_for(3)[0]) == 3


def whole_leaks(docs, bench, window=13, agree=0.8):
    """As ``brute_leaks``, texts and items of any length."""
    out = set()
    for i, t in docs:
        d = plain(t)
        for item, b in bench:
            w = plain(b)
            n = min(window, len(w))
            for shift in range(-len(w), len(d)) if w else ():
                same = [0 <= shift + j < len(d) and d[shift + j] == w[j] for j in range(len(w))]
                if any(sum(same[s:s + n]) >= math.ceil(agree * n) for s in range(len(w) - n + 1)):
                    out.add((i, item))
                    break
    return out


def test_all_exchanges_within_the_threshold_are_found(spark):
    text = [f"w{i}" for i in range(15)]
    bench = [(n, " ".join(f"i{n}w{j}" for j in range(n))) for n in range(1, 13)] + [(13, " ".join(text[:13])), (15, " ".join(text))]
    docs = [(n, f"before {b} after") for n, b in bench] + [(20 + n, b) for n, b in bench]
    for n, (item, b) in enumerate(bench):
        for k, out in enumerate(combinations(range(len(b.split())), 3 if item == 15 else 2 if item > 9 else 1)):
            docs.append((1000 * (n + 1) + k, " ".join("x" if j in out else w for j, w in enumerate(b.split()))))
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(documents(spark, docs), items(spark, bench)).collect()}
    assert got == whole_leaks(docs, bench)
    assert {(8, 8), (9, 9), (28, 8), (29, 9), (3, 3)} <= got and len([p for p in got if p[0] >= 13_000 and p[1] == 13]) >= 78


def test_full_texts_notices_and_owner_lines(spark):
    full = dict(licenses._full_texts()[::2])
    gnu = next(t for i, t in licenses._gnu_notices() if i == "GPL-3.0" and "see <http" in t and "later" in t)
    wrapped = MIT.replace("The above copyright notice", "The above\ncopyright notice").replace("authors or copyright", "authors or\ncopyright")
    some = [(i, tag, text) for i, (tag, text) in enumerate(sorted(licenses._full_texts()))]
    some += [(100 + i, tag, " \n * ".join(text.split("\n"))) for i, (tag, text) in enumerate(sorted(full.items()))]
    some += [(201, "GPL-3.0", "# Copyright 2020 A\n#\n" + re.sub("(.{60} )", r"\1\n# ", gnu).replace("http:", "https:")),
             (202, "MPL-2.0", "/* " + re.sub("(.{60} )", r"\1\n * ", licenses._MPL_NOTICE) + " */"),
             (203, "MIT", "Copyright (c) 2020 X Permission is hereby" + MIT.split("Permission is hereby", 1)[1]),
             (204, "MIT", "The MIT License (MIT) Copyright (c) 2020 X Y, Inc. " + MIT), (205, "MIT", wrapped),
             (206, "MIT", "# Copyright 2020 X\n" + MIT), (207, "MIT", " * Copyright (C) 2020 X\n * All rights reserved.\n * " + MIT),
             (208, "MIT", "Copyright The X Authors\n" + MIT), (209, None, MIT.replace("the following", "no")), (210, None, "(c) you may")]
    got = {(r.doc_id, r.license_id) for r in licenses.scan(documents(spark, [(i, t) for i, _, t in some])).where("unit = 'text'").collect()}
    assert got == {(i, tag) for i, tag, _ in some if tag}


def test_hits_leave_a_long_document_without_its_text(spark):
    """What is joined with the items' texts holds the words beside an item, not all of a document's hashes."""
    plan = decontaminate.leaks(documents(spark), items(spark, bench_rows()))._jdf.queryExecution().optimizedPlan().toString()
    after = [line for line in plan.split("\n") if re.search(r"Project \[.*\bat#", line) and "item_at" in line]
    assert after and all("slice(" in line and not re.search(r"[\[,] ?hashes#\d+[,\]]", line) for line in after)


def test_a_long_document_full_of_items_and_copies_of_items(spark):
    some = bench_rows()
    text = " ".join(t for _, t in some if t)
    bench = [(n + 1000 * c, t) for c in range(3) for n, t in some if n is not None]
    docs = [(1, " ".join([text] * 20)), (2, text)]
    got = {(r.doc_id, r.item_id): r[2:] for r in decontaminate.leaks(documents(spark, docs), items(spark, bench)).collect()}
    assert brute_leaks(docs, bench) <= set(got) and {n // 1000 for _, n in got} == {0, 1, 2}
    assert all(v == got[d, n % 1000] for (d, n), v in got.items())

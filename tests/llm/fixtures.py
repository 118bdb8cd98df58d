"""Small tables with the awkward cases that every operator must take: nulls, empty and long texts, ties,
repeated rows, extra columns with clashing names."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = ("doc_id long, text string, key string, n long, k long, part int, block int, batch int, rank int, ids binary, "
          "kept boolean, list int, v string, u string, item string, seed long, text_hash long, good int, rest string")
EXTRA = ("x", 1, 2, 3, 4, 5, 6, b"q", True, 7, "v", "u", "item", 8, 9, 10, "r")
PASSAGE = " ".join(f"shared{i} words" for i in range(40))


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["alpha", "beta", "gamma", "Delta.", "the", "of", "réunion", "größe,", "x1"]) + str(rng.randrange(60))
                    for _ in range(n))


def rows() -> list[tuple[int | None, str | None]]:
    base = prose(1, 400)
    near = base.replace("alpha", "ALPHA", 1) + " tail"
    return [
        (1, base), (2, base), (3, near), (4, None), (5, ""), (6, "   \n\t "), (7, "one"), (8, "one two three"),
        (9, "One two THREE"), (10, prose(2, 30) + " " + PASSAGE + " " + prose(3, 30)), (11, PASSAGE + "\n" + prose(4, 20)),
        (12, prose(5, 50_000)), (13, "a b c d e f g h i j"), (14, "a b c d e f g h i j k"), (15, "ü" * 120), (16, "é" + "ü" * 119),
        (17, "word " * 3000), (17, "word " * 3000), (18, base), (18, "one two three"), (19, "日本語 テスト 👩‍👩‍👧 ́x"), (20, "\x00 nul \x7f"),
        (21, prose(6, 12)), (22, prose(6, 12) + " more"), (23, "line\r\nend\x0bof\x0ctext\x85next"), (None, base), (None, "lonely row"),
        (24, "z" * 5000), (25, "z" * 49), (26, "z" * 50 + "y"),
    ]


def documents(spark: SparkSession, some: list | None = None) -> DataFrame:
    return spark.createDataFrame([(*r, *EXTRA) for r in (rows() if some is None else some)], SCHEMA)

"""Small tables with every odd case: nulls, empty and long texts, ties, repeated rows, and further
columns whose names the operators use themselves."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, `row` string, spans string, "
    "text_key string, word string, `range` string, place string, kept string, shared string, n string, at string")

SECRET = 'api_key = "Zx81-nope"; token: "q9w8e7r6t5y4u3i2o1p0"'


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    syllables = ["ther", "on", "ing", "re", "ou", "ä", "é", "st", "and", "ly"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(words))


def texts() -> list[tuple[int | None, str | None]]:
    base = prose(1, 120)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    return [
        (1, base), (2, base), (3, near), (4, None), (5, ""), (6, ""), (7, prose(2, 3)), (8, prose(3, 40) + ".\n\n" + prose(4, 50)),
        (None, prose(5, 30)), (None, base), (9, prose(6, 25)), (9, prose(6, 25)), (10, SECRET), (11, f"see {SECRET} twice {SECRET}"),
        (12, prose(7, 9_000)), (13, "x" * 9_000), (14, "  \t\n "), (15, "Ünder THE MIT license, CC-BY-NC 4; cc by nc"),
        (16, "under under the mit license"), (17, "Licensed under the Apache License, Version 2.0."), (2**40, prose(8, 15)),
    ]


def table(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame(
        [(d, t, None if i % 5 == 0 else "en", None if i % 4 == 0 else f"org{i % 3}/repo{i % 2}", len(t or ""), *["x"] * 10)
         for i, (d, t) in enumerate(rows)], SCHEMA)

"""Spelling variants against brute force and SQL."""

import random
import re
import zlib
from collections import Counter

import pytest

import compare
import fixtures
from clickwell.llm import spelling

SF_DIR = "/root/testdata/sf0.001"


def distance_is_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def expected(rows):
    counts = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1:] if h % 97 == 0 else run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    near = {w: [o for o in n if distance_is_one(w, o)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return Counter((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def misspelt():
    """Families of words with one change after another, some with a common half, some very long."""
    rng, rows = random.Random(3), []
    heads = ["commo", "aaaaa", "ñandú", "x" * 90, "straße"]
    for doc in range(120):
        words = []
        for _ in range(60):
            w = list(rng.choice(heads) + "".join(rng.choices("abé", k=rng.randint(0, 4))))
            for _ in range(rng.choice([0, 0, 1, 2])):
                at = rng.randrange(len(w))
                rng.choice([lambda: w.pop(at), lambda: w.insert(at, "o"), lambda: w.__setitem__(at, "u")])()
            words.append("".join(w).title() if doc % 7 == 0 else "".join(w))
        rows.append((doc, rng.choice([" ", ", ", "×÷", "1"]).join(words)))
    return rows


@pytest.mark.parametrize("hot, parts", [(4096, 4), (3, 4), (0, 2)])
def test_variants_equal_brute_force(spark, monkeypatch, hot, parts):
    monkeypatch.setattr(spelling, "HOT", hot)
    monkeypatch.setattr(spelling, "PARTS", parts)
    given = [*fixtures.texts(), *misspelt(), (None, "commoa commoa commoa"), (500, "commoa" * 40_000)]
    got = Counter(tuple(r) for r in spelling.variants(fixtures.table(spark, given)).collect())
    want = expected(given)
    assert len(want) > 200 and any(root != form for _, form, root, *_ in want if form)
    assert got == want


def test_variants_of_nothing(spark):
    assert spelling.variants(fixtures.table(spark, [])).count() == 0
    assert spelling.variants(fixtures.table(spark, [(1, None), (2, ""), (3, "ab 12")])).count() == 0


def test_op12_equals_sql(spark):
    got = compare.spark_rows(spelling.op12_spelling(spark, SF_DIR))
    assert got == compare.oracle(SF_DIR, spelling.OP12_SQL)


def test_op12_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in spelling.op12_spelling(spark, SF_DIR).collect()) == expected(docs)

"""Language identification: features and sums against plain loops, accuracy on held-out rows."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import fixtures
from clickwell.llm import language


def plain_grams(word):
    line = b" " + word.encode() + b" "
    out = Counter()
    for n in language.GRAMS:
        for i in range(len(line) - n + 1):
            if n == 1 and i == len(line) - 1:
                continue  # the blank behind a word is that in front of the next one
            code = int.from_bytes(line[i:i + n], "big") + (n << 56)
            out[(code * 0x9E3779B97F4A7C15 % 2**64) >> (64 - language.BITS)] += 1
    return out


@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_grams_equal_plain_loops(monkeypatch, piece):
    monkeypatch.setattr(language, "PIECE", piece)
    words = ["a", "the", "straße", "x" * 40, "né"]
    got = [Counter() for _ in words]
    for word, feature in language.grams_of([w.encode() for w in words]):
        for w, f in zip(word, feature):
            got[w][f] += 1
    want = [plain_grams(w) for w in words]
    assert [+g for g in got] == want


def test_text_values_are_sums_over_words(monkeypatch):
    monkeypatch.setattr(language, "CACHE_WORDS", 3)
    weights = np.random.default_rng(1).normal(size=(2, language.FEATURES)).astype(np.float32)
    values = language.Values(weights)
    texts = ["The cat, the CAT", "", "12 ½ _", "ñu " + "z" * 300, "one two three four the cat"]
    for _ in range(2):
        sums = values.sums(texts)
        for text, row in zip(texts, sums):
            grams = Counter()
            for w in re.findall(r"[^\W\d_]+", text.lower()):
                grams += plain_grams(w)
            want = [sum(n * w[f] for f, n in grams.items()) for w in weights]
            assert np.allclose(row[:2], want, atol=1e-2) and row[2] == sum(grams.values())
            assert (row[3] > 0) == any(map(str.isalpha, text))


def test_support_vector_machine_is_the_minimum():
    rng = np.random.default_rng(2)
    rows = [np.sort(rng.choice(50, 8, replace=False)) for _ in range(60)]
    side = np.where([r.mean() > 24 for r in rows], 1.0, -1.0)
    starts = np.arange(0, 481, 8)
    w = language.fit(np.concatenate(rows), np.ones(480), starts, side)
    loss = lambda v: v @ v / 2 + language.COST * sum(max(0, 1 - s * v[r].sum() / np.sqrt(8))**2 for r, s in zip(rows, side))
    # Up to the scale, which the fit sets.
    best = min((loss(w * c), c) for c in np.geomspace(1e-3, 1e3, 4000))
    around = [loss(w * best[1] + rng.normal(scale=0.02, size=language.FEATURES) * (np.arange(language.FEATURES) < 50)) for _ in range(50)]
    assert best[0] <= min(around)


def test_families_join_the_likest():
    a, b, c, d = np.eye(4)
    unit = lambda v: v / np.linalg.norm(v)
    found = language.families_of({"w": a, "x": unit(c + d), "y": unit(a + 0.2 * b), "z": d})
    assert found == [["w", "y"], ["x", "z"]]
    assert language.families_of({"w": a}) == [["w"]] and language.families_of({}) == []


def mixed(rows=240):
    words = {"aa": "the and of with thing", "ab": "the und of mit thing", "ba": "que los una casa", "bb": "que les une maison"}
    out = []
    for i in range(rows):
        lang = ("aa", "ab", "ba", "bb")[i % 4]
        rng = np.random.default_rng(i)
        out.append((i, " ".join(rng.choice(words[lang].split(), 12)), lang))
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows],
                                 "doc_id bigint, text string, lang string, score string, lang_pred string, rank int")


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_odd_rows(spark):
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 ½ !", None), (None, "que les une", "bb"), (1003, "the und", None),
           (1004, "zz" * 5_000, None), (1006, "the and", "aa"), (1006, "the and", "aa"), (1005, "the of and with " * 50_000, None)]
    given = [*mixed(), *odd]
    got = language.identify(table(spark, given)).collect()
    assert len(got) == len(given) and all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert by_id[None].lang_pred == "bb" and by_id[1005].lang_pred == "aa"
    known = {d: lang for d, _, lang in mixed()}
    assert all(by_id[d].lang_pred == lang for d, lang in known.items() if held(d))


def test_held_out_rows_teach_nothing(spark):
    rows = mixed()
    lies = [(d, t, "zz" if held(d) or d is None else lang) for d, t, lang in [*rows, (None, "the", "qq")]]
    one = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(table(spark, [*rows, (None, "the", "aa")])).collect()}
    two = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(table(spark, lies)).collect()}
    assert one == two


@pytest.mark.parametrize("langs, want", [([], {"und"}), (["aa"], {"aa", "und"}), (["aa", "ba"], {"aa", "ba", "und"})])
def test_few_languages(spark, langs, want):
    rows = [(d, t, lang if lang in langs else None) for d, t, lang in mixed(80)] + [(999, "7", None)]
    assert {r.lang_pred for r in language.identify(table(spark, rows)).collect()} == want


def test_of_nothing(spark):
    assert language.identify(table(spark, [])).count() == 0
    assert language.identify(fixtures.table(spark)).count() == len(fixtures.texts())


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    right = language.op13_language(spark, sf_dir).join(docs, "doc_id").where("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right[0] > 0.98 and 0 <= right[1] <= right[2] <= 1

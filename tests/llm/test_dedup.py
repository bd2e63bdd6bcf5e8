"""Exact and near dedup against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import compare
import fixtures
from clickwell.llm import exact_dedup, near_dedup

SF_DIR = "/root/testdata/sf0.001"


def exact_expected(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    best = {t: max(ids, key=lambda d: (d is not None, d or 0)) for t, ids in groups.items()}
    return Counter((d, best[t or ""], len(groups[t or ""])) for d, t in rows), len(groups)


@pytest.mark.parametrize("historical", ["false", "true", "doc_id < 6", "cast(null AS boolean)"])
def test_exact_dedup_of_odd_rows(spark, historical):
    rows = exact_dedup.dedup(fixtures.table(spark), F.expr(historical)).collect()
    want, groups = exact_expected(fixtures.texts())
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in rows) == want
    assert sum(r.kept for r in rows) == groups
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_exact_dedup_of_nothing(spark):
    empty = fixtures.table(spark, [])
    assert exact_dedup.dedup(empty, exact_dedup.earlier_half(empty)).count() == 0


def test_perfect_hash_is_minimal():
    words = np.random.default_rng(1).integers(0, 2**63, (5_000, 4)).astype(np.uint64)
    sizes, bits = exact_dedup.build_hash(words)
    assert sorted(exact_dedup.slots_of(words, sizes, bits)) == list(range(5_000))
    with pytest.raises(ValueError):
        exact_dedup.build_hash(np.concatenate([words, words[:1]]))


def test_op3_equals_sql(spark):
    got = compare.spark_rows(exact_dedup.op3_exact_dedup(spark, SF_DIR))
    assert got == compare.oracle(SF_DIR, exact_dedup.OP3_SQL)


def bag(text):
    words = (text or "").lower().split()
    return Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def near_expected(rows):
    """The set of row numbers of each class, by comparing all pairs."""
    texts = sorted({t or "" for _, t in rows})
    head = {t: t for t in texts}

    def root(t):
        while head[t] != t:
            t = head[t]
        return t

    bags = {t: bag(t) for t in texts}
    for i, a in enumerate(texts):
        for b in texts[:i]:
            shared = sum((bags[a] & bags[b]).values())
            if shared and shared >= 0.8 * (sum(bags[a].values()) + sum(bags[b].values()) - shared) - 1e-9:
                head[root(a)] = root(b)
    groups = {}
    for d, t in rows:
        groups.setdefault(root(t or ""), []).append(d)
    best = {r: max(ids, key=lambda d: (d is not None, d or 0)) for r, ids in groups.items()}
    return Counter((d, best[root(t or "")], len(groups[root(t or "")])) for d, t in rows), len(groups)


def copies():
    """A chain of near copies, longer than several blocks, and multisets that differ in counts."""
    words = fixtures.prose(9, 200).split()
    chain = []
    for i in range(24):
        words = [*words[:8 * i], f"new{i}", *words[8 * i + 1:]]
        chain.append((100 + i, " ".join(words)))
    loop = "one two three four five "
    return [*chain, (200, loop * 40), (201, loop * 44), (202, loop * 70)]


@pytest.mark.parametrize("block", [256, 4])
def test_near_dedup_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    given = [*fixtures.texts(), *copies()]
    rows = near_dedup.group(fixtures.table(spark, given)).collect()
    want, groups = near_expected(given)
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in rows) == want
    assert sum(r.kept for r in rows) == groups


def half_alike(n):
    """Texts of one frame with a few words each of their own: some pairs link, most that share a
    band do not; and a group of near copies beside them."""
    rng = random.Random(5)
    frame = fixtures.prose(40, 150).split()
    rows = []
    for i in range(n):
        words = list(frame)
        for at in rng.sample(range(150), 1 if i % 3 == 0 else 3):
            words[at] = f"own{i}x{at}"
        rows.append((1_000 + i, " ".join(words)))
    return rows


@pytest.mark.parametrize("way", ["cheaper", "blocks", "bands"])
def test_both_ways_to_compare_components_give_the_same(spark, monkeypatch, way):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "EARLY", 2)
    whole, used = near_dedup.by_component, []

    def forced(late):
        met, rest = whole(late)
        used.append((met.count(), rest.count()))
        if way == "bands":
            return met.limit(0), late.drop("a")
        return met, rest

    monkeypatch.setattr(near_dedup, "by_component", forced)
    if way == "blocks":
        monkeypatch.setattr(near_dedup, "BAND_COST", 10**6)
    given = [*half_alike(90), *copies()]
    rows = near_dedup.group(fixtures.table(spark, given)).collect()
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in rows) == near_expected(given)[0]
    assert way != "blocks" or used[0][0] > 0 and used[0][1] == 0


def test_near_copies_meet_their_buckets_in_the_early_bands_only(spark, monkeypatch):
    n, written, made = 60, near_dedup.common.written, []

    def counted(rows, name):
        done = written(rows, name)
        if name in ("buckets", "late", "mixed"):
            made.append(done.count())
        return done

    monkeypatch.setattr(near_dedup.common, "written", counted)
    words = fixtures.prose(60, 400).split()
    given = [(i, " ".join([*words[:6 * i], f"own{i}", *words[6 * i + 1:]])) for i in range(n)]
    rows = near_dedup.group(fixtures.table(spark, given)).collect()
    assert {(r.class_id, r.class_size) for r in rows} == {(n - 1, n)}
    assert sum(made) <= n * near_dedup.EARLY


def test_near_dedup_of_nothing(spark):
    assert near_dedup.group(fixtures.table(spark, [])).count() == 0


def test_signatures_estimate_weighted_similarity():
    loop, errors = "a b c d e f g ", []
    for seed in range(20):
        one, two = loop * 20 + fixtures.prose(seed, 60), loop * (14 + seed % 5) + fixtures.prose(seed, 45)
        text, shingle = near_dedup.shingles_of([one, two])
        registers = near_dedup.signatures(text, shingle, 2)
        a, b = bag(one), bag(two)
        shared = sum((a & b).values())
        errors.append((registers[0] == registers[1]).mean() - shared / (sum(a.values()) + sum(b.values()) - shared))
    assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 0.2


def test_op9_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = near_dedup.op9_near_dedup(spark, SF_DIR).collect()
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in rows) == near_expected([tuple(d) for d in docs])[0]


def test_pairs_at_the_threshold_share_a_band():
    # Chance of no common band: over the number of equal registers, weighted by its own chance.
    size, rng, missed = near_dedup.SIGNATURE, np.random.default_rng(1), 0.0
    for equal in range(size // 2, size, 2):
        agree = rng.permuted(np.tile(np.arange(size) < equal, (1_000, 1)), axis=1)
        none = np.ones(len(agree), bool)
        for band in near_dedup.MEMBERS:
            none &= ~agree[:, band].all(axis=1)
        missed += none.mean() * sum(
            math.comb(size, n) * near_dedup.SIMILARITY**n * (1 - near_dedup.SIMILARITY)**(size - n) for n in (equal, equal + 1))
    assert missed < 1e-6

"""The conversation trie against brute force and SQL."""

import hashlib
import zlib
from collections import Counter

import pytest

import compare
from clickwell.llm import prefix_trie

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = ("conv_id bigint, turn bigint, role string, text string, i bigint, cell string, id string, block string, "
          "a string, key_a string, depth string, bytes string")


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, *["x"] * 7) for r in rows], SCHEMA)


def expected(rows):
    said = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            key = (turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest())
            said.setdefault(conv, []).append((key, (role or "", text or "")))
    said = {c: [t for _, t in sorted(ts)] for c, ts in said.items()}
    paths = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(said.get(c - c % 5, [])[:h] + said[c][h:])
    members = {}
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members.setdefault(paths[c][:d], []).append(c)
    out = Counter()
    for node, of in members.items():
        below = [n for n in members if n[:len(node)] == node]
        childless = [n for n in below if not any(len(m) == len(n) + 1 and m[:-1] == n for m in members)]
        ends = ",".join(str(c) for c in of if paths[c] == node)
        out[(of[0], len(node), members[node[:-1]][0] if node else None, len(of),
             sum(len(m) == len(node) + 1 for m in below), len(childless),
             sum((len(members[n]) - 1) * len(n[-1][1].encode()) if n else 0 for n in below),
             hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def odd_rows():
    rows = [(None, 1, "user", "nobody's"), (3, None, None, None), (3, None, "user", "ä"), (3, 1, "user", "same"), (3, 1, "user", "same")]
    for c in range(10, 60):
        rows += [(c, t, "user" if t % 2 else "bot", f"line {t if t < c % 11 else c % 3 + t}") for t in range(c % 14)]
    rows += [(c, t, "user", f"copy {t}") for c in (70, 75, 80, 1000, 10**12) for t in range(12)]
    rows += [(200, t, "bot", f"long {t}" * (t % 3)) for t in range(60)] + [(201, t, "bot", "é" * 3000) for t in (0, 5)]
    return rows + [(205, t, "bot", f"long {t}" * (t % 3)) for t in range(47)]


@pytest.mark.parametrize("block, cell", [(4, 1024), (1, 4), (3, 7)])
def test_trie_equals_brute_force(spark, monkeypatch, block, cell):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "CELL", cell)
    rows = odd_rows()
    got = Counter(tuple(r) for r in prefix_trie.trie(table(spark, rows)).collect())
    assert got == expected(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.trie(table(spark, [])).count() == 0


def test_turnless_conversations_are_members_of_the_root(spark):
    # With all of its few turns replaced by those of an absent conversation nothing is left.
    lone = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(lone, 1, "user", "a"), (lone, 2, "bot", "b")]
    got = prefix_trie.trie(table(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == expected(rows) and len(got) == 1


def test_op11_equals_sql(spark):
    got = compare.spark_rows(prefix_trie.op11_prefix_trie(spark, SF_DIR))
    assert got == compare.oracle(SF_DIR, prefix_trie.OP11_SQL)

"""Exact dedup by a minimal perfect hash over the digests of an earlier corpus.

The distinct digests of the historical rows are dealt into buckets of bounded size. Each bucket
gets a minimal perfect hash (a cascade of bit arrays, each holding the digests that were alone in
their bit; the rank of its bit is a digest's slot). A slot holds the full digest, the locator of
the winning row, and how many rows share it. New rows are grouped by digest first, so a text that
a third of all rows share reaches its bucket as one row. A lookup compares all 32 bytes of the
slot: members take part in the slot's contest, the others form groups of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickwell.llm import common

DIGESTS_PER_BUCKET = 50_000
BITS_PER_DIGEST = 2
MAX_LEVELS = 64

GROUPS = "digest binary, win_id bigint, win_row bigint, n bigint"
INDEX = "bucket bigint, sizes array<bigint>, bits binary, digests binary, win_ids array<bigint>, win_rows array<bigint>, counts array<bigint>"


def words_of(digests: list[bytes]) -> np.ndarray:
    """Digests of 32 bytes as rows of four unsigned numbers."""
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)


def mixed(words: np.ndarray, level: int) -> np.ndarray:
    """A hash of the whole digest for one level."""
    odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], dtype=np.uint64)
    h = (words * (odd + np.uint64(2 * level))).sum(axis=1, dtype=np.uint64)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def build_hash(words: np.ndarray) -> tuple[list[int], bytes]:
    """Level sizes in bits, and the bit arrays one after another."""
    sizes, parts, left = [], [], words
    for level in range(MAX_LEVELS):
        if not len(left):
            return sizes, b"".join(parts)
        size = max(8, -(-BITS_PER_DIGEST * len(left) // 8) * 8)
        place = (mixed(left, level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        sizes.append(size)
        parts.append(np.packbits(alone, bitorder="little").tobytes())
        left = left[~alone[place]]
    raise ValueError("digests that repeat cannot be hashed perfectly")


def slots_of(words: np.ndarray, sizes: list[int], bits: bytes) -> np.ndarray:
    """The slot of each digest; -1 where no level knows it. Strangers may get a slot too."""
    slot = np.full(len(words), -1, dtype=np.int64)
    flags = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), bitorder="little")
    rank = np.cumsum(flags, dtype=np.int64) - flags
    base = 0
    for level, size in enumerate(sizes):
        open_ = np.flatnonzero(slot < 0)
        if not len(open_):
            break
        place = base + (mixed(words[open_], level) % np.uint64(size)).astype(np.int64)
        hit = flags[place] == 1
        slot[open_[hit]] = rank[place[hit]]
        base += size
    return slot


def index_bucket(key: tuple, groups: pa.Table) -> pa.Table:
    digests = groups["digest"].to_pylist()
    words = words_of(digests)
    sizes, bits = build_hash(words)
    order = np.argsort(slots_of(words, sizes, bits))
    at = pa.array(order)
    return pa.table({
        "bucket": pa.array([key[0].as_py()], pa.int64()),
        "sizes": pa.array([sizes], pa.list_(pa.int64())),
        "bits": pa.array([bits], pa.binary()),
        "digests": pa.array([words[order].tobytes()], pa.binary()),
        "win_ids": pa.array([groups["win_id"].take(at).to_pylist()], pa.list_(pa.int64())),
        "win_rows": pa.array([groups["win_row"].take(at).to_pylist()], pa.list_(pa.int64())),
        "counts": pa.array([groups["n"].take(at).to_pylist()], pa.list_(pa.int64())),
    })


def later(ours: tuple, theirs: tuple) -> bool:
    """Whether the first locator (id, row) wins; a null id ranks below every id."""
    return (ours[0] is not None, ours[0] or 0, ours[1]) > (theirs[0] is not None, theirs[0] or 0, theirs[1])


def probe_bucket(fresh: pa.Table, index: pa.Table) -> pa.Table:
    """Historical slots with new members counted in, then groups of digests the index lacks."""
    digests = fresh["digest"].to_pylist()
    ids, rows, counts = (fresh[c].to_pylist() for c in ("win_id", "win_row", "n"))
    out: list[tuple] = []
    strangers = range(len(digests))
    if index.num_rows:
        old = index.to_pylist()[0]
        held = words_of([old["digests"]])
        win = list(zip(old["win_ids"], old["win_rows"]))
        total = old["counts"]
        asked = words_of(digests)
        slot = slots_of(asked, old["sizes"], old["bits"])
        member = slot >= 0
        member[member] = (held[slot[member]] == asked[member]).all(axis=1)
        for i in np.flatnonzero(member):
            s = slot[i]
            total[s] += counts[i]
            if later((ids[i], rows[i]), win[s]):
                win[s] = (ids[i], rows[i])
        raw = held.tobytes()
        out = [(raw[32 * s:32 * s + 32], *win[s], total[s]) for s in range(len(win))]
        strangers = np.flatnonzero(~member)
    out += [(digests[i], ids[i], rows[i], counts[i]) for i in strangers]
    columns = list(zip(*out)) or [(), (), (), ()]
    kinds = (("digest", pa.binary()), ("win_id", pa.int64()), ("win_row", pa.int64()), ("n", pa.int64()))
    return pa.table({name: pa.array(values, kind) for (name, kind), values in zip(kinds, columns)})


def by_digest(rows: DataFrame, buckets: int) -> DataFrame:
    """One row per distinct digest with the locator of its winner: the largest id."""
    return rows.groupBy("digest").agg(
        F.max(F.struct("doc_id", "row")).alias("win"), F.count("*").alias("n"),
    ).select(
        F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket"), "digest",
        F.col("win.doc_id").alias("win_id"), F.col("win.row").alias("win_row"), "n")


def build_index(rows: DataFrame, buckets: int) -> DataFrame:
    """The perfect hash and its slots, one row per bucket of historical digests."""
    return common.written(by_digest(rows, buckets).groupBy("bucket").applyInArrow(index_bucket, INDEX), "mph")


def dedup(docs: DataFrame, historical: Column) -> DataFrame:
    """Which rows repeat a text: one row per row of `docs`, with (doc_id, keep_id, group_size,
    kept, text_sha256, historical).

    `historical` marks the rows the index is built from; null counts as new. Texts are equal when
    identical, a null text is empty. Of equal texts the row with the largest doc_id stays, a null
    doc_id ranks lowest, and of rows equal in both exactly one stays. Other columns are not read,
    so their names do not matter. An empty table gives no rows.
    """
    digests = common.written(docs.select(
        common.row_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.unhex(F.sha2(common.text_of(), 256)).alias("digest"),
        F.coalesce(historical, F.lit(False)).alias("old")), "digests")
    buckets = max(1, -(-digests.count() // DIGESTS_PER_BUCKET))
    index = build_index(digests.where("old"), buckets)
    fresh = by_digest(digests.where("NOT old"), buckets)
    groups = fresh.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(probe_bucket, GROUPS)
    # A row alone in its group is its own winner: only repeated digests are joined back.
    shared = groups.where("n > 1").withColumnRenamed("digest", "shared")
    winner = F.coalesce(F.col("win_row"), F.col("row"))
    return digests.join(shared, digests["digest"] == shared["shared"], "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("win_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        (winner == F.col("row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), F.col("old").alias("historical"))


def earlier_half(docs: DataFrame) -> Column:
    """Ids up to the middle of their range stand for the earlier corpus."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    return F.col("doc_id") <= F.lit(((low or 0) + (high or 0)) // 2)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return dedup(docs, earlier_half(docs)).drop("historical")


OP3_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""

"""Hierarchical packing of documents into windows of several context sizes.

Each task streams its documents through a pool of bounded size. Full windows of the longest size
are cut off long documents; what is left of each document is routed to the shortest tier that
holds it. Windows are opened from the longest tier down, each seeded with the longest document
left in it; its gap is filled with the longest documents of the shorter tiers that fit, and
closed by cutting one that does not. What cannot fill a window waits for the next pool. Windows
are dealt to step groups so that each group has about the same number of tokens.

Nothing is shuffled: a task needs its own documents only, and a retried task packs them alike.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickwell.llm import common, encoding

TIERS = (512, 1024, 2048, 4096)
POOL_TOKENS = 2_000_000
STEP_TOKENS = 65_536
END_ID = 2

PIECE_SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, tier bigint, step_group bigint"

class Words(encoding.Words):
    """As the vocabulary is one of lower case, a word is looked up in lower case (of A-Z only)
    before the library is asked."""

    def made(self, word: str) -> bytes:
        lower = word.lower() if word.isascii() else word
        return self[lower] if lower != word else super().made(word)


_words: dict[str, Words] = {}


def encode_text(path: str, text: str) -> bytes:
    """The ids of a whole text: word by word unless rare white space stands in it."""
    words = _words.get(path)
    if words is None:
        words = _words[path] = Words(encoding.ids_by(path))
    encoding.only(words)
    if encoding.RARE_SPACE.search(text):
        return np.array(words.encode(text), dtype="<u4").tobytes()
    return b"".join([words[w] for w in text.split()])


class Packer:
    """Packs a stream of (doc_id, ids); one per task."""

    def __init__(self, task: int, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS):
        self.tiers, self.longest, self.step_tokens = tiers, tiers[-1], step_tokens
        self.base = task << 32
        self.sequences = self.groups = 0
        self.items: list[tuple[int, int, int]] = []  # (length, piece number, start), sorted
        self.docs: list[tuple[int | None, np.ndarray]] = []
        self.full: list[list[tuple[int, int, int]]] = []
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        number = len(self.docs)
        self.docs.append((doc_id, ids))
        self.held += len(ids)
        whole = len(ids) // self.longest * self.longest
        self.full += [[(self.longest, number, at)] for at in range(0, whole, self.longest)]
        if len(ids) > whole:
            self.items.append((len(ids) - whole, number, whole))

    def fill(self, size: int) -> list[tuple[int, int, int]]:
        """One window of a tier: the longest item that the tier holds, then the longest that fit,
        then part of one that does not. May stay short when items run out."""
        window, gap = [], size
        while gap and self.items:
            at = bisect_right(self.items, (gap, 1 << 62, 0)) - 1
            if at >= 0:
                piece = self.items.pop(at)
                window.append(piece)
                gap -= piece[0]
            else:
                length, number, start = self.items.pop(0)
                window.append((gap, number, start))
                insort(self.items, (length - gap, number, start + gap))
                gap = 0
        return window

    def windows(self, last: bool) -> list[tuple[int, list]]:
        """The pool's windows, longest tier first; documents left over stay unless `last`."""
        self.items.sort()
        out = [(self.longest, window) for window in self.full]
        self.full = []
        left = sum(item[0] for item in self.items)
        for low, size in zip((*reversed(self.tiers[:-1]), 0), reversed(self.tiers)):
            while self.items and self.items[-1][0] > low and left >= size:
                out.append((size, self.fill(size)))
                left -= size
        if last:
            size = self.longest
            while left:
                if left >= size:
                    out.append((size, self.fill(size)))
                    left -= size
                else:
                    size //= 2
        return out

    def flush(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        windows = self.windows(last)
        groups = max(1, -(-sum(size for size, _ in windows) // self.step_tokens))
        loads = [(0, g) for g in range(groups)]
        rows: list[tuple] = []
        for size, window in windows:
            load, group = heapq.heappop(loads)
            heapq.heappush(loads, (load + size, group))
            offset = 0
            for length, number, start in window:
                doc_id, ids = self.docs[number]
                rows.append((doc_id, start, length, ids[start:start + length].tobytes(), len(ids),
                             self.base + self.sequences, offset, size, self.base + self.groups + group))
                offset += length
            self.sequences += 1
        self.groups += groups
        # Only documents with pieces still to place are kept.
        keep = {number: i for i, number in enumerate(sorted({number for _, number, _ in self.items}))}
        self.items = [(length, keep[number], start) for length, number, start in self.items]
        self.docs = [self.docs[number] for number in keep]
        self.held = sum(item[0] for item in self.items)
        names = [f.split()[0] for f in PIECE_SCHEMA.split(", ")]
        for at in range(0, len(rows), 5_000):
            columns = zip(*rows[at:at + 5_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary() if name == "ids" else pa.int64()) for name, c in zip(names, columns)], names)


def pack(docs: DataFrame, path: str, pool_tokens: int = POOL_TOKENS) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, ids (32-bit little-endian), doc_tokens,
    sequence_id, offset, tier, step_group.

    A document is its text's ids and an end id, so null and empty texts are one token. Each id is
    in exactly one piece; repeated rows and null ids are documents like others. A sequence is as
    long as its tier, a power of two, so none needs padding; the last few of a task (at most one
    of each size) are of shorter tiers than TIERS has. Texts of any length are streamed into windows; other columns are not read. An
    empty table gives no rows.
    """
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId())
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc_id, np.frombuffer(encode_text(path, text.as_py()) + end, dtype="<u4"))
                if packer.held >= pool_tokens:
                    yield from packer.flush()
        yield from packer.flush(last=True)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), common.text_of().alias("text")).mapInArrow(run, PIECE_SCHEMA)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "tier", "step_group")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_packing(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return digests(pack(common.table(spark, sf_dir, "documents"), path or default_path()))

"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are hashes of its words, of pairs of neighbouring words, of pairs with one word
between them, and of the beginnings of words (inflected forms share them); a beginning that
occurs again counts as a feature of its own. Features are made in parallel; FTRL-proximal itself
is a sequence of steps and runs in one task over a bounded sample of the labelled rows. Each
coordinate has its own rate, and L1 leaves most weights zero. The weights that are not zero (some
hundreds, at most FEATURES) are sent to the tasks that score.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickwell.llm import common
from clickwell.llm.encoding import CACHE_WORDS, only

BITS = 20
FEATURES = 1 << BITS
STEMS = (4, 6)
TRAIN_ROWS = 16_000  # most labelled rows that are learned from: the bound of the sample
ROUNDS = 5
ALPHA, BETA, L1, L2 = 0.5, 1.0, 10.0, 1.0
THRESHOLD = 0.3

WORDS = re.compile(r"[^\W_]+")

class Vocabulary(dict):
    """Word -> row of `parts`: hashes of the word and of its beginnings, 0 for a beginning that
    the word does not go beyond. Forgets all when full."""

    def __init__(self) -> None:
        super().__init__()
        self.parts = array("q")

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self.parts) // (1 + len(STEMS))
        self.parts.append(crc32(word.encode("utf-8", "replace")) + 1)
        self.parts.extend(crc32(f"{n}:{word[:n]}".encode("utf-8", "replace")) + 1 if len(word) > n else 0 for n in STEMS)
        return row

    def forget(self) -> None:
        self.clear()
        self.parts = array("q")

    def rows(self, words: list[str]) -> np.ndarray:
        only(self)
        if len(self) > CACHE_WORDS:
            self.forget()
        at = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        return np.array(self.parts, dtype=np.int64).reshape(-1, 1 + len(STEMS))[at] if len(at) else np.zeros((0, 1 + len(STEMS)), dtype=np.int64)


_vocabulary = Vocabulary()


def scatter(hashes: np.ndarray, kind: int) -> np.ndarray:
    """Hashes of one kind of feature, spread over the index range."""
    h = hashes.astype(np.uint64) + np.uint64(kind << 40)
    h *= np.uint64(0x9E3779B97F4A7C15)
    return (((h ^ (h >> np.uint64(31))) >> np.uint64(17)) & np.uint64(FEATURES - 1)).astype(np.int64)


def again(feature: np.ndarray) -> np.ndarray:
    """The index that stands for a beginning's second occurrence."""
    return (feature * 0x5851F42D + 0x14057B7F) & (FEATURES - 1)


def features_of(texts: list[str], weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of whole texts, distinct and in order; with `weights`, those that
    have one."""
    words = [WORDS.findall(t.lower()) for t in texts]
    parts = _vocabulary.rows([w for own in words for w in own])
    doc = np.repeat(np.arange(len(words)), [len(own) for own in words])
    plain = [(doc, scatter(parts[:, 0], 0))]
    for gap, (a, b) in ((1, (3, 0x9E3779B1)), (2, (5, 0x85EBCA77))):
        same = doc[gap:] == doc[:-gap]
        plain.append((doc[gap:][same], scatter((parts[:-gap, 0] * a + parts[gap:, 0] * b)[same], gap)))
    stems = []
    for kind, column in enumerate(parts[:, 1:].T):
        longer = column > 0
        stems.append((doc[longer], scatter(column[longer], 3 + kind)))
    if weights is not None:
        has = weights != 0
        plain = [(d[has[f]], f[has[f]]) for d, f in plain]
        either = [has[f] | has[again(f)] for _, f in stems]
        stems = [(d[e], f[e]) for (d, f), e in zip(stems, either)]
    keys = [(d << BITS) | f for d, f in plain]
    for d, f in stems:
        once, counts = np.unique((d << BITS) | f, return_counts=True)
        more = once[counts > 1]
        keys += [once, (more >> BITS << BITS) | again(more & (FEATURES - 1))]
    found = np.unique(np.concatenate(keys))
    return found >> BITS, found & (FEATURES - 1)


def blocks(texts: pa.Array, chars: int = 1_000_000) -> Iterator[list[str]]:
    """The texts of a batch in blocks of bounded size."""
    block, size = [], 0
    for t in texts:
        block.append(t.as_py())
        size += len(block[-1])
        if size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def fit(flat: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights that are not zero, by FTRL-proximal over rows of features
    (row i has flat[starts[i]:starts[i + 1]]). The last place is the intercept."""
    z, n = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
    for round_ in range(ROUNDS):
        for i in np.random.default_rng(round_).permutation(len(labels)):
            at = np.append(flat[starts[i]:starts[i + 1]], FEATURES)
            zi, ni = z[at], n[at]
            w = weights_of(zi, ni, at == FEATURES)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[i]
            rate = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[at] = zi + g - rate * w
            n[at] = ni + g * g
    weights = weights_of(z, n, np.arange(FEATURES + 1) == FEATURES)
    place = np.flatnonzero(weights)
    return place, weights[place]


def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model from batches (doc_id, label, at), in their order. Features are copied into one array
    as they come, and each batch is let go: one copy is held, besides room to grow."""
    flat, n, lengths, labels = np.zeros(1 << 16, dtype=np.int32), 0, [], []
    for b in batches:
        own = b.column(2).flatten().to_numpy()
        if n + len(own) > len(flat):
            flat.resize(max(n + len(own), len(flat) + len(flat) // 4), refcheck=False)
        flat[n:n + len(own)] = own
        n += len(own)
        lengths.append(b.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        labels.append(b.column(1).to_numpy().copy())  # a view would hold the whole batch
        del own, b
    starts = np.append(0, np.cumsum(np.concatenate(lengths or [np.zeros(0, np.int64)])))
    place, weight = fit(flat, starts, np.concatenate(labels or [np.zeros(0, np.int32)]))
    yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(weight, pa.float64())], ["place", "weight"])


def weights_of(z: np.ndarray, n: np.ndarray, free: np.ndarray | bool) -> np.ndarray:
    """The weights that a state stands for; `free` places (the intercept) have no L1 penalty."""
    l1 = np.where(free, 0.0, L1)
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def train(docs: DataFrame, labels: DataFrame, usable: Column, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Indices and weights of the model, learned from the labelled rows that are `usable`.

    Of more than `rows` labelled ids, those with the smallest hash are taken: a bounded sample of
    the labels, which is all that the training task holds. An id labelled twice is toxic if one
    label says so; null labels do not count. Without labels all scores are a half.
    """
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("label")).where(usable)
    chosen = common.written(known.orderBy(F.xxhash64(F.lit("toxicity"), "doc_id"), "doc_id").limit(rows), "labelled")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for texts in blocks(b.column(2)):
                doc, feature = features_of(texts)
                found += np.split(feature.astype(np.int32), np.searchsorted(doc, np.arange(1, len(texts))))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "label", "at"])

    chosen = chosen.select(F.col("doc_id").alias("labelled_id"), "label")
    examples = common.written(docs.select("doc_id", common.text_of().alias("text")).join(
        chosen, F.col("doc_id") == F.col("labelled_id")).select(F.col("doc_id").cast("bigint"), "label", "text").mapInArrow(
        features, "doc_id bigint, label int, at array<int>"), "features")
    # One task, over at most `rows` rows (times the repeats of their ids), in a fixed order.
    model = examples.repartition(1).sortWithinPartitions("doc_id", "label").mapInArrow(
        learn, "place bigint, weight double").toArrow()
    return model["place"].to_numpy(), model["weight"].to_numpy().astype(np.float32)


def score(text: Column, model: tuple[np.ndarray, np.ndarray], spark: SparkSession) -> Column:
    """The probability of a whole text to be toxic; of an empty one, that of the intercept."""
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        place, weight = sent.value
        dense = np.zeros(FEATURES, dtype=np.float32)
        inner = place < FEATURES
        dense[place[inner]] = weight[inner]
        bias = float(weight[~inner].sum())
        sums = []
        for block in blocks(texts):
            doc, feature = features_of(block, dense)
            sums.append(bias + np.bincount(doc, dense[feature], minlength=len(block)))
        sums = np.concatenate(sums or [np.zeros(0)])
        return pa.array(1 / (1 + np.exp(-np.clip(sums, -35, 35))), pa.float64())

    return probability(text)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with _score (0 to 1). A null or empty text gets the score of a text without words,
    a null doc_id is scored but never learned from; repeated rows are scored alike. All columns
    of `docs` stay; only doc_id and text are read. An empty table gives no rows."""
    model = train(docs, labels, ~held_out(F.col("doc_id")))
    return docs.withColumn("_score", score(F.coalesce(docs["text"], F.lit("")), model, docs.sparkSession))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(docs, common.table(spark, sf_dir, "labels")).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))

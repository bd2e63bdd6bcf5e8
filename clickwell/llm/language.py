"""Language identification by hierarchical discrimination.

Languages are put into families by the likeness of their profiles (mean shares of hashed letter
grams): the two likest groups become one until about the square root of the number of languages is
left. A text is judged twice: first between families, then between the languages of the family that
won. Every judgement is a linear support vector machine for one pair (of families, or of languages
of one family); the one that wins most pairs is taken.

Examples are made in parallel, every pair is fitted in a task of its own over its bounded share of
the examples, and the weights are sent to the tasks that predict. A machine is linear in the counts
of grams and grams do not cross words, so each word has one value per pair and a text has their sum.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window

from clickwell.llm import common
from clickwell.llm.toxicity import blocks

EXAMPLES = 500  # most labelled rows of a language that are learned from: the bound of the sample
BITS = 14
FEATURES = 1 << BITS
GRAMS = (1, 2, 3, 4, 6)  # bytes of UTF-8, blanks around a word included
ROUNDS, COST = 10, 1.0
STEEPNESS = 3.0  # of the score, where a usual margin is 1
UNKNOWN = "und"

WORDS = re.compile(r"[^\W\d_]+")
WORD_BYTES = 64      # longer words are not remembered
CACHE_WORDS, CACHE_BYTES = 100_000, 16 << 20
PIECE = 1 << 20


def grams_of(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word number, feature) of all grams of the words, in pieces of bounded size."""
    line = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1)  # place of the blank behind each word
    for start in range(0, len(line) - 1, PIECE):
        part = line[start:start + PIECE + max(GRAMS)].astype(np.uint64)
        size = min(PIECE, len(line) - start)
        # The blank in front of a word belongs to it, as the one behind it does.
        word = np.searchsorted(ends, np.arange(start, start + size), side="right")
        code = np.zeros(size, dtype=np.uint64)
        for n in range(1, max(GRAMS) + 1):
            if n > len(part):
                break
            here = part[n - 1:n - 1 + size]
            code = (code[:len(here)] << np.uint64(8)) | here
            if n not in GRAMS:
                continue
            at = np.arange(start, start + len(here))
            own = word[:len(here)]
            inside = own < len(words)
            inside[inside] = at[inside] + n - 1 <= ends[own[inside]]
            h = (code[inside] + np.uint64(n << 56)) * np.uint64(0x9E3779B97F4A7C15)
            yield own[inside], (h >> np.uint64(64 - BITS)).astype(np.int64)


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, rank, and the counts of features of whole texts; texts without words have none."""
    for b in batches:
        at = 0
        for texts in blocks(b.column(2)):
            for text in texts:
                counts = np.zeros(FEATURES, dtype=np.int64)
                for _, feature in grams_of([w.encode("utf-8", "replace") for w in words_of(text)]):
                    counts += np.bincount(feature, minlength=FEATURES)
                place = np.flatnonzero(counts)
                if len(place):
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(at, 1), b.column(1).slice(at, 1), pa.array([place.astype(np.int32)]),
                         pa.array([counts[place].astype(np.float32)])], ["lang", "rank", "place", "count"])
                at += 1


def rows_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, counts, and where each example's begin (one more than there are examples)."""
    table = table.combine_chunks()
    place, count = table["place"].combine_chunks(), table["count"].combine_chunks()
    starts = np.append(0, np.cumsum(place.value_lengths().to_numpy(zero_copy_only=False)))
    return place.flatten().to_numpy(), count.flatten().to_numpy(), starts


def profile(table: pa.Table) -> pa.Table:
    """The mean shares of features of one language, of length one."""
    place, count, starts = rows_of(table)
    share = count / np.repeat(np.add.reduceat(count, starts[:-1]), np.diff(starts))
    mean = np.bincount(place, share, minlength=FEATURES)
    return pa.table({"lang": table["lang"][:1], "mean": pa.array([mean / np.linalg.norm(mean)])})


def families_of(profiles: dict[str, np.ndarray]) -> list[list[str]]:
    """Languages grouped by the mean cosine of their profiles, likest first."""
    groups = [[lang] for lang in sorted(profiles)]
    while len(groups) > math.ceil(math.sqrt(len(profiles))):
        one, two = max(combinations(range(len(groups)), 2), key=lambda p: (np.mean(
            [profiles[a] @ profiles[b] for a in groups[p[0]] for b in groups[p[1]]]), -p[0], -p[1]))
        groups[one] += groups.pop(two)
    return [sorted(g) for g in groups]


def fit(place: np.ndarray, count: np.ndarray, starts: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Weights of a linear support vector machine (squared hinge loss, no intercept) by dual
    coordinate descent, scaled so that the usual margin of an example's mean gram is 1."""
    w, alpha = np.zeros(FEATURES), np.zeros(len(side))
    unit = count / np.repeat(np.sqrt(np.add.reduceat(count * count, starts[:-1])), np.diff(starts))
    for round_ in range(ROUNDS):
        for i in np.random.default_rng(round_).permutation(len(side)):
            at, x = place[starts[i]:starts[i + 1]], unit[starts[i]:starts[i + 1]]
            slope = side[i] * (w[at] @ x) - 1 + alpha[i] / (2 * COST)
            new = max(alpha[i] - slope / (1 + 1 / (2 * COST)), 0.0)
            w[at] += (new - alpha[i]) * side[i] * x
            alpha[i] = new
    margin = np.abs(np.add.reduceat(w[place] * count, starts[:-1]) / np.add.reduceat(count, starts[:-1]))
    return w / (np.median(margin) or 1.0)


def duel(table: pa.Table) -> pa.Table:
    """Weights of one pair, from its examples in a fixed order."""
    table = table.sort_by([("lang", "ascending"), ("rank", "ascending")])
    weights = fit(*rows_of(table), table["side"].to_numpy().astype(np.float64))
    return pa.table({"pair": table["pair"][:1], "weights": pa.array([weights.astype(np.float32)])})


class Model:
    """Families of languages and the weights of each pair (first, second): positive for the first."""

    def __init__(self, families: list[list[str]], weights: dict[int, np.ndarray]):
        self.families = families
        self.pairs = pairs_of(families)
        self.weights = np.array([weights.get(i, np.zeros(FEATURES)) for i in range(len(self.pairs))], dtype=np.float32).reshape(-1, FEATURES)

    def winner(self, names: list[int] | list[str], margins: dict) -> tuple[int | str, float]:
        """Who wins most pairs (then the largest sum of margins, then the first), and a probability
        from its closest pair."""
        def rank(name):
            own = [margins[p] if p[0] == name else -margins[p] for p in combinations(names, 2) if name in p]
            return sum(m > 0 for m in own), sum(own), own

        best = max(names, key=lambda name: rank(name)[:2])
        closest = min(rank(best)[2], default=math.inf)
        return best, 1 / (1 + math.exp(-STEEPNESS * max(min(closest, 10.0), -10.0))) if closest < math.inf else 1.0

    def judge(self, margins: np.ndarray) -> tuple[str, float]:
        named = dict(zip(self.pairs, margins.tolist()))
        family, sure = self.winner(list(range(len(self.families))), named)
        lang, own = self.winner(self.families[family], named)
        return lang, sure * own


def pairs_of(families: list[list[str]]) -> list[tuple]:
    """Pairs of families (by number), then pairs of languages of each family."""
    return [*combinations(range(len(families)), 2), *(p for own in families for p in combinations(own, 2))]


def usable(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 != 1, F.lit(False))


def train(docs: DataFrame, learnt: Column, per_language: int = EXAMPLES) -> Model:
    """The model learned from rows that are `learnt` and have a language.

    Of a language with more rows, the `per_language` with the smallest hash of their id are taken.
    A pair of families takes as many of each side, spread over its languages.
    """
    spark = docs.sparkSession
    first = Window.partitionBy("lang").orderBy(F.xxhash64(F.lit("language"), "doc_id"), "doc_id")
    known = docs.where(learnt & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    chosen = common.written(known.distinct().withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= per_language).select(
        F.col("doc_id").alias("id"), F.col("lang").alias("of"), "rank"), "chosen")
    same = (F.col("doc_id").cast("string") == F.col("id")) & (F.col("lang").cast("string") == F.col("of"))
    made = common.written(docs.join(chosen, same).select("of", "rank", common.text_of().alias("text")).mapInArrow(
        examples, "lang string, rank int, place array<int>, count array<float>"), "examples")
    profiles = {r.lang: np.array(r.mean) for r in made.groupBy("lang").applyInArrow(
        profile, "lang string, mean array<double>").collect()}
    families = families_of(profiles)
    sides = []
    for i, (one, two) in enumerate(pairs_of(families)):
        for side, names in ((1, one), (-1, two)):
            names = [names] if isinstance(names, str) else families[names]
            sides += [(lang, i, side, math.ceil(per_language / len(names))) for lang in names]
    if not sides:
        return Model(families, {})
    roles = spark.createDataFrame(sides, "as string, pair int, side int, most int")
    fitted = made.join(roles, (F.col("lang") == F.col("as")) & (F.col("rank") <= F.col("most"))).select(
        "pair", "side", "lang", "rank", "place", "count").groupBy("pair").applyInArrow(duel, "pair int, weights array<float>")
    return Model(families, {r.pair: np.array(r.weights) for r in fitted.collect()})


class Values(dict):
    """Word -> row of `table`: the word's value for each pair, its number of grams, whether it
    has a letter. Forgets all when full."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights
        self.table = np.zeros((0, len(weights) + 2), dtype=np.float32)
        self.most = min(CACHE_WORDS, CACHE_BYTES // (4 * self.table.shape[1]))

    def compute(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.table.shape[1]), dtype=np.float64)
        for word, feature in grams_of([w.encode("utf-8", "replace") for w in words]):
            for k, w in enumerate(self.weights):
                out[:, k] += np.bincount(word, w[feature], minlength=len(words))
            out[:, -2] += np.bincount(word, minlength=len(words))
        out[:, -1] = [any(map(str.isalpha, w)) for w in words]
        return out.astype(np.float32)

    def sums(self, texts: list[str]) -> np.ndarray:
        """One row per text: the sum over its words."""
        said = [words_of(t) for t in texts]
        if len(self) > self.most:
            self.clear()
            self.table = self.table[:0]
        new = list({w for own in said for w in own if w not in self})
        short = [w for w in new if len(w) <= WORD_BYTES]
        rest = [w for w in new if len(w) > WORD_BYTES]
        size = len(self.table)
        self.update(zip(short, range(size, size + len(short))))
        self.table = np.concatenate([self.table, self.compute(short)])
        table, at = self.table, self
        if rest:
            table = np.concatenate([table, self.compute(rest)])
            at = dict(self)
            at.update(zip(rest, range(len(self.table), len(table))))
        each = [len(own) for own in said]
        rows = np.fromiter((at[w] for own in said for w in own), dtype=np.int64, count=sum(each))
        text = np.repeat(np.arange(len(texts)), each)
        return np.stack([np.bincount(text, column[rows], minlength=len(texts)) for column in table.T], axis=1)


def predict(text: Column, model: Model, spark: SparkSession) -> Column:
    """struct<lang, score> of a whole text; `und` with score 0 for a null text, one without a
    letter, or where no language was learned."""
    sent = spark.sparkContext.broadcast(model)
    held: dict[str, Values] = {}

    @F.arrow_udf("struct<lang: string, score: double>")
    def judged(texts: pa.Array) -> pa.Array:
        values = held.setdefault("values", Values(sent.value.weights))
        langs, scores = [], []
        for block in blocks(texts.fill_null("")):
            for *margins, grams, letters in values.sums(block):
                known = letters > 0 and sent.value.families
                lang, score = sent.value.judge(np.array(margins) / grams) if known else (UNKNOWN, 0.0)
                langs.append(lang)
                scores.append(score)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return judged(text)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per row of `docs`.

    Learned from rows with a language and text whose doc_id is not held out. A null doc_id is never learned
    from and not held out; ids that repeat are all learned from. Null texts and texts without a letter
    are `und`. Whole texts of any length count; equal texts get equal results. Further columns
    are not read. An empty table gives no rows.
    """
    model = train(docs.select("doc_id", "text", "lang"), usable(F.col("doc_id")))
    found = predict(F.col("text").cast("string"), model, docs.sparkSession)
    return docs.select("doc_id", (~usable(F.col("doc_id")) & F.col("doc_id").isNotNull()).alias("held_out"), found.alias("_found")).select(
        "doc_id", "held_out", F.col("_found.lang").alias("lang_pred"), F.col("_found.score").alias("score"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(common.table(spark, sf_dir, "documents"))

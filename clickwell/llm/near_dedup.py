"""Near-duplicates by BagMinHash.

A text is a multiset of shingles of five words. Its signature comes from Poisson processes over
discretised weights: each shingle's weight axis is cut at whole numbers, a process runs on each
interval [2^i, 2^(i+1)) below the largest weight, and its points are split between the halves of
the interval down to single levels. A point at a level that the weight reaches lowers one of the
SIGNATURE registers to its time. Equal registers of two texts are as likely as their weighted
Jaccard similarity, without bias. Registers are cut into bands, in several orders; texts that agree in a
band are compared on their whole multisets. Bands are long, so that texts which merely share a
passage with very many others seldom agree in one, and many, so that of pairs at the threshold
itself about one in ten million is missed.

Identical texts are one text from the start. Within a bucket of texts that agree in a band, texts
are compared only until they are connected: a text whose class is known to be that of another is
not compared with it again. A few bands go first, and connect most of what is alike. Buckets of
the other bands matter only where several classes still meet; the classes that do make a
component, and a component is cut into blocks, so that a text is sent once per block it has to
meet and not once per band. Components so large that this would send more stay with their buckets,
whose blocks are connected through one pivot block, and what remains apart is compared with all
other blocks. Thus no link between different texts is lost, and a group of near copies costs about
as many comparisons as it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickwell.llm import common
from clickwell.llm.licenses import Hashes
from clickwell.llm.toxicity import blocks

SHINGLE = 5
SIMILARITY = 0.8
SIGNATURE, ROWS, ORDERS = 256, 8, 4  # SIGNATURE is a power of two
BANDS = SIGNATURE // ROWS * ORDERS
EARLY = 8  # bands that are compared first
BLOCK = 256
BAND_COST = 1  # of a row that is sent for a band, against one that is sent for a block

SIGNED = "text_key binary, doc_id bigint, bands array<bigint>"
BAG = "id bigint, shingles binary"
EDGES = "a bigint, b bigint"

# The registers of each band.
MEMBERS = np.concatenate([
    np.random.default_rng(order).permutation(SIGNATURE).reshape(-1, ROWS) for order in range(ORDERS)])

_hashes = Hashes()


def mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of whole numbers."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit shingle) of whole texts: SHINGLE lower-cased words each, cut at white
    space; of a shorter text all its words. A text without words has none."""
    words = [t.lower().split() for t in texts]
    each = np.array([len(own) for own in words], dtype=np.int64)
    pairs = _hashes.of([w for own in words for w in own])[:, 0]
    text = np.repeat(np.arange(len(words)), each)
    place = np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)
    left = each[text] - place
    run = np.zeros(len(text), dtype=np.uint64)
    for i in range(SHINGLE):
        here = pairs[np.minimum(np.arange(len(text)) + i, max(0, len(text) - 1))]
        run = np.where(left > i, mix(run ^ here, i + 1), run)
    start = (left >= SHINGLE) | (place == 0)
    return text[start], run[start]


def uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(text: np.ndarray, shingle: np.ndarray, n_texts: int) -> np.ndarray:
    """Registers of each text (n_texts x SIGNATURE), all texts of a block at once.

    A round draws the next point of every process that may still lower a register. A process
    stops once its time is above all registers of its text.
    """
    registers = np.full((n_texts, SIGNATURE), np.inf)
    flat = registers.reshape(-1)
    order = np.lexsort((shingle, text))
    text, shingle = text[order], shingle[order]
    new = np.append(True, (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])) if len(text) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    weight = np.diff(np.append(first, len(text)))
    text, shingle = text[first], shingle[first]
    top = np.full(n_texts, np.inf)

    def draw(own: np.ndarray, low: np.ndarray, width: np.ndarray, shingle: np.ndarray, weight: np.ndarray) -> None:
        """Processes on [low, low + width), drawn until none may still lower a register of its text."""
        time, count = np.zeros(len(own)), 0
        draws = mix(mix(shingle ^ mix(low.astype(np.uint64), 7), 8), 11)
        wide = len(width) and width.max() > 1
        while len(own):
            # All processes are at the same draw; the fewer they are, the more draws go at once.
            ahead = min(64, max(1, 16_384 // len(own)))
            h = draws[:, None] ^ mix(np.arange(count, count + ahead, dtype=np.uint64), 12)
            times = -np.log(uniform(mix(h, 13)))
            if wide:
                times /= width[:, None]
            times[:, 0] += time
            times = np.cumsum(times, axis=1)
            time, count = times[:, -1], count + ahead
            point = np.flatnonzero((times < top[own][:, None]).ravel())
            process, h, at = point // ahead, h.ravel()[point], times.ravel()[point]
            place = own[process] * SIGNATURE + (mix(h, 15) & np.uint64(SIGNATURE - 1)).astype(np.int64)
            if wide:
                # The point falls on one level of the interval, found by halving: each half is as likely.
                level_low, bit = low[process], mix(h, 14)
                level_high = level_low + width[process]
                while (parts := level_high - level_low > 1).any():
                    middle = (level_low + level_high) // 2
                    upper = parts & ((bit & np.uint64(1)) == 1)
                    lower = parts & ~upper
                    level_low, level_high = np.where(upper, middle, level_low), np.where(lower, middle, level_high)
                    bit = bit >> np.uint64(1)
                hit = level_low < weight[process]
                place, at = place[hit], at[hit]
            np.minimum.at(flat, place, at)
            changed = np.zeros(n_texts, dtype=bool)
            changed[own] = True
            top[changed] = registers[changed].max(axis=1)
            live = np.flatnonzero(time < top[own])
            own, time, draws = (x[live] for x in (own, time, draws))
            if wide:
                low, width, weight = (x[live] for x in (low, width, weight))

    # Processes: [0, 1) for every shingle, and [2^i, 2^(i+1)) as far as the weight reaches. Level l
    # is the unit interval [l, l + 1); the weight reaches levels below it.
    draw(text, np.zeros(len(text), np.int64), np.ones(len(text), np.int64), shingle, weight)
    low = 1
    while len(weight) and low < weight.max():
        reached = np.flatnonzero(weight > low)
        draw(text[reached], np.full(len(reached), low), np.full(len(reached), low), shingle[reached], weight[reached])
        low *= 2
    return registers


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band; texts with equal registers in a band share it."""
    bits = registers.view(np.uint64)[:, MEMBERS]
    keys = np.zeros((len(registers), BANDS), dtype=np.uint64)
    for r in range(ROWS):
        keys = mix(keys ^ bits[:, :, r], r + 1)
    return keys ^ mix(np.arange(BANDS, dtype=np.uint64), 99)


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text_key, doc_id and band keys of texts; texts without words have none."""
    for b in batches:
        at = 0
        for texts in blocks(b.column(2), 300_000):
            text, shingle = shingles_of(texts)
            keys = band_keys(signatures(text, shingle, len(texts)))
            some = np.unique(text)
            flat = pa.array(keys[some].view(np.int64).reshape(-1))
            ends = pa.array(np.arange(len(some) + 1, dtype=np.int32) * BANDS)
            own = [b.column(c).slice(at, len(texts)).take(pa.array(some)) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([*own, pa.ListArray.from_arrays(ends, flat)], ["text_key", "doc_id", "bands"])
            at += len(texts)


def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id and the sorted shingles of each text, 64 bits each."""
    for b in batches:
        at = 0
        for texts in blocks(b.column(1), 300_000):
            text, shingle = shingles_of(texts)
            shingle = shingle[np.lexsort((shingle, text))]
            parts = np.split(shingle, np.cumsum(np.bincount(text, minlength=len(texts)))[:-1])
            yield pa.RecordBatch.from_arrays([
                b.column(0).slice(at, len(texts)), pa.array([p.tobytes() for p in parts], pa.binary())],
                ["id", "shingles"])
            at += len(texts)


def occurrences(a: np.ndarray) -> np.ndarray:
    """The elements of a sorted multiset made distinct: the n-th copy is hashed with n."""
    if not len(a):
        return a
    first = np.append(True, a[1:] != a[:-1])
    nth = np.arange(len(a)) - np.maximum.accumulate(np.where(first, np.arange(len(a)), 0))
    return np.where(nth > 0, mix(a, 0) ^ mix(nth.astype(np.uint64), 21), a)


class Classes:
    """Union-find over the texts of one comparison."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = sorted((self.root(i), self.root(j)))
        self.parent[j] = i


def connect(
    keys: list[int], classes: list, bags: list[bytes], sides: list | None = None, bands: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Links that connect the texts of a block, each implied by verified ones. Texts of one class (from earlier links)
    count as connected; with `sides`, texts of the same side are not compared, and with `bands` (a row
    of band keys per text) only texts that agree in one.

    A text is compared with one text after another until all of its links inside the block are
    known or implied; texts already connected with it are passed over.
    """
    found = Classes(len(keys))
    known: dict = {}
    for i, c in enumerate(classes):
        if c is not None:
            found.join(i, known.setdefault(c, i))
    elements = [np.sort(occurrences(np.frombuffer(b, dtype=np.uint64))) for b in bags]
    sizes = np.array([len(e) for e in elements])
    joined: set[int] = set()
    for i in range(len(keys)):
        near = np.minimum(sizes[:i], sizes[i]) >= SIMILARITY * np.maximum(sizes[:i], sizes[i])
        if bands is not None:
            near[near] = (bands[:i][near] == bands[i]).any(axis=1)
        for j in np.flatnonzero(near).tolist():
            if sides is not None and sides[i] is not None and sides[i] == sides[j]:
                continue
            if found.root(i) == found.root(j):
                continue
            both = np.sort(np.concatenate([elements[i], elements[j]]), kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            if shared >= SIMILARITY * (sizes[i] + sizes[j] - shared) - 1e-9:
                joined |= {i, j}
                found.join(i, j)
    # Linked to the smallest of their class in the block: stars are short ways to walk.
    return [(keys[found.root(i)], keys[i]) for i in sorted(joined) if found.root(i) != i]


def connect_block(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("id")
    sides = rows["side"].to_pylist() if "side" in rows.column_names else None
    bands = None
    if "bands" in rows.column_names:
        bands = rows["bands"].combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
    links = connect(rows["id"].to_pylist(), rows["class"].to_pylist(), rows["shingles"].to_pylist(), sides, bands)
    return pa.table({name: pa.array([link[i] for link in links], pa.int64()) for i, name in enumerate("ab")})


def classes_of(edges: DataFrame) -> DataFrame:
    """(id, class): the smallest id of each connected component, for ids with links.

    Large stars and small stars in turn: each round links the neighbours of every key to the
    smallest of them. Each round is a written table; it ends when nothing changes.
    """
    def star(pairs: DataFrame) -> DataFrame:
        both = pairs.select("a", "b").unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        # Larger neighbours hang on the least one.
        large = both.join(least, "a").where("b > a").select(F.col("least").alias("a"), "b")
        large = large.where("a <> b").distinct()
        # Smaller neighbours, and the key itself, hang on the least smaller one.
        down = large.groupBy(F.col("b").alias("key")).agg(F.min("a").alias("least"))
        near = large.join(down, large["b"] == down["key"]).select(
            F.col("least"), F.explode(F.array("a", "b")).alias("other"))
        return near.where("least <> other").select(F.col("least").alias("a"), F.col("other").alias("b")).distinct()

    pairs = common.written(edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        after = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if after == before:
            break
        before, pairs = after, common.written(star(pairs), "links")
    return pairs.select(F.col("b").alias("id"), F.col("a").alias("class")).unionAll(
        pairs.select(F.col("a").alias("id"), F.col("a").alias("class")).distinct())


def bucket_of() -> list[Column]:
    """How many members a bucket has, and hashes of who they are."""
    return [F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("members"),
            F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("again")]


def one_of_same(buckets: DataFrame, *also: str) -> DataFrame:
    """Of the buckets with the same members the one of the smallest key, `of`."""
    return buckets.groupBy("n", "members", "again", *also).agg(F.min("band").alias("of"))


def bags_of(texts: DataFrame, wanted: DataFrame, winners: DataFrame) -> DataFrame:
    """(held, shingles) of the `wanted` ids; each text from the one row that stands for it."""
    chosen = wanted.join(winners, F.col("wanted") == F.col("id")).select("id", "own", "best")
    of_winner = (F.col("text_key") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
    bags = common.written(texts.join(chosen, of_winner).select("id", "text").mapInArrow(bag, BAG), "bags")
    return bags.dropDuplicates(["id"]).withColumnRenamed("id", "held")


def links_between(texts: DataFrame, winners: DataFrame) -> DataFrame:
    """Verified links (a, b) between different texts (text_key, doc_id, text) that connect all
    near duplicates found by the bands. `winners` names for each text its id and the doc_id of the
    row that stands for it."""
    of_winner = (F.col("text_key") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
    signed = common.written(texts.select("text_key", "doc_id", "text").mapInArrow(sign, SIGNED).join(
        winners, of_winner).dropDuplicates(["text_key"]).select("id", "bands"), "signed")
    # A few bands go first. Buckets of the same members are one bucket: the members' hashes stand for them.
    buckets = signed.select("id", F.explode(F.slice("bands", 1, EARLY)).alias("band")).repartition("band")
    chosen = common.written(one_of_same(buckets.groupBy("band").agg(*bucket_of()).where("n > 1")), "chosen")
    members = common.written(buckets.join(chosen, F.col("band") == F.col("of")).select("id", "band", "n"), "buckets")
    held = bags_of(texts, members.select(F.col("id").alias("wanted")).distinct(), winners)

    # Blocks of a bucket are dealt differently in each band, so its blocks mix from band to band.
    n_blocks = F.ceil(F.col("n") / BLOCK)
    block = F.pmod(F.xxhash64("id", "band"), n_blocks)
    blocked = members.withColumn("block", block)
    early = blocked.withColumn("class", F.lit(None).cast("bigint")).join(held, F.col("id") == F.col("held")).drop("held")
    edges = common.written(early.groupBy("band", "block").applyInArrow(connect_block, EDGES), "edges")
    # A bucket whose members are of one class by now has nothing to add, nor has one that was compared
    # whole, whatever its band: only rows of the others meet their bucket.
    classes = classes_of(edges)
    known = classes.withColumnRenamed("id", "known")
    class_of = F.coalesce("class", "id")
    buckets = signed.join(known, F.col("id") == F.col("known"), "left").select(
        "id", "class", F.explode(F.slice("bands", EARLY + 1, BANDS - EARLY)).alias("band")).repartition("band")
    mixed = buckets.groupBy("band").agg(*bucket_of(), F.min(class_of).alias("a"), F.max(class_of).alias("z")).where("n > 1 AND a <> z")
    mixed = one_of_same(mixed.join(chosen, ["n", "members", "again"], "left_anti"), "a")
    late = buckets.join(mixed, F.col("band") == F.col("of")).select("id", "band", "n", block.alias("block"), class_of.alias("class"), "a")
    large = blocked.where(n_blocks > 1).join(known, F.col("id") == F.col("known"), "left").drop("known").withColumn("class", class_of)
    mixed = large.groupBy(F.col("band").alias("of")).agg(F.min("class").alias("a"), F.max("class").alias("z")).where("a <> z").drop("z")
    late = common.written(late.unionByName(large.join(mixed, F.col("band") == F.col("of")).drop("of")), "mixed")
    more = late.select(F.col("id").alias("wanted")).distinct().join(held, F.col("wanted") == F.col("held"), "left_anti")
    held = held.unionAll(bags_of(texts, more, winners))

    def with_bags(rows: DataFrame) -> DataFrame:
        return rows.join(held, F.col("id") == F.col("held")).drop("held")

    held_bands = held.join(signed.withColumnRenamed("id", "_id"), F.col("held") == F.col("_id")).drop("_id")
    blocks_of, rest = by_component(late)
    met = blocks_of.join(held_bands, F.col("id") == F.col("held")).drop("held")
    edges = common.written(stars(classes).unionAll(
        met.groupBy("comp", "left", "right").applyInArrow(connect_block, EDGES)).unionAll(
        with_bags(rest).groupBy("band", "block").applyInArrow(connect_block, EDGES)), "edges")
    large = rest.drop("class").where(n_blocks > 1)
    if large.isEmpty():
        return edges
    # Each block of a large bucket meets the pivot block.
    pivot = large.where("block = 0").withColumn("left", F.col("block"))
    classes = classes_of(edges)
    crossed = cross(large, classes, pivot)
    edges = common.written(stars(classes).unionAll(with_bags(crossed).groupBy("band", "left", "right").applyInArrow(connect_block, EDGES)), "edges")
    # Texts outside their bucket's main class meet all blocks, in as few blocks as they fill.
    classes = classes_of(edges)
    labelled = large.join(classes.withColumnRenamed("id", "known"), F.col("id") == F.col("known"), "left").withColumn(
        "class", F.coalesce("class", "id"))
    counts = labelled.groupBy("band", "class").agg(F.count("*").alias("many"))
    main = counts.groupBy(F.col("band").alias("of")).agg(
        F.max_by("class", F.struct("many", "class")).alias("main"), (F.sum("many") - F.max("many")).alias("few"))
    apart = labelled.join(main, F.col("band") == F.col("of")).where(F.col("class") != F.col("main")).withColumn(
        "left", F.pmod(F.xxhash64("id"), F.ceil(F.col("few") / BLOCK))).select(*large.columns, "left")
    crossed = cross(large, classes, common.written(apart, "apart"))
    return stars(classes).unionAll(with_bags(crossed).groupBy("band", "left", "right").applyInArrow(connect_block, EDGES))


def by_component(late: DataFrame) -> tuple[DataFrame, DataFrame]:
    """How the rows of mixed buckets, (id, band, n, block, class, a) with `a` the smallest class
    of the bucket, are compared at the least cost: (blocks of components, buckets as they are).

    Classes that meet in a bucket make a component. Its main class need not be compared with itself,
    so its texts are cut into blocks and so are the other ones, and each block of the others meets
    every block: (comp, left, right, side, id, class). A text is sent once per block that it meets and
    not once per band. Where that is more than the buckets' rows, the buckets stay: both ways compare
    every pair that agrees in a band and is not of one class.
    """
    comps = classes_of(late.select("a", F.col("class").alias("b")).distinct()).select(F.col("id").alias("of_class"), F.col("class").alias("comp"))
    rows = late.drop("a").join(comps, F.col("class") == F.col("of_class")).drop("of_class")
    rows = common.written(rows, "components")
    sizes = rows.select("comp", "class", "id").distinct().groupBy("comp", "class").agg(F.count("*").alias("size"))
    whole = sizes.groupBy(F.col("comp").alias("_comp")).agg(
        F.max_by("class", F.struct("size", "class")).alias("main"), F.max("size").alias("most"), F.sum("size").alias("all"))
    whole = whole.join(rows.groupBy("comp").agg(F.count("*").alias("sent")), F.col("_comp") == F.col("comp")).drop("comp")
    mains, others = F.ceil(F.col("most") / BLOCK), F.ceil((F.col("all") - F.col("most")) / BLOCK)
    whole = whole.select("_comp", "main", mains.alias("mains"), others.alias("others"), (
        F.col("most") * others + (F.col("all") - F.col("most")) * (mains + others) <= F.col("sent") * BAND_COST).alias("cheap"))
    whole = common.written(whole, "plans")
    placed = rows.join(whole, F.col("comp") == F.col("_comp")).drop("_comp")
    texts = placed.where("cheap").select("comp", "id", "class", "main", "mains", "others").distinct()
    span = lambda start, end: F.when(F.lit(start) <= end, F.sequence(F.lit(start).cast("bigint"), end)).otherwise(
        F.array().cast("array<bigint>"))
    main = texts.where("class = main").withColumn("right", F.pmod(F.xxhash64("id"), F.col("mains")))
    met = main.select("comp", F.explode(span(0, F.col("others") - 1)).alias("left"), "right", F.lit(0).alias("side"), "id", "class")
    other = texts.where("class <> main").withColumn("own", F.pmod(F.xxhash64("id"), F.col("others")))
    met = met.unionAll(other.select(
        "comp", F.col("own").alias("left"), F.explode(span(0, F.col("mains") - 1)).alias("right"), F.lit(1).alias("side"), "id", "class"))
    # Blocks of the others among themselves, each pair once; a block with itself has no sides.
    index = F.explode(span(0, F.col("others") - 1)).alias("peer")
    pairs = other.select("comp", "own", "others", "mains", index, "id", "class")
    met = met.unionAll(pairs.select(
        "comp", F.least("own", "peer").alias("left"), F.col("mains") + F.greatest("own", "peer"),
        F.when(F.col("own") != F.col("peer"), (F.col("own") > F.col("peer")).cast("int")).alias("side"), "id", "class"))
    return met, placed.where("NOT cheap").select("id", "band", "n", "block", "class")


def stars(classes: DataFrame) -> DataFrame:
    """Known classes as links: they stand for those that made them."""
    return classes.where("id <> class").select(F.col("class").alias("a"), F.col("id").alias("b"))


def cross(large: DataFrame, classes: DataFrame, first: DataFrame) -> DataFrame:
    """Rows (band, left, right, side, id, class): the rows `first`, in their blocks `left`,
    against every block `right` of their bucket."""
    rights = F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("n") / BLOCK) - 1)
    ones = first.select("band", "left", F.explode(rights).alias("right"), F.lit(True).alias("side"), "id")
    lefts = first.select(F.col("band").alias("of"), "left").distinct()
    others = large.join(lefts, F.col("band") == F.col("of")).select(
        "band", "left", F.col("block").alias("right"), F.lit(False).alias("side"), "id")
    known = classes.withColumnRenamed("id", "known")
    return ones.unionAll(others).join(known, F.col("id") == F.col("known"), "left").drop("known")


def group(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, class_id, class_size, kept, text_sha256.

    Texts are alike when the generalised Jaccard similarity of their shingles is SIMILARITY or
    more; a class is what such links connect, and identical texts always share one. class_id is
    the largest doc_id of a class, whose row is kept (of rows equal in doc_id one). Null texts are
    empty; texts without words are alike only when identical. A null doc_id ranks lowest. Shorter
    texts than a shingle are one shingle. Other columns are not read. An empty table gives no rows.
    """
    rows = common.written(docs.select(
        common.row_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.unhex(F.sha2(common.text_of(), 256)).alias("text_key")), "rows")
    winners = common.written(rows.groupBy(F.col("text_key").alias("own")).agg(
        F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("copies")).withColumn(
        "id", F.col("best.row")), "winners")
    texts = docs.select(
        F.unhex(F.sha2(common.text_of(), 256)).alias("text_key"),
        F.col("doc_id").cast("bigint").alias("doc_id"), common.text_of().alias("text"))
    classes = common.written(classes_of(links_between(texts, winners)), "classes").select(
        F.col("id").alias("known"), "class")
    labelled = winners.join(classes, F.col("id") == F.col("known"), "left").select(
        "own", "best", "copies", F.coalesce("class", "id").alias("class"))
    whole = labelled.groupBy(F.col("class").alias("of")).agg(F.max("best").alias("head"), F.sum("copies").alias("class_size"))
    final = labelled.join(whole, F.col("class") == F.col("of")).select("own", "head", "class_size")
    return rows.join(final, F.col("text_key") == F.col("own")).select(
        "doc_id", F.col("head.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("head.row")).alias("kept"),
        F.lower(F.hex("own")).alias("text_sha256"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group(common.table(spark, sf_dir, "documents"))

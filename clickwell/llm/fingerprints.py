"""Document fingerprints by consistent weighted sampling.

A text is a bag of word pairs, each weighted by how often it occurs. For each of SAMPLES samples a
pair draws r and c from Gamma(2, 1) and b from the unit interval, all three functions of the pair
and the sample's number. With t = floor(ln(weight) / r + b), the pair with the smallest
c * exp(-r * (t - b + 1)) is sampled together with its t. Two bags agree in a sample with the
probability of their generalised Jaccard similarity, the sum of minima over the sum of maxima.

All of it is DataFrame functions: texts are shuffled once, into ranges of ids; the pairs of a text
are counted within its row, and the samples are minima of whole numbers in a hash aggregation
that needs no further shuffle.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickwell.llm import common

SAMPLES = 64
R_BITS, C_BITS = 9, 11  # of uniform numbers; twice their sum and 24 bits make a 64-bit hash
ROWS_PER_RANGE = 2_000
CELLS = 64


def gamma_at(share: np.ndarray) -> np.ndarray:
    """The Gamma(2, 1) quantile: x with 1 - exp(-x) * (1 + x) = share."""
    low, high = np.zeros_like(share), np.full_like(share, 40.0)
    for _ in range(60):
        middle = (low + high) / 2
        under = 1 - np.exp(-middle) * (1 + middle) < share
        low, high = np.where(under, middle, low), np.where(under, high, middle)
    return (low + high) / 2


def constants(values: np.ndarray) -> Column:
    """A constant array."""
    return F.split(F.lit(",".join(f"{v:.12g}" for v in values)), ",").cast("array<double>")


# The larger of two uniform numbers is below s with probability s * s. On that scale the quantile
# is close to linear near 0, so an even grid serves small values as well; grids hold midpoints.
R_GRID = gamma_at(((np.arange(1 << R_BITS) + 0.5) / (1 << R_BITS)) ** 2)
LOG_C_GRID = np.log(gamma_at(((np.arange(1 << C_BITS) + 0.5) / (1 << C_BITS)) ** 2))


def sample(k: int, r_grid: Column, log_c_grid: Column) -> Column:
    """Sample k of a row (term, log_weight) as a whole number: the rank in the upper 32 bits, what
    is sampled in the lower. The smallest over a bag's terms is the bag's sample."""
    h = F.xxhash64("term", F.lit(k))
    part = lambda shift, n: F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << n) - 1))
    larger = lambda shift, n: F.greatest(part(shift, n), part(shift + n, n))
    r = F.get(r_grid, larger(0, R_BITS))
    log_c = F.get(log_c_grid, larger(2 * R_BITS, C_BITS))
    b = part(2 * R_BITS + 2 * C_BITS, 24) * F.lit(2.0**-24)
    # A weight of one, the usual case, has t = 0.
    t = F.when(F.col("log_weight") == 0, F.lit(0).cast("bigint")).otherwise(F.floor(F.col("log_weight") / r + b))
    # The logarithm of the rank lies within -200 and 50 and keeps 31 bits: log_c is -8 or more, and
    # r * (t - b + 1) at most the largest r of the grid and the logarithm of the weight together.
    log_a = log_c - r * (t - b + 1.0)
    rank = ((log_a + 200.0) * 8388608.0).cast("bigint")
    return F.shiftleft(rank, 32).bitwiseOR(h.bitwiseXOR(t).bitwiseAND(F.lit(0xFFFFFFFF)))


def terms(text: Column) -> Column:
    """The distinct word pairs of a text with their counts: array of (term, weight).

    Each step is bound to a lambda's variable, which Spark evaluates once. The first word pairs
    with nothing, so a text of one word has a term, and an empty text that of the empty word.
    """
    words = F.split(F.trim(F.translate(F.lower(text), "\n\t\r", "   ")), " ")
    bound = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))
    hashes = bound(words, lambda ws: F.sort_array(F.transform(
        ws, lambda w, i: F.xxhash64(w, F.get(ws, i - 1)))))
    return bound(hashes, lambda s: bound(
        F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1))),
        lambda starts: F.transform(starts, lambda i, j: F.struct(
            F.get(s, i).alias("term"), (F.coalesce(F.get(starts, j + 1), F.size(s)) - i).alias("weight")))))


def ranged(docs: DataFrame) -> DataFrame:
    """`docs` with `range`, a number that grows with doc_id. A null id goes before all ids.

    Quantiles of the ids cut them into cells, each cell is cut evenly: ranges stay alike in size
    when ids are unevenly spread.
    """
    ids = docs.select("doc_id")
    n, low, high = ids.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    ranges = max(1, -(-n // ROWS_PER_RANGE))
    cells = min(CELLS, ranges)
    per_cell = -(-ranges // cells)
    cuts = []
    if cells > 1 and low is not None:
        shares = [i / cells for i in range(1, cells)]
        cuts = sorted(set(ids.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0]) - {low})
    edges = [low or 0, *cuts, (high or 0) + 1]
    starts, ends = F.array(*[F.lit(e) for e in edges[:-1]]), F.array(*[F.lit(e) for e in edges[1:]])
    cell = F.size(F.filter(starts, lambda e: e <= F.col("doc_id"))) - 1
    lo, hi = F.get(starts, cell), F.get(ends, cell)
    part = F.floor((F.col("doc_id") - lo) / (hi - lo) * per_cell)
    return docs.withColumn("range", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(
        cell * per_cell + F.least(part, F.lit(per_cell - 1))).cast("bigint"))


def with_next(docs: DataFrame) -> DataFrame:
    """(range, place, lent, doc_id, text, next_text) where the next row is the one with the next
    smaller doc_id, and the largest after the smallest. Rows with lent are copies: the first row
    of each range also stands behind the range before it."""
    rows = ranged(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), common.text_of().alias("text")))
    tops = rows.groupBy("range").agg(F.max("doc_id").alias("top"))
    upward = Window.orderBy("range")  # one row per range: 1 of ROWS_PER_RANGE documents
    first = F.first("range").over(upward.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    lenders = common.written(tops.select(
        F.col("range").alias("of"), "top", F.coalesce(F.lead("range").over(upward), first).alias("to")), "lenders")
    lent = rows.join(lenders, (F.col("range") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("top"))).select(
        F.col("to").alias("range"), "doc_id", "text", F.lit(True).alias("lent"))
    downward = Window.partitionBy("range").orderBy(
        "lent", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")
    return rows.select("range", "doc_id", "text", F.lit(False).alias("lent")).unionByName(lent).select(
        "range", "lent", "doc_id", "text", F.row_number().over(downward).alias("place"),
        F.lead("text").over(downward).alias("next_text"))


def sampled(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The samples of each row's text: its keys and `samples`, an array of SAMPLES whole numbers
    (32 bits each). One row per distinct combination of keys."""
    bag = rows.select(*keys, F.inline(terms(F.col("text"))))
    bag = bag.select(*keys, "term", F.ln("weight").alias("log_weight"))
    # The grids are one row that meets every term, and so one place in memory for all samples: as
    # literals they would be in the plan, and in each task, twice per sample.
    grids = common.written(rows.sparkSession.range(1).select(
        constants(R_GRID).alias("r_grid"), constants(LOG_C_GRID).alias("log_c_grid")), "grids")
    least = bag.crossJoin(grids).groupBy(*keys).agg(*[
        F.min(sample(k, F.col("r_grid"), F.col("log_c_grid"))).alias(f"s{k}") for k in range(SAMPLES)])
    return least.select(*keys, F.array(*[
        F.col(f"s{k}").bitwiseAND(F.lit(0xFFFFFFFF)) for k in range(SAMPLES)]).alias("samples"))


def likeness(a: Column, b: Column) -> Column:
    """The share of samples in which two fingerprints agree: estimates generalised Jaccard."""
    equal = F.filter(F.sequence(F.lit(0), F.lit(SAMPLES - 1)), lambda i: F.get(a, i) == F.get(b, i))
    return F.size(equal) / F.lit(float(SAMPLES))


def compare(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, n_chars, edited_sha256, samples, edited_samples,
    near_edited, near_next.

    The edited text is the text with its last third replaced by the next row's beginning. Texts
    are lower-cased and cut at blanks, newlines, tabs and carriage returns. A null text is empty;
    an empty text is the bag of one empty word, so two empty texts are alike. Rows that share a
    doc_id follow each other by a hash of their texts; null ids come last. A single row is its own
    next one. Other columns are not read. An empty table gives no rows.
    """
    rows = with_next(docs)
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third))
    rows = rows.withColumn("edited", F.coalesce(edited, "text"))
    keys = ["range", "place", "lent", "doc_id", "n_chars", "edited_digest"]
    both = rows.select(
        *keys[:4], n.cast("bigint").alias("n_chars"), F.unhex(F.sha2("edited", 256)).alias("edited_digest"),
        F.explode(F.array(
            F.struct(F.lit(0).alias("which"), F.col("text").alias("text")),
            F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))).alias("version"),
    ).select(*keys, "version.which", "version.text")
    found = sampled(both, [*keys, "which"])
    # Both versions of a row meet in the partition they are in: it is dealt by range.
    pair = found.groupBy(*keys).agg(
        F.max(F.when(F.col("which") == 0, F.col("samples"))).alias("samples"),
        F.max(F.when(F.col("which") == 1, F.col("samples"))).alias("edited_samples"))
    after = F.lead("samples").over(Window.partitionBy("range").orderBy("place"))
    return pair.withColumn("next_samples", after).where(~F.col("lent")).select(
        "doc_id", "n_chars", F.lower(F.hex("edited_digest")).alias("edited_sha256"),
        "samples", "edited_samples",
        likeness(F.col("samples"), F.col("edited_samples")).alias("near_edited"),
        likeness(F.col("samples"), F.col("next_samples")).alias("near_next"))


def as_text(samples: Column) -> Column:
    return F.concat_ws("", F.transform(samples, lambda s: F.lpad(F.lower(F.hex(s)), 8, "0")))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare(common.table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("samples")).alias("fingerprint"),
        as_text(F.col("edited_samples")).alias("edited_fingerprint"), "near_edited", "near_next")

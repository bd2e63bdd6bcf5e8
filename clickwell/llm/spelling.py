"""Spelling variants by asymmetric q-chunks.

Two words are near when one code point inserted, deleted or replaced turns one into the other. Of a
pair the shorter word (of equals the smaller one) is cut into two disjoint chunks, of which the edit
leaves one as it is; the longer one offers the grams of its own that can be such a chunk. Places
shift by one at most: a chunk before the edit stands where it stood, one behind it moves with
the difference of the lengths, so only these are joined. What meets is verified.

Where very many words share a chunk (a bucket of more than HOT pairs), comparing them would cost the
square of their number. What is left of the words besides the chunk is then cut further, and all
but one of the smaller parts have to agree as well, until buckets are small or the part left out is
a single code point, of which there are few.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickwell.llm import common
from clickwell.llm.prefix_trie import CRC_TABLE

SHORTEST, RAREST = 5, 3
NOISE = 97
HOT = 4096  # pairs of a bucket that are compared as they are
PARTS = 4   # a part of a hot bucket is cut into so many

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUNS = "[a-zÀ-ÿ]+"


def counted(docs: DataFrame) -> DataFrame:
    """(word, n, size): words of at least SHORTEST code points and RAREST occurrences."""
    lowered = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(lowered, F.lit(RUNS), F.lit(0))).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = hashed.select(F.when(F.col("h") % NOISE == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= SHORTEST).groupBy("word").agg(F.count("*").alias("n")).where(
        F.col("n") >= RAREST).select("word", "n", F.char_length("word").alias("size"))


def keyed(rows: DataFrame) -> DataFrame:
    """`rows` (word, n, size, cut, parts, part) with `key`: a hash of all but one of the `parts` parts of
    a word that is as long as `cut`, the word itself or one shorter by a code point."""
    start, end = ((F.col("cut") * i / F.col("parts")).cast("int") for i in (F.col("part"), F.col("part") + 1))
    shift = F.col("size") - F.col("cut")
    return rows.withColumn("hole", end - start).where("hole > 0").withColumn("key", F.xxhash64(
        "cut", "parts", "part", F.substring("word", F.lit(1), start),
        F.substring("word", end + shift + 1, F.col("size"))))


def meeting(words: DataFrame) -> DataFrame:
    """(a, b): near words, each pair once, the shorter or smaller one as a.

    Bounded: a bucket is compared if it has at most HOT pairs, or if one code point is left out of it.
    """
    halves = F.explode(F.array(F.lit(0), F.lit(1))).alias("part")
    chunk = words.select("word", "n", "size", F.col("size").alias("cut"), F.lit(False).alias("longer"))
    grams = words.select("word", "n", "size", F.explode(F.array("size", F.col("size") - 1)).alias("cut"), F.lit(True).alias("longer"))
    rows = common.written(keyed(chunk.unionAll(grams.where(F.col("cut") >= SHORTEST)).select(
        "*", F.lit(2).alias("parts"), halves)), "chunks")
    found = []
    while True:
        chunks, grams = F.count_if(~F.col("longer")), F.count_if(F.col("longer"))
        hot = common.written(rows.where("hole > 1").groupBy(F.col("key").alias("of")).agg(
            chunks.alias("chunks"), grams.alias("grams")).where(F.col("chunks") * F.col("grams") > HOT).select("of"), "hot")
        cold = rows.join(hot, F.col("key") == F.col("of"), "left_anti")
        a = cold.where("NOT longer").select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("size").alias("a_size"), F.col("key").alias("a_key"))
        b = cold.where("longer").select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("size").alias("b_size"), "key")
        ordered = (F.col("a_size") < F.col("b_size")) | (F.col("a") < F.col("b"))
        found.append(a.join(b, (F.col("a_key") == F.col("key")) & ordered).where(
            F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n"))
        if hot.isEmpty():
            break
        rows = rows.join(hot, F.col("key") == F.col("of"), "left_semi").select(
            "word", "n", "size", "cut", "longer", (F.col("parts") * PARTS).alias("parts"),
            F.explode(F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda i: F.col("part") * PARTS + i)).alias("part"))
        rows = common.written(keyed(rows), "chunks")
    return reduce(DataFrame.unionAll, found).dropDuplicates(["a", "b"])


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form. A form is at least twice as frequent, so there are no
    circles and chains are short; each round doubles the way that is known."""
    known = common.written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = known.select(F.col("word").alias("_word"), F.col("root").alias("onward"))
        step = common.written(known.join(onward, F.col("root") == F.col("_word"), "left").select(
            "word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")), "roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        known = step.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    A word's form is its most frequent near word (of equally frequent ones the smallest in
    code-point order) if that is at least twice as frequent as the word. Null and empty texts have no
    words, a null doc_id counts as an empty one. Repeated rows count each. Runs of letters have any
    length. Further columns are not read. An empty table gives no rows.
    """
    words = common.written(counted(docs.select("doc_id", "text")), "words")
    pairs = common.written(meeting(words), "near")
    near = pairs.select(F.col("a").alias("of"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionAll(
        pairs.select("b", "a", "a_n"))
    best = near.groupBy("of").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("least"), "near")).alias("best"))
    strong = -F.col("best.least") >= 2 * F.col("n")
    formed = common.written(words.join(best, F.col("word") == F.col("of"), "left").select(
        "word", F.when(strong, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(strong, -F.col("best.least")).alias("form_n")), "forms")
    ways = roots(formed.where("form IS NOT NULL")).withColumnRenamed("word", "of")
    return formed.join(ways, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(common.table(spark, sf_dir, "documents"))


OP12_SQL = f"""
WITH RECURSIVE {CRC_TABLE}, runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{RUNS}')) AS run FROM documents)
  GROUP BY doc_id, run
), hashed AS MATERIALIZED (
  SELECT run, n, xor(list_reduce([4294967295] || flatten(list_transform(
    string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
      ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM runs, crc_table
), words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
      ELSE run END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), gaps AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) u(i)
), near AS MATERIALIZED (
  SELECT DISTINCT word, other, n, other_n FROM (
    SELECT g.word, w.word AS other, g.n, w.n AS other_n FROM gaps g JOIN words w ON w.word = g.rest
    UNION ALL SELECT w.word, g.word, w.n, g.n FROM gaps g JOIN words w ON w.word = g.rest
    UNION ALL SELECT g.word, k.word, g.n, k.n FROM gaps g JOIN gaps k ON k.rest = g.rest AND k.i = g.i AND k.word <> g.word)
), best AS MATERIALIZED (
  SELECT w.word, w.n, count(o.other) AS n_near,
    CASE WHEN max(o.other_n) >= 2 * w.n THEN first(o.other ORDER BY o.other_n DESC, encode(o.other)) END AS form,
    CASE WHEN max(o.other_n) >= 2 * w.n THEN max(o.other_n) END AS form_n
  FROM words w LEFT JOIN near o USING (word) GROUP BY w.word, w.n
), ways AS (
  SELECT word, word AS root, form AS onward FROM best
  UNION ALL
  SELECT ways.word, best.word, best.form FROM ways JOIN best ON best.word = ways.onward
)
SELECT b.word, b.form, ways.root, b.n, b.n_near, b.form_n
FROM best b JOIN ways ON ways.word = b.word AND ways.onward IS NULL
"""

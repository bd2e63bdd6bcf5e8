"""Chat formatting after collapsing cumulative snapshots.

Logs often store a conversation again after each turn, so the same turns occur as ever longer
snapshots. A rolling hash is kept for each prefix of turns; a conversation whose whole hash is a
proper prefix of another one, or equals another one's, is a snapshot and goes. What is maximal is
rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickwell.llm import common

START, END = "<|im_start|>", "<|im_end|>"


def rolling(turns: DataFrame) -> DataFrame:
    """(conv_id, i, n, hash): the hash of the first i of a conversation's n turns.

    The hash of a prefix is the exclusive-or of its turns' hashes, each salted with the turn's
    place, so a running window keeps it without holding the turns. Two 64-bit hashes make it.
    """
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "text_key")
    placed = turns.select(
        "conv_id", "turn", "role", F.sha2(F.col("text"), 256).alias("text_key"),
    ).withColumn("i", F.row_number().over(by_turn))
    upto = by_turn.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    a = F.xxhash64(F.lit(1), "i", "role", "text_key")
    b = F.xxhash64(F.lit(2), "text_key", "role", "i")
    return placed.select(
        "conv_id", "i", F.count("*").over(Window.partitionBy("conv_id")).alias("n"),
        F.bit_xor(a).over(upto).alias("h1"), F.bit_xor(b).over(upto).alias("h2"))


def cleaned(turns: DataFrame) -> DataFrame:
    return turns.select(
        F.col("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        common.text_of().alias("text"))


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_equal) of the conversations that no other one extends.

    Equal conversations become the one with the smallest conv_id before anything is compared,
    and prefixes become a distinct set by partial aggregation: a turn that opens a third of all
    conversations is one row on either side of the anti-join.
    """
    prefixes = common.written(rolling(cleaned(turns)), "prefixes")
    whole = prefixes.where("i = n").groupBy("h1", "h2", "n").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_equal"))
    inner = prefixes.where("i < n").groupBy("h1", "h2", "i").agg(F.lit(1).alias("seen"))
    inner = inner.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("i").alias("pi"))
    same = (whole["h1"] == inner["p1"]) & (whole["h2"] == inner["p2"]) & (whole["n"] == inner["pi"])
    return whole.join(inner, same, "left_anti").select(
        "conv_id", F.col("n").cast("bigint").alias("n_turns"), "n_equal")


def rendered(turn: Column) -> Column:
    """A turn as marked-up text. Markers inside a text are broken up so they cannot be forged."""
    safe = lambda c: F.replace(F.replace(c, F.lit(START), F.lit("<im_start>")), F.lit(END), F.lit("<im_end>"))
    return F.concat(F.lit(START), safe(turn["role"]), F.lit("\n"), safe(turn["text"]), F.lit(f"{END}\n"))


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per maximal conversation: conv_id, n_turns, n_equal, rendered.

    Turns are ordered by turn, then role, then text (its SHA-256); a null turn comes first, so
    ties and repeated rows have one order and are all kept. Null roles and texts are empty, a
    null conv_id is a conversation like others. n_equal counts the equal conversations that the
    row stands for, itself included. A conversation is one output row, so it has to fit a row.
    Further columns are not read. An empty table gives no rows.
    """
    kept = maximal(turns).withColumnRenamed("conv_id", "kept_id")
    said = cleaned(turns)
    return said.join(kept, said["conv_id"].eqNullSafe(kept["kept_id"])).groupBy(
        "conv_id", "n_turns", "n_equal",
    ).agg(
        F.sort_array(F.collect_list(F.struct(
            "turn", "role", F.sha2("text", 256).alias("text_key"), "text"))).alias("turns"),
    ).select(
        "conv_id", "n_turns", "n_equal",
        F.concat_ws("", F.transform("turns", rendered)).alias("rendered"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(common.table(spark, sf_dir, "conversations"))


OP10_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(coalesce(text, ''))) AS i
  FROM conversations
), prefixes AS (
  SELECT conv_id, i, count(*) OVER (PARTITION BY conv_id) AS n,
         string_agg(length(role) || ':' || role || sha256(text), ' ') OVER (
           PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS said
  FROM turns
), whole AS (
  SELECT said, min(conv_id) AS conv_id, max(n) AS n_turns, count(*) AS n_equal
  FROM prefixes WHERE i = n GROUP BY said
), kept AS (
  SELECT * FROM whole WHERE said NOT IN (SELECT said FROM prefixes WHERE i < n)
)
SELECT conv_id, n_turns, n_equal,
       string_agg('<|im_start|>' || replace(replace(role, '<|im_start|>', '<im_start>'), '<|im_end|>', '<im_end>')
         || chr(10) || replace(replace(text, '<|im_start|>', '<im_start>'), '<|im_end|>', '<im_end>')
         || '<|im_end|>' || chr(10), '' ORDER BY i) AS rendered
FROM kept JOIN turns USING (conv_id)
GROUP BY conv_id, n_turns, n_equal
"""

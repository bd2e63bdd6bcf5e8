"""The trie of all prefixes of conversations, by fixed-length block hashing.

A conversation is cut into blocks of BLOCK turns. Conversations are grouped by what stands before
a block and by the block's own digest first, so copies become one row per block with a count. Only
where several different blocks follow the same prefix are they taken apart into turns and grouped
again: the siblings diverge somewhere inside. A block that is the only one behind its prefix is
a plain chain, whose nodes have the block's members.

The digest of a sequence of turns is the sum of hashes of (place, turn) in four lanes of 32 bits,
128 bits in all. Sums of parts add up to that of the whole, so what stands before a block is a
running sum, kept per stretch of CELL rows and then over stretches: a conversation with very many
turns is not one task's work.

Sums over subtrees need no walk. A node belongs to its smallest member, so of each conversation a
last part of its path is its own. A subtree holds the own parts of all its members but the smallest,
and of that one the path from the subtree's top on; members' sums come with the grouping.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickwell.llm import common

BLOCK = 4
CELL = 1024
FAMILY, OPENINGS = 5, 9  # conversations c - c % FAMILY to c share fewer than OPENINGS opening turns

LANES = ("a", "b", "c", "d")
BEFORE = tuple(f"before_{x}" for x in LANES)
KEY = tuple(f"key_{x}" for x in LANES)
PARENT = tuple(f"parent_{x}" for x in LANES)
NOTHING = sha256(b"").hexdigest()


def running(rows: DataFrame, order: list[Column], names: tuple[str, ...]) -> DataFrame:
    """`rows` (conv_id, cell, ...) with before_<name>: the sum of each name over all earlier rows of
    the conversation. Cells come one after another; `order` is that of the rows of a cell."""
    inside = Window.partitionBy("conv_id", "cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("_conv").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy(F.col("conv_id").alias("_conv"), F.col("cell").alias("_cell")).agg(
        *[F.sum(x).alias(f"_{x}") for x in names])
    starts = cells.select("_conv", "_cell", *[F.coalesce(F.sum(f"_{x}").over(earlier), F.lit(0)).alias(f"_{x}") for x in names])
    placed = rows.withColumns({f"before_{x}": F.coalesce(F.sum(x).over(inside), F.lit(0)) for x in names})
    same = (F.col("conv_id") == F.col("_conv")) & (F.col("cell") == F.col("_cell"))
    return placed.join(starts, same).withColumns(
        {f"before_{x}": F.col(f"before_{x}") + F.col(f"_{x}") for x in names}).drop("_conv", "_cell", *[f"_{x}" for x in names])


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, i, digest, bytes): the turns of each conversation from 1 on."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), common.text_of()
    said = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"),
        F.unhex(F.sha2(text, 256)).alias("text_key"), F.octet_length(text).cast("bigint").alias("bytes"), F.lit(1).cast("bigint").alias("one"))
    said = said.withColumn("cell", F.coalesce(F.floor(F.col("turn") / CELL), F.lit(-(2**63))))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text_key")]
    return running(said, order, ("one",)).select(
        "conv_id", (F.col("before_one") + 1).alias("i"), F.concat(F.unhex(F.sha2("role", 256)), "text_key").alias("digest"), "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns): conversations with the opening turns of their family's first one in
    place of their own. Turns are (conv_id, i, bytes, one column per lane)."""
    placed = common.written(numbered(turns), "turns")
    convs = placed.groupBy("conv_id").agg(F.count("*").alias("n"))
    swaps = convs.select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % OPENINGS).alias("h"))
    bases = convs.select(F.col("conv_id").alias("base_id"), F.col("n").alias("base_n"))
    swaps = common.written(swaps.join(bases, F.col("base") == F.col("base_id"), "left").select(
        F.col("conv_id").alias("id"), "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")), "swaps")
    first = swaps.join(placed.where(F.col("i") < OPENINGS), (F.col("base") == F.col("conv_id")) & (F.col("i") <= F.col("taken")))
    own = placed.join(swaps, F.col("conv_id") == F.col("id")).where(F.col("i") > F.col("h"))
    parts = first.select("id", "i", "digest", "bytes").unionAll(
        own.select("id", F.col("i") - F.col("h") + F.col("taken"), "digest", "bytes"))
    low = F.lit(0xFFFFFFFF).cast("bigint")
    one, two = F.xxhash64(F.lit(1), "i", "digest"), F.xxhash64(F.lit(2), "digest", "i")
    lanes = (F.shiftrightunsigned(one, 32), one.bitwiseAND(low), F.shiftrightunsigned(two, 32), two.bitwiseAND(low))
    return swaps.select("id"), parts.select(
        F.col("id").alias("conv_id"), "i", "bytes", *[lane.alias(x) for lane, x in zip(lanes, LANES)])


def cut(turns: DataFrame) -> DataFrame:
    """One row per conversation and block: sums before the block, its own sums, and its turns."""
    sums = ("bytes", *LANES)
    blocks = turns.groupBy("conv_id", F.floor((F.col("i") - 1) / BLOCK).alias("block")).agg(
        *[F.sum(x).alias(x) for x in sums], F.sort_array(F.collect_list(F.struct("i", *sums))).alias("turns"))
    return running(blocks.withColumn("cell", F.floor(F.col("block") / CELL)), [F.col("block")], sums).drop("cell", "block")


def grouped(blocks: DataFrame, measures: list[Column]) -> DataFrame:
    """One row per different block behind the same prefix, with the measures of its members."""
    return blocks.groupBy(*BEFORE, *LANES).agg(
        F.first("turns").alias("turns"), F.first("before_bytes").alias("before_bytes"), *measures)


def refined(groups: DataFrame, names: list[str], merge: list[Column]) -> DataFrame:
    """Nodes inside blocks: KEY, PARENT, depth, bytes (of the last turn), path_bytes (of the turns
    before it), and the measures `names`.

    Behind a prefix with one block the nodes are a chain; where blocks diverge they are grouped by
    turns, and `merge` puts the measures together.
    """
    kinds = groups.groupBy(*[F.col(x).alias(f"_{x}") for x in BEFORE]).agg(F.count("*").alias("kinds"))
    same = reduce(Column.__and__, [F.col(x) == F.col(f"_{x}") for x in BEFORE])
    upto = lambda x: F.aggregate(F.slice("turns", 1, F.col("j") + 1), F.lit(0).cast("bigint"), lambda s, t: s + t[x])
    steps = groups.join(kinds, same).select("*", F.posexplode("turns").alias("j", "last"))
    nodes = steps.select(
        "kinds", *[(F.col(b) + upto(x)).alias(k) for b, x, k in zip(BEFORE, LANES, KEY)],
        *[(F.col(b) + upto(x) - F.col("last")[x]).alias(p) for b, x, p in zip(BEFORE, LANES, PARENT)],
        F.col("last.i").alias("depth"), F.col("last.bytes").alias("bytes"),
        (F.col("before_bytes") + upto("bytes") - F.col("last.bytes")).alias("path_bytes"), *names)
    fixed = [*PARENT, "depth", "bytes", "path_bytes"]
    diverging = nodes.where("kinds > 1").groupBy(*KEY).agg(*[F.first(x).alias(x) for x in fixed], *merge)
    return nodes.where("kinds = 1").select(*KEY, *fixed, *names).unionAll(diverging.select(*KEY, *fixed, *names))


def on(left: tuple[str, ...], right: tuple[str, ...]) -> Column:
    return reduce(Column.__and__, [F.col(x) == F.col(y) for x, y in zip(left, right)])


def hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """KEY and the digest of a key's comma-joined lists of ids, which come sorted."""
    schema = pa.schema([*[(f"end_{x}", pa.int64()) for x in LANES], ("ends_sha256", pa.string())])
    key, digest = None, None
    for b in batches:
        out = []
        for *own, ids in zip(*[b.column(c).to_pylist() for c in range(len(LANES) + 1)]):
            if own == key:
                digest.update(b",")
            else:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = own, sha256()
            digest.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*key, digest.hexdigest()), schema)], schema=schema)


def ends(convs: DataFrame) -> DataFrame:
    """The digest of the ids that end at each node. Ids go in lists of up to CELL, so the one
    stream that a digest has to be is short."""
    lists = convs.groupBy(*LANES, F.floor(F.col("conv_id") / CELL).alias("cell")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids"))
    kind = ", ".join([*[f"end_{x} bigint" for x in LANES], "ends_sha256 string"])
    return lists.repartition(*LANES).sortWithinPartitions(*LANES, "cell").select(*LANES, "ids").mapInArrow(hash_ends, kind)


def trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (its smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by turn (null first), then role, then the text's SHA-256, so ties and repeated
    rows have one order and all count as turns. Null roles and texts are empty. Rows without a
    conv_id belong to no conversation and are left out. A text may have any length: only its digest
    and its bytes go on. Further columns are not read. An empty table gives no rows, not even a root.
    """
    ids, said = rebuilt(turns.select("conv_id", "turn", "role", "text"))
    said = common.written(said, "rebuilt")
    whole = said.groupBy("conv_id").agg(*[F.sum(x).alias(x) for x in ("bytes", *LANES)])
    convs = common.written(ids.join(whole, F.col("id") == F.col("conv_id"), "left").select(
        F.col("id").alias("conv_id"), *[F.coalesce(x, F.lit(0)).alias(x) for x in ("bytes", *LANES)]), "convs")
    blocks = common.written(cut(said), "blocks")
    zero = lambda names: [F.lit(0).cast("bigint").alias(x) for x in names]

    # First the nodes, their members and children.
    members = [F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")]
    inner = refined(grouped(blocks, members), ["n_convs", "conv_id"], [F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id")])
    root = convs.agg(*members).where("n_convs > 0").select(
        *zero(KEY), *[F.lit(None).cast("bigint").alias(x) for x in PARENT], *zero(("depth", "bytes", "path_bytes")), "n_convs", "conv_id")
    nodes = common.written(inner.unionAll(root), "nodes")
    children = nodes.where("depth > 0").groupBy(*[F.col(x).alias(f"of_{x}") for x in PARENT]).agg(F.count("*").alias("n_children"))
    tree = common.written(nodes.join(children, on(KEY, tuple(f"of_{x}" for x in PARENT)), "left").select(
        *nodes.columns, F.coalesce("n_children", F.lit(0)).alias("n_children")), "tree")

    # Then what each conversation's own nodes hold, summed over the members of every node.
    own = tree.groupBy(F.col("conv_id").alias("owner")).agg(
        F.sum("bytes").alias("own_bytes"), F.max_by((F.col("n_children") == 0).cast("bigint"), "depth").alias("leaf"))
    held = common.written(convs.join(own, F.col("conv_id") == F.col("owner"), "left").select(
        F.col("conv_id").alias("id"), F.col("bytes").alias("all_bytes"),
        F.coalesce("own_bytes", F.lit(0)).alias("own_bytes"), F.coalesce("leaf", F.lit(0)).alias("leaf")), "held")
    names = ["sum_all", "sum_own", "n_leaves"]
    sums = [F.sum(c).alias(x) for c, x in zip(("all_bytes", "own_bytes", "leaf"), names)]
    below = refined(grouped(blocks.join(held, F.col("conv_id") == F.col("id")), sums), names, [F.sum(x).alias(x) for x in names])
    below = below.select(*[F.col(x).alias(f"sum_{x}") for x in KEY], *names).unionAll(
        held.agg(*sums).where("sum_all IS NOT NULL").select(*zero(KEY), *names))

    up = tree.select(*[F.col(x).alias(f"up_{x}") for x in KEY], F.col("conv_id").alias("parent_conv_id"))
    full = tree.join(below, on(KEY, tuple(f"sum_{x}" for x in KEY))).join(
        held.drop("leaf"), F.col("conv_id") == F.col("id")).join(
        up, on(PARENT, tuple(f"up_{x}" for x in KEY)), "left").join(
        common.written(ends(convs), "ends"), on(KEY, tuple(f"end_{x}" for x in LANES)), "left")
    # Bytes of all members from here on, less those of the different nodes that they share.
    nodes_bytes = F.col("sum_own") - F.col("own_bytes") + F.col("all_bytes") - F.col("path_bytes")
    return full.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("sum_all") - F.col("n_convs") * F.col("path_bytes") - nodes_bytes).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(common.table(spark, sf_dir, "conversations"))


# SQL has no CRC-32: it is computed from the decimal digits with a table of 256 entries.
CRC_TABLE = """crc_table AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || list_transform(range(8), lambda k: 0), lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i)))"""

OP11_SQL = f"""
WITH {CRC_TABLE}, said AS (
  SELECT conv_id, sha256(coalesce(role, '')) || sha256(coalesce(text, '')) AS digest,
         octet_length(encode(coalesce(text, ''))) AS bytes,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), swaps AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(
    [4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: unicode(x)::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM said), crc_table
), parts AS (
  SELECT s.conv_id, p.i, p.digest, p.bytes FROM swaps s JOIN said p ON p.conv_id = s.base AND p.i <= s.h
  UNION ALL
  SELECT s.conv_id, p.i + 1000000000, p.digest, p.bytes FROM swaps s JOIN said p ON p.conv_id = s.conv_id AND p.i > s.h
), prefixes AS (
  SELECT conv_id, row_number() OVER w AS depth, bytes, string_agg(digest, '') OVER w AS path
  FROM parts WINDOW w AS (PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING)
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM swaps
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM prefixes GROUP BY path, depth
), tree AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1
    AND substr(c.path, 1, length(n.path)) = n.path) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = substr(n.path, 1, length(n.path) - 128)
), below AS (
  SELECT a.path, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves, sum((u.n_convs - 1) * u.bytes) AS saved
  FROM tree u JOIN prefixes a ON a.conv_id = u.conv_id AND a.depth <= u.depth GROUP BY a.path
), lasts AS (
  SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends
  FROM (SELECT conv_id, max_by(path, depth) AS path FROM prefixes GROUP BY conv_id) GROUP BY path
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved::BIGINT AS saved_tokens,
       coalesce(ends, sha256('')) AS ends_sha256
FROM tree JOIN below USING (path) LEFT JOIN lasts USING (path)
"""
